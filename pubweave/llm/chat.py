"""Preference formatting of conversations, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _turn(x: Column) -> Column:
    return F.concat(F.lit("<|"), x["role"], F.lit("|>\n"), x["text"], F.lit("\n"))


def _render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _turn), "")


def _spans(turns: Column, trained: str) -> Column:
    """[start, end) of the characters to train on: the texts of the trained role's turns,
    each with its closing line feed, counted from the start of the rendered turns."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:long,end:long>>").alias("spans"))

    def step(acc: Column, x: Column) -> Column:
        end = acc["at"] + F.length(_turn(x))
        own = F.array(F.struct((end - F.length(x["text"]) - 1).cast("long").alias("start"), end.cast("long").alias("end")))
        return F.struct(end.cast("long").alias("at"), F.when(x["role"] == trained, F.concat(acc["spans"], own)).otherwise(acc["spans"]).alias("spans"))

    return F.aggregate(turns, start, step, lambda acc: acc["spans"])


def _turns(df: DataFrame, key: str, out: str) -> DataFrame:
    """An array of a conversation's turns in order; turns of one number by role and text."""
    row = F.struct(F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return df.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("pair_id")).agg(F.sort_array(F.collect_list(row)).alias(out))


def preference_pairs(chosen: DataFrame, rejected: DataFrame, key: str = "pair_id", trained: str = "assistant") -> DataFrame:
    """``formatted`` pairs of two tables (key, turn, role, text), a row per turn.

    Null role or text counts as empty. Turns without a key belong to no pair. A pair
    that lacks one side has that completion empty, and no prompt. Turn numbers order the
    turns and aren't compared, ties go by role and text. A conversation is one row of the
    result, so it must fit into a task; there is no limit of its length. Further columns are
    ignored; empty tables give no rows.
    """
    both = _turns(chosen, key, "_c").join(_turns(rejected, key, "_r"), "pair_id", "full")
    none = F.array().cast("array<struct<turn:long,role:string,text:string>>")
    return formatted(both.select("pair_id", F.coalesce("_c", none).alias("_c"), F.coalesce("_r", none).alias("_r")), trained)


def formatted(both: DataFrame, trained: str = "assistant") -> DataFrame:
    """Rows (pair_id, n_prompt_turns, prompt, chosen, rejected, chosen_spans, rejected_spans), of
    pairs (pair_id, _c, _r) of chosen and rejected turns in order.

    The prompt is the longest run of turns that both sides start with, equal in role and
    text, rendered once; each completion is the rest of its side. The spans are the
    characters of a completion that count in training: those of the ``trained`` role; all
    else, and the whole prompt, is masked.
    """
    same = F.zip_with("_c", "_r", lambda a, b: F.coalesce((a["role"] == b["role"]) & (a["text"] == b["text"]), F.lit(False)))
    differ = F.array_position(same, F.lit(False))
    both = both.withColumn("_n", F.when(differ > 0, differ - 1).otherwise(F.size("_c")).cast("int"))
    rest = lambda c: F.slice(c, F.col("_n") + 1, F.greatest(F.size(c) - F.col("_n"), F.lit(0)))
    both = both.select("pair_id", "_n", F.slice("_c", F.lit(1), F.col("_n")).alias("_p"), rest("_c").alias("_c"), rest("_r").alias("_r"))
    return both.select(
        "pair_id", F.col("_n").cast("long").alias("n_prompt_turns"), _render(F.col("_p")).alias("prompt"), _render(F.col("_c")).alias("chosen"), _render(F.col("_r")).alias("rejected"),
        _spans(F.col("_c"), trained).alias("chosen_spans"), _spans(F.col("_r"), trained).alias("rejected_spans"),
    )


def swapped_pairs(turns: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """Pairs (pair_id, _c, _r) made from a table of conversations, each as the chosen side.

    The rejected side keeps the turns before the last assistant turn, and ends in the last
    assistant turn of the conversation whose number differs in the last bit. A
    conversation without an assistant turn keeps all its turns; a partner without one, or
    missing, adds none. Of several assistant turns of the last number, that with the
    greatest text is the reply, and all turns of that number give way to it. Ids are whole
    numbers. The two conversations are brought together by one grouping.
    """
    own = F.col(id_col).cast("long")
    turn = F.struct(own.alias("id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    both = turns.filter(own.isNotNull()).groupBy(own.bitwiseAND(F.lit(-2).cast("long")).alias("even")).agg(F.sort_array(F.collect_list(turn)).alias("t"))
    side = lambda test: F.transform(F.filter("t", test), lambda x: F.struct(x["turn"].alias("turn"), x["role"].alias("role"), x["text"].alias("text")))
    both = both.select("even", side(lambda x: x["id"] == F.col("even")).alias("a"), side(lambda x: x["id"] != F.col("even")).alias("b"))
    reply = lambda c: F.array_max(F.transform(F.filter(c, lambda x: x["role"] == "assistant"), lambda x: F.struct(x["turn"].alias("turn"), x["text"].alias("text"))))
    both = both.select("even", "a", "b", reply("a").alias("ra"), reply("b").alias("rb"))

    def rejected(c: str, mine: str, other: str) -> Column:
        given = F.struct(F.col(f"{mine}.turn").alias("turn"), F.lit("assistant").alias("role"), F.col(f"{other}.text").alias("text"))
        end = F.when(F.col(other).isNotNull(), F.array(given)).otherwise(F.array().cast("array<struct<turn:long,role:string,text:string>>"))
        return F.when(F.col(mine).isNull(), F.col(c)).otherwise(F.concat(F.filter(c, lambda x: x["turn"] < F.col(f"{mine}.turn")), end))

    pair = lambda i, c, mine, other: F.struct((F.col("even") + i).alias("pair_id"), F.col(c).alias("_c"), rejected(c, mine, other).alias("_r"))
    pairs = both.select(F.inline(F.array(pair(0, "a", "ra", "rb"), pair(1, "b", "rb", "ra"))))
    return pairs.filter(F.size("_c") > 0)
