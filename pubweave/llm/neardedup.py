"""Near-duplicates by the Jaccard similarity of word shingles: weighted SimHashes in the byte-position
inverted index of ``simhash`` find what may be similar by a tally of shared bytes, and an exact check follows."""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pubweave.llm import simhash
from pubweave.llm.common import components, remove, stored, text_digest, turn, without_repeats, written

WIDTH = 5
SIMILARITY = 0.8
#: Two texts of similarity 0.8 share fewer than five bytes of a fingerprint with a chance of 0.094 at most
#: (simulated; sets of 4 and 5 shingles, larger ones less), and so in all of them with one in a million.
FINGERPRINTS = 6
#: So many of a text's rarest shared shingles go with each of its rows, to tell whether a pair has met before.
FIRST = 16


def shingle_set(text: str | None) -> np.ndarray:
    """The distinct hashes of a text's shingles, sorted; a text of fewer words, or none, is one shingle."""
    words = (text or "").encode("utf-8", "replace").lower().split()  # words as in simhash.fingerprint
    joined, n = b" ".join(words), len(words)
    if n <= WIDTH:
        return np.array([xxhash.xxh64_intdigest(joined, 42)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1][: n - WIDTH + 1].tolist()
    return np.unique(np.array([xxhash.xxh64_intdigest(joined[a:b], 42) for a, b in zip(starts, ends[WIDTH - 1 :].tolist(), strict=True)], np.uint64))


def fingerprints(hashes: np.ndarray) -> np.ndarray:
    """The text's SimHashes, as signed numbers."""
    return simhash.weighted_fingerprints(hashes, FINGERPRINTS).view(np.int64)


def _longs(text: Column, made) -> Column:
    @F.pandas_udf("array<long>")
    def found(texts: pd.Series) -> pd.Series:
        with turn("neardedup"):
            return pd.Series([made(shingle_set(t)) for t in texts])

    return found(text)


def _similar(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs of which a fingerprint shares enough bytes, as in the index, and whose whole sets have the similarity."""
    of = lambda x: sets.select(F.col("node").alias(x), F.col("fps").alias(f"f{x}"), F.col("s").alias(f"s{x}"))
    both = F.size(F.array_intersect("sa", "sb"))
    met = pairs.join(of("a"), "a").join(of("b"), "b").filter(simhash.share_bytes(F.col("fa"), F.col("fb")))
    return met.filter(both / (F.size("sa") + F.size("sb") - both) >= similarity).select("a", "b")


def rarest_shingles(sets: DataFrame, similarity: float = SIMILARITY, write=written) -> DataFrame:
    """(key, node, size, common, indexed, at, begin): the shingles by which texts (node, s) meet.

    Shingles are ordered by the number of texts that have them, then by hash. A pair of the
    similarity shares so many shingles that the smaller set has one of them among its first
    size - 2 t / (1 + t) size + 1 (``indexed``), and the larger among its first size - t size + 1.
    Shingles of one text alone come first and have no row, so a text that is more than a ninth
    its own is indexed nowhere, whatever crowd shares the rest of it. ``common``: its
    shingles that some other text has too. ``at`` is the place of the key among those under which the text
    has rows, ``begin`` the first ``FIRST`` of these. ``write`` puts the counts of shingles into the shared folder.
    """
    each = sets.select("node", F.explode("s").alias("x"))
    counts = write(each.groupBy("x").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("node")), "shingle-counts")
    alone = counts.filter("n = 1").groupBy("node").agg(F.count(F.lit(1)).alias("alone"))
    own = sets.join(alone, "node", "left").select("node", "s", F.size("s").alias("size"), F.coalesce("alone", F.lit(0)).alias("alone"))
    own = own.filter(F.col("size") - F.col("alone") >= similarity * F.col("size") - 1e-6)
    rows = own.select("node", "size", "alone", F.explode("s").alias("x")).join(counts.filter("n > 1").select("x", "n"), "x")
    first = lambda share: F.col("size") - F.ceil(share * F.col("size") - 1e-6) + 1
    ordered = rows.groupBy("node", "size", "alone").agg(F.array_sort(F.collect_list(F.struct("n", "x"))).alias("xs"))
    some = F.slice("xs", F.lit(1), F.greatest(F.lit(0), first(similarity) - F.col("alone")).cast("int"))
    ordered = ordered.withColumn("xs", some).select("node", "size", "alone", F.slice("xs.x", 1, FIRST).alias("begin"), F.posexplode("xs").alias("pos", "x"))
    indexed = F.col("alone") + F.col("pos") < first(2 * similarity / (1 + similarity))
    return ordered.select(F.col("x.x").alias("key"), "node", "size", (F.col("size") - F.col("alone")).alias("common"), indexed.alias("indexed"), F.col("pos").alias("at"), "begin")


def _may_link(a, b, similarity: float) -> Column:
    """Of two texts under a key, by functions that give their columns: they aren't in one group, the
    smaller is indexed there, and their sizes and shared shingles allow the similarity."""
    smaller = (a("indexed") & (a("size") <= b("size"))) | (b("indexed") & (b("size") <= a("size")))
    most = F.least(a("common"), b("common"))
    return (a("root") != b("root")) & smaller & (most >= similarity * (a("size") + b("size") - most) - 1e-6)


def met_pairs(members: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(a, b) that meet under a key, a being a pivot, and may be linked; hardly any twice.

    Under its later keys a pair isn't made again if both texts have one of their ``FIRST`` shingles in
    common that comes before, and by which they may be linked as well. A pair whose first common shingle comes
    after those is made under each. Rows of the earlier shingle are only done with once
    the pair has met there or is in one group, so no pair is lost.
    """
    side = lambda x: members.select("key", *[F.col(c).alias(f"{x}_{c}") for c in ("node", "root", "size", "common", "indexed", "pivot", "at", "begin")])
    once = (F.col("a_node") < F.col("b_node")) | ~F.col("b_pivot")
    # all rows before ``at`` are indexed where this one is, so an earlier common shingle makes the same pair
    before = lambda x: F.slice(f"{x}_begin", F.lit(1), F.least(F.col(f"{x}_at"), F.lit(FIRST)))
    met = side("a").filter("a_pivot").join(side("b"), "key")
    met = met.filter(once & _may_link(lambda c: F.col(f"a_{c}"), lambda c: F.col(f"b_{c}"), similarity) & ~F.arrays_overlap(before("a"), before("b")))
    return met.select(F.col("a_node").alias("a"), F.col("b_node").alias("b"))


def tried_pairs(members: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The pairs that meet, each once."""
    return met_pairs(members, similarity).distinct()


def similar_groups(texts: DataFrame, text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """Rows (node, root) for the texts that links of ``similarity`` or more put in a group;
    a node is the digest of a text.

    Texts of which the index links a fingerprint with another's go on to the exact check: they
    meet under their rarest shingles, and of what meets, pairs that share enough bytes are verified. In a round some
    pivots under each key are compared with all others there that aren't in their group
    yet, and are done with: first the text that has the least of its own, so the copies of one
    text meet it, then about eight, 64, ... chosen by hash as well, the same under like keys, until
    every two texts under a key are in one group or have been compared. No key's texts
    are numbered or held.
    """
    spark, paths = texts.sparkSession, {}

    def keep(df: DataFrame, name: str) -> DataFrame:
        out, paths[name] = stored(df, name)
        return out

    def done(*names: str) -> None:
        for name in names:
            remove(spark, paths.pop(name))

    rows = texts.select(text_digest(text_col).alias("node"), F.col(text_col).alias("t"))
    prints = keep(rows.select("node", _longs(F.col("t"), fingerprints).alias("fps")).dropDuplicates(["node"]), "fingerprints")
    posts = prints.select("node", F.explode(F.array_distinct("fps")).alias("fp"))
    counts = keep(posts.groupBy("fp").agg(F.count(F.lit(1)).alias("n")), "fingerprint-counts")
    near = simhash.fingerprint_links(counts.select("fp"), radius=None)
    linked = counts.filter("n > 1").select("fp").union(near.select("a")).union(near.select("b")).distinct()
    nodes = keep(prints.join(posts.join(linked, "fp", "left_semi").select("node").distinct(), "node", "left_semi"), "linked-nodes")
    done("fingerprint-counts", "fingerprints")
    sets = keep(rows.join(nodes, "node").dropDuplicates(["node"]).select("node", "fps", _longs(F.col("t"), lambda s: s.view(np.int64)).alias("s")), "shingle-sets")
    done("linked-nodes")
    members = keep(rarest_shingles(sets, similarity, keep), "members").withColumn("root", F.col("node"))
    done("shingle-counts")
    links, roots, step, n_links = None, None, 1, 0
    while True:
        # the text of which others have the largest share comes first: the one that a group of copies was made from
        first = F.max(F.struct((F.col("common") / F.col("size")).alias("share"), "node", "root", "size", "common", "indexed")).alias("top")
        open_ = members.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("root").alias("lo"), F.max("root").alias("hi"), F.max("indexed").alias("any"), first)
        open_ = open_.filter("lo < hi and any").select("key", "n", "top")
        by_hash = F.lit(step > 1) & (F.pmod(F.xxhash64("node", F.lit(step)), F.lit(1 << 30)) * F.col("n") < step << 30)
        is_top = F.col("node") == F.col("top.node")
        beside = F.when(~is_top & _may_link(lambda c: F.col("top")[c], F.col, similarity), F.col("top.node"))
        met = keep(members.join(open_, "key").withColumns({"is_top": is_top, "pivot": by_hash, "beside": beside}).drop("n", "top"), "met")
        done("members")
        if met.isEmpty():
            break
        # each text beside the first one of its key, without a join
        tried = met.filter("beside is not null").select(F.col("beside").alias("a"), F.col("node").alias("b")).distinct()
        if step > 1:
            tried = tried.union(tried_pairs(met, similarity)).distinct()
        n_links += 1
        new = keep(_similar(tried, sets, similarity), f"links-{n_links}")
        if links is None or not new.isEmpty():
            links = new if links is None else links.union(new)
            roots = components(links)
        left = met.filter("not is_top and not pivot").drop("root", "is_top", "pivot", "beside").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        members, step = keep(left, "members"), 8 * step
        done("met")
    groups, _ = stored(sets.limit(0).select("node", F.col("node").alias("root")) if roots is None else roots, "groups")
    done(*list(paths))
    return groups


def drop_near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per group of similar texts, with all its columns: the one with the smallest
    id, or a row without id where none has one. Of rows repeated under that id one stays.
    Null text counts as empty; texts are compared whole; an empty table gives no rows."""
    df = without_repeats(df, id_col, text_col)
    groups = similar_groups(df, text_col)
    rows = df.select(F.col(id_col).alias("_nd_id"), text_digest(text_col).alias("node"))
    rows = rows.join(groups, "node", "left").select("_nd_id", F.col("node").alias("_nd_text"), F.coalesce("root", "node").alias("root"))
    place = F.struct(F.col("_nd_id").isNull(), "_nd_id", "_nd_text")
    least = rows.groupBy("root").agg(F.min(place).alias("least"))
    spare = rows.join(least, "root").filter(place != F.col("least")).select("_nd_id", "_nd_text").distinct()
    return df.join(spare, df[id_col].eqNullSafe(spare["_nd_id"]) & (text_digest(text_col) == spare["_nd_text"]), "left_anti")
