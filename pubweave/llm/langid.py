"""Language identification with interpolated Kneser-Ney character models."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pubweave.llm.common import runs, slices, turn
from pubweave.llm.ngrams import Tables, counted

#: Bits of a symbol in a packed n-gram; the rarest letters of larger alphabets share one symbol.
BITS = 12
OTHER, GAP = 0, 1


@dataclass
class Params:
    order: int = 4
    #: Rows that the models are fitted on, by language, in expectation; a fifth of them calibrates.
    docs_per_lang: int = 1500
    #: Share of calibration texts whose cross-entropy the rejection level must admit. A few
    #: texts of a wrong label can't move it, and those that another language fits better don't count.
    admit: float = 0.99
    #: Nats per symbol above that level, and nats for a single symbol, which fade with the root of the length.
    slack: float = 0.6
    spread: float = 6.0


def letter_table() -> np.ndarray:
    """For each code point, that of its lower-case letter, or 32 if it isn't a letter."""
    table = np.full(sys.maxunicode + 1, 32, np.int32)
    for cp in range(sys.maxunicode + 1):
        c = chr(cp)
        if c.isalpha():
            low = c.lower()
            table[cp] = ord(low) if len(low) == 1 else cp
    return table


_LETTERS: list[np.ndarray] = []


def letters_of(text: str) -> np.ndarray:
    """Lower-case letters of the whole text, each run of anything else as one gap (32)."""
    if not _LETTERS:
        _LETTERS.append(letter_table())
    out = _LETTERS[0][np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)]
    gap = out == 32
    return out[~(gap & np.r_[False, gap[:-1]])] if len(out) else out


#: Candidates for the sharpness of scores.
SHARPNESS = (0.25, 0.5, 1, 2, 4, 8, 16)


class Models:
    """All languages' Kneser-Ney models, and what calibration has set: the rejection level of
    each language, and how sharply scores follow the entropies."""

    def __init__(self, langs: list[str], alphabet: np.ndarray, counts: list[tuple[np.ndarray, np.ndarray]], order: int):
        self.langs, self.order, self.alphabet = langs, order, np.sort(alphabet)
        self.tables = Tables(counts, order, BITS, len(self.alphabet) + 2, kneser_ney=True)
        self.level = np.full(len(langs), np.inf)
        self.sharpness = 1.0

    def symbols(self, text: str) -> np.ndarray:
        found = letters_of(text)
        at = np.minimum(np.searchsorted(self.alphabet, found), max(len(self.alphabet) - 1, 0))
        known = self.alphabet[at] == found if len(self.alphabet) else np.zeros(len(found), bool)
        return np.where(found == 32, GAP, np.where(known, at + 2, OTHER)).astype(np.uint16)

    def entropies(self, symbols: list[np.ndarray]) -> np.ndarray:
        """Nats per symbol, by text and language."""
        return self.tables.entropies(symbols, GAP)

    def scores(self, ce: np.ndarray, sizes: np.ndarray, sharpness: float) -> np.ndarray:
        """Shares of the languages by text, of evidence that grows with the root of the length."""
        z = -ce * np.sqrt(sizes)[:, None] * sharpness
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)

    def predict(self, texts: list[str | None], p: Params) -> list[tuple[str, float, bool, float | None]]:
        """(language, score, rejected, nats per symbol) of each text."""
        if not self.langs:
            return [("und", 0.0, True, None)] * len(texts)
        symbols = [self.symbols(t or "") for t in texts]
        sizes = np.fromiter(map(len, symbols), np.int64, len(symbols))
        ce = self.entropies(symbols)
        best = ce.argmin(1)
        score = self.scores(ce, sizes, self.sharpness).max(1)
        low = ce[np.arange(len(best)), best]
        rejected = low > self.level[best] + p.spread / np.sqrt(np.maximum(sizes, 1))
        none = np.array([not (s != GAP).any() for s in symbols], bool)
        return [("und", 0.0, True, None) if n else (self.langs[b], float(s), bool(r), float(x)) for n, b, s, r, x in zip(none, best, score, rejected, low, strict=True)]


def held_out(id_col: str = "doc_id") -> Column:
    """True for the fourth of the ids that no model learns from; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def fit(df: DataFrame, params: Params | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Models:
    """Models of every language in ``lang_col``, from rows that aren't held out.

    ``docs_per_lang`` bounds the sample: rows are chosen by a hash of the id, at a rate
    that the number of labelled rows of their language sets, and whole texts are counted.
    N-grams are counted and calibration texts scored in Spark; the driver gets one row per
    kind of n-gram and language, and three numbers per calibration text, which the sample
    bounds. Rows without text or language are left out.
    """
    p = params or Params()
    rows = df.filter(~held_out(id_col) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    totals = {r["lang"]: r["n"] for r in rows.groupBy(F.col(lang_col).alias("lang")).agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(totals)
    if not langs:
        return Models([], np.empty(0, np.int32), [], p.order)
    hashed = lambda salt: F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit(salt)), F.lit(1_000_000))
    rate = F.element_at(F.create_map(*[x for k, n in totals.items() for x in (F.lit(k), F.lit(min(1e6, 1e6 * p.docs_per_lang / n)))]), F.col(lang_col))
    sample = rows.filter(hashed("sample") < rate).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), (hashed("part") < 200_000).alias("later"))

    def letters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with turn("langid"):
            for batch in slices(batches):
                found = [letters_of(t) for t in batch.column(0).to_pylist()]
                cp, n = np.unique(np.concatenate(found), return_counts=True) if found else (np.empty(0, np.int32), np.empty(0, np.int64))
                yield pa.record_batch([pa.array(cp.astype(np.int64)), pa.array(n.astype(np.int64))], ["cp", "n"])

    top = sample.select("text").mapInArrow(letters, "cp long, n long").groupBy("cp").agg(F.sum("n").alias("n")).filter("cp <> 32").orderBy(F.desc("n"), "cp").limit((1 << BITS) - 3).collect()
    alphabet = Models([], np.array([r["cp"] for r in top], np.int32), [], p.order)

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            langs_in, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lang in sorted(set(langs_in)):
                codes, n = counted([alphabet.symbols(t) for t, k in zip(texts, langs_in, strict=True) if k == lang], p.order, BITS, GAP)
                yield pa.record_batch([pa.array([lang] * len(codes), pa.string()), pa.array(codes.view(np.int64)), pa.array(n.astype(np.int64))], ["lang", "gram", "n"])

    got = sample.filter("not later").select("lang", "text").mapInArrow(grams, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    lang_of, gram, n = np.array(got["lang"].to_pylist(), object), got["gram"].to_numpy().view(np.uint64), got["n"].to_numpy()
    counts = []
    for lang in langs:
        own = np.flatnonzero(lang_of == lang)
        own = own[np.argsort(gram[own])]
        counts.append((gram[own], n[own]))
    models = Models(langs, alphabet.alphabet, counts, p.order)
    _calibrate(sample.filter("later").select("lang", "text"), models, p)
    return models


def _calibrate(later: DataFrame, models: Models, p: Params) -> None:
    """Sets levels and sharpness from labelled texts that the models haven't seen."""
    shared = later.sparkSession.sparkContext.broadcast(models)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        place = {k: i for i, k in enumerate(m.langs)}
        for batch in slices(batches):
            truth = np.array([place[k] for k in batch.column(0).to_pylist()], np.int64)
            symbols = [m.symbols(t) for t in batch.column(1).to_pylist()]
            sizes, ce, row = np.fromiter(map(len, symbols), np.int64, len(symbols)), m.entropies(symbols), np.arange(len(truth))
            own = ce[row, truth] - p.spread / np.sqrt(np.maximum(sizes, 1))
            loss = [(-np.log(np.maximum(m.scores(ce, sizes, t)[row, truth], 1e-300))).tolist() for t in SHARPNESS]
            columns = [batch.column(0), pa.array(own), pa.array(ce.argmin(1) == truth), pa.array(list(zip(*loss, strict=True)), pa.list_(pa.float64()))]
            yield pa.record_batch(columns, ["lang", "own", "first", "loss"])

    found = later.mapInArrow(measured, "lang string, own double, first boolean, loss array<double>").collect()
    shared.unpersist()
    if not found:
        return
    for i, lang in enumerate(models.langs):
        own = [r["own"] for r in found if r["lang"] == lang and r["first"]]
        if own:
            models.level[i] = np.quantile(own, p.admit) + p.slack
    models.sharpness = SHARPNESS[int(np.mean([r["loss"] for r in found], 0).argmin())]


def identify(df: DataFrame, models: Models, params: Params | None = None, text_col: str = "text") -> DataFrame:
    """All rows and columns, plus lang_pred, score (0 to 1), rejected and nats_per_symbol.

    The language of the lowest cross-entropy per symbol of the whole text; ``und`` with
    score 0, rejected, where the text is null or has no letter. ``rejected`` marks texts
    whose cross-entropy is above the level calibrated for their language. Columns of the
    input named like an added one are replaced; an empty table gives no rows. Repeated rows
    have one verdict; of languages that fit equally well the first by name is predicted.
    """
    p = params or Params()
    shared = df.sparkSession.sparkContext.broadcast(models)

    @F.pandas_udf("lang_pred string, score double, rejected boolean, nats_per_symbol double")
    def predicted(texts):
        import pandas as pd

        with turn("langid"):
            rows = [r for run in runs([None if t is None or t != t else t for t in texts]) for r in shared.value.predict(run, p)]
            return pd.DataFrame(rows, columns=["lang_pred", "score", "rejected", "nats_per_symbol"])

    new = ["lang_pred", "score", "rejected", "nats_per_symbol"]
    kept = [F.col(f"`{c}`") for c in df.columns if c not in new]
    found = df.select(F.struct(*kept).alias("row") if kept else F.lit(None).alias("row"), predicted(F.col(text_col)).alias("found"))
    return found.select(*([F.col("row.*")] if kept else []), "found.*")


def keep_identified(df: DataFrame, params: Params | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows whose text isn't rejected, in the columns of the input. Rows without a letter go, null
    texts among them; repeated rows stay or go together; of languages that fit equally well the
    first by name counts. An empty table gives no rows."""
    models = fit(df, params, id_col, text_col, lang_col)
    rows = identify(df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.col(text_col).alias("text")), models, params)
    return rows.filter("not rejected").select("row.*")
