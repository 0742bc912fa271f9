"""Quality rules: how far a document's histograms lie from those of its language."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pubweave.llm.common import slices

#: The classes of ASCII characters; other characters are letters or symbols of their own.
PUNCTUATION, SYMBOLS = "!\"'(),-.:;?", "#*$%&|<>"
CLASSES = ("lower", "upper", "digit", "space", "punctuation", "symbol", "other ASCII", "other letter", "other")
_TABLE = np.full(128, CLASSES.index("other ASCII"), np.uint8)
for _i, _chars in enumerate(("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t\n\v\f\r", PUNCTUATION, SYMBOLS)):
    _TABLE[np.frombuffer(_chars.encode(), np.uint8)] = _i


@dataclass
class Params:
    #: Common words of a language; all others share one bin.
    common: int = 50
    #: Least lengths for a verdict by characters and by words; shorter documents pass.
    min_chars: int = 200
    min_words: int = 50
    #: Largest Jensen-Shannon distances (square roots of divergences in bits, 0 to 1) that pass.
    max_class_distance: float = 0.3
    max_word_distance: float = 0.45
    #: The fixed base rules.
    base_min_words: int = 50
    base_max_repeat_percent: int = 50


def char_classes(text: str) -> np.ndarray:
    """Characters of the whole text by class."""
    cp = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    ascii_only = cp < 128
    out = np.bincount(_TABLE[cp[ascii_only]], minlength=len(CLASSES))
    rest = cp[~ascii_only]
    if len(rest):
        kinds, n = np.unique(rest, return_counts=True)
        letters = sum(int(k) for c, k in zip(kinds.tolist(), n, strict=True) if chr(c).isalpha())
        out[-2] += letters
        out[-1] += len(rest) - letters
    return out


def words_of(text: str | None) -> list[bytes]:
    """Runs of anything but the six ASCII white-space characters, in UTF-8."""
    return (text or "").encode("utf-8", "replace").split()


def repeated_words(words: list[bytes], width: int = 3) -> int:
    """Words inside windows of ``width`` words that occur twice or more, each word once."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    index: dict[bytes, int] = {}
    ids = np.array([index.setdefault(w, len(index)) for w in words], np.int64)
    code = ids[:n].copy()
    for k in range(1, width):  # pairs get numbers below the number of words, so nothing overflows
        code = np.unique(code * len(index) + ids[k : k + n], return_inverse=True)[1]
    again = np.flatnonzero(np.bincount(code)[code] > 1)
    covered = np.zeros(len(words), bool)
    for k in range(width):
        covered[again + k] = True
    return int(covered.sum())


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of a whole text."""
    text = text or ""
    words = words_of(text)
    spaces = sum(map(text.count, " \t\n\v\f\r"))
    lines = [x for x in text.split("\n") if x.strip(" \t\v\f\r")]
    return len(words), len(text) - spaces, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(words)


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance of two histograms, in bits: 0 for equal ones, 1 for disjoint ones."""
    if not p.sum() or not q.sum():
        return 0.0
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    part = lambda x: float((x[x > 0] * np.log2(x[x > 0] / m[x > 0])).sum())
    return float(np.sqrt(max(0.0, (part(p) + part(q)) / 2)))


def references(df: DataFrame, params: Params | None = None, text_col: str = "text", lang_col: str | None = "lang") -> dict[str, tuple[np.ndarray, dict[bytes, int], np.ndarray]]:
    """By language (null: ``und``): its character classes, its common words with their
    places, and the histogram of these words and of all others together.

    All documents are counted: each task adds up its own, Spark sums by language and
    word. The driver gets ``common`` words and the classes of each language.
    """
    p = params or Params()

    def counts(batches: Iterator[pa.RecordBatch], most: int = 200_000) -> Iterator[pa.RecordBatch]:
        words: dict[str, Counter] = defaultdict(Counter)
        classes: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(len(CLASSES), np.int64))

        def out() -> pa.RecordBatch:
            rows = [(k, b"w" + w, n) for k, c in words.items() for w, n in c.items()] + [(k, b"c%d" % i, int(n)) for k, c in classes.items() for i, n in enumerate(c)]
            words.clear()
            classes.clear()
            return pa.record_batch([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.int64())], ["lang", "item", "n"])

        for batch in slices(batches):
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = (text or "").encode("utf-8", "replace").lower().split()
                words[lang].update(own)
                words[lang][b""] += len(own)  # no word is empty: the total
                classes[lang] += char_classes(text or "")
            if sum(map(len, words.values())) > most:
                yield out()
        yield out()

    lang = F.coalesce(F.col(lang_col), F.lit("und")) if lang_col else F.lit("und")
    rows = df.select(lang.alias("lang"), F.col(text_col).alias("text")).mapInArrow(counts, "lang string, item binary, n long").groupBy("lang", "item").agg(F.sum("n").alias("n"))
    top = Window.partitionBy("lang", F.substring("item", 1, 1)).orderBy(F.desc("n"), "item")
    kept = rows.withColumn("r", F.row_number().over(top)).filter(F.col("r") <= max(p.common + 1, len(CLASSES))).collect()
    out = {}
    for k in {r["lang"] for r in kept}:
        own = {bytes(r["item"]): r["n"] for r in kept if r["lang"] == k}
        classes = np.array([own.get(b"c%d" % i, 0) for i in range(len(CLASSES))], float)
        words = sorted((w for w in own if w[:1] == b"w" and w != b"w"), key=lambda w: (-own[w], w))[: p.common]
        known = [own[w] for w in words]
        out[k] = classes, {w[1:]: i for i, w in enumerate(words)}, np.array([*known, own.get(b"w", 0) - sum(known)], float)
    return out


def distances(text: str | None, words: list[bytes], reference, p: Params) -> tuple[float | None, float | None]:
    """(by character classes, by common words); None where the text is too short to tell."""
    classes, places, usual = reference
    by_class = js_distance(char_classes(text), classes) if text and len(text) >= p.min_chars else None
    if len(words) < p.min_words:
        return by_class, None
    found = np.zeros(len(usual))
    for w, n in Counter(words).items():
        found[places.get(w, len(usual) - 1)] += n
    return by_class, js_distance(found, usual)


def judge(df: DataFrame, params: Params | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = "lang") -> DataFrame:
    """One row per input row: id, the base counts, base_failed, kept and both distances.

    ``kept`` is false for documents that fail the base rules; others are kept unless one
    of their distances to the references of their language is above its limit. A
    distance is null, and admits, where the text is shorter than its guard. Null text
    counts as empty, and a null language as ``und``, with whatever is labelled so. Repeated rows
    have a row each, and count each in the references. Of equally common words the first in
    byte order are in a reference. An empty table gives no rows.
    """
    p = params or Params()
    usual = references(df, p, text_col, lang_col)

    def verdicts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for lang, text in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                base = base_counts(text)
                failed = base[0] < p.base_min_words or 100 * base[4] > p.base_max_repeat_percent * base[0]
                a, b = distances(text, (text or "").encode("utf-8", "replace").lower().split(), usual[lang], p)
                kept = not failed and (a is None or a <= p.max_class_distance) and (b is None or b <= p.max_word_distance)
                rows.append((*base, failed, kept, a, b))
            columns = list(zip(*rows, strict=True)) or [()] * 9
            kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] * 2
            yield pa.record_batch([batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]], names)

    names = [id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "class_distance", "word_distance"]
    kind = f"`{id_col}` {df.schema[id_col].dataType.simpleString()}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, class_distance double, word_distance double"
    lang = F.coalesce(F.col(lang_col), F.lit("und")) if lang_col else F.lit("und")
    return df.select(F.col(id_col), lang.alias("_q_lang"), F.col(text_col).alias("_q_text")).mapInArrow(verdicts, kind)
