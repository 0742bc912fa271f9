"""Periodic runs of words in a text, and the text with each run's repetitions left out."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pubweave.llm import common

#: A run has at least so many words, and at least so many times its period.
LEAST_WORDS, LEAST_PERIODS = 6, 4


def context_words(lag: int) -> int:
    """Words in a row that must match before a diagonal begins: three for a lag of one, six for two and three,
    twelve for four to seven, and so on. They are more than the lag, and no more than match in the shortest run of that period."""
    return 3 << (lag.bit_length() - 1)


def _named(at: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of contexts that occur more than once, and a number for each different context."""
    _, names, counts = np.unique(codes, return_inverse=True, return_counts=True)
    again = counts[names] > 1
    return at[again], names[again]


def _longer(at: np.ndarray, names: np.ndarray, by: int) -> tuple[np.ndarray, np.ndarray]:
    """Each context together with the one that ends ``by`` words before it."""
    k = np.searchsorted(at, at - by)
    both = np.flatnonzero(at[k] == at - by)
    return _named(at[both], names[both] * (names.max(initial=0) + 1) + names[k[both]])


def beginnings(texts: list[Sequence]) -> list[list[tuple[int, int]]]:
    """By text, (word, lag) where a diagonal begins: the word's context has its last occurrence before that so many words earlier.

    No other occurrence matters. Inside a run, a context that is longer than the period comes again after
    the period and not before, and one that comes again sooner lies in a run of a smaller period. Texts lie one
    after the other; a context overlaps its occurrence at such a lag, so it never meets one of another text.
    """
    number: dict = {}
    flat = np.fromiter((x for k, words in enumerate(texts) for x in (*[number.setdefault(w, len(number)) for w in words], -1 - k)), np.int64)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    at, names = _named(np.arange(len(flat)), flat)
    for _ in range(2):
        at, names = _longer(at, names, 1)
    lag, places, lags = 1, [], []
    while len(at) and lag <= sizes.max() // LEAST_PERIODS:
        by = np.argsort(names, kind="stable")
        place, back = at[by][1:], np.diff(at[by])
        hit = (np.diff(names[by]) == 0) & (back >= lag) & (back < 2 * lag)
        places.append(place[hit])
        lags.append(back[hit])
        at, names = _longer(at, names, context_words(lag))
        lag *= 2
    out: list[list[tuple[int, int]]] = [[] for _ in texts]
    if not lags:
        return out
    place, back = np.concatenate(places), np.concatenate(lags)
    by = np.lexsort((place, back))
    place, back = place[by], back[by]
    first = np.flatnonzero(np.r_[True, (np.diff(back) != 0) | (np.diff(place) != 1)][: len(place)])  # the others are on a diagonal already
    first = first[np.argsort(place[first], kind="stable")]
    starts = np.cumsum(sizes + 1) - (sizes + 1)
    of = np.searchsorted(starts, place[first], "right") - 1
    for text, word, lag in zip(of.tolist(), (place[first] - starts[of]).tolist(), back[first].tolist(), strict=True):
        out[text].append((word, lag))
    return out


def _followed(words: Sequence, begun: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """The runs of a text whose diagonals begin at these (word, lag). A diagonal is a lag under which the last words
    match; each word lengthens the active diagonals that it matches and ends the others. One that ends long enough gives out its run."""
    n, k, i = len(words), 0, 0
    runs: list[tuple[int, int, int]] = []
    active: dict[int, int] = {}  # lag: the first word of the unbroken match

    def end(lag: int, stop: int) -> None:
        start = active.pop(lag) - lag
        if stop - start >= max(LEAST_WORDS, LEAST_PERIODS * lag):
            runs.append((start, stop - start, lag))

    while active or k < len(begun):
        if not active:
            i = begun[k][0]
        elif i == n:
            break
        for lag in [lag for lag in active if words[i - lag] != words[i]]:
            end(lag, i)
        while k < len(begun) and begun[k][0] == i:
            lag = begun[k][1]
            active.setdefault(lag, i - context_words(lag) + 1)
            k += 1
        i += 1
    for lag in list(active):
        end(lag, n)
    return sorted(runs, key=lambda r: (r[0], r[2]))


def runs_of(texts: list[Sequence]) -> list[list[tuple[int, int, int]]]:
    """The runs (start, length, period) of each list of words, by start, then period.

    A run is a stretch with smallest period q (words q apart are the same) of at least
    max(6, 4 q) words that no neighbouring word extends. The words are gone through once, from where the first
    diagonal begins. In a text of few different words short contexts come again everywhere; as a context grows
    with the lag, each word begins one diagonal at most for every doubling of the lag, whatever its text repeats.
    """
    return [_followed(words, begun) if begun else [] for words, begun in zip(texts, beginnings(texts), strict=True)]


def periodic_runs(words: Sequence) -> list[tuple[int, int, int]]:
    """As ``runs_of``, for one text."""
    return runs_of([words])[0]


def collapsed(words: Sequence, runs: list[tuple[int, int, int]]) -> list:
    """The words without those that a run has after its first period."""
    drop = bytearray(len(words))
    for start, length, period in runs:
        drop[start + period : start + length] = b"\1" * (length - period)
    return [w for w, d in zip(words, drop, strict=True) if not d] if runs else list(words)


SCHEMA = "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in common.slices(batches):
        n_words, all_runs, rest = [], [], []
        for texts in common.runs([t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]):
            split = [t.split() for t in texts]  # at the six ASCII white-space characters
            for words, runs in zip(split, runs_of(split), strict=True):
                n_words.append(len(words))
                all_runs.append([dict(zip(("start", "length", "period"), r, strict=True)) for r in runs])
                rest.append(b" ".join(collapsed(words, runs)))
        yield pa.record_batch(
            [batch.column(0), pa.array(n_words, pa.int64()), pa.array(all_runs, pa.list_(_RUN)), pa.array(rest, pa.binary()).cast(pa.string())],
            ["_pr_id", "n_words", "runs", "collapsed"],
        )


def text_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: its id, n_words, runs (start, length, period; by start, then
    period), and collapsed, the words that stay joined by one space.

    Nothing is shuffled: a text is a row of its task. A null or empty text has no words and no runs;
    a very long one is read once. Repeated rows, also of one id or of none, are rows of the
    result each. Other columns are left aside, whatever their names. An empty table gives no rows.
    """
    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(f"`{id_col}`").alias("_pr_id"), F.col(f"`{text_col}`").alias("_pr_text"))
    return rows.mapInArrow(_found, f"_pr_id {kind}, {SCHEMA}").withColumnRenamed("_pr_id", id_col)


def longest_run(runs: str = "runs"):
    """The run of greatest length (ties: smallest start, then period), or null."""
    order = lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("start"), r["period"].alias("period"))
    return F.array_min(F.transform(F.col(runs), order))
