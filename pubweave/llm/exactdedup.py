"""Exact de-duplication with a cuckoo index of live digests."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from pubweave.llm.common import slices, without_repeats

_DIGEST, _KEEP, _N = "_xd_digest", "_xd_keep", "_xd_n"


class CuckooIndex:
    """Live digests with a value each, in buckets of four.

    A slot is found by a 16-bit tag in one of two buckets; a tag hit is verified
    against the digest kept in the slot. Entries can be deleted. When an insertion
    finds no room after ``kicks`` moves, the table doubles and is refilled from the
    stored digests, so no entry is ever lost.
    """

    SLOTS = 4

    def __init__(self, buckets: int = 64, kicks: int = 128):
        self.kicks, self.size = kicks, 0
        self._clear(buckets)

    def _clear(self, buckets: int) -> None:
        self.mask = buckets - 1
        self.tags: list[list[int]] = [[] for _ in range(buckets)]
        self.content: list[list[tuple]] = [[] for _ in range(buckets)]

    def _place(self, digest: bytes) -> tuple[int, int, int]:
        tag = int.from_bytes(digest[:2], "big")
        first = int.from_bytes(digest[2:10], "big") & self.mask
        return tag, first, first ^ self._hop(tag)

    def _hop(self, tag: int) -> int:
        return ((tag + 1) * 0x9E3779B1) & self.mask

    def _find(self, digest: bytes) -> tuple[int, int] | None:
        tag, first, second = self._place(digest)
        for b in (first, second):
            if tag in self.tags[b]:
                for slot, (held, _) in enumerate(self.content[b]):
                    if held == digest:
                        return b, slot
        return None

    def get(self, digest: bytes):
        at = self._find(digest)
        return None if at is None else self.content[at[0]][at[1]][1]

    def delete(self, digest: bytes) -> bool:
        at = self._find(digest)
        if at is None:
            return False
        self.tags[at[0]].pop(at[1])
        self.content[at[0]].pop(at[1])
        self.size -= 1
        return True

    def insert(self, digest: bytes, value) -> None:
        """Adds a digest that is not live."""
        entry = (digest, value)
        while entry:
            entry = self._try(entry)
            if entry:
                self._grow()
        self.size += 1

    def _try(self, entry: tuple) -> tuple | None:
        """Places the entry; returns the entry left over when there is no room."""
        tag, b, other = self._place(entry[0])
        if len(self.tags[b]) >= self.SLOTS:
            b = other
        for k in range(self.kicks):
            if len(self.tags[b]) < self.SLOTS:
                self.tags[b].append(tag)
                self.content[b].append(entry)
                return None
            slot = k % self.SLOTS
            self.tags[b][slot], tag = tag, self.tags[b][slot]
            self.content[b][slot], entry = entry, self.content[b][slot]
            b ^= self._hop(tag)
        return entry

    def _grow(self) -> None:
        stored, buckets = list(self), 2 * (self.mask + 1)
        while True:
            self._clear(buckets)
            if not any(self._try(x) for x in stored):
                return
            buckets *= 2

    def __iter__(self) -> Iterator[tuple]:
        for bucket in self.content:
            yield from bucket


def _later(a, b):
    """The larger id; null is below any id."""
    return b if a is None or (b is not None and b > a) else a


def _merge(limit: int, by_digest: bool, id_type: pa.DataType):
    """Merges rows of equal digests. At most ``limit`` digests are live: then all are
    given out, at once or, for rows sorted by digest, at the next new digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = CuckooIndex()

        def out() -> pa.RecordBatch:
            rows = list(index)
            return pa.record_batch([pa.array([d for d, _ in rows], pa.binary()), pa.array([v[0] for _, v in rows], id_type), pa.array([v[1] for _, v in rows], pa.int64())], [_DIGEST, _KEEP, _N])

        last = None
        for batch in slices(batches, 4096):
            for digest, keep, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if index.size >= limit and (not by_digest or digest != last):
                    yield out()
                    index = CuckooIndex()
                live = index.get(digest)
                if live is None:
                    index.insert(digest, (keep, n))
                else:  # the live copy goes, the later of the two takes its place
                    index.delete(digest)
                    index.insert(digest, (_later(live[0], keep), live[1] + n))
                last = digest
        if index.size:
            yield out()

    return run


def _id(df: DataFrame, id_col: str) -> Column:
    """Ids as they are compared: text by its code points, all others as long."""
    return F.col(id_col).cast("string" if isinstance(df.schema[id_col].dataType, StringType) else "long")


def copy_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = 200_000) -> DataFrame:
    """Groups of identical texts: (_xd_digest, _xd_keep, _xd_n), one row per distinct
    text, with the largest id and the number of rows. Null text counts as empty.

    Every input task merges its own rows first, so a text that a third of all rows
    share reaches the shuffle as one row per task.
    """
    rows = df.select(digest_of(text_col).alias(_DIGEST), _id(df, id_col).alias(_KEEP), F.lit(1).cast("long").alias(_N))
    text_ids = isinstance(df.schema[id_col].dataType, StringType)
    id_type, kind = pa.string() if text_ids else pa.int64(), f"{_DIGEST} binary, {_KEEP} {'string' if text_ids else 'long'}, {_N} long"
    part = rows.mapInArrow(_merge(limit, False, id_type), kind)
    return part.repartition(_DIGEST).sortWithinPartitions(_DIGEST).mapInArrow(_merge(limit, True, id_type), kind)


def digest_of(text_col: str):
    return F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))


def exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical; null counts as empty. The row with the largest id
    of a group stays (text ids by code points, others as long); a null id is below any other. Rows repeated under one id stand or
    fall together. An empty table gives no rows; further columns are ignored.
    """
    groups = copy_groups(df, id_col, text_col)
    rows = df.select(F.col(id_col).alias(id_col), digest_of(text_col).alias(_DIGEST))
    return rows.join(groups, _DIGEST).select(
        id_col,
        F.col(_KEEP).alias("keep_id"),
        F.col(_N).alias("group_size"),
        _id(df, id_col).eqNullSafe(F.col(_KEEP)).alias("kept"),
        F.lower(F.hex(_DIGEST)).alias("text_sha256"),
    )


def drop_exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per distinct text, with all its columns: of the rows that ``exact_duplicates``
    keeps, those repeated under one id (or none) count once."""
    df = without_repeats(df, id_col, text_col)
    groups = copy_groups(df, id_col, text_col).select(_DIGEST, _KEEP)
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), _id(df, id_col).alias("id"), digest_of(text_col).alias("digest"))
    same = (F.col("digest") == F.col(_DIGEST)) & F.col("id").eqNullSafe(F.col(_KEEP))
    return rows.join(groups, same, "left_semi").select("row.*")
