"""SimHash near-duplicates over a byte-position inverted index with count filtering."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pubweave.llm.common import checkpointed, components

#: Fingerprints of at most this many differing bits are linked.
RADIUS = 3
#: Such a pair differs in at most three of its eight bytes, so it shares at least five.
BYTES, LEAST_SHARED = 8, 8 - RADIUS
#: Longest posting list whose pairs are tallied; a longer one is split by another position.
LONGEST = 1024
_LOW, _HIGH = np.uint64(0x7F7F7F7F7F7F7F7F), np.uint64(0x8080808080808080)
#: The sign that each byte gives each of eight bits.
_SIGNS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little") * 2.0 - 1.0


def first_positions(depth: int) -> list[tuple[int, ...]]:
    """The sets of byte positions that the first ``depth`` of any five shared positions make.
    At depth 1 these are four positions (a pair that shares five bytes shares one of the first
    four); each further position splits a list by another shared byte."""
    return list(combinations(range(BYTES - LEAST_SHARED + depth), depth))


def deeper(positions: tuple[int, ...]) -> list[tuple[int, ...]]:
    """The sets that go one position further."""
    return [(*positions, p) for p in range(positions[-1] + 1, BYTES - LEAST_SHARED + len(positions) + 1)]


def _nibbles(positions: tuple[int, ...]) -> int:
    """Byte positions as a set of half bytes, in sixteen bits: the number of a posting set."""
    return sum(0b11 << 2 * p for p in positions)


def _deepest(positions: tuple[int, ...]) -> list[int]:
    """Below five bytes: of the six half bytes left, a pair shares three as only three bits may differ."""
    left = [2 * p + h for p in range(BYTES) if p not in positions for h in (0, 1)]
    return [_nibbles(positions) | sum(1 << h for h in three) for three in combinations(left, len(left) - RADIUS)]


def _mask(number: int) -> int:
    """The bits at a set's positions, as a signed 64-bit number."""
    bits = sum(0xF << (4 * h) for h in range(2 * BYTES) if number >> h & 1)
    return bits - (1 << 64) if bits >> 63 else bits


def fingerprint(text: str | None, width: int = 3) -> int:
    """Unsigned 64-bit SimHash of the word shingles of a text; zero for no words."""
    words = (text or "").encode("utf-8", "replace").lower().split()  # both ASCII only, as the word rule asks
    if not words:
        return 0
    joined, n = b" ".join(words), len(words)
    if n < width:
        hashes = [xxhash.xxh64_intdigest(joined, 42)]
    else:
        lengths = np.fromiter(map(len, words), np.int64, n)
        ends = np.cumsum(lengths + 1) - 1
        starts = (ends - lengths)[: n - width + 1].tolist()
        hashes = [xxhash.xxh64_intdigest(joined[a:b], 42) for a, b in zip(starts, ends[width - 1 :].tolist(), strict=True)]
    h = np.array(hashes, np.uint64)
    counts = np.zeros(64, np.int64)
    for k in range(0, len(h), 1 << 16):
        counts += np.unpackbits(h[k : k + (1 << 16)].view(np.uint8), bitorder="little").reshape(-1, 64).sum(0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * counts > len(h)).tolist())


def weighted_fingerprints(hashes: np.ndarray, n: int) -> np.ndarray:
    """``n`` unsigned 64-bit SimHashes of a set of shingle hashes, in each of which every shingle votes on every bit.

    A shingle has a weight of its own at every byte position, u ** -4 with u even in (0, 1), so
    a few shingles decide a byte, and its bits agree or differ together: sets of Jaccard
    similarity 0.8 share a byte with a chance of 0.76 at least, where equal votes leave 0.27. ``hashes`` come sorted.
    """
    rng = np.random.default_rng(20240101)
    xor, times = rng.integers(0, 1 << 64, (2, n * BYTES, 1), np.uint64)
    votes = np.zeros((n * BYTES, 8))
    for k in range(0, len(hashes), 1024):
        x = (hashes[k : k + 1024] ^ xor) * (times | np.uint64(1))
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(32)
        weights = 2.0**56 / ((x >> np.uint64(8)) + np.uint64(1))
        np.square(np.square(weights, out=weights), out=weights)
        votes += (weights[:, None, :] @ _SIGNS.take((x & np.uint64(0xFF)).astype(np.int64), axis=0))[:, 0, :]
    return np.packbits(votes > 0, axis=1, bitorder="little").reshape(n, BYTES).view("<u8")[:, 0]


def share_bytes(a: Column, b: Column) -> Column:
    """Whether fingerprints at one place of two arrays have ``LEAST_SHARED`` positional bytes in common."""
    fold = lambda x, shift: F.transform(x, lambda v: v.bitwiseOR(F.shiftrightunsigned(v, shift)))
    # the lowest bit of a byte tells whether any of its bits is set
    x = fold(fold(fold(F.zip_with(a, b, lambda p, q: p.bitwiseXOR(q)), 4), 2), 1)
    return F.exists(x, lambda v: F.bit_count(v.bitwiseAND(F.lit(0x0101010101010101))) <= BYTES - LEAST_SHARED)


def simhash(text: Column) -> Column:
    """The fingerprint of a whole text, as a signed 64-bit number."""

    @F.pandas_udf("long")
    def found(texts: pd.Series) -> pd.Series:
        return pd.Series(np.fromiter((fingerprint(t) for t in texts), np.uint64, len(texts)).view(np.int64))

    return found(text)


def shared_bytes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many positional bytes of each pair are equal."""
    x = a ^ b
    return BYTES - np.bitwise_count(((x & _LOW) + _LOW | x) & _HIGH)


def list_links(lists: np.ndarray, fps: np.ndarray, radius: int | None = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of the linked pairs of posting lists; ``lists`` numbers each row's list,
    whose rows stand together. All pairs of a list are tallied, those a step of k apart at
    once over all lists; pairs that share enough bytes are verified by their bits, if there is a radius."""
    ends = np.searchsorted(lists, lists, "right")
    i, step, found = np.arange(len(fps)), 1, [(np.empty(0, np.int64),) * 2]
    while True:
        i = i[i + step < ends[i]]
        if not len(i):
            break
        near = i[shared_bytes(fps[i], fps[i + step]) >= LEAST_SHARED]
        if radius is not None:
            near = near[np.bitwise_count(fps[near] ^ fps[near + step]) <= radius]
        found.append((near, near + step))
        step += 1
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def local_roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of n places, the first one that the links (i, j) lead to."""
    root = np.arange(n)
    while len(i):
        low, before = np.minimum(root[i], root[j]), root.copy()
        np.minimum.at(root, i, low)
        np.minimum.at(root, j, low)
        root = root[root]
        if (root == before).all():
            break
    return root


def _walk_lists(longest: int | None, radius: int | None = RADIUS):
    """Posting lists (q, key, fp) arrive in order, over batch borders. Rows (q, a, b): links that
    keep a list's connections, one per fingerprint at most, instead of all its pairs, with q
    null; and, as (q, fp, fp), the members of longer lists, which are not held."""
    most = np.inf if longest is None else longest

    def out(rows: np.ndarray, passed: bool = False) -> pa.RecordBatch:
        """Of whole lists, or of a part of a list that is passed on."""
        number = np.r_[0, np.cumsum(np.any(rows[1:, :2] != rows[:-1, :2], axis=1))]
        long = (np.bincount(number)[number] > most) | passed
        fps = np.ascontiguousarray(rows[:, 2]).view(np.uint64)
        own, lists = fps[~long], number[~long]
        root = local_roots(len(own), *list_links(lists, own, radius))
        far = root != np.arange(len(own))
        a, b = np.concatenate([fps[long], own[root[far]]]), np.concatenate([fps[long], own[far]])
        q = np.r_[rows[long, 0], np.zeros(far.sum(), np.int64)]
        return pa.record_batch([pa.array(q, pa.int64(), mask=np.arange(len(a)) >= long.sum()), pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["q", "a", "b"])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, None
        for batch in batches:
            rows = np.column_stack([c.to_numpy() for c in batch.columns]).astype(np.int64)
            if not len(rows):
                continue
            starts = np.flatnonzero(np.any(rows[1:, :2] != rows[:-1, :2], axis=1)) + 1
            if last is not None and (rows[0, :2] != last).any():
                starts = np.r_[0, starts]
            last = rows[-1, :2]
            if len(starts):
                going_on, whole, rows = np.split(rows, [starts[0], starts[-1]])
                if size > most and len(going_on):
                    yield out(going_on, True)
                elif size <= most:
                    whole = np.vstack([*held, going_on, whole])
                if len(whole):
                    yield out(whole)
                held, size = [], 0
            held.append(rows)
            size += len(rows)
            if size > most:
                yield out(np.vstack(held), True)
                held = []
        if held:
            yield out(np.vstack(held))

    return walk


def fingerprint_links(fps: DataFrame, fp_col: str = "fp", longest: int = LONGEST, depth: int | None = None, radius: int | None = RADIUS) -> DataFrame:
    """Links (a, b) among distinct fingerprints that connect whatever lies within
    ``RADIUS`` bits of each other, directly or over further links.

    The inverted index lists fingerprints by positional bytes. A pair within the radius
    shares five bytes at least, so it meets in a list of its first shared one, of its first
    two, and so on. Lists of more than ``longest`` members are not held: they are split by
    the next shared byte, and beyond five by half bytes, which leaves 4,096 members at most.
    ``depth`` is the number of bytes to begin with; by default as many as leave 64 members to
    a list on average, as shallower ones would all be split. In each list the shared bytes of
    every pair are tallied, and pairs that reach five are verified.

    ``radius`` None: the tally alone links, five shared bytes or more. A list by five
    bytes then needs no tally: each member is linked with its first one, however many there are.
    """
    spark = fps.sparkSession
    if depth is None:
        n = fps.count()
        depth = next((d for d in range(1, LEAST_SHARED) if n <= 64 * 256**d), LEAST_SHARED - 1)
    sets = first_positions(depth)
    every = F.array(*[F.struct(F.lit(_nibbles(s)).cast("long").alias("q"), F.lit(_mask(_nibbles(s))).alias("mask")) for s in sets])
    lists, links = fps.select(F.explode(every).alias("s"), F.col(fp_col).alias("fp")).select("s.q", "s.mask", "fp"), None
    while True:
        keyed = lists.select("q", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")
        if radius is None and depth == LEAST_SHARED:
            first = keyed.groupBy("q", "key").agg(F.min("fp").alias("a"))
            own = checkpointed(keyed.join(first, ["q", "key"]).filter("a <> fp").select("a", F.col("fp").alias("b")))
            return own if links is None else links.union(own)
        rows = keyed.repartition("q", "key").sortWithinPartitions("q", "key", "fp")
        # written out, so that the links and the members passed on come from one walk
        found = checkpointed(rows.mapInArrow(_walk_lists(longest if depth <= LEAST_SHARED else None, radius), "q long, a long, b long"))
        own, long = found.filter("q is null").select("a", "b"), found.filter("q is not null").select("q", F.col("a").alias("fp"))
        links = own if links is None else links.union(own)
        if depth > LEAST_SHARED or long.isEmpty():
            return links
        below = [(_nibbles(s), q) for s in sets for q in (map(_nibbles, deeper(s)) if depth < LEAST_SHARED else _deepest(s))]
        table = spark.createDataFrame([(q, child, _mask(child)) for q, child in below], "q long, child long, mask long")
        lists = long.join(F.broadcast(table), "q").select(F.col("child").alias("q"), "mask", "fp")  # 1,120 rows at most
        sets, depth = [d for s in sets for d in deeper(s)] if depth < LEAST_SHARED else [], depth + 1


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, fingerprint (16 hex digits), component_id.

    component_id is the smallest id that links between fingerprints reach, the row's own
    included. Null and empty texts have fingerprint zero and are linked like any other.
    Copies collapse to one fingerprint before any comparison. Null ids are ignored in the
    minimum, and are given a component all the same. An empty table gives no rows.
    """
    rows = checkpointed(df.select(F.col(id_col).alias("_sh_id"), simhash(F.col(text_col)).alias("fp")))
    distinct = rows.groupBy("fp").agg(F.min("_sh_id").alias("least"))
    roots = components(fingerprint_links(distinct.select("fp")))
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    whole = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    parts = rooted.join(whole, "root").select("fp", "component_id")
    return rows.join(parts, "fp").select(F.col("_sh_id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
