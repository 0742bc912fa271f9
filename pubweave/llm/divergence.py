"""How the word use of sources differs within a language, counted over perfect hashes of the frequent terms."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pubweave.llm.common import slices, written

SEED = 42


@dataclass(frozen=True)
class Params:
    #: Documents of a language that a term must be in.
    least_docs: int = 3
    #: Ranks of the term part.
    ranks: int = 200
    #: Bytes of keys in a perfect hash, about; and of the hashes that a pass over the texts broadcasts (or one, if larger).
    shard_bytes: int = 1 << 20
    pass_bytes: int = 64 << 20
    #: Entries that a task holds of document frequencies, and bytes of dense slots, before it gives them out.
    entries: int = 400_000
    slot_bytes: int = 128 << 20
    #: Cells (terms x sources) of a block of the comparison, about.
    cells: int = 1 << 15


#: A term is a run of ASCII letters and of whatever is beyond ASCII; all else separates. Only A-Z become lower case.
_FOLD = bytes(b if b >= 0x80 or chr(b).islower() else b + 32 if chr(b).isupper() else 0x20 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def term_hashes(terms: list[bytes]) -> np.ndarray:
    """XXH64, as Spark's xxhash64 of a string."""
    return np.fromiter((xxhash.xxh64_intdigest(t, SEED) for t in terms), np.uint64, len(terms))


def _mixed(hashes: np.ndarray, level: int) -> np.ndarray:
    x = (hashes ^ np.uint64((level * 0x9E3779B97F4A7C15 + 0x2545F4914F6CDD1D) & (1 << 64) - 1)) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB) >> np.uint64(16)


class PerfectHash:
    """A minimal perfect hash of distinct keys, with the keys in the order of their slots.

    Each level has a bit per place; keys that are alone at their place stay there, the others
    go to the next level. A key's slot is the number of bits set before its own. Keys that
    no level tells apart (equal 64-bit hashes) take the last slots and are looked up by
    themselves. A look-up compares the stored key, so a key that isn't there has slot -1.
    """

    LEVELS = 40

    def __init__(self, sizes: np.ndarray, bits: np.ndarray, keys: pa.Array):
        self.sizes, self.bits, self.keys = sizes, bits, keys
        self.before = np.r_[0, np.cumsum(np.bitwise_count(bits), dtype=np.int64)]
        self.starts = np.r_[0, np.cumsum(sizes)]
        self.rest = {keys[k].as_py(): k for k in range(int(self.before[-1]), len(keys))}

    @classmethod
    def build(cls, keys: list[bytes], hashes: np.ndarray) -> PerfectHash:
        left, sizes, bits, order = np.arange(len(keys)), [], [], []
        for level in range(cls.LEVELS):
            if not len(left):
                break
            size = -(-len(left) * 3 // 2 // 64) * 64 or 64
            at = (_mixed(hashes[left], level) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            mine = alone[at]
            order.append(left[mine][np.argsort(at[mine])])
            bits.append(np.packbits(alone, bitorder="little").view(np.uint64))
            sizes.append(size)
            left = left[~mine]
        order = np.concatenate([*order, left]) if len(keys) else left
        words = np.concatenate(bits) if bits else np.empty(0, np.uint64)
        return cls(np.array(sizes, np.int64), words, pa.array([keys[k] for k in order.tolist()], pa.binary()))

    def slots(self, terms: list[bytes], hashes: np.ndarray) -> np.ndarray:
        out = np.full(len(terms), -1, np.int64)
        left = np.arange(len(terms))
        for level, size in enumerate(self.sizes.tolist()):
            if not len(left):
                break
            at = self.starts[level] + (_mixed(hashes[left], level) % np.uint64(size)).astype(np.int64)
            word, bit = self.bits[at >> 6], (at & 63).astype(np.uint64)
            here = (word >> bit & np.uint64(1)).astype(bool)
            below = word & ((np.uint64(1) << bit) - np.uint64(1))
            out[left[here]] = (self.before[at >> 6] + np.bitwise_count(below))[here]
            left = left[~here]
        for k in left.tolist() if self.rest else ():
            out[k] = self.rest.get(terms[k], -1)
        hit = np.flatnonzero(out >= 0)
        if len(hit):
            same = pc.equal(self.keys.take(pa.array(out[hit])), pa.array([terms[k] for k in hit.tolist()], pa.binary()))
            out[hit[~same.to_numpy(zero_copy_only=False)]] = -1
        return out


def _rows(df: DataFrame, cols: tuple[str, str, str]) -> DataFrame:
    return df.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for c, n in zip(cols, ("lang", "source", "text"), strict=True)])


def frequent_terms(rows: DataFrame, params: Params) -> DataFrame:
    """(lang, term): exactly those in at least ``least_docs`` documents of the language."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Counter] = defaultdict(Counter)

        def out() -> Iterator[pa.RecordBatch]:
            for lang, c in seen.items():
                yield pa.record_batch([pa.array([lang] * len(c), pa.string()), pa.array(c.keys(), pa.binary()).cast(pa.string()), pa.array(c.values(), pa.int64())], ["lang", "term", "n"])
            seen.clear()

        for batch in slices(batches):
            texts = batch.column(1).cast(pa.binary())
            for k, lang in enumerate(batch.column(0).to_pylist()):
                seen[lang].update(set(terms_of(texts[k].as_py())))
            if sum(map(len, seen.values())) > params.entries:
                yield from out()
        yield from out()

    found = rows.select("lang", "text").mapInArrow(counted, "lang string, term string, n long")
    return found.groupBy("lang", "term").agg(F.sum("n").alias("n")).filter(F.col("n") >= params.least_docs).select("lang", "term")


def _shards(kept: DataFrame, langs: DataFrame, params: Params) -> DataFrame:
    """A perfect hash per part of a language's terms: (lang, part, parts, n_terms, n_bytes, sizes, bits, ends, keys)."""
    sized = kept.join(langs.select("lang", "size"), "lang").select("lang", "term", F.ceil(F.col("size") / params.shard_bytes).cast("int").alias("parts"))
    parted = sized.withColumn("part", F.pmod(F.xxhash64("term"), "parts").cast("int"))

    def build(table: pa.Table) -> pa.Table:
        keys = table.column("term").cast(pa.binary()).combine_chunks().to_pylist()
        made = PerfectHash.build(keys, term_hashes(keys))
        data = b"".join(made.keys.to_pylist())
        ends = np.cumsum([len(k) for k in made.keys.to_pylist()], dtype=np.int64).tobytes()
        row = {"lang": table["lang"][0].as_py(), "part": table["part"][0].as_py(), "parts": table["parts"][0].as_py(), "n_terms": len(keys), "n_bytes": len(data) + len(ends) + made.bits.nbytes}
        return pa.Table.from_pylist([row | {"sizes": made.sizes.tobytes(), "bits": made.bits.tobytes(), "ends": ends, "keys": data}])

    return parted.groupBy("lang", "part").applyInArrow(build, "lang string, part long, parts long, n_terms long, n_bytes long, sizes binary, bits binary, ends binary, keys binary")


def _opened(row: tuple) -> PerfectHash:
    sizes, bits, ends, keys = row
    ends = np.r_[0, np.frombuffer(ends, np.int64)]
    stored = pa.array([keys[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)], pa.binary())
    return PerfectHash(np.frombuffer(sizes, np.int64), np.frombuffer(bits, np.uint64), stored)


def _recount(rows: DataFrame, held: Broadcast, params: Params) -> DataFrame:
    """(lang, source, term, n): the occurrences of the broadcast shards' terms in each group, summed by task."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes: dict[str, dict[int, tuple[int, PerfectHash]]] = defaultdict(dict)  # language: part: (its first slot, its hash)
        parts, width = {}, Counter()
        for lang, part, n_parts, n_terms, *rest in held.value:
            hashes[lang][part] = (width[lang], _opened(rest))
            width[lang] += n_terms
            parts[lang] = n_parts
        slots: dict[tuple[str, str], np.ndarray] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for (lang, source), dense in slots.items():
                for first, h in hashes[lang].values():
                    own = dense[first : first + len(h.keys)]
                    at = np.flatnonzero(own)
                    if len(at):
                        yield pa.record_batch([pa.array([lang] * len(at)), pa.array([source] * len(at)), h.keys.take(pa.array(at)).cast(pa.string()), pa.array(own[at])], ["lang", "source", "term", "n"])
            slots.clear()

        for batch in batches:  # texts are taken one at a time, so only the batch's different terms are held
            texts, found = batch.column(2).cast(pa.binary()), defaultdict(Counter)
            for k, group in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                if group[0] in hashes:
                    found[group].update(terms_of(texts[k].as_py()))
            for group, c in found.items():
                lang, terms = group[0], list(c)
                n, h = np.fromiter(c.values(), np.int64, len(c)), term_hashes(terms)
                part = np.mod(h.view(np.int64), parts[lang])
                if group not in slots:
                    if (sum(len(x) for x in slots.values()) + width[lang]) * 8 > params.slot_bytes:
                        yield from out()
                    slots[group] = np.zeros(width[lang], np.int64)
                for p, (first, own) in hashes[lang].items():
                    mine = np.flatnonzero(part == p)
                    at = own.slots([terms[k] for k in mine.tolist()], h[mine])
                    slots[group][first + at[at >= 0]] += n[mine[at >= 0]]
        yield from out()

    return rows.mapInArrow(counted, "lang string, source string, term string, n long")


def group_counts(rows: DataFrame, kept: DataFrame, langs: DataFrame, params: Params) -> DataFrame:
    """(lang, source, term, n): how often each kept term occurs in each group, where it does.

    The perfect hashes are broadcast ``pass_bytes`` at a time; each such pass reads the texts
    once, so what the driver and the workers hold doesn't grow with the vocabulary. A language's
    terms of 64 MB (some four million) take one pass.
    """
    shards = written(_shards(kept, langs, params), "term-hashes")
    passes, size = [[]], 0
    for r in shards.select("lang", "part", "n_bytes").orderBy("lang", "part").collect():  # a row per million bytes of terms
        if passes[-1] and size + r.n_bytes > params.pass_bytes:
            passes.append([])
            size = 0
        passes[-1].append((r.lang, r.part))
        size += r.n_bytes
    counts = None
    for chosen in passes:
        wanted = rows.sparkSession.createDataFrame(chosen, "lang string, part long")
        wanted = shards.join(wanted, ["lang", "part"]).select("lang", "part", "parts", "n_terms", "sizes", "bits", "ends", "keys")
        held = rows.sparkSession.sparkContext.broadcast([(r[0], r[1], r[2], r[3], *map(bytes, r[4:])) for r in wanted.collect()])
        own = written(_recount(rows, held, params).groupBy("lang", "source", "term").agg(F.sum("n").alias("n")), "term-counts")
        held.destroy()  # before the next pass: the counts are written
        counts = own if counts is None else counts.unionByName(own)
    return counts


def shares(counts: np.ndarray, total: np.ndarray | int) -> np.ndarray:
    """1 + floor(10^9 (count + 1) / total), exactly; in whole numbers of any size where 64 bits might not hold them."""
    if counts.size and int(counts.max()) >= 9_000_000_000:
        return (1 + (counts.astype(object) + 1) * 1_000_000_000 // total).astype(np.int64)
    return 1 + (counts + 1) * 1_000_000_000 // total


def _compared(ranks: int):
    """A block of a language's terms as a dense table of counts by source: each source's part of
    its values against the others, and its best terms against the language."""

    def compare(counts: pa.Table, groups: pa.Table) -> pa.Table:
        order = np.argsort(np.array(groups["source"].to_pylist(), object), kind="stable")
        sources = [groups["source"][k].as_py() for k in order.tolist()]
        totals = np.array([groups["total"][k].as_py() for k in order.tolist()], np.int64)
        lang, n_terms = groups["lang"][0].as_py(), groups["n_terms"][0].as_py()
        terms = np.array(sorted({*counts["term"].to_pylist()}, key=lambda t: t.encode()), object)
        place, number = {s: k for k, s in enumerate(sources)}, {t: k for k, t in enumerate(terms)}
        dense = np.zeros((len(sources), len(terms)), np.int64)
        dense[[place[s] for s in counts["source"].to_pylist()], [number[t] for t in counts["term"].to_pylist()]] = counts["n"].to_numpy()
        out = {"source": [], "part": [], "item": [], "value": []}

        def add(source: str, part: str, items: list, values: np.ndarray) -> None:
            out["source"] += [source] * len(items)
            out["part"] += [part] * len(items)
            out["item"] += items
            out["value"] += values.tolist()

        p = shares(dense, totals[:, None] + n_terms) if len(terms) else dense
        whole = shares(dense.sum(0), int(totals.sum()) + n_terms) if len(terms) else dense.sum(0)
        for k, source in enumerate(sources):
            against = np.array([((p[k] - q) ** 2 // q).sum() for q in p], np.int64)
            others = np.arange(len(sources)) != k
            add(source, "pair", [s for s, o in zip(sources, others, strict=True) if o], against[others])
            more = np.flatnonzero((dense[k] > 0) & (p[k] > whole))
            value = (p[k][more] - whole[more]) ** 2 // whole[more]
            best = np.argsort(-value, kind="stable")[:ranks]  # terms are in the order of ties
            add(source, "term", terms[more[best]].tolist(), value[best])
        return pa.table({"lang": pa.array([lang] * len(out["source"]), pa.string()), "source": pa.array(out["source"], pa.string()), "part": pa.array(out["part"], pa.string()), "item": pa.array(out["item"], pa.string()), "value": pa.array(out["value"], pa.int64())})

    return compare


def source_divergence(df: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", params: Params | None = None) -> DataFrame:
    """How each (lang, source) group differs from the other sources of its language and from the language.

    Rows (lang, source, part, item, value, rank): ``pair`` has every other source of the language,
    ``term`` the terms that the group uses more than the language does, up to ``ranks``; by value, then item.
    A share is 1 + floor(10^9 (count + 1) / (N + V)) over the V terms that are in at least
    ``least_docs`` documents of the language; a value is floor((p - q)^2 / q). All whole numbers.

    The first pass counts each term's documents exactly; the second looks every term up in
    perfect hashes of those kept, compares the stored key, and adds to dense slots of the group.
    Both add up within tasks before they shuffle, so a hot source or word is one row per task.
    The comparison takes a block of a language's terms at a time.

    Null language, source or text count as empty. Repeated rows count each. A group without
    terms has its rows in ``pair``; a language without kept terms has the value 0 there. An empty
    table gives no rows. Other columns are left aside, whatever their names.
    """
    params = params or Params()
    rows = _rows(df, (lang_col, source_col, text_col))
    kept = written(frequent_terms(rows, params), "frequent-terms")
    groups = written(rows.select("lang", "source").distinct(), "term-groups")
    none = F.lit(0).cast("long")
    size = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("n_terms"), F.sum(F.octet_length("term") + 8).alias("size"))
    n_terms = F.coalesce("n_terms", none)
    blocks = F.greatest(F.lit(1), F.ceil(n_terms * F.col("n_sources") / params.cells)).cast("int")
    # written, so that its size is known: a row per language meets all terms, of which one language may have most
    langs = written(groups.groupBy("lang").agg(F.count(F.lit(1)).alias("n_sources")).join(size, "lang", "left").select("lang", n_terms.alias("n_terms"), F.coalesce("size", none).alias("size"), blocks.alias("blocks")), "term-languages")
    counts = group_counts(rows, kept, langs, params)
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    known = groups.join(totals, ["lang", "source"], "left").select("lang", "source", F.coalesce("total", none).alias("total")).join(langs.drop("size"), "lang")
    meta = known.select("lang", "source", "total", "n_terms", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    cells = counts.join(langs.select("lang", "blocks"), "lang").select("lang", "source", "term", "n", F.pmod(F.xxhash64("term"), "blocks").cast("int").alias("block"))
    compared = cells.groupBy("lang", "block").cogroup(meta.groupBy("lang", "block")).applyInArrow(_compared(params.ranks), "lang string, source string, part string, item string, value long")
    made = written(compared, "term-values")
    pairs = made.filter("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")).alias("rank")
    best = made.filter("part = 'term'").select("*", place).filter(F.col("rank") <= params.ranks)
    return pairs.select("*", place).unionByName(best)
