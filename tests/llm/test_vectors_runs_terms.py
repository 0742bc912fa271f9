"""Nearest neighbours, periodic runs and source divergence against plain versions of them."""

import hashlib
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pubweave.llm import ann, divergence, periodic, queries

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")

# --- nearest neighbours


def product(a, b):
    total = 0.0
    for x, y in zip(a, b, strict=True):
        total += float(x) * float(y)
    return total


def exact(rows, is_query, k=20):
    """{(query, rank): (id, score)} over all candidates."""
    out = {}
    for q, v in rows:
        if is_query(q):
            best = sorted((-product(v, w), i) for i, w in rows if i != q and len(w) == len(v))[:k]
            out |= {(q, r + 1): (i, -s) for r, (s, i) in enumerate(best)}
    return out


def found(df):
    return {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in df.collect()}


def test_recall_of_whole_tables(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()]
    want = exact(rows, lambda i: i % 20 == 0)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    for got in (queries.op11_hnsw(spark, "/root/testdata/sf0.1"), ann.nearest(table.filter("vec_id % 20 = 0"), table, params=ann.Params(least_shards=1))):
        got = found(got)
        assert got.keys() == want.keys()
        near = defaultdict(set)
        for (q, _), (i, _) in want.items():
            near[q].add(i)
        assert sum(i in near[q] for (q, _), (i, _) in got.items()) / len(want) >= 0.95
        scores = {(q, i): product(dict(rows)[q], dict(rows)[i]) for (q, _), (i, _) in got.items() if q < 200}
        assert all(s == scores[q, i] for (q, _), (i, s) in got.items() if q < 200)


def test_largest_products_of_vectors_of_any_length(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=8) * rng.exponential()).astype("f4").tolist()) for i in range(900)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got, want = found(ann.nearest(df.filter("vec_id < 60"), df, params=ann.Params(least_shards=2, task_queries=20))), exact(rows, lambda i: i < 60)
    assert got.keys() == want.keys() and sum(got[x] == want[x] for x in want) / len(want) >= 0.95


def test_copies_ties_and_what_takes_no_part(spark):
    a, b, c = [1.0, 0.0], [0.0, 1.0], [0.5, 0.5]
    nan, inf = float("nan"), float("inf")
    good = [(i, a) for i in range(100)] + [(i, b) for i in range(100, 130)] + [(130, c), (131, [-0.0, 1.0]), (140, [1.0, 2.0, 3.0]), (160, [2.0, 0.0, 0.0])]
    bad = [(None, a), (200, None), (220, [0.0, 0.0]), (240, [nan, 1.0]), (260, [inf, 1.0]), (280, [None, 1.0]), (300, []), (320, [0.0, -0.0])]
    df = spark.createDataFrame([(*r, "x", "y", 1) for r in good + bad + good[:5] + good[:5]], "vec_id long, embedding array<float>, vector string, ids string, dim int")
    got = found(ann.nearest(df.filter("vec_id % 20 = 0"), df))
    assert got == exact(good, lambda i: i % 20 == 0) and [got[0, r][0] for r in (1, 2, 20)] == [1, 2, 20] and got[160, 1] == (140, 2.0) and (160, 2) not in got
    assert ann.nearest(df.limit(0), df).count() == ann.nearest(df, df.limit(0)).count() == 0


# --- periodic runs


def plain_runs(words):
    n, out = len(words), []
    numbers = {}
    x = np.array([numbers.setdefault(w, len(numbers)) for w in words], int)
    for q in range(1, n // 4 + 1):
        same = np.r_[False, x[q:] == x[:-q], False]
        for begin, stop in zip(np.flatnonzero(same[1:] & ~same[:-1]), np.flatnonzero(~same[1:] & same[:-1]), strict=True):
            start, length = int(begin), int(stop - begin) + q
            if length >= max(6, 4 * q) and not any((x[start + p : start + length] == x[start : start + length - p]).all() for p in range(1, q)):
                out.append((start, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("seed", range(4))
def test_runs_of_random_words(seed):
    rng = random.Random(seed)
    for _ in range(1500):
        words = []
        while len(words) < rng.randint(0, 50):
            phrase = [rng.choice("abc"[: rng.randint(1, 3)]) for _ in range(rng.randint(1, 6))]
            words += (phrase * rng.choice((1, 2)) + [rng.choice("abc")] * rng.choice((0, 1))) * rng.randint(1, 7)
        assert periodic.periodic_runs(words) == plain_runs(words)


def test_runs_within_runs_take_time_by_length():
    """A million words would take hours, were all earlier occurrences gone through."""
    words = ((["a"] * 20 + ["b"]) * 10 + ["c"]) * 40
    assert periodic.periodic_runs(words) == plain_runs(words)
    assert periodic.periodic_runs(["a"] * 1_000_000) == [(0, 1_000_000, 1)]
    assert len(periodic.periodic_runs((["a"] * 50 + ["b"]) * 1000)) == 1001


def test_texts_of_few_different_words():
    """Short contexts come again at every other word: a diagonal for each of those would take minutes."""
    rng = random.Random(4)
    words, began = [rng.choice("ab") for _ in range(100_000)], time.perf_counter()
    runs = periodic.periodic_runs(words)
    assert time.perf_counter() - began < 10 and runs[:20] == [r for r in plain_runs(words[:1000]) if r[0] <= runs[19][0]][:20]
    assert all(sum(i == k for k, _ in begun) <= 15 for begun in periodic.beginnings([words[:2000]]) for i in range(2000))


def test_runs_of_texts_together():
    """Texts that lie one after the other don't meet, however alike they are."""
    texts = [["a", "b"], [], ["a", "b"] * 4, ["a"] * 3, ["a"] * 3, ["b", "a"] * 5 + ["c"], list("abcabcab"), list("cabcabc")]
    assert periodic.runs_of(texts) == [plain_runs(t) for t in texts] and periodic.runs_of([]) == [] and periodic.runs_of([[], []]) == [[], []]


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def test_periodic_runs_of_the_documents(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got, some = {r.doc_id: r for r in queries.op12_periodic_runs(spark, SF).collect()}, 0
    assert len(got) == len(table)
    for r in table:
        words = planted(r.doc_id, WORD.findall(r.text or ""))
        runs, own = plain_runs(words), got[r.doc_id]
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=None)
        kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in runs)]
        digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
        assert own.n_runs == len(runs) and (own.start, own.length, own.period) == (best or (None,) * 3)
        assert own.exponent_milli == (best and 1000 * best[1] // best[2])
        assert own.runs_sha256 == digest("".join(f"{s},{n},{q}\n" for s, n, q in runs)) and own.collapsed_sha256 == digest(" ".join(kept))
        some += bool(runs)
    assert some > 10


def test_runs_edges(spark):
    schema = "doc_id long, text string, runs string, n_words int, collapsed string, _pr_id int"
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a a a a a a "), (4, "a a a a a a"), (None, "x y\nx\ty x y x y z"), (6, "ab " * 50_000)]
    df = spark.createDataFrame([(*r, "c", 1, "c", 2) for r in rows], schema)
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic.text_runs(df).collect()), key=repr)
    assert got == sorted([
        (1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (4, 6, [], "a a a a a a "), (4, 6, [(0, 6, 1)], "a"), (None, 9, [(0, 8, 2)], "x y z"), (6, 50_000, [(0, 50_000, 1)], "ab"),
    ], key=repr)
    assert periodic.text_runs(df.limit(0)).count() == 0
    texts = spark.createDataFrame([("k", "a")], "name string, body string")
    assert periodic.text_runs(texts, "name", "body").columns == ["name", "n_words", "runs", "collapsed"]


# --- source divergence


def test_perfect_hash():
    rng = random.Random(1)
    for n in (0, 1, 2, 100, 5000):
        keys = [f"k{i}".encode() for i in range(n)]
        h = divergence.PerfectHash.build(keys, divergence.term_hashes(keys))
        rng.shuffle(keys)
        slots = h.slots(keys, divergence.term_hashes(keys))
        assert sorted(slots.tolist()) == list(range(n)) and [h.keys[k].as_py() for k in slots.tolist()] == keys
        others = [f"x{i}".encode() for i in range(500)]
        assert (h.slots(others, divergence.term_hashes(others)) == -1).all()
    # keys of one hash are told apart by themselves
    keys, same = [b"a", b"b", b"c", b"d"], np.array([7, 7, 7, 9], np.uint64)
    h = divergence.PerfectHash.build(keys, same)
    assert sorted(h.slots(keys, same).tolist()) == [0, 1, 2, 3] and h.slots([b"e"], np.array([7], np.uint64)).tolist() == [-1]


TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain_divergence(rows, least=3, ranks=200):
    docs = [(r[0] or "", r[1] or "", ["".join(c.lower() if "A" <= c <= "Z" else c for c in t) for t in TERM.findall(r[2] or "")]) for r in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        df = Counter(t for d in own for t in set(d[2]))
        kept = {t for t, n in df.items() if n >= least}
        counts = defaultdict(Counter)
        for _, source, terms in own:
            counts[source].update(t for t in terms if t in kept)
        whole = sum(counts.values(), Counter())
        share = lambda c, kept=kept: {t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept)) for t in kept}
        p, q = {s: share(c) for s, c in counts.items()}, share(whole)
        f = lambda a, b: (a - b) ** 2 // b
        for s in counts:
            pairs = sorted(((-sum(f(p[s][t], p[o][t]) for t in kept), o.encode()) for o in counts if o != s))
            terms = sorted((-f(p[s][t], q[t]), t.encode()) for t in kept if counts[s][t] and p[s][t] > q[t])[:ranks]
            out |= {(lang, s, part, i.decode(), -v, k + 1) for part, x in (("pair", pairs), ("term", terms)) for k, (v, i) in enumerate(x)}
    return out


def as_set(df):
    return {(r.lang, r.source, r.part, r.item, r.value, r["rank"]) for r in df.collect()}


def test_divergence_edges_and_small_bounds(spark):
    rng = random.Random(9)
    vocabulary = ["the", "The", "été", "ÉTÉ", "日本", "x", "ab1cd", "o'clock", "z" * 3000, *[f"w{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]}" for i in range(40)]]
    rows = [(rng.choice(["en", "fr", "", None]), rng.choice(["a", "b", None, "c\u0000d"]), " ".join(rng.choices(vocabulary, k=rng.randint(0, 30)))) for _ in range(150)]
    rows += [("de", "a", "one two"), ("de", "b", None), ("de", None, ""), ("en", "without terms", "123 !"), ("en", "a", "the " * 20_000), *[("en", "a", "the same row")] * 3]
    df = spark.createDataFrame([(*r, 1, "t", 2) for r in rows], "lang string, source string, text string, term int, item string, n int")
    want = plain_divergence(rows)
    assert ("de", "a", "pair", "b", 0, 2) in want and any(r[1] == "without terms" and r[4] for r in want)
    assert as_set(divergence.source_divergence(df)) == want
    tight = divergence.Params(shard_bytes=200, pass_bytes=500, entries=5, slot_bytes=100, cells=8)
    assert as_set(divergence.source_divergence(df, params=tight)) == want
    assert divergence.source_divergence(df.limit(0)).count() == 0
    few = divergence.Params(least_docs=2, ranks=3)
    assert as_set(divergence.source_divergence(df.repartition(7), params=few)) == plain_divergence(rows, 2, 3)


def test_shares_beyond_64_bits():
    counts = np.array([0, 5, 9_999_999_999, 10**12], np.int64)
    total = int(counts.sum()) + 4
    assert divergence.shares(counts, total).tolist() == [1 + 10**9 * (int(c) + 1) // total for c in counts]


def test_queries_are_whole(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert queries.op12_periodic_runs(spark, SF).count() == docs.count()
    groups = docs.select(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source")).distinct()
    pairs = queries.op13_source_divergence(spark, SF).filter("part = 'pair'").select("lang", "source").distinct()
    alone = groups.groupBy("lang").count().filter("count = 1").select("lang")
    assert groups.join(alone, "lang", "left_anti").exceptAll(pairs).isEmpty()
