"""The pipeline's near-duplicates against all pairs, and on edited copies."""

import random
from itertools import combinations

import corpus_pipeline
import numpy as np
from pyspark.sql import functions as F

from pubweave.llm import neardedup, simhash


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def kept_by_all_pairs(docs):
    sets, root = {i: shingles(t) for i, t in docs}, {i: i for i, _ in docs}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(sorted(sets), 2):
        both = len(sets[i] & sets[j])
        if both / (len(sets[i]) + len(sets[j]) - both) >= 0.8:
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    return {i for i in sets if find(i) == i}


def edited(rng, words, n):
    words = list(words)
    for i in rng.sample(range(len(words)), n):
        words[i] = f"edit{rng.random()}"
    return " ".join(words)


def test_edited_copies_go(spark):
    rng = random.Random(5)
    texts = [[f"w{rng.randrange(5000)}" for _ in range(300)] for _ in range(20)]
    # up to five words in 300 changed: similarities from 0.84 on, many more than three bits apart
    docs = [(100 * k + n, edited(rng, t, n)) for k, t in enumerate(texts) for n in range(6)]
    docs += [(5000 + k, edited(rng, t, 40)) for k, t in enumerate(texts)]  # far below 0.8: these stay
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id for r in corpus_pipeline.near_dedup(spark, df, "").collect()}
    assert got == kept_by_all_pairs(docs) == {100 * k for k in range(20)} | {5000 + k for k in range(20)}


def test_chains_and_crowded_bands(spark):
    rng = random.Random(6)
    # 60 texts that share 70 %: crowded bands without links, but for the last ten, a chain of small edits
    base = [f"b{i}" for i in range(210)]
    docs = [(i, " ".join(base + [f"o{i}x{k}" for k in range(90)])) for i in range(50)]
    words = docs[-1][1].split()
    for i in range(50, 60):
        for k in rng.sample(range(len(words)), 3):
            words[k] = f"c{i}x{k}"
        docs.append((i, " ".join(words)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id for r in corpus_pipeline.near_dedup(spark, df, "").collect()}
    assert got == kept_by_all_pairs(docs) == set(range(50))


def test_all_pairs_of_the_documents(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    docs = [(r.doc_id, r.text) for r in table.dropDuplicates(["text"]).orderBy("doc_id").limit(400).collect()]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r.doc_id for r in neardedup.drop_near_duplicates(df).collect()} == kept_by_all_pairs(docs)


def test_a_crowd_that_shares_most_words_makes_few_pairs(spark):
    """2,000 texts of one template, each with a tenth to a third of its own words, and a few real copies among them."""
    rng = random.Random(7)
    base = [f"b{i}" for i in range(200)]
    texts = {i: " ".join(base[:100] + [f"o{i}x{k}" for k in range(rng.randint(30, 90))] + base[100:]) for i in range(2000)}
    for i in range(2000, 2010):
        words = texts[i - 2000].split()
        words[rng.randrange(100)] = f"edit{i}"
        texts[i] = " ".join(words)
    sets = spark.createDataFrame([(i, [int(x) for x in neardedup.shingle_set(t).view("i8")]) for i, t in texts.items()], "node long, s array<long>")
    members = neardedup.rarest_shingles(sets).withColumns({"root": F.col("node"), "pivot": F.lit(True)})  # all against all
    tried = {(r.a, r.b) for r in neardedup.tried_pairs(members).collect()}
    assert len(tried) < len(texts) and {(i, 2000 + i) for i in range(10)} <= {tuple(sorted(p)) for p in tried}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r.doc_id for r in neardedup.drop_near_duplicates(df).collect()} == set(range(2000))


def test_a_pair_meets_once(spark):
    """Edited copies of one text share dozens of their rarest shingles, and are made a pair under one of them."""
    rng = random.Random(9)
    base = [f"b{i}" for i in range(400)]
    sets = {i: {int(x) for x in neardedup.shingle_set(edited(rng, base, 3)).view("i8")} for i in range(40)}
    df = spark.createDataFrame([(i, sorted(s)) for i, s in sets.items()], "node long, s array<long>")
    members = neardedup.rarest_shingles(df).withColumns({"root": F.col("node"), "pivot": F.lit(True)})
    met = [(r.a, r.b) for r in neardedup.met_pairs(members).collect()]
    similar = {(a, b) for a, b in combinations(sets, 2) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    assert similar and similar <= {tuple(sorted(p)) for p in met} and len(met) <= 1.1 * len(set(met))


def test_every_similar_pair_meets(spark):
    """Pairs around the similarity, of sets of different sizes: none that reaches it is left out."""
    rng = random.Random(3)
    sets = {}
    for k in range(60):
        common = set(range(1000 * k, 1000 * k + rng.randint(1, 120)))
        for side in range(2):
            sets[2 * k + side] = sorted(common | {-(100_000 * (side + 1) + 500 * k + x) for x in range(rng.randint(0, max(1, len(common) // 5)))} | {7_000_000 + rng.randrange(5)})
    df = spark.createDataFrame(list(sets.items()), "node long, s array<long>")
    members = neardedup.rarest_shingles(df).withColumns({"root": F.col("node"), "pivot": F.lit(True)})
    tried = {tuple(sorted((r.a, r.b))) for r in neardedup.tried_pairs(members).collect()}
    for a, b in combinations(sets, 2):
        both = len(set(sets[a]) & set(sets[b]))
        if both / (len(sets[a]) + len(sets[b]) - both) >= 0.8:
            assert (a, b) in tried
    assert len(tried) >= 20


def plain_fingerprints(hashes, n):
    """Votes one by one, in exact numbers as far as floats go."""
    rng, mask, out = np.random.default_rng(20240101), (1 << 64) - 1, []
    xor, times = rng.integers(0, 1 << 64, (2, n * 8, 1), np.uint64)
    for a, b in zip(xor[:, 0].tolist(), times[:, 0].tolist(), strict=True):
        votes = [0.0] * 8
        for h in hashes:
            x = ((h ^ a) * (b | 1)) & mask
            x = ((x ^ (x >> 29)) * 0xBF58476D1CE4E5B9) & mask
            x ^= x >> 32
            for bit in range(8):
                votes[bit] += (((x >> 8) + 1) / 2**56) ** -4 * (1 if x >> bit & 1 else -1)
        out.append(sum(1 << bit for bit in range(8) if votes[bit] > 0))
    return [int.from_bytes(bytes(out[8 * k : 8 * k + 8]), "little") for k in range(n)]


def common_bytes(a, b):
    return sum(x == y for x, y in zip(int(a).to_bytes(8, "little", signed=a < 0), int(b).to_bytes(8, "little", signed=b < 0), strict=True))


def test_fingerprints_are_votes_of_all_shingles():
    rng = random.Random(11)
    for n in (1, 7, 1500):
        hashes = np.array(sorted(rng.randrange(1 << 64) for _ in range(n)), np.uint64)
        assert simhash.weighted_fingerprints(hashes, 3).tolist() == plain_fingerprints(hashes.tolist(), 3)


def test_similar_sets_share_bytes():
    """Sets of a similarity of 0.8 share five bytes of a fingerprint in nine cases of ten, and others never."""
    rng, shared, other = random.Random(12), 0, 0
    before = np.zeros(neardedup.FINGERPRINTS, np.int64)
    for _ in range(200):
        h = [rng.randrange(1 << 64) for _ in range(100)]
        a, b = (neardedup.fingerprints(np.array(sorted(s), np.uint64)) for s in (h[:90], h[10:]))
        shared += sum(common_bytes(x, y) >= 5 for x, y in zip(a.tolist(), b.tolist(), strict=True))
        other += sum(common_bytes(x, y) >= 5 for x, y in zip(a.tolist(), before.tolist(), strict=True))
        before = b
    assert shared >= 0.88 * 200 * neardedup.FINGERPRINTS and other == 0


def test_links_by_the_tally_of_shared_bytes(spark):
    """Without a radius whatever shares five bytes is connected, in lists of any length, and nothing else."""
    rng = np.random.default_rng(13)
    base = rng.integers(0, 256, (6, 8), np.uint8)
    fps = np.repeat(base, 60, 0)
    for row in fps:
        row[rng.permutation(8)[: rng.integers(0, 5)]] = rng.integers(0, 256)
    fps = np.unique(fps.copy().view("<i8")[:, 0]).tolist()
    root = {x: x for x in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(fps, 2):
        if common_bytes(a, b) >= 5:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    for longest, depth in ((1024, None), (4, 2), (1, 4)):
        got = {r.node: r.root for r in simhash.components(simhash.fingerprint_links(df, longest=longest, depth=depth, radius=None)).collect()}
        assert {x: got.get(x, x) for x in fps} == {x: find(x) for x in fps}
    pairs = [(a, b) for a, b in combinations(fps[:80], 2)]
    shared = spark.createDataFrame([([0, a], [-1, b]) for a, b in pairs], "a array<long>, b array<long>").select(simhash.share_bytes(F.col("a"), F.col("b")).alias("s"))
    assert [r.s for r in shared.collect()] == [common_bytes(a, b) >= 5 for a, b in pairs]


def test_what_the_index_does_not_link_stays(spark, monkeypatch):
    """Near copies go because the byte-position index has linked their fingerprints, by no other way."""
    rng = random.Random(14)
    docs = [(n, edited(rng, [f"w{i}" for i in range(300)], 3 * n)) for n in range(2)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert corpus_pipeline.near_dedup(spark, df, "").count() == 1
    monkeypatch.setattr(neardedup, "fingerprints", lambda s: np.array([s.sum(dtype=np.uint64)]).view(np.int64))
    assert corpus_pipeline.near_dedup(spark, df, "").count() == 2
