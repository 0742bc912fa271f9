"""The pipeline against a plain version of its stages, on the smallest documents."""

import hashlib
import math
import re
import time
from collections import Counter, defaultdict

import corpus_pipeline
import pyarrow as pa
from pubweave.llm import bpe, langid, neardedup
from pubweave.llm.queries import default_vocabulary

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_near(docs):
    """Five-word shingles, a Jaccard similarity of 0.8 or more, the smallest id of a group."""
    words = {d["doc_id"]: "".join(c.lower() if c.isascii() else c for c in d["text"]).split() for d in docs}
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for i, w in words.items()}
    ids, root = sorted(sets), {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in ids:
        for j in ids:
            if i < j and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [d for d in docs if find(d["doc_id"]) == d["doc_id"]]


def plain_mix(docs):
    by = defaultdict(list)
    for d in docs:
        by[d["source"]].append(d)
    size = {s: sum(len(WORD.findall(d["text"])) for d in ds) for s, ds in by.items()}
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sorted(by))}
    target, open_, left = {}, set(by), 1.5 * sum(size.values())
    while True:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level > 2 * size[s]}
        for s in full:
            target[s] = 2 * size[s]
            left -= target[s]
        open_ -= full
        if not full:
            break
    target |= {s: weight[s] * left / sum(weight[t] for t in open_) for s in open_}
    out = []
    for s, ds in by.items():
        budget = math.floor(target[s] + 0.5)
        order = sorted(ds, key=lambda d: (hashlib.md5(str(d["doc_id"]).encode()).hexdigest(), d["doc_id"]))
        while budget > 0:
            for d in order:
                ends = [m.end() for m in WORD.finditer(d["text"])]
                n = min(len(ends), budget)
                if n:
                    out.append((d["doc_id"], d["text"] if n == len(ends) else d["text"][: ends[n - 1]]))
                budget -= n
    return out


def test_pipeline(spark):
    from tokenizers import Tokenizer

    ref = Tokenizer.from_file(default_vocabulary())
    table = spark.read.parquet(f"{SF}/documents.parquet")
    kept = [r.asDict() for r in langid.keep_identified(table).collect()]
    assert len(kept) >= 0.97 * table.count()
    last = {}
    for d in kept:
        last[d["text"]] = max(last.get(d["text"], -1), d["doc_id"])
    mixed = plain_mix(plain_near([d for d in kept if last[d["text"]] == d["doc_id"]]))
    want = Counter((i, len(ids := ref.encode(t, add_special_tokens=False).ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()) for i, t in mixed)
    rows = corpus_pipeline.run(spark, SF).collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows) == want
    assert all(len(r.ids) == r.n_tokens and hashlib.sha256(",".join(map(str, r.ids)).encode()).hexdigest() == r.ids_sha256 for r in rows)


def test_stages_keep_the_columns_and_take_nothing(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, table.limit(0), SF)
        assert out.columns == table.columns and out.count() == 0


def test_stages_take_nulls_repeats_and_long_texts(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    long = "the same words again and " * 30_000
    odd = [(1, None, None, None, None), (1, None, None, None, None), (None, "some text of no number", "en", None, 22), (None, "", "en", "src1", 0), (2, long, "en", "src1", len(long)), (2, long, "en", "src1", len(long)), (3, "42 # 7", None, "src2", 6)]
    rows = table.union(spark.createDataFrame(odd, table.schema))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, rows, SF)
        assert name == "encode" or out.columns == table.columns
        found = out.collect()
        assert found
        if name == "language_id":
            assert not any(r.doc_id == 3 and r.text == "42 # 7" for r in found)  # no letter, no language
        if name == "exact_dedup":
            assert sum(r.text == long for r in found) == 1 and sum(not r.text for r in found) == 1
        if name == "source_mix":
            words = lambda t: len(WORD.findall(t or ""))
            sizes = Counter()
            for r in rows.collect():
                sizes[r.source] += words(r.text)
            taken = Counter()
            for r in found:
                taken[r.source] += words(r.text)
            assert all(taken[s] <= 2 * n for s, n in sizes.items()) and abs(sum(taken.values()) - 1.5 * sum(sizes.values())) <= len(sizes)
        if name == "encode":
            assert len(found) == rows.count()


def test_workers_forget_what_they_remember_for_another_operator(spark):
    """Idle Python workers count with their executor's memory: one that has encoded doesn't hold the vocabulary and its chunks for the near stage."""

    def held(batches):
        for batch in batches:
            time.sleep(0.1 * len(batch))
            yield pa.record_batch([pa.array([bpe.tokenizer.cache_info().currsize] * len(batch), pa.int64())], ["n"])

    # idle workers take turns, so with so many tasks each has one of every kind
    texts = spark.range(0, 32, 1, 32).selectExpr("id doc_id", "concat('a text of number ', id) text")
    tokens = bpe.token_digests(texts, default_vocabulary)
    assert {r.n_tokens > 0 for r in tokens.collect()} == {True}
    assert any(r.n for r in texts.mapInArrow(held, "n long").collect())
    texts.select(neardedup._longs(texts["text"], neardedup.fingerprints)).collect()
    assert not any(r.n for r in texts.mapInArrow(held, "n long").collect())
    assert [r.ids_sha256 for r in bpe.token_digests(texts, default_vocabulary).collect()] == [r.ids_sha256 for r in tokens.collect()]
