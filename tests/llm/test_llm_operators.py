"""Edge cases and brute-force comparisons of the training-data operators."""

import hashlib
import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from pubweave.llm import bpe, chat, exactdedup, langid, licenses, mixing, neardedup, quality, simhash, urlfilter, warc
from pubweave.llm.queries import URL_RULES, default_vocabulary

DOC = "doc_id long, text string, lang string, source string, n_chars long, rank string"
LONG = "lorem ipsum dolor " * 20_000
ROWS = [
    (1, "the same text here", "en", "a", 18, "x"), (2, "the same text here", "en", "b", 18, "x"), (3, None, None, None, None, None), (4, "", "en", "a", 0, "y"),
    (None, "the same text here", "fr", None, 18, "z"), (5, LONG, "en", "a", len(LONG), "w"), (6, "42 $$$", "en", "a", 6, "w"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOC)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOC)


# --- exact de-duplication


def test_cuckoo_index_against_a_dict():
    rng, index, live = random.Random(1), exactdedup.CuckooIndex(2), {}
    keys = [hashlib.sha256(b"%d" % i).digest() for i in range(3000)]
    for _ in range(9000):
        k = rng.choice(keys)
        if k in live and rng.random() < 0.4:
            assert index.delete(k)
            del live[k]
        elif k not in live:
            index.insert(k, len(live))
            live[k] = len(live)
        assert index.get(k) == live.get(k)
    assert dict(index) == live and index.size == len(live)
    assert not index.delete(b"x" * 32)


def test_exact_duplicates(docs, none):
    got = {r.doc_id: r for r in exactdedup.exact_duplicates(docs).collect()}
    assert [(got[i].keep_id, got[i].group_size, got[i].kept) for i in (1, 2, None)] == [(2, 3, False), (2, 3, True), (2, 3, False)]
    assert (got[3].keep_id, got[4].kept, got[3].text_sha256) == (4, True, hashlib.sha256(b"").hexdigest())
    kept = exactdedup.drop_exact_duplicates(docs)
    assert {r.doc_id for r in kept.collect()} == {2, 4, 5, 6} and kept.columns == docs.columns
    assert exactdedup.exact_duplicates(none).count() == 0


def test_exact_duplicates_with_a_small_index(spark):
    rows = spark.range(2000).select(F.col("id").alias("doc_id"), (F.col("id") % 7 * (F.col("id") % 2)).cast("string").alias("text"))
    groups = exactdedup.copy_groups(rows, limit=2).collect()
    assert sum(r._xd_n for r in groups) == 2000 and len(groups) == 7 == len({bytes(r._xd_digest) for r in groups})


# --- SimHash


def test_positions_cover_every_five():
    for depth in range(1, 6):
        sets = simhash.first_positions(depth)
        assert all(five[:depth] in sets for five in combinations(range(8), 5))
        assert depth == 5 or sorted({d for s in sets for d in simhash.deeper(s)}) == simhash.first_positions(depth + 1)
    assert [len(simhash.first_positions(d)) for d in range(1, 6)] == [4, 10, 20, 35, 56]


def plain_fingerprint(text):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()
    grams = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints():
    for t in [None, "", "One", "A b\tc d", "É a B É a B"]:
        assert simhash.fingerprint(t) == plain_fingerprint(t)


def test_tallies_decide_what_is_verified():
    rng = random.Random(5)
    fps = np.array([rng.getrandbits(64) & 0x0700070003010003 for _ in range(200)], np.uint64)
    lists = np.sort(np.array([rng.randrange(9) for _ in fps]))
    shared = lambda a, b: sum(x == y for x, y in zip(int(a).to_bytes(8), int(b).to_bytes(8), strict=True))
    tallies = [simhash.shared_bytes(fps[i : i + 1], fps[i + 1 : i + 2])[0] for i in range(199)]
    assert tallies == [shared(fps[i], fps[i + 1]) for i in range(199)]
    want = {(i, j) for i, j in combinations(range(200), 2) if lists[i] == lists[j] and (int(fps[i]) ^ int(fps[j])).bit_count() <= 3}
    assert set(zip(*(x.tolist() for x in simhash.list_links(lists, fps)), strict=True)) == want and want


def test_components_against_brute_force(spark):
    rng = random.Random(7)
    base = [rng.getrandbits(64) for _ in range(40)]
    fps = list({b ^ sum(1 << i for i in rng.sample(range(64), rng.randrange(7))) for b in base for _ in range(12)})
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in combinations(range(len(fps)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= 3:
            a, b = find(i), find(j)
            parent[max(a, b)] = min(a, b)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    table = spark.createDataFrame([(x,) for x in signed], "fp long")
    want = {}
    for i, x in enumerate(signed):
        want.setdefault(find(i), []).append(x)
    for depth, longest in ((None, 1024), (1, 9), (3, 2), (1, 0)):  # the shorter, the more lists are split, at last by half bytes
        roots = simhash.components(simhash.fingerprint_links(table, depth=depth, longest=longest)).collect()
        got = {r.node: r.root for r in roots}
        for members in want.values():
            assert {got.get(x, x) for x in members} == {min(members)}


def test_lists_over_batch_borders():
    rng = random.Random(3)
    rows = sorted((q, key, key << 32 | rng.getrandbits(6)) for q, key, n in [(0, 1, 9), (0, 2, 1), (1, 1, 30), (2, 5, 2), (2, 6, 12)] for _ in range(n))

    def walk(step, limit):
        batches = [pa.record_batch([pa.array(c, pa.int64()) for c in zip(*rows[i : i + step], strict=True)], ["q", "key", "fp"]) for i in range(0, len(rows), step)]
        return sorted((r["q"] is None, r["q"] or 0, r["a"], r["b"]) for b in simhash._walk_lists(limit)(iter(batches)) for r in b.to_pylist())

    for limit in (None, 10, 1):
        want = walk(len(rows), limit)
        assert all(walk(step, limit) == want for step in (1, 2, 3, 7, 20))
        assert sum(not linked for linked, *_ in want) == {None: 0, 10: 42, 1: 53}[limit]


def test_near_duplicates_edges(docs, none):
    got = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    assert got[3].fingerprint == got[4].fingerprint == "0" * 16 and got[3].component_id == got[4].component_id == 3
    assert got[1].component_id == got[2].component_id == got[None].component_id == 1
    assert simhash.near_duplicates(none).count() == 0
    assert {1, 3, 5} <= {r.doc_id for r in neardedup.drop_near_duplicates(docs).collect()}


# --- mixing


def test_mix(docs, none, spark):
    rows = spark.range(600).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 9).cast("int")).alias("text"), F.when(F.col("id") % 10 < 7, "big").when(F.col("id") % 10 < 9, "mid").alias("source"))
    got = mixing.mix_sources(rows).collect()
    for s in ("big", "mid", None):
        own = [r for r in got if r.source == s]
        assert sum(r.taken for r in own) == round(own[0].target) and all(0 <= r.taken <= 2 * r["size"] for r in own)
    assert sum(r.taken for r in got) == pytest.approx(1.5 * sum(r["size"] for r in got), abs=3)
    out = mixing.mixed_documents(rows.withColumn("n_chars", F.length("text").cast("long")))
    words = out.select(F.sum(F.size(F.expr("filter(split(text, ' '), x -> x <> '')")))).first()[0]
    assert words == sum(r.taken for r in got)
    assert mixing.mix_sources(docs).count() == len(ROWS) and mixing.mix_sources(none).count() == 0


# --- byte-pair encoding


def test_bpe_equals_the_library(docs, none):
    from tokenizers import Tokenizer

    ref = Tokenizer.from_file(default_vocabulary())
    texts = ["", " ", "a  b \n\n c\t\td  ", "x<|endoftext|> y <|endoftext|>", "日本語 🎉🎉 　x", "aaaa" * 300, "it's we'll \x1c a\x85b\xa0c", "don't 'S", "é́ ½²³ Ⅷ", "\x00\x01", "中" * 900]
    own = bpe.Tokenizer(default_vocabulary(), remember=300)
    for _ in range(2):
        ids, sizes = own.encode_batch(texts)
        got = [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]
        assert got == [x.ids for x in ref.encode_batch(texts, add_special_tokens=False)]
    assert [own.decode(np.array(x, np.int64)) for x in got] == texts
    assert own.decode(np.array([183, 50256])) == ref.decode([183, 50256], skip_special_tokens=False)
    rows = {r.doc_id: r for r in bpe.token_digests(docs, default_vocabulary()).collect()}
    assert rows[3].n_tokens == 0 and rows[5].decoded_sha256 == hashlib.sha256(LONG.encode()).hexdigest()
    assert bpe.token_digests(none, default_vocabulary()).count() == 0
    back = docs.select("text", bpe.decode(bpe.encode(F.col("text"), default_vocabulary()), default_vocabulary()).alias("back")).collect()
    assert all((r.text or "") == r.back for r in back)


# --- language identification


def test_language_id(spark, docs, none):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    models = langid.fit(table)
    found = langid.identify(table.select("doc_id", "lang", "text"), models).withColumn("held", langid.held_out()).collect()
    held = [r for r in found if r.held]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)
    assert sum(r.rejected for r in found) <= 0.01 * len(found) and all(0 <= r.score <= 1 for r in found)
    edge = {r.doc_id: r for r in langid.identify(docs, models).collect()}
    assert edge[3].lang_pred == edge[4].lang_pred == edge[6].lang_pred == "und" and edge[5].lang_pred in models.langs
    foreign = spark.createDataFrame([("ωστόσο η γλώσσα αυτή δεν είναι γνωστή " * 5,), ("qxzj vkqw zzxq jjkv " * 20,)], "text string")
    assert all(r.rejected for r in langid.identify(foreign, models).collect())
    assert langid.keep_identified(none).count() == 0


# --- quality


def plain_repeats(words):
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    again = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    return len(again)


def test_quality(docs, none):
    rng = random.Random(2)
    for _ in range(30):
        words = [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randrange(25))]
        assert quality.repeated_words(words) == plain_repeats(words)
    assert quality.base_counts("a b\n\na b\n \n#x | é\n") == (7, 8, 2, 1, 0)
    assert quality.js_distance(np.array([1.0, 0]), np.array([0, 1.0])) == 1 and quality.js_distance(np.array([2.0, 2]), np.array([1.0, 1])) == 0
    got = {r.doc_id: r for r in quality.judge(docs).collect()}
    assert got[3].n_words == 0 and got[3].base_failed and got[5].n_repeat_words == 60_000 and not got[5].kept
    assert quality.judge(none).count() == 0


# --- URL filter


def test_url_filter(spark):
    urls = ["https://a.com/x", "https://example.com/en/1", "HTTP://WWW.Example.com/en/1?q", "x://b.net/es/", "x://c.net/en/z", None, "no host", "x://d.org", "x://com/"]
    rows = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, rule string")
    got = {r.page_id: r for r in urlfilter.judge(rows, URL_RULES).collect()}
    assert [got[i].rule for i in range(9)] == ["com/", "example.com/en/", "www.example.com/en/", "net/es/", None, None, None, None, "com/"]
    assert [got[i].verdict for i in (0, 1, 2, 3)] == ["allow", "block", "allow", "block"] and (got[2].host, got[2].path) == ("www.example.com", "/en/1")
    assert (got[5].host, got[5].path, got[6].host) == ("", "", "") and all(r.verdict in ("allow", "block") for r in got.values())
    assert urlfilter.judge(rows.limit(0), URL_RULES).count() == 0
    tie = rows.limit(1).select(urlfilter.matching_rule(F.lit("a.com"), F.lit("/"), [("block", "com/"), ("allow", "com/")])["verdict"])
    assert tie.first()[0] == "block"


# --- preference pairs


def test_preferences(spark):
    kind = "pair_id long, turn long, role string, text string"
    chosen = spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", "good"), (2, 0, "user", "only"), (None, 0, "user", "lost")], kind)
    rejected = spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", "bad"), (1, 2, "user", None)], kind)
    got = {r.pair_id: r for r in chat.preference_pairs(chosen, rejected).collect()}
    assert (got[1].prompt, got[1].n_prompt_turns, got[1].chosen, got[1].rejected) == ("<|user|>\nq\n", 1, "<|assistant|>\ngood\n", "<|assistant|>\nbad\n<|user|>\n\n")
    assert [got[1].chosen[s.start : s.end] for s in got[1].chosen_spans] == ["good\n"] and [got[1].rejected[s.start : s.end] for s in got[1].rejected_spans] == ["bad\n"]
    assert (got[2].prompt, got[2].rejected, got[2].chosen_spans) == ("", "", []) and len(got) == 2
    assert chat.preference_pairs(chosen.limit(0), rejected.limit(0)).count() == 0


# --- WARC


def test_warc_round_trip(spark, tmp_path):
    html = ["a", "a", None, "", "x\r\n\r\n\r\ny" * 30_000, "é" * 100_000, "0\r\n\r\n", "\r\n\r\n"]
    pages = spark.createDataFrame([(i, None if i == 1 else f"https://x/{i}", h) for i, h in enumerate(html)], "page_id long, url string, html string")
    warc.write_archives(pages, str(tmp_path / "w"))
    stored = warc.reassemble(warc.read_archives(spark, str(tmp_path / "w"))).collect()
    got = {r.page_id: r for r in stored}
    assert all(r.complete for r in stored) and len(got) == len(html) and max(r.segments for r in stored) > 1
    for i, h in enumerate(html):
        if got[i].type == "response":
            assert bytes(got[i].payload) == (h or "").encode()
    assert (got[1].type, got[1].refers_to, got[3].type, got[3].refers_to, got[0].type) == ("revisit", 0, "revisit", 2, "response")
    lost = warc.reassemble(warc.read_archives(spark, str(tmp_path / "w")).filter("number <> 2"))
    assert not lost.filter("page_id = 4").first().complete


def test_dechunk():
    assert warc.dechunk(b"3;x=1\r\nabc\r\n1\r\n\r\r\n0\r\nTrailer: y\r\n\r\n") == b"abc\r"


# --- licences


def test_licenses(spark, none):
    texts = ["intro words. Licensed under the Apache License, Version 2.0. And more text follows here", "Released under the MIT License.", "licensed under nothing of note at all", None, "", "Licensed under CC BY-NC 4.0. " * 3]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r.doc_id, r.license, r.containment, r.first_word) for r in licenses.license_notices(rows).collect()}
    assert got == {(0, "Apache-2.0", 1.0, 0), (1, "MIT", 1.0, 0), (5, "CC-BY-NC-4.0", 1.0, 0)}
    assert licenses.license_notices(none).count() == 0
