"""The n-gram models against dictionary versions of them, over the whole smallest tables."""

import contextlib
import io
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pubweave.llm import common, langid, ngrams, queries, urlfilter

SF = "/root/testdata/sf0.001"


def level_counts(texts, order, pad, continuation):
    """counts[k] of k-grams, as tuples."""
    counts = [None] * (order + 1)
    counts[order] = Counter(tuple(([pad] * (order - 1) + s)[i : i + order]) for s in texts for i in range(len(s)))
    for k in range(order - 1, 0, -1):
        counts[k] = Counter()
        for g, n in counts[k + 1].items():
            counts[k][g[1:]] += 1 if continuation else n
    return counts


class Plain:
    def __init__(self, texts, order, pad, size, kneser_ney):
        self.counts, self.size, self.kneser_ney = level_counts(texts, order, pad, kneser_ney), size, kneser_ney
        self.total, self.kinds = defaultdict(int), defaultdict(int)
        self.discount = [None]
        for c in self.counts[1:]:
            for g, n in c.items():
                self.total[g[:-1]] += n
                self.kinds[g[:-1]] += 1
            once, twice = sum(n == 1 for n in c.values()), sum(n == 2 for n in c.values())
            self.discount.append(once / (once + 2 * twice) if once and twice else 0.5)

    def prob(self, g):
        if not g:
            return 1 / self.size
        context, rest = g[:-1], self.prob(g[1:])
        if not self.total[context]:
            return rest
        total, kinds, n = self.total[context], self.kinds[context], self.counts[len(g)][g]
        if self.kneser_ney:
            d = self.discount[len(g)]
            return max(n - d, 0) / total + d * kinds / total * rest
        return (n + kinds * rest) / (total + kinds)

    def nats(self, s, order, pad):
        full = [pad] * (order - 1) + s
        return -sum(math.log(self.prob(tuple(full[i : i + order]))) for i in range(len(s))) / max(1, len(s))


def letters(text):
    out = []
    for c in text or "":
        low = (c.lower() if len(c.lower()) == 1 else c) if c.isalpha() else " "
        if low != " " or not out or out[-1] != " ":
            out.append(low)
    return out


def test_languages(spark):
    p = langid.Params()
    part = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("part")), F.lit(1_000_000)) < 200_000
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("*", langid.held_out().alias("held"), part.alias("later")).collect()
    taught = [r for r in rows if not r.held and r.lang is not None and r.text is not None]
    langs = sorted({r.lang for r in taught})
    size = len({c for r in taught for c in letters(r.text)} - {" "}) + 2
    models = [Plain([letters(r.text) for r in taught if r.lang == k and not r.later], p.order, " ", size, True) for k in langs]
    nats = {r.doc_id: [m.nats(letters(r.text), p.order, " ") for m in models] for r in rows}
    level = {}
    for i, k in enumerate(langs):
        own = [nats[r.doc_id][i] - p.spread / math.sqrt(max(1, len(letters(r.text)))) for r in taught if r.later and r.lang == k and min(nats[r.doc_id]) == nats[r.doc_id][i]]
        level[k] = np.quantile(own, p.admit) + p.slack if own else math.inf
    got = {r.doc_id: r for r in queries.op1_language_id(spark, SF).collect()}
    found = {r.doc_id: r for r in langid.identify(spark.read.parquet(f"{SF}/documents.parquet"), langid.fit(spark.read.parquet(f"{SF}/documents.parquet"))).collect()}
    assert len(got) == len(rows)
    for r in rows:
        own, all_of = got[r.doc_id], nats[r.doc_id]
        if not any(c != " " for c in letters(r.text)):
            assert own.lang_pred == "und" and own.score == 0 and own.rejected
            continue
        best = langs[all_of.index(min(all_of))]
        assert own.lang_pred == best and own.held_out == r.held
        assert found[r.doc_id].nats_per_symbol == pytest.approx(min(all_of), abs=1e-4)
        assert own.rejected == (min(all_of) > level[best] + p.spread / math.sqrt(max(1, len(letters(r.text)))))
        z = [-x * math.sqrt(len(letters(r.text))) for x in all_of]
        assert any(own.score == pytest.approx(1 / sum(math.exp(t * (x - max(z))) for x in z), abs=2e-3) for t in langid.SHARPNESS)


def test_urls(spark):
    p = urlfilter.Params()
    judged = queries.op4_url_filter(spark, SF).collect()
    order, symbols = p.order + 1, lambda u: [b + 1 for b in u.replace("\n", " ").encode() + b"\n"]
    url = spark.createDataFrame(sorted({(r.host + r.path, r.verdict == "allow") for r in judged if r.rule}), "url string, accepted boolean")
    part = F.pmod(F.xxhash64("url", F.lit("part")), F.lit(1_000_000)) < 200_000
    taught = [r for r in url.withColumn("later", part).collect() if r.url]
    models = [Plain([symbols(r.url) for r in taught if r.accepted is kind and not r.later], order, 0, 257, False) for kind in (True, False)]
    ratio = lambda u: models[1].nats(symbols(u), order, 0) - models[0].nats(symbols(u), order, 0)
    of = lambda kind: [ratio(r.url) for r in taught if r.later and r.accepted is kind]
    accepted, rejected = of(True), of(False)
    threshold = 0.0
    if accepted and rejected:
        values = sorted({*accepted, *rejected})
        cuts = [0.0, values[0] - 1e-9, values[-1] + 1e-9, *((a + b) / 2 for a, b in zip(values, values[1:], strict=False))]
        share = lambda xs, cut: sum(x < cut for x in xs) / len(xs)
        threshold = min((1 - share(rejected, c), share(accepted, c), abs(c), c) for c in cuts if share(accepted, c) <= p.false_block)[-1]
    undecided = [r for r in judged if r.rule is None]
    assert undecided
    for r in undecided:
        assert r.log_ratio == pytest.approx(ratio(r.host + r.path), abs=1e-4)
        if abs(r.log_ratio - threshold) > 1e-3:
            assert r.verdict == ("allow" if r.log_ratio > threshold else "block")


@pytest.mark.parametrize("kneser_ney", [True, False])
def test_probabilities_sum_to_one(kneser_ney):
    rng = np.random.default_rng(1)
    texts = [[rng.integers(1, 5, 9).astype(np.uint16) for _ in range(4)] for _ in range(3)]
    t = ngrams.Tables([ngrams.counted(x, 3, 4, 0) for x in texts], 3, 4, 6, kneser_ney)
    for context in ((1, 1), (2, 3), (0, 0), (5, 5)):
        every = np.array([context[0] << 8 | context[1] << 4 | s for s in range(6)], np.uint64)
        assert np.exp(t.log(every)).sum(0) == pytest.approx(1, abs=1e-4)
    grams = rng.integers(0, 1 << 12, 500).astype(np.uint64)
    want = t.computed(grams)
    assert (t.log(grams) == want).all() and (t.log(grams[::-1].copy()) == want[::-1]).all()
    assert not ngrams.Tables([], 3, 4, 6, kneser_ney).log(grams).size


def test_the_worker_forgets(monkeypatch):
    monkeypatch.setattr(ngrams, "REMEMBER", 40)
    t = ngrams.Tables([ngrams.counted([np.arange(1, 9, dtype=np.uint16)], 2, 4, 0)], 2, 4, 10, True)
    for k in range(8):
        grams = np.arange(k * 30, k * 30 + 30, dtype=np.uint64) % 256
        assert (t.log(grams) == t.computed(grams)).all() and t.rows.size <= 40


def test_every_url_teaches(spark):
    """More URLs of a class than a sample would hold: all are counted or calibrate."""
    rows = spark.range(60_000).select(F.concat(F.lit("h.example/"), F.col("id").cast("string")).alias("url"), (F.col("id") % 3 != 0).alias("accepted"))
    later = F.pmod(F.xxhash64("url", F.lit("part")), F.lit(1_000_000)) < 200_000
    want = {r.accepted: r.n for r in rows.filter(~later).groupBy("accepted").agg(F.count(F.lit(1)).alias("n")).collect()}
    model = urlfilter.fit(rows.union(rows.limit(10)))
    ends = model.counts.filter(F.col("gram").bitwiseAND((1 << urlfilter.BITS) - 1) == urlfilter.END).agg(F.sum("n0"), F.sum("n1")).first()
    assert tuple(ends) == (want[True], want[False]) and want[True] > 30_000


def test_url_plans_stay_small(spark, monkeypatch):
    """The driver plans, compiles and reports every table that is written; the n-gram levels once made plans of dozens of exchanges, twice a run."""
    exchanges = []

    def stored(df, name, keep=common.stored):
        with contextlib.redirect_stdout(io.StringIO()) as plan:
            df.explain()
        exchanges.append(len(re.findall(r"Exchange (?!SinglePartition)", plan.getvalue())))
        return keep(df, name)

    monkeypatch.setattr(urlfilter, "stored", stored, raising=False)
    monkeypatch.setattr(urlfilter, "written", lambda df, name: stored(df, name)[0])
    assert queries.op4_url_filter(spark, SF).count() == spark.read.parquet(f"{SF}/pages.parquet").count()
    assert max(exchanges) <= 12 and sum(exchanges) <= 30, exchanges


def test_thresholds_of_tables(spark):
    rng = random.Random(8)
    sides = [([0.5], [0.25]), ([1.0], [2.0]), ([1.0, 1.0], [1.0]), ([1.0], []), ([], [1.0])]
    sides += [([rng.randint(-20, 20) / 8 for _ in range(rng.randint(1, 60))], [rng.randint(-20, 20) / 8 for _ in range(rng.randint(1, 60))]) for _ in range(6)]
    for k, (a, r) in enumerate(sides):
        share = (0.0, 0.1, 0.3, 1.0)[k % 4]
        df = spark.createDataFrame([(True, x) for x in a] + [(False, x) for x in r], "accepted boolean, ratio double")
        assert urlfilter.threshold_of(df, share) == urlfilter.best_threshold(np.array(a), np.array(r), share), (a, r, share)


def test_thresholds():
    best = lambda a, r: urlfilter.best_threshold(np.array(a, float), np.array(r, float), 0.0)
    assert best([1, 2], [-1, -2]) == 0 and best([], [1]) == 0 and best([1], []) == 0
    assert 1 < best([2, 3], [0.5, 1]) < 2 and best([-1, 2], [-3, 1]) == pytest.approx(-2)
