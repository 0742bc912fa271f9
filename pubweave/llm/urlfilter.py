"""URL filters: rules first, then the ratio of two Markov models of URLs."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pubweave.llm.common import remove, slices, stored, written
from pubweave.llm.ngrams import laid_out, packed
from pubweave.operators.numbering import number_sorted

#: Bits of a symbol in a packed sequence: a byte and one, or 0 before the URL begins.
BITS, BEFORE, END = 9, 0, 11
#: Log-likelihoods are summed in whole parts of a nat, so that a sum doesn't depend on its order.
PARTS = 1 << 30


@dataclass
class Params:
    #: Longest context, in characters.
    order: int = 5
    #: Largest share of the accepted calibration URLs that the threshold may block.
    false_block: float = 0.01


def host_of(url: Column) -> Column:
    """What follows the first ``://``, up to ``/``, ``?`` or ``#``, with A-Z in lower case; null or no ``://``: empty."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """struct(rule, verdict) of the longest of the (verdict, host/path) rules that fits the
    host or a domain above it and begins the path; null if none does. Among equally long
    rules the first listed wins."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(reversed(rules), key=lambda r: len(r[1])):  # the last one wrapped around the others wins
        domain, _, start = rule.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith("/" + start)
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def ending(gram: Column, k: int) -> Column:
    """The last k symbols of a packed n-gram."""
    return gram.bitwiseAND((1 << (BITS * k)) - 1)


def symbols_of(url: str) -> np.ndarray:
    """The bytes of a URL and its end (a line feed; those inside count as spaces)."""
    own = np.frombuffer(url.replace("\n", " ").encode("utf-8", "replace") + b"\n", np.uint8)
    return own.astype(np.uint16) + 1


def _ends(batches: Iterator[pa.RecordBatch], order: int) -> Iterator[pa.RecordBatch]:
    """A row (id, gram) for each symbol of the URLs (id, url): the n-gram that ends there."""
    for batch in slices(batches, 2048):
        own = [symbols_of(u) for u in batch.column(1).to_pylist()]
        flat, sizes = laid_out(own, order, BEFORE)
        first = np.cumsum(sizes + order - 1) - (sizes + order - 1)
        at = np.repeat(first - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        grams = packed(flat, order, BITS)[at].view(np.int64)
        for k in range(0, max(1, len(grams)), 1 << 18):
            rows = np.repeat(np.arange(len(own)), sizes)[k : k + (1 << 18)]
            yield pa.record_batch([batch.column(0).take(pa.array(rows)), pa.array(grams[k : k + (1 << 18)])], ["id", "gram"])


def url_grams(urls: DataFrame, order: int) -> DataFrame:
    """Rows (id, gram) of the n-grams of URLs (id, url), one for each symbol."""
    kind = urls.schema["id"].dataType.simpleString()
    return urls.select("id", "url").mapInArrow(lambda batches: _ends(batches, order), f"id {kind}, gram long")


@dataclass
class RatioFilter:
    """Accepts a URL whose mean log-likelihood per byte is higher under the accepted URLs' model
    than under the rejected ones' by the threshold or more.

    The models (class 0 the accepted, 1 the rejected) are of variable order, smoothed by
    Witten-Bell: a byte's probability under each context it follows is its share there, mixed
    with that under the next shorter context by the number of kinds seen after it. They are a table
    (gram, n0, n1) of how often each class has the longest n-grams, which is joined with what is judged,
    so they may be of any size.
    """

    counts: DataFrame
    order: int
    threshold: float = 0.0
    blind: bool = False

    def _gram_counts(self, grams: DataFrame) -> DataFrame:
        """(k, g, and by class n, t, kinds) of the n-grams asked for and all their endings, k symbols long: how often a class has
        the n-gram, how often its context, and how many kinds of symbols after that. What has been counted and what is asked for
        meet in one grouping, and the n-grams of a context, 256 at most, in one window."""
        none = F.lit(0).cast("long")
        counted = self.counts.select("gram", "n0", "n1", F.lit(False).alias("asked"))
        both = counted.union(grams.select("gram", none, none, F.lit(True)))
        summed = [F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.bool_or("asked").alias("asked")]
        levels = F.array(*[F.struct(F.lit(k).alias("k"), ending(F.col("gram"), k).alias("g")) for k in range(1, self.order + 1)])
        every = both.groupBy("gram").agg(*summed).select(F.explode(levels).alias("l"), "n0", "n1", "asked").select("l.k", "l.g", "n0", "n1", "asked")
        same = Window.partitionBy("k", F.shiftright("g", BITS))
        sums = {name: x.over(same) for c in (0, 1) for name, x in ((f"t{c}", F.sum(f"n{c}")), (f"kinds{c}", F.count_if(F.col(f"n{c}") > 0)))}
        return every.groupBy("k", "g").agg(*summed).withColumns(sums).filter("asked").drop("asked")

    def _gram_ratios(self, grams: DataFrame) -> DataFrame:
        """(gram, ratio) of different n-grams, from the lowest order up: one without count has the
        probability of its lower order, by the weight of its context where that has been seen."""
        parts, path = stored(self._gram_counts(grams), "url-gram-counts")
        mixed = lambda c, p: F.when(F.col(f"t{c}") > 0, (F.col(f"n{c}") + F.col(f"kinds{c}") * p) / (F.col(f"t{c}") + F.col(f"kinds{c}"))).otherwise(p)
        out = parts.filter("k = 1").select("g", *[mixed(c, F.lit(1 / 257)).alias(f"p{c}") for c in (0, 1)])
        for k in range(2, self.order + 1):
            lower = out.select(F.col("g").alias("lower"), F.col("p0").alias("q0"), F.col("p1").alias("q1"))
            level = parts.filter(F.col("k") == k).join(lower, ending(F.col("g"), k - 1) == F.col("lower"))
            out = level.select("g", *[mixed(c, F.col(f"q{c}")).alias(f"p{c}") for c in (0, 1)])
        known = written(out.select(F.col("g").alias("gram"), F.round((F.ln("p0") - F.ln("p1")) * PARTS).cast("long").alias("ratio")), "url-grams")
        remove(grams.sparkSession, path)
        return known

    def ratios(self, urls: DataFrame) -> DataFrame:
        """(id, ratio) of URLs (id, url) of different ids."""
        grams = url_grams(urls, self.order)
        sums = grams.join(self._gram_ratios(grams), "gram").groupBy("id").agg(F.sum("ratio").alias("s"), F.count(F.lit(1)).alias("n"))
        return sums.select("id", (F.col("s") / F.col("n") / PARTS).alias("ratio"))


def best_threshold(accepted: np.ndarray, rejected: np.ndarray, false_block: float) -> float:
    """The cut that admits the least share of rejected URLs, of those that block no more than
    ``false_block`` of the accepted; of equal ones that nearest to 0, where both models are
    even. 0 without a URL of each class."""
    if not len(accepted) or not len(rejected):
        return 0.0
    values = np.unique(np.concatenate([accepted, rejected]))
    cuts = np.concatenate([[0.0, values[0] - 1e-9, values[-1] + 1e-9], (values[1:] + values[:-1]) / 2])
    blocked = np.searchsorted(np.sort(accepted), cuts, "left") / len(accepted)
    admitted = 1 - np.searchsorted(np.sort(rejected), cuts, "left") / len(rejected)
    fine = np.flatnonzero(blocked <= false_block)
    best = fine[np.lexsort((np.abs(cuts[fine]), blocked[fine], admitted[fine]))[0]]
    return float(cuts[best])


def threshold_of(scores: DataFrame, false_block: float) -> float:
    """``best_threshold`` of rows (accepted, ratio), however many: it lies between the largest rejected ratio below the
    accepted one that may just not be blocked, and the next accepted one, and only those two come to the driver."""
    n = {r["accepted"]: r["n"] for r in scores.groupBy("accepted").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not n.get(True) or not n.get(False):
        return 0.0
    accepted, rejected = scores.filter("accepted").select("ratio"), scores.filter("not accepted").select("ratio")
    may = int(false_block * n[True])
    may += ((may + 1) / n[True] <= false_block) - (may / n[True] > false_block)
    one = lambda rows, found: rows.agg(found("ratio").alias("x")).first()["x"]
    if may >= n[True]:
        return best_threshold(np.array([one(accepted, F.max)]), np.array([one(rejected, F.max)]), 1.0)
    kept = number_sorted(accepted, "ratio", name="at").filter(F.col("at") == may).first()["ratio"]
    below = one(rejected.filter(F.col("ratio") < kept), F.max)
    if below is None:
        return best_threshold(np.array([one(accepted, F.min)]), np.array([one(rejected, F.min)]), 0.0)
    return best_threshold(np.array([one(accepted.filter(F.col("ratio") > below), F.min)]), np.array([below]), 0.0)


def taught(urls: DataFrame, params: Params | None = None) -> tuple[RatioFilter, DataFrame]:
    """From rows (url, accepted), null for one to be judged: the model, and rows (url, accepted, ratio) of the different
    URLs that it is asked about: those to be judged, and those the threshold is made of. They are scored together, in one go."""
    p = params or Params()
    later = F.col("accepted").isNotNull() & (F.pmod(F.xxhash64("url", F.lit("part")), F.lit(1_000_000)) < 200_000)
    rows = written(urls.select("url", "accepted").distinct().withColumns({"later": later, "id": F.monotonically_increasing_id()}), "urls")
    own = url_grams(rows.filter("accepted is not null and not later").select(F.col("accepted").alias("id"), "url"), p.order + 1)
    counts = written(own.groupBy("gram").agg(F.count_if("id").alias("n0"), F.count_if(~F.col("id")).alias("n1")), "url-counts")
    n = counts.agg(F.max("n0").alias("n0"), F.max("n1").alias("n1")).first()
    out = RatioFilter(counts, p.order + 1, blind=not n["n0"] or not n["n1"])
    asked = rows.filter("accepted is null or later")
    scores = written(out.ratios(asked).join(asked, "id").select("url", "accepted", "ratio"), "url-scores")
    if not out.blind:
        out.threshold = threshold_of(scores.filter("accepted is not null").select("accepted", "ratio"), p.false_block)
    return out, scores


def fit(urls: DataFrame, params: Params | None = None) -> RatioFilter:
    """From rows (url, accepted): both models, and the threshold.

    Every different URL has a part, and counts once, however often it occurs. A fifth of them, chosen by
    a hash, is kept from the models, as a threshold must come from URLs that they haven't seen; the models count
    all others, and the threshold is made of all of that fifth. N-grams are counted and URLs scored in Spark; the driver gets a few numbers.
    """
    return taught(urls.filter("url is not null and url <> '' and accepted is not null"), params)[0]


def judge(df: DataFrame, rules: list[tuple[str, str]], params: Params | None = None, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per input row: id, host, path, rule, verdict (allow or block), and the
    log-likelihood ratio per character (null where a rule decides). Urls are scored once each.

    The longest fitting rule decides. The URLs that rules decide teach the two models,
    which decide the others by host and path. A null url, or one without ``://``, has an
    empty host and path, fits no rule, and is judged by the models as an empty string.
    Without a URL of either class nothing is known and the models allow. An empty table
    gives no rows.
    """
    url = F.concat("host", "path")
    parts = df.select(F.col(id_col), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    parts = written(parts.withColumn("_uf", matching_rule(F.col("host"), F.col("path"), rules)), "url-parts")
    ruled, others = parts.filter("_uf is not null"), parts.filter("_uf is null")
    model, scores = taught(parts.select(url.alias("url"), (F.col("_uf.verdict") == "allow").alias("accepted")), params)
    ratio = scores.filter("accepted is null").select(F.col("url").alias("_uf_url"), F.col("ratio").alias("log_ratio"))
    learnt = F.lit("allow") if model.blind else F.when(F.col("log_ratio") >= model.threshold, "allow").otherwise("block")
    judged = others.join(ratio, url == F.col("_uf_url")).select(id_col, "host", "path", F.lit(None).cast("string").alias("rule"), learnt.alias("verdict"), "log_ratio")
    return ruled.select(id_col, "host", "path", "_uf.rule", "_uf.verdict", F.lit(None).cast("double").alias("log_ratio")).union(judged)
