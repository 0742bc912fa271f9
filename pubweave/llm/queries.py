"""The registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pubweave.llm import ann, bpe, chat, divergence, exactdedup, langid, licenses, mixing, periodic, quality, simhash, urlfilter, warc
from pubweave.llm.common import let, remove, shared_path, written


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    models = langid.fit(docs)
    found = langid.identify(docs.select("doc_id", "text"), models)
    return found.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score", "rejected")


def op2_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_table(spark, sf_dir, "documents"))


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sizes(_table(spark, sf_dir, "documents"))


#: The rules of the URL filter.
URL_RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(_table(spark, sf_dir, "pages"), URL_RULES)


def op5_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each conversation against itself with the last reply of another."""
    pairs = chat.formatted(chat.swapped_pairs(_table(spark, sf_dir, "conversations")))
    spans = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string"))), ",")
    return pairs.withColumn("chosen_spans", spans(F.col("chosen_spans"))).withColumn("rejected_spans", spans(F.col("rejected_spans")))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digests(_table(spark, sf_dir, "documents"), default_vocabulary)


#: Small enough that about a fifth of the pages are written in several segments, and most in several chunks.
SEGMENT_BYTES, CHUNK_BYTES = 4 << 10, 1 << 10


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives are written, read back into a narrow table, and removed."""
    path = shared_path(spark, "warc")
    warc.write_archives(_table(spark, sf_dir, "pages"), path, segment_bytes=SEGMENT_BYTES, chunk_bytes=CHUNK_BYTES)
    stored = written(warc.page_records(warc.reassemble(warc.read_archives(spark, path))), "warc-pages")
    remove(spark, path)
    return stored.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "segments")


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_notices(_table(spark, sf_dir, "documents"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactdedup.exact_duplicates(_table(spark, sf_dir, "documents"))


def op11_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors.filter("vec_id % 20 = 0"), vectors)


def with_planted_tail(docs: DataFrame) -> DataFrame:
    """Of a tenth of the documents, chosen by their id, the words from a place on are repeated."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)

    def planted(words):
        n = F.size(words)
        a = F.pmod(g, n.cast("long"))
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + F.pmod(g, F.lit(8))))
        return let(F.struct(words.alias("w"), a.alias("a"), p.alias("p")), lambda x: F.transform(x["w"], lambda w, i: F.when(i < x["a"], w).otherwise(F.get(x["w"], (x["a"] + F.pmod(i - x["a"], x["p"])).cast("int")))))

    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    tail = let(words, lambda w: F.when(F.size(w) > 0, F.array_join(planted(w), " ")).otherwise(F.lit("")))
    return docs.withColumn("text", F.when(F.pmod(h, F.lit(10)) == 0, tail).otherwise(F.col("text")))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_planted_tail(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periodic.text_runs(docs).withColumn("best", periodic.longest_run())
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    length = -F.col("best")["l"]
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best")["start"].alias("start"), length.alias("length"), F.col("best")["period"].alias("period"),
        F.floor(length * 1000 / F.col("best")["period"]).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(_table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = [op1_language_id, op2_divergence, op3_source_mix, op4_url_filter, op5_preferences, op6_bpe, op7_warc, op8_licenses, op9_simhash, op10_exact_dedup, op11_hnsw, op12_periodic_runs, op13_source_divergence]
    return {f.__name__: f for f in own} | {"pipeline": pipeline}


SQL = {
    "op3_source_mix": r"""
WITH d AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS k,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS total,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS w
  FROM d GROUP BY source
), r AS (
  SELECT *, 2 * total AS cap, (2 * total) / CAST(w AS DOUBLE) AS ratio,
         sum(total) OVER () * CAST(1.5 AS DOUBLE) AS all_size, CAST(sum(w) OVER () AS DOUBLE) AS all_w FROM s
), l AS (
  SELECT *, (all_size - coalesce(sum(cap) OVER before, 0)) / (all_w - coalesce(sum(w) OVER before, 0)) > ratio AS is_full
  FROM r WINDOW before AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), t AS (
  SELECT source, total, CASE WHEN is_full THEN CAST(cap AS DOUBLE) ELSE
    w * ((all_size - sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER ())
         / nullif(all_w - sum(CASE WHEN is_full THEN w ELSE 0 END) OVER (), 0)) END AS target
  FROM l
), p AS (
  SELECT d.doc_id, d.size, t.total, t.target, CAST(floor(t.target + 0.5) AS BIGINT) AS budget,
         CAST(coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, total AS source_size, target,
       CAST(CASE WHEN total = 0 THEN 0 ELSE (budget // total) * size
         + greatest(0, least(size, budget - (budget // total) * total - before)) END AS BIGINT) AS taken
FROM p""",
    "op10_exact_dedup": """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))""",
}


SQL["op5_preferences"] = """
WITH t AS (
  SELECT conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), l AS (
  SELECT conv_id, max(turn) AS last, arg_max(text, (turn, text)) AS reply FROM t WHERE role = 'assistant' GROUP BY conv_id
), r AS (
  SELECT t.* FROM t LEFT JOIN l USING (conv_id) WHERE l.last IS NULL OR t.turn < l.last
  UNION ALL
  SELECT a.conv_id, a.last, 'assistant', b.reply FROM l AS a JOIN l AS b ON b.conv_id = xor(a.conv_id, 1)
), s AS (
  SELECT 'c' AS side, *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS pos FROM t
  UNION ALL
  SELECT 'r' AS side, *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS pos FROM r
), d AS (
  SELECT coalesce(a.conv_id, b.conv_id) AS conv_id,
         min(CASE WHEN a.role = b.role AND a.text = b.text THEN NULL ELSE coalesce(a.pos, b.pos) END) AS first_other, count(*) AS n
  FROM (FROM s WHERE side = 'c') AS a FULL JOIN (FROM s WHERE side = 'r') AS b ON a.conv_id = b.conv_id AND a.pos = b.pos
  GROUP BY 1
), p AS (
  SELECT s.*, coalesce(first_other - 1, n) AS n_prompt, '<|' || role || '|>' || chr(10) || text || chr(10) AS turn_text,
         CASE WHEN pos <= coalesce(first_other - 1, n) THEN 'p' ELSE side END AS part
  FROM s JOIN d USING (conv_id)
), e AS (
  SELECT *, CAST(sum(length(turn_text)) OVER (PARTITION BY conv_id, side, part ORDER BY pos) AS BIGINT) AS ends FROM p
)
SELECT conv_id AS pair_id, any_value(n_prompt) AS n_prompt_turns,
  coalesce(string_agg(turn_text, '' ORDER BY pos) FILTER (part = 'p' AND side = 'c'), '') AS prompt,
  coalesce(string_agg(turn_text, '' ORDER BY pos) FILTER (part = 'c'), '') AS chosen,
  coalesce(string_agg(turn_text, '' ORDER BY pos) FILTER (part = 'r'), '') AS rejected,
  coalesce(string_agg((ends - length(text) - 1) || '-' || ends, ',' ORDER BY pos) FILTER (part = 'c' AND role = 'assistant'), '') AS chosen_spans,
  coalesce(string_agg((ends - length(text) - 1) || '-' || ends, ',' ORDER BY pos) FILTER (part = 'r' AND role = 'assistant'), '') AS rejected_spans
FROM e GROUP BY conv_id"""

# a response's block: two header lines, the framing line, chunks with their lengths in hexadecimal, the closing chunk
SQL["op7_warc"] = f"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY hex) AS first, payload_bytes % {CHUNK_BYTES} AS tail FROM p
), b AS (
  SELECT *, length('HTTP/1.1 200 OK') + length('Content-Type: text/html; charset=utf-8') + length('Transfer-Encoding: chunked') + 8 + payload_bytes
    + (payload_bytes // {CHUNK_BYTES}) * (length(printf('%x', {CHUNK_BYTES})) + 4) + CASE WHEN tail > 0 THEN length(printf('%x', tail)) + 4 ELSE 0 END + 5 AS block FROM f
)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(1 + ((CAST('0x' || substr(hex, CAST(i // 4 * 5 + 1 AS INTEGER), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31) AS INTEGER), 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to,
  CAST(CASE WHEN page_id = first THEN (block + {SEGMENT_BYTES - 1}) // {SEGMENT_BYTES} ELSE 1 END AS INTEGER) AS segments
FROM b"""

SQL["op13_source_divergence"] = r"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS doc,
         list_transform(regexp_extract_all(coalesce(text, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+'),
                        lambda t: translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS terms
  FROM documents
), w AS (
  SELECT lang, source, doc, unnest(terms) AS term FROM d
), kept AS (
  SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT doc) >= 3
), g AS (
  SELECT DISTINCT lang, source FROM d
), v AS (
  SELECT lang, count(*) AS v FROM kept GROUP BY lang
), c AS (
  SELECT w.lang, w.source, w.term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY w.lang, w.source, w.term
), own AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n FROM g JOIN kept AS k USING (lang) LEFT JOIN c USING (lang, source, term)
), p AS (
  SELECT lang, source, term, n,
    1 + (CAST(1000000000 AS HUGEINT) * (n + 1)) // (sum(n) OVER (PARTITION BY lang, source) + v) AS p,
    1 + (CAST(1000000000 AS HUGEINT) * (sum(n) OVER (PARTITION BY lang, term) + 1)) // (sum(n) OVER (PARTITION BY lang) + v) AS q
  FROM own JOIN v USING (lang)
), r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(sum((a.p - b.p) * (a.p - b.p) // b.p) AS BIGINT) AS value
  FROM p AS a JOIN p AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source
  UNION ALL
  SELECT a.lang, a.source, 'pair', b.source, 0 FROM g AS a JOIN g AS b ON a.lang = b.lang AND a.source <> b.source WHERE a.lang NOT IN (SELECT lang FROM v)
  UNION ALL
  SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // q AS BIGINT) FROM p WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM r QUALIFY part = 'pair' OR rank <= 200"""

SQL["op8_licenses"] = licenses.oracle()


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
