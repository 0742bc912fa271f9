"""One query per operator over the given tables, with its SQL."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pubweave import constants as K
from pubweave.functions import scoring, titles, urls
from pubweave.operators import batches, blogs, checks, feeds, manysearch, posts, search, stories
from pubweave.operators.numbering import number_sorted
from pubweave.operators.storage import new_folder as _folder
from pubweave.plans import views as V
from pubweave.sources import readers, writers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


_URL = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


def _part(i: int, u: str = "url") -> str:
    return f"regexp_extract({u}, '{_URL}', {i})"


def _canonical(u: str = "url") -> str:
    path = f"regexp_replace(regexp_replace({_part(3, u)}, ';[^/]*$', ''), '/+$', '')"
    kept = f"list_sort(list_filter(string_split({_part(4, u)}, '&'), lambda x: x <> '' AND NOT regexp_full_match(lower(split_part(x, '=', 1)), '{K.TRACKING_KEYS}')))"
    return f"""('https://' || regexp_replace(lower({_part(2, u)}), '^www\\.', '') || CASE WHEN {path} = '' THEN '/' ELSE {path} END
      || CASE WHEN len({kept}) > 0 THEN '?' || array_to_string({kept}, '&') ELSE '' END || CASE WHEN regexp_matches({_part(5, u)}, '^[!/]') THEN '#' || {_part(5, u)} ELSE '' END)"""


HOST = f"regexp_replace(split_part(lower({_part(2)}), ':', 1), '^www\\.', '')"
NORM = lambda t: f"regexp_replace(lower(regexp_replace(regexp_replace({t}, '{K.YEAR_SUFFIX}', ''), '(?i){K.BRACKET_TAG}', ' ', 'g')), '[^a-z0-9]+', '', 'g')"


def _q(pattern: str) -> str:
    """A pattern as SQL text, its word borders minding letters of all scripts as Spark's do."""
    opened = re.sub(r"\\b(?=[A-Za-z(])", r"(^|[^\\w\\p{L}])", pattern)
    return opened.replace(r"\b", r"($|[^\w\p{L}])").replace("'", "''")


KIND = lambda t: "CASE " + " ".join(f"WHEN regexp_matches({t}, '(?i){_q(p)}') THEN '{k}'" for k, p in K.KIND_RULES) + " END"
CLEAN = lambda t: f"nullif(regexp_replace(regexp_replace({t}, '[\\r\\n]', ' ', 'g'), '^\\s+|\\s+$', '', 'g'), '')"


# --- URLs and titles ------------------------------------------------------------------


@query(f"SELECT page_id, {_canonical()} AS canonical_url FROM pages")
def canonical_urls(spark, d):
    return V.table(spark, d, "pages").select("page_id", urls.canonical_url(F.col("url")).alias("canonical_url"))


@query(f"SELECT page_id, array_to_string(list_transform(list_filter(string_split({_part(3)}, '/'), lambda x: x <> '')[1:6], lambda x: left(x, 40)), '/') AS slugs FROM pages")
def url_slugs(spark, d):
    return V.table(spark, d, "pages").select("page_id", urls.slugs(F.col("url")).alias("slugs"))


def _tail(u: str, fragment: bool) -> str:
    """Path or root, query, and fragment."""
    end = f" || CASE WHEN {_part(5, u)} <> '' THEN '#' || {_part(5, u)} ELSE '' END" if fragment else ""
    return f"coalesce(nullif({_part(3, u)}, ''), '/') || CASE WHEN {_part(4, u)} <> '' THEN '?' || {_part(4, u)} ELSE '' END{end}"


@query(f"SELECT page_id, {_tail('cu', True)} AS path, {_tail('url', False)} AS feed_path FROM (SELECT *, {_canonical()} AS cu FROM pages)")
def post_paths(spark, d):
    """Of stories, by their canonical URL; of feed entries, by their own."""
    url = F.col("url")
    return V.table(spark, d, "pages").select("page_id", urls.post_path(urls.canonical_url(url)).alias("path"), urls.post_path(url, fragment=False).alias("feed_path"))


@query("SELECT page_id, '/' AS path FROM pages")
def root_paths(spark, d):
    """Of the pages' hosts alone."""
    home = F.regexp_extract("url", "^[a-z]+://[^/?#]*", 0)
    return V.table(spark, d, "pages").select("page_id", urls.post_path(home).alias("path"))


@query(f"SELECT page_id, {HOST} AS key, 'https://' || {HOST} AS home FROM pages WHERE {_part(1)} IN ('http', 'https') AND {HOST} LIKE '%.%'")
def publisher_keys(spark, d):
    rows = V.table(spark, d, "pages").select("page_id", urls.blog_key(F.col("url")).alias("k"))
    return rows.filter("k is not null").select("page_id", "k.key", "k.home")


@query(f"SELECT page_id, {HOST} AS host, {HOST} IN ({', '.join(f"'{h}'" for h in K.DENIED_HOSTS)}) OR regexp_matches({HOST}, '\\.(gov|mil|edu)$|{K.DENIED_LABELS}') AS denied FROM pages")
def denied_hosts(spark, d):
    host = urls.host_of(F.col("url"))
    return V.table(spark, d, "pages").select("page_id", host.alias("host"), urls.denied(host).alias("denied"))


@query(f"SELECT doc_id, {NORM('string_split(text, chr(10))[1]')} AS norm_title FROM documents")
def normalized_titles(spark, d):
    return V.table(spark, d, "documents").select("doc_id", titles.norm_title(F.substring_index("text", "\n", 1)).alias("norm_title"))


@query(f"SELECT seq, {CLEAN('title')} AS title, {KIND('title')} AS kind FROM ({V.PAGE_STORIES}) UNION ALL SELECT item_id, {CLEAN('text')}, {KIND('text')} FROM benchmark")
def title_kinds(spark, d):
    rows = V.page_stories(spark, d).select("seq", "title").union(V.table(spark, d, "benchmark").select("item_id", "text"))
    return rows.select("seq", titles.clean_title(F.col("title")).alias("title"), titles.kind_rule(F.col("title")).alias("kind"))


@query(f"""SELECT key, round(avg(CAST(regexp_matches(title, '(?i){_q(K.CRAFT_TITLE)}') AS INTEGER)), 6) AS craft, round(avg(CAST(regexp_matches(title, '(?i){_q(K.EVENT_TITLE)}') AS INTEGER)), 6) AS event
FROM ({V.DOC_STORIES}) GROUP BY key""")
def title_rates(spark, d):
    rate = lambda test: F.round(F.avg(test(F.col("title")).cast("int")), 6)
    return V.doc_stories(spark, d).groupBy("key").agg(rate(titles.is_craft).alias("craft"), rate(titles.is_event).alias("event"))


# --- de-duplication and publishers ----------------------------------------------------

BY_URL = lambda view: f"""SELECT * EXCLUDE (rn) FROM (  -- noqa
  SELECT seq, "objectID", title, url, points, created_at_i, cu AS canonical_url, sum(num_comments) OVER g AS num_comments, count(*) OVER g - 1 AS repost_count,
    min(seq) OVER g AS first_seq, row_number() OVER (PARTITION BY cu ORDER BY points DESC, seq) AS rn
  FROM (SELECT *, {_canonical()} AS cu FROM ({view})) WINDOW g AS (PARTITION BY cu)) WHERE rn = 1""".replace("  -- noqa", "")  # noqa: E731
BY_TITLE = lambda view: f"""SELECT seq, "objectID", title, url, points, created_at_i, canonical_url, num AS num_comments, repost_count + more AS repost_count FROM (
  SELECT *, sum(num_comments) OVER g AS num, count(*) OVER g - 1 AS more, row_number() OVER (PARTITION BY h, nt ORDER BY points DESC, first_seq) AS rn
  FROM (SELECT *, regexp_extract(canonical_url, '^https://([^/?#]*)', 1) AS h, {NORM('title')} AS nt FROM ({BY_URL(view)})) WINDOW g AS (PARTITION BY h, nt)) WHERE rn = 1"""  # noqa: E731
STORY_COLUMNS = ["seq", "objectID", "title", "url", "points", "num_comments", "created_at_i"]


@query(f"SELECT seq, canonical_url, points, CAST(num_comments AS BIGINT) AS num_comments, repost_count FROM ({BY_URL(V.PAGE_STORIES)})")
def dedupe_by_url(spark, d):
    return stories.dedupe_by_url(V.page_stories(spark, d)).select("seq", "canonical_url", "points", "num_comments", "repost_count")


@query(f"SELECT seq, canonical_url, title, points, CAST(num_comments AS BIGINT) AS num_comments, repost_count FROM ({BY_TITLE(V.DOC_STORIES)})")
def dedupe_by_title(spark, d):
    once = stories.dedupe_by_url(V.doc_stories(spark, d).select(*STORY_COLUMNS))
    return stories.dedupe_by_title(once).select("seq", "canonical_url", "title", "points", "num_comments", "repost_count")


@query(f"""SELECT n0, n1, n2, round(100.0 * (n0 - n1) / n0, 3) AS url_pct, round(100.0 * (n1 - n2) / n1, 3) AS title_pct, round(100.0 * (n0 - n2) / n0, 3) AS total_pct FROM
(SELECT count(*) AS n0 FROM documents), (SELECT count(*) AS n1 FROM ({BY_URL(V.DOC_STORIES)})), (SELECT count(*) AS n2 FROM ({BY_TITLE(V.DOC_STORIES)}))""")
def dedupe_stats(spark, d):
    return stories.dedupe_stats(V.doc_stories(spark, d).select(*STORY_COLUMNS))


CANDIDATES = lambda view, n: f"""SELECT key, any_value(home) AS home, count(*) AS n_stories, CAST(sum(points) AS BIGINT) AS total_points, CAST(trunc(quantile_cont(points, 0.5)) AS INTEGER) AS median_points,
  max(points) AS max_points, min(created_at_i) AS first_seen, max(created_at_i) AS last_seen, list(title ORDER BY points DESC, seq)[1:5] AS sample_titles, list(url ORDER BY points DESC, seq)[1:5] AS sample_urls
  FROM ({view}) GROUP BY key HAVING count(*) >= {n}"""  # noqa: E731


@query(f"SELECT * REPLACE (array_to_string(sample_titles, ' | ') AS sample_titles, array_to_string(sample_urls, ' | ') AS sample_urls) FROM ({CANDIDATES(V.LINE_STORIES, 3)})")
def candidate_blogs(spark, d):
    rows = stories.aggregate_blogs(V.line_stories(spark, d))
    return rows.withColumn("sample_titles", F.array_join("sample_titles", " | ")).withColumn("sample_urls", F.array_join("sample_urls", " | "))


@query(f"""SELECT count(*) AS n_read, count(*) FILTER (NOT ok) AS n_skipped, count(DISTINCT key) FILTER (ok) AS n_keys, (SELECT count(*) FROM (SELECT key FROM (SELECT {HOST} AS key FROM pages) GROUP BY key HAVING count(*) >= 3)) AS n_candidates
FROM (SELECT {HOST} AS key, {HOST} LIKE '%.%' AS ok FROM pages)""")
def candidate_stats(spark, d):
    return stories.aggregate_stats(V.page_stories(spark, d))


@query(f"SELECT key, rn, title, url FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY points DESC, seq) AS rn FROM ({V.LINE_STORIES})) WHERE rn <= 5")
def top_samples(spark, d):
    rows = stories.top_samples(V.line_stories(spark, d)).select("key", F.posexplode(F.arrays_zip("sample_titles", "sample_urls")).alias("p", "s"))
    return rows.select("key", (F.col("p") + 1).cast("long").alias("rn"), F.col("s.sample_titles").alias("title"), F.col("s.sample_urls").alias("url"))


QUALITY = "((n_stories * ln(greatest(median_points, 1)) + 8 * ln(88.0)) / (n_stories + 8))"


@query(f"SELECT key, CAST(row_number() OVER (ORDER BY round({QUALITY}, 9) DESC, key) - 1 AS INTEGER) AS blog_id, round({QUALITY}, 6) AS quality FROM ({CANDIDATES(V.DOC_STORIES, 3)})")
def ranked_blogs(spark, d):
    return blogs.rank_blogs(stories.aggregate_blogs(V.doc_stories(spark, d))).select("key", "blog_id", F.round("quality", 6).alias("quality"))


@query(f"""SELECT seq, {_part(3)} <> '' AS has_path, points FROM ({V.PAGE_STORIES}) WHERE url <> '' AND title <> '' AND points >= 100 AND created_at_i >= {K.DAY0 + 864000}""")
def usable_stories(spark, d):
    rows = stories.above_bar(stories.usable_stories(V.page_stories(spark, d)), 100, K.DAY0 + 864_000)
    return rows.select("seq", (F.col("url").isNotNull() & (urls.url_parts(F.col("url"))["path"] != "")).alias("has_path"), "points")


# --- labels ---------------------------------------------------------------------------

LAST = f"SELECT * FROM ({V.LABEL_ROWS}) QUALIFY row_number() OVER (PARTITION BY key ORDER BY ord DESC) = 1"
OVERRIDES = [("src1.example", "trade"), ("src2.example", "personal"), ("src3.example", "no such source")]
OVERRIDDEN = f"SELECT * REPLACE (CASE key WHEN 'src1.example' THEN 'trade' WHEN 'src2.example' THEN 'personal' ELSE source END AS source) FROM ({LAST})"
SOFTWARE = ", ".join(f"'{t}'" for t in K.SOFTWARE_TOPICS)
INCLUDED = f"""SELECT l.*, c.* EXCLUDE (key), source IN ('newsroom', 'vendor', 'institution') AS hidden FROM ({OVERRIDDEN}) AS l JOIN ({CANDIDATES(V.DOC_STORIES, 3)}) AS c USING (key)
  WHERE key NOT IN (SELECT key FROM ({LAST}) WHERE toxic = 1)
  AND ((source IN ('engineering', 'project', 'trade') AND is_programming_blog) OR (source IN ('personal', 'vendor') AND is_programming_blog AND (topic1 IN ({SOFTWARE}) OR topic2 IN ({SOFTWARE}))) OR (source = 'newsroom' AND n_stories >= 20))"""
BIT = lambda t: "coalesce(map {" + ", ".join(f"'{s}': {1 << i}" for i, s in enumerate(K.TOPIC_SLUGS)) + f"}}[{t}], 0)"
MASK = f"CASE WHEN weight1 >= 0.25 THEN {BIT('topic1')} | {BIT('topic2')} ELSE {BIT('topic2')} END"
IDX = lambda slugs, x: "map {" + ", ".join(f"'{s}': {i}" for i, s in enumerate(slugs)) + f"}}[{x}]"


def _labels(spark, d):
    return readers.last_labels(V.label_rows(spark, d), "key", "ord")


def _overridden(spark, d):
    return blogs.apply_overrides(_labels(spark, d), spark.createDataFrame(OVERRIDES, "key string, source string"))


def _included(spark, d):
    deny = _labels(spark, d).filter("toxic = 1").select("key")
    return blogs.include_blogs(_overridden(spark, d), stories.aggregate_blogs(V.doc_stories(spark, d)), deny)


@query(f"SELECT key, source, kind, one_line, is_programming_blog FROM ({LAST})")
def labels_last_wins(spark, d):
    return _labels(spark, d).select("key", "source", "kind", "one_line", "is_programming_blog")


@query(f"SELECT key, source FROM ({OVERRIDDEN})")
def overridden_labels(spark, d):
    return _overridden(spark, d).select("key", "source")


@query(f"SELECT key, source, hidden, n_stories FROM ({INCLUDED})")
def included_blogs(spark, d):
    return _included(spark, d).select("key", "source", "hidden", "n_stories")


@query(f"SELECT key, n_stories FROM ({CANDIDATES(V.DOC_STORIES, 3)}) WHERE key IN (SELECT key FROM ({LAST}) WHERE is_programming_blog OR source IN ('newsroom', 'trade'))")
def feed_selection(spark, d):
    return blogs.select_for_feeds(stories.aggregate_blogs(V.doc_stories(spark, d)), _labels(spark, d)).select("key", "n_stories")


@query(f"SELECT ord, {MASK} AS topic_mask FROM ({V.LABEL_ROWS})")
def topic_masks(spark, d):
    return V.label_rows(spark, d).select("ord", scoring.topic_mask(F.col("topics")).alias("topic_mask"))


@query("SELECT key, n FROM (SELECT key, count(*) AS n FROM (" + V.LABEL_ROWS + ") GROUP BY key) WHERE n > 1")
def duplicate_labels(spark, d):
    return checks.duplicate_keys(V.label_rows(spark, d))


EXPECTED = "SELECT DISTINCT 'd' || lpad(CAST(doc_id AS VARCHAR), 8, '0') AS key FROM documents"
BATCHED = f"SELECT key, CAST((row_number() OVER (ORDER BY key) - 1) // 50 AS BIGINT) AS batch FROM ({EXPECTED})"
# label files of several batches each, as runs that read the wrong evidence leave them; a file's name has its batch
GIVEN = f"SELECT 'd' || lpad(CAST(doc_id AS VARCHAR), 8, '0') AS key, 'cls_' || (doc_id // 50 % 9) || '.jsonl' AS file FROM labels"
LARGEST = f"(SELECT max(n) FROM (SELECT count(*) AS n FROM ({GIVEN}) GROUP BY file))"
SIZED = f"SELECT key, CAST((row_number() OVER (ORDER BY key) - 1) // {LARGEST} AS BIGINT) AS batch FROM ({EXPECTED})"


def _expected(spark, d):
    return V.table(spark, d, "documents").select(F.concat(F.lit("d"), F.lpad(F.col("doc_id").cast("string"), 8, "0")).alias("key"))


def _given(spark, d):
    i = F.col("doc_id")
    return V.table(spark, d, "labels").select(F.concat(F.lit("d"), F.lpad(i.cast("string"), 8, "0")).alias("key"), F.concat(F.lit("cls_"), (F.floor(i / 50) % 9).cast("string"), F.lit(".jsonl")).alias("file"))


@query(f"SELECT batch, count(*) AS missing FROM ({SIZED}) WHERE key NOT IN (SELECT key FROM ({GIVEN})) GROUP BY batch ORDER BY missing DESC, batch LIMIT 3")
def missing_by_batch(spark, d):
    return checks.missing_by_batch(_expected(spark, d), _given(spark, d))


# of the slice of the sorted keys that a file's number stands for, those in the file must be half as many as the file's rows
@query(f"""WITH given AS ({GIVEN}), files AS (SELECT file, CAST(regexp_extract(file, '([0-9]+)', 1) AS BIGINT) AS batch, count(*) AS n_keys FROM given GROUP BY file), size AS (SELECT max(n_keys) AS n FROM files),
 keys AS (SELECT key, row_number() OVER (ORDER BY key) - 1 AS at FROM ({EXPECTED})), wanted AS (SELECT f.file, k.key FROM files AS f, size AS z, keys AS k WHERE k.at >= f.batch * z.n AND k.at < (f.batch + 1) * z.n)
SELECT f.file, f.batch, count(DISTINCT g.key) AS n_found, f.n_keys FROM files AS f JOIN wanted AS w USING (file) LEFT JOIN given AS g ON g.file = w.file AND g.key = w.key
GROUP BY f.file, f.batch, f.n_keys HAVING count(DISTINCT g.key) < 0.5 * f.n_keys""")
def mismatched_files(spark, d):
    return checks.mismatched_files(_expected(spark, d), _given(spark, d))


# labels with faults by their number: an unknown source, a kind left out, a topic without a slug, one that is unknown, none at all
FAULTY = f"""SELECT key, CASE WHEN ord % 11 = 3 THEN 'nowhere' ELSE source END AS source, CASE WHEN ord % 13 <> 4 THEN kind END AS kind,
  CASE ord % 17 WHEN 5 THEN 'no slug' WHEN 6 THEN 'unknown' WHEN 7 THEN 'none' END AS topics, confidence FROM ({V.LABEL_ROWS})"""


@query(f"""
WITH l AS ({FAULTY}), c AS (SELECT DISTINCT source || '.example' AS key FROM documents), found AS (
  SELECT 'malformed' AS "check", count(*) AS n FROM benchmark
  UNION ALL SELECT 'duplicates', count(*) FROM (SELECT key FROM l GROUP BY key HAVING count(*) > 1)
  UNION ALL SELECT 'unexpected', count(DISTINCT key) FROM l WHERE key NOT IN (FROM c)
  UNION ALL SELECT 'missing', count(*) FROM c WHERE key NOT IN (SELECT key FROM l)
  UNION ALL SELECT 'source', count(*) FROM l WHERE source = 'nowhere'
  UNION ALL SELECT 'kind', count(*) FROM l WHERE kind IS NULL
  UNION ALL SELECT 'topics', count(*) FROM l WHERE topics IS NOT NULL
  UNION ALL SELECT 'low confidence', count(*) FROM l WHERE confidence < 0.55)
SELECT "check", n = 0 OR "check" = 'low confidence' AS ok, n FROM found""")
def label_validation(spark, d):
    """Labels with faults in a part of their rows, and as many malformed lines as there are benchmark items."""
    i, topic = F.col("ord"), lambda slug: F.array(F.struct(slug.cast("string").alias("slug"), F.lit(1.0).alias("weight")))
    topics = F.when(i % 17 == 5, topic(F.lit(None))).when(i % 17 == 6, topic(F.lit("gardening"))).when(i % 17 != 7, F.col("topics"))
    faulty = V.label_rows(spark, d).withColumns({"source": F.when(i % 11 == 3, "nowhere").otherwise(F.col("source")), "kind": F.when(i % 13 != 4, F.col("kind")), "topics": topics})
    bad = V.table(spark, d, "benchmark").agg(F.count(F.lit(1)).alias("n_malformed"))
    return checks.label_validation(faulty, V.doc_stories(spark, d).select("key"), bad)


@query(f"SELECT count(*) FILTER (confidence < 0.55) AS n_low, round(avg(CAST(confidence < 0.55 AS INTEGER)), 9) AS share_low FROM ({V.LABEL_ROWS})")
def low_confidence(spark, d):
    return checks.low_confidence(V.label_rows(spark, d)).withColumn("share_low", F.round("share_low", 9))


# --- posts ----------------------------------------------------------------------------

RANKED = f"SELECT *, CAST(row_number() OVER (ORDER BY round({QUALITY}, 9) DESC, key) - 1 AS INTEGER) AS blog_id FROM ({INCLUDED})"
FALLBACK = f"coalesce({KIND('title')}, map {K.FALLBACK_KIND}[source], kind, 'deep-dive')"
RECENCY = lambda t: f"(1 / (1 + greatest(CAST(0 AS DOUBLE), ({V.AS_OF} - {t}) / CAST(31557600 AS DOUBLE)) / 6))"
SCORE = f"CAST(trunc(255 * (0.78 * (log10(greatest(points, 1)) / log10(3000.0)) + 0.22 * {RECENCY('created_at_i')})) AS INTEGER)"
RULE_FLAG = f"CASE WHEN {KIND('title')} IS NOT NULL THEN {K.FLAG_KIND_RULE} ELSE 0 END"
PACKED = f"CAST({IDX(K.KIND_SLUGS, FALLBACK)} | ({IDX(K.SOURCE_SLUGS, 'source')} << 3) AS INTEGER) AS kind_source"
STORY_POSTS = f"""SELECT blog_id, points, CAST((created_at_i - {K.DAY0}) // 86400 AS INTEGER) AS day, CAST(({MASK}) | {RULE_FLAG} AS INTEGER) AS topic_mask, {PACKED}, least(255, {SCORE}) AS score,
  CAST("objectID" AS BIGINT) AS hn_id, title, {_tail(_canonical(), True)} AS path, {_canonical()} AS canonical_url
  FROM (SELECT s.* REPLACE ({CLEAN('s.title')} AS title), b.* EXCLUDE (key, home) FROM ({V.DOC_STORIES}) AS s JOIN ({RANKED}) AS b USING (key)) WHERE title IS NOT NULL AND NOT (hidden AND points < 150)"""


def _ranked(spark, d):
    """The ranked blogs, written before the posts that refer to them."""
    path = _folder(spark, "blogs")
    blogs.rank_blogs(_included(spark, d)).write.parquet(path)
    return spark.read.parquet(path)


def _story_posts(spark, d, ranked):
    return posts.story_posts(V.doc_stories(spark, d).drop("home"), ranked.select("key", "blog_id", "source", "kind", "topics", "hidden"), V.AS_OF)


def _given_entries(spark, d):
    """Feed entries given to the documents' publishers."""
    key = F.concat(F.lit("src"), (F.col("feed_ord") % 20).cast("string"), F.lit(".example"))
    return V.feed_entries(spark, d).withColumn("key", key).filter("ts > 0")


def _entries_of_blogs(spark, d):
    """Feed entries of publishers of which every seventh has no feed."""
    return _given_entries(spark, d).filter("feed_ord % 20 % 7 <> 6")


FEED_POSTS = lambda of: f"""SELECT blog_id, 0 AS points, CAST((ts - {K.DAY0}) // 86400 AS INTEGER) AS day, CAST(({MASK}) | {RULE_FLAG} | {K.FLAG_FEED} AS INTEGER) AS topic_mask, {PACKED},
  CAST(trunc(120 * {RECENCY('ts')}) AS INTEGER) AS score, CAST(0 AS BIGINT) AS hn_id, title, {_tail('url', False)} AS path, {_canonical()} AS canonical_url
  FROM (SELECT e.* REPLACE ('src' || (feed_ord % 20) || '.example' AS key) FROM ({V.FEED_ENTRIES}) AS e WHERE {of}) JOIN ({RANKED}) AS b USING (key)"""  # noqa: E731


def _index(spark, d, ranked, entries=_entries_of_blogs):
    feed = posts.feed_posts(entries(spark, d), ranked.select("key", "blog_id", "source", "kind", "topics", "hidden"), V.AS_OF)
    return posts.build_posts(_story_posts(spark, d, ranked), feed)


def _whole_index(spark, d, ranked):
    """With the feed entries of every publisher."""
    return _index(spark, d, ranked, _given_entries)


INDEX_OF = lambda of: f"""SELECT *, CAST(row_number() OVER (ORDER BY part, day DESC, hn_id, canonical_url, title, blog_id) - 1 AS BIGINT) AS post_id
  FROM (SELECT *, 0 AS part FROM ({STORY_POSTS}) UNION ALL SELECT *, 1 FROM ({FEED_POSTS(of)}))"""  # noqa: E731
INDEX, WHOLE_INDEX = INDEX_OF("ts > 0 AND feed_ord % 20 % 7 <> 6"), INDEX_OF("ts > 0")


@query(STORY_POSTS)
def story_posts(spark, d):
    return _story_posts(spark, d, _ranked(spark, d))


@query(f"SELECT blog_id, n, h, s, tm, o, c, m, l, q FROM (SELECT blog_id, key AS n, home AS h, {IDX(K.SOURCE_SLUGS, 'source')} AS s, {MASK} AS tm, left(one_line, 110) AS o, n_stories AS c, median_points AS m, CAST(year(make_timestamp(last_seen * 1000000)) AS INTEGER) AS l, round({QUALITY}, 3) AS q FROM ({RANKED}))")
def blog_table(spark, d):
    return blogs.blog_rows(_ranked(spark, d))


@query(f"SELECT * EXCLUDE (part) FROM ({WHOLE_INDEX})")
def all_posts(spark, d):
    return _whole_index(spark, d, _ranked(spark, d))


@query(f"""SELECT hn_id, (CAST({K.DAY0} AS BIGINT) + day * CAST(86400 AS BIGINT)) * 1000 AS epoch_ms, kind_source & 7 AS kind, kind_source >> 3 AS source, topic_mask & 4095 AS topics,
 (topic_mask & {K.FLAG_FEED}) <> 0 AS from_feed, (topic_mask & {K.FLAG_KIND_RULE}) <> 0 AS rule_fired, (topic_mask & {K.FLAG_DEAD}) <> 0 AS dead FROM ({STORY_POSTS})""")
def unpacked_posts(spark, d):
    return posts.unpack_posts(_story_posts(spark, d, _ranked(spark, d))).select("hn_id", "epoch_ms", "kind", "source", "topics", "from_feed", "rule_fired", "dead")


@query(f"SELECT (SELECT count(*) FROM ({WHOLE_INDEX})) AS n_posts, (SELECT count(*) FROM ({INCLUDED})) AS n_blogs, (SELECT count(*) FROM documents) AS n_stories_scanned, {K.HIDDEN_MASK} AS hidden_source_mask")
def index_meta(spark, d):
    scanned, ranked = V.doc_stories(spark, d).agg(F.count(F.lit(1)).alias("n_stories_scanned")), _ranked(spark, d)
    return posts.index_meta(_whole_index(spark, d, ranked), blogs.blog_rows(ranked), scanned, V.AS_OF).select("n_posts", "n_blogs", "n_stories_scanned", "hidden_source_mask")


_SHARE = lambda cond: f"coalesce(avg(CAST({cond} AS INTEGER)), 0)"
_FEED = f"(topic_mask & {K.FLAG_FEED}) <> 0"
# each check: its value over all posts, or as a query of its own, and when it is fine
INDEX_RULES = {
    "posts": ("count(*)", "value > 100"), "blank titles": ("count(*) FILTER (coalesce(trim(title), '') = '')", "value = 0"), "least story points": (f"min(points) FILTER (NOT {_FEED})", "value >= 25"),
    "feed posts": (f"count(*) FILTER ({_FEED})", "value > 0"), "feed points": (f"coalesce(max(points) FILTER ({_FEED}), 0)", "value = 0"), "largest source": ("max(kind_source >> 3)", f"value < {len(K.SOURCES)}"),
    "largest kind": ("max(kind_source & 7)", f"value < {len(K.KINDS)}"), "rule share": (_SHARE(f"(topic_mask & {K.FLAG_KIND_RULE}) <> 0"), "value > 0.1 AND value < 0.6"), "no topic share": (_SHARE(f"(topic_mask & {K.TOPIC_BITS}) = 0"), "value < 0.05"),
    "no id share": (_SHARE(f"hn_id = 0 AND NOT {_FEED}"), "value < 0.01"), "hidden share": (_SHARE(f"({K.HIDDEN_MASK} & (1 << (kind_source >> 3))) <> 0"), "value > 0.1 AND value < 0.85"),
    "blogs": ("(SELECT count(*) FROM b) + 0 * count(*)", "value > 5"), "orphan posts": ("count(*) FILTER (blog_id NOT IN (SELECT blog_id FROM b))", "value = 0"), "missing canaries": ("(SELECT 1 - count(*) FROM b WHERE key = 'src1.example') + 0 * count(*)", "value = 0"),
    "posts beside meta": ("count(*) - (SELECT count(*) FROM documents)", "value = 0"), "blogs beside meta": ("0 * count(*)", "value = 0"),
}
INDEX_CHECKS = f"WITH b AS MATERIALIZED ({RANKED}), p AS MATERIALIZED ({INDEX}) " + " UNION ALL ".join(
    f"""SELECT '{name}' AS "check", coalesce({fine}, false) AS ok, round(value, 6) AS value FROM (SELECT CAST({value} AS DOUBLE) AS value FROM p)""" for name, (value, fine) in INDEX_RULES.items()
)


@query(INDEX_CHECKS)
def index_checks(spark, d):
    """Against a meta row that counts the documents as posts, as of an index cut short."""
    ranked = _ranked(spark, d)
    table = blogs.blog_rows(ranked)
    meta = table.agg(F.count(F.lit(1)).alias("n_blogs"), F.lit(K.HIDDEN_MASK).alias("hidden_source_mask")).crossJoin(V.table(spark, d, "documents").agg(F.count(F.lit(1)).alias("n_posts")))
    return checks.index_checks(_index(spark, d, ranked), table, meta, 100, 5, ["src1.example"])


# --- feeds ----------------------------------------------------------------------------

VALID = f"SELECT * FROM ({V.FEED_ENTRIES}) WHERE ts >= {K.DAY0} AND ts <= {V.AS_OF + 172800} AND NOT regexp_matches(key, '(?i){K.FORUM_HOST}')"
FIREHOSE = f"SELECT key FROM (SELECT key, ts, row_number() OVER (PARTITION BY key ORDER BY ts DESC, pos) AS rn FROM ({VALID})) GROUP BY key HAVING max(ts) - max(ts) FILTER (rn = 12) < 604800"


@query(f"SELECT key, pos, ts FROM ({VALID})")
def feed_valid_entries(spark, d):
    return feeds.valid_entries(V.feed_entries(spark, d), V.AS_OF).select("key", "pos", "ts")


@query(FIREHOSE)
def firehose_feeds(spark, d):
    return feeds.firehose_feeds(feeds.valid_entries(V.feed_entries(spark, d), V.AS_OF))


@query(f"SELECT key, pos, {_canonical()} AS canonical_url FROM ({VALID}) WHERE {_canonical()} NOT IN (SELECT 'https://blog.' || (event_id % 40) || '.example/e/' || (event_id % 400) FROM events WHERE event_id % 3 = 0)")
def new_feed_entries(spark, d):
    e = F.col("event_id")
    known = V.table(spark, d, "events").filter(e % 3 == 0).select(F.concat(F.lit("https://blog."), (e % 40).cast("string"), F.lit(".example/e/"), (e % 400).cast("string")).alias("canonical_url"))
    return feeds.new_feed_entries(feeds.valid_entries(V.feed_entries(spark, d), V.AS_OF), known).select("key", "pos", "canonical_url")


@query()
def capped_feed_entries(spark, d):
    valid = feeds.valid_entries(V.feed_entries(spark, d), V.AS_OF)
    kept = valid.join(feeds.firehose_feeds(valid), "key", "left_anti").withColumn("canonical_url", urls.canonical_url(F.col("url")))
    return feeds.cap_feed_entries(kept).select("key", "canonical_url", "ts")


OWN_URL = "'https://own.example/' || feed_ord || '/' || (pos % 60)"


@query(f"""SELECT key, cu AS canonical_url, ts FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY ts DESC, pos) AS rn FROM (
  SELECT *, {OWN_URL} AS cu FROM ({VALID}) WHERE key NOT IN ({FIREHOSE}) AND title NOT LIKE 'Re: %' QUALIFY row_number() OVER (PARTITION BY key, cu ORDER BY ts DESC, pos) = 1)) WHERE rn <= 12""")
def capped_own_entries(spark, d):
    """Feeds that share no URL, so that no choice depends on another's."""
    valid = feeds.valid_entries(V.feed_entries(spark, d), V.AS_OF)
    own = F.concat(F.lit("https://own.example/"), F.col("feed_ord").cast("string"), F.lit("/"), (F.col("pos") % 60).cast("string"))
    kept = valid.join(feeds.firehose_feeds(valid), "key", "left_anti").withColumn("canonical_url", own)
    return feeds.cap_feed_entries(kept).select("key", "canonical_url", "ts")


@query(f"SELECT (SELECT count(*) FROM customer) AS n_feeds, (SELECT count(*) FROM customer WHERE c_custkey % 10 = 0) AS n_forums, count(DISTINCT key) AS n_with_entries, count(*) FILTER (NOT (ts <> 0 AND ts BETWEEN {K.DAY0} AND {V.AS_OF + 172800})) AS n_bad_dates, (SELECT count(*) FROM ({FIREHOSE})) AS n_firehoses FROM ({V.FEED_ENTRIES})")
def feed_summary(spark, d):
    listed = V.table(spark, d, "customer").select(F.concat(F.when(F.col("c_custkey") % 10 == 0, "forum.").otherwise("blog."), F.col("c_custkey").cast("string"), F.lit(".example")).alias("key"))
    return feeds.feed_summary(listed, V.feed_entries(spark, d), V.AS_OF)


@query("SELECT page_id, CASE page_id % 3 WHEN 0 THEN regexp_extract(url, '^[a-z]+://[^/?#]*') || '/feed/' || page_id || '.xml' WHEN 1 THEN 'https://feeds.example/' || page_id END AS feed FROM pages")
def feed_links(spark, d):
    """Pages with a relative link to their feed, with an absolute one after a tag without address, and with none."""
    i = F.col("page_id").cast("string")
    tag = lambda href: F.concat(F.lit('<link rel="alternate" TYPE="application/rss+xml"'), href, F.lit(">"))
    relative, absolute = F.concat(F.lit(' href="/feed/'), i, F.lit('.xml"')), F.concat(F.lit(" href='https://feeds.example/"), i, F.lit("'"))
    link = F.when(F.col("page_id") % 3 == 0, tag(relative)).when(F.col("page_id") % 3 == 1, F.concat(tag(F.lit("")), tag(absolute))).otherwise("")
    return V.table(spark, d, "pages").select("page_id", urls.discover_feed_link(F.concat(link, F.coalesce("html", F.lit(""))), F.col("url")).alias("feed"))


@query("SELECT page_id, page_id % 3 <> 1 AS is_feed FROM pages")
def feed_looks(spark, d):
    """Bodies with the type of a feed, without it, and with its first line."""
    kind = F.when(F.col("page_id") % 3 == 0, "Application/RSS+XML").when(F.col("page_id") % 3 == 1, "text/html")
    body = F.when(F.col("page_id") % 3 == 2, F.concat(F.lit("\n <?xml version='1.0'?>"), "html")).otherwise(F.col("html"))
    return V.table(spark, d, "pages").select("page_id", urls.looks_like_feed(kind, body).alias("is_feed"))


@query(f"""SELECT page_id, i, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || [{', '.join(f"'{p}'" for p in K.FEED_PATHS)}][i + 1] AS guess FROM pages, range(14) AS r(i)""")
def candidate_feed_urls(spark, d):
    return V.table(spark, d, "pages").select("page_id", F.posexplode(urls.candidate_feed_urls(F.col("url"))).alias("i", "guess")).withColumn("i", F.col("i").cast("long"))


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'https://a' || doc_id || '.substack.com/feed' WHEN doc_id % 3 = 1 THEN 'https://dev.to/feed/u' || doc_id END AS feed FROM documents")
def platform_feeds(spark, d):
    i = F.col("doc_id").cast("string")
    home = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("https://a"), i, F.lit(".substack.com"))).when(F.col("doc_id") % 3 == 1, F.concat(F.lit("https://dev.to/u"), i)).otherwise(F.concat(F.lit("https://b"), i, F.lit(".example")))
    return V.table(spark, d, "documents").select("doc_id", urls.platform_feed(home).alias("feed"))


@query(r"SELECT page_id, left(trim(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')), 300) AS summary FROM pages")
def clean_summaries(spark, d):
    return V.table(spark, d, "pages").select("page_id", titles.clean_summary(F.col("html")).alias("summary"))


@query("SELECT 'blog' || (event_id % 50) AS key, event_type || ' ' || event_id AS title, CAST(floor(epoch(ts)) AS BIGINT) AS published, 'https://x.example/' || event_id || '?a=1&b=2' AS url FROM events")
def parsed_feeds(spark, d):
    """Events written out as small RSS documents, some not well-formed, and parsed."""
    e = F.col("event_id").cast("string")
    item = F.concat(F.lit("<item><title>"), F.col("event_type"), F.lit(" "), e, F.lit("</title><link>https://x.example/"), e, F.when(F.col("event_id") % 2 == 0, "?a=1&amp;b=2").otherwise("?a=1&b=2"), F.lit("</link><pubDate>"), F.date_format(F.col("ts").cast("timestamp"), "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT</pubDate></item>"))
    docs = V.table(spark, d, "events").select(F.concat(F.lit("blog"), (F.col("event_id") % 50).cast("string")).alias("key"), F.concat(F.lit("<rss><channel><title>t</title>"), item, F.lit("</channel></rss>")).alias("content"))
    return feeds.parse_feed_documents(docs).select("key", "title", "published", "url")


# --- browse and search ----------------------------------------------------------------

DOC_POSTS = f"SELECT doc_id AS post_id, CAST(substr(source, 4) AS INTEGER) AS blog_id, CAST(n_chars % 1000 AS INTEGER) AS points, CAST(doc_id * 7 % 5000 AS INTEGER) AS day, CAST(n_chars % 256 AS INTEGER) AS score, string_split(text, chr(10))[1] AS title, CAST(1 << (doc_id % 12) AS INTEGER) AS topic_mask, CAST(doc_id % 4 | ((doc_id % 7) << 3) AS INTEGER) AS kind_source FROM documents"


def _doc_posts(spark, d):
    i = F.col("doc_id")
    return V.table(spark, d, "documents").select(
        i.alias("post_id"), F.substring("source", 4, 10).cast("int").alias("blog_id"), (F.col("n_chars") % 1000).cast("int").alias("points"), (i * 7 % 5000).cast("int").alias("day"), (F.col("n_chars") % 256).cast("int").alias("score"),
        F.substring_index("text", "\n", 1).alias("title"), F.expr("shiftleft(1, cast(doc_id % 12 as int))").alias("topic_mask"), (i % 4).cast("int").bitwiseOR(F.shiftleft((i % 7).cast("int"), 3)).alias("kind_source"),
    )


def _page_sql(rows: str, order: str, cap: int = 3, limit: int = 40) -> str:
    return f"""SELECT post_id, rank, CAST(row_number() OVER (ORDER BY over_cap, rank) AS INTEGER) AS page_pos FROM (SELECT *, row_number() OVER (PARTITION BY blog_id ORDER BY rank) > {cap} AS over_cap
  FROM (SELECT *, CAST(row_number() OVER (ORDER BY {order}) AS INTEGER) AS rank FROM ({rows}) ORDER BY {order} LIMIT {5 * limit})) ORDER BY over_cap, rank LIMIT {limit}"""


def _browse(mode: str, order: str) -> None:
    def run(spark, d):
        return search.browse(_doc_posts(spark, d), mode).select("post_id", "rank", "page_pos")

    run.__name__ = f"browse_{mode}"
    query(_page_sql(DOC_POSTS, order))(run)


for _mode, _order in {"relevance": "score DESC, post_id", "points": "points DESC, post_id", "date": "day DESC, post_id", "oldest": "day, post_id"}.items():
    _browse(_mode, _order)

FACETS = "(topic_mask & 3) <> 0 AND (3 & (1 << (kind_source & 7))) <> 0 AND (112 & (1 << (kind_source >> 3))) = 0"


@query(f"SELECT post_id FROM ({DOC_POSTS}) WHERE {FACETS}")
def facet_posts(spark, d):
    return _doc_posts(spark, d).filter(posts.passes(topic_mask=3, kind_mask=3)).select("post_id")


@query(f"SELECT count(*) AS total FROM ({DOC_POSTS}) WHERE {FACETS}")
def facet_total(spark, d):
    return search.total_matches(_doc_posts(spark, d).filter(posts.passes(topic_mask=3, kind_mask=3)))


@query(_page_sql(f"SELECT * FROM ({DOC_POSTS}) WHERE blog_id = 3", "score DESC, post_id", cap=40))
def pinned_blog(spark, d):
    return search.blog_posts(_doc_posts(spark, d), 3).select("post_id", "rank", "page_pos")


def _slips(term: str) -> str:
    """A term and, from four letters on, its single slips past the first letter: one left out,
    replaced, put in before it, or swapped with the next."""
    forms = [term]
    for k in range(1, len(term) if len(term) > 3 else 1):
        head, letter, tail = term[:k], term[k], term[k + 1 :]
        forms += [head + tail, head + "." + tail, head + "." + letter + tail, head + tail[:1] + letter + tail[1:]]
    return "(" + "|".join(sorted(set(forms))) + ")"


def _order_of_matches(text: str, terms: list[str]) -> str:
    """Whole words hit, other characters, where the match begins, the text."""
    hit = " + ".join(f"CAST(regexp_matches({text}, '(?i)(^|\\W){t}(\\W|$)') AS INTEGER)" for t in terms)
    return f"{hit} DESC, length({text}), length(regexp_extract({text}, '(?is)^(.*?){'.*'.join(map(_slips, terms))}', 1)), {text}"


def _tiered(rows: str, terms: list[str]) -> str:
    """The best 3,000 by score, in three tiers by the order of matches, by score inside them."""
    return f"""SELECT *, CAST(row_number() OVER (ORDER BY CASE WHEN place <= 200 THEN 0 WHEN place <= 1000 THEN 1 ELSE 2 END, score DESC, post_id) AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (ORDER BY {_order_of_matches('title', terms)}, post_id) AS place FROM (SELECT * FROM ({rows}) ORDER BY score DESC, post_id LIMIT 3000))"""


def _matching(terms: list[str]) -> str:
    return f"SELECT * FROM ({DOC_POSTS}) WHERE regexp_matches(title, '(?i){'.*'.join(map(_slips, terms))}')"


THE_OF = _matching(["the", "of"])


@query(f"SELECT post_id, rank, (SELECT count(*) FROM ({THE_OF})) AS total FROM ({_tiered(THE_OF, ['the', 'of'])}) WHERE rank <= 40")
def search_all_terms(spark, d):
    return search.search_posts(_doc_posts(spark, d), "the of").select("post_id", "rank", "total")


@query(f"SELECT post_id, rank, (SELECT count(*) FROM ({THE_OF}) WHERE {FACETS}) AS total FROM ({_tiered(f'SELECT * FROM ({THE_OF}) WHERE {FACETS}', ['the', 'of'])}) WHERE rank <= 40")
def search_with_facets(spark, d):
    return search.search_posts(_doc_posts(spark, d), "the of", facets=posts.passes(topic_mask=3, kind_mask=3)).select("post_id", "rank", "total")


@query(f"SELECT *, (SELECT count(*) FROM ({THE_OF})) AS total FROM ({_page_sql(THE_OF, 'points DESC, post_id')})")
def search_by_points(spark, d):
    return search.search_posts(_doc_posts(spark, d), "the of", "points").select("post_id", "rank", "page_pos", "total")


@query(f"SELECT *, (SELECT count(*) FROM ({THE_OF}) WHERE blog_id = 3) AS total FROM ({_page_sql(f'SELECT * FROM ({THE_OF}) WHERE blog_id = 3', 'day, post_id', cap=40)})")
def search_in_blog(spark, d):
    return search.search_posts(_doc_posts(spark, d), "the of", "oldest", facets=posts.passes(blog_id=3), pinned=True).select("post_id", "rank", "page_pos", "total")


def _loose(terms: list[str]) -> str:
    """Hits of single terms, and one more than all where they match in order."""
    one = " + ".join(f"CAST(regexp_matches(title, '(?i){_slips(t)}') AS INTEGER)" for t in terms)
    return f"SELECT *, {one} + CASE WHEN regexp_matches(title, '(?i){'.*'.join(map(_slips, terms))}') THEN {len(terms) + 1} ELSE 0 END AS hits FROM ({DOC_POSTS})"


@query(f"SELECT post_id, hits FROM ({_loose(['attion', 'eriner', 'thanea'])}) WHERE hits >= 2")
def search_any_terms(spark, d):
    return search.match_any(_doc_posts(spark, d), "attion eriner thanea").select("post_id", "hits")


# too few titles have both words in order, so either will do
EITHER = f"SELECT * FROM ({_loose(['attion', 'zzzqzz'])}) WHERE hits >= 1"


@query(f"SELECT post_id, CAST(row_number() OVER (ORDER BY hits DESC, score DESC, post_id) AS INTEGER) AS rank, (SELECT count(*) FROM ({EITHER})) AS total FROM (SELECT * FROM ({EITHER}) ORDER BY score DESC, post_id LIMIT 3000) ORDER BY rank LIMIT 40")
def search_fallback_terms(spark, d):
    return search.search_posts(_doc_posts(spark, d), "attion zzzqzz").select("post_id", "rank", "total")


WORDS = lambda c: f"list_distinct(list_filter(string_split_regex(lower({c}), '[^a-z0-9]+'), lambda x: length(x) > 2))"


@query(f"""
WITH p AS (SELECT post_id, score, unnest({WORDS('title')}) AS w FROM ({DOC_POSTS})),
 q AS (SELECT item_id AS query_id, unnest({WORDS('text')}) AS w FROM benchmark),
 need AS (SELECT query_id, CASE WHEN count(*) >= 3 THEN 2 ELSE 1 END AS need FROM q GROUP BY query_id),
 hit AS (SELECT query_id, post_id, score, count(*) AS hits FROM q JOIN p USING (w) GROUP BY ALL)
SELECT query_id, post_id, hits FROM hit JOIN need USING (query_id) WHERE hits >= need
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY hits DESC, score DESC, post_id) <= 40""")
def search_many_queries(spark, d):
    return search.search_many(_doc_posts(spark, d), V.table(spark, d, "benchmark").select(F.col("item_id").alias("query_id"), "text"))


# a query's terms with what a title may have instead: letters left out or swapped, and LIKE patterns with one open place
SLIP = "length(t) > 3"
PLACES = "range(2, CAST(length(t) + 1 AS BIGINT))"
FORMS_OF = f"""list_distinct([t] || CASE WHEN {SLIP} THEN
   list_transform({PLACES}, lambda i: left(t, CAST(i - 1 AS INTEGER)) || substr(t, CAST(i + 1 AS INTEGER)))
   || list_transform({PLACES}, lambda i: left(t, CAST(i - 1 AS INTEGER)) || '_' || substr(t, CAST(i + 1 AS INTEGER)))
   || list_transform({PLACES}, lambda i: left(t, CAST(i - 1 AS INTEGER)) || '_' || substr(t, CAST(i AS INTEGER)))
   || list_transform(range(2, CAST(length(t) AS BIGINT)), lambda i: left(t, CAST(i - 1 AS INTEGER)) || substr(t, CAST(i + 1 AS INTEGER), 1) || substr(t, CAST(i AS INTEGER), 1) || substr(t, CAST(i + 2 AS INTEGER)))
  ELSE [] END)"""
OR_FORMS = f"'(' || array_to_string(list_transform({FORMS_OF}, lambda f: replace(regexp_escape(f), '_', '.')), '|') || ')'"
# no benchmark text has 25 strict matches, so every page is a fallback; search_tiers and a fixture cover strict pages
MANY_PAGES = f"""
WITH posts AS (SELECT post_id, score, lower(title) AS title FROM ({DOC_POSTS})), titles AS (SELECT DISTINCT title FROM posts),
 q AS (SELECT item_id AS query_id, regexp_split_to_array(trim(lower(text), ' ' || chr(9) || chr(10) || chr(13)), '\\s+') AS ts FROM benchmark),
 need AS (
  SELECT query_id, len(list_filter(ts, lambda t: length(t) > 2)) AS n_long, len(list_distinct(ts)) AS n_all,
    array_to_string(list_transform(ts, lambda t: {OR_FORMS}), '.*') AS pattern FROM q
 ),
 terms AS (SELECT query_id, unnest(ts) AS t FROM q),
 forms AS (SELECT t, unnest({FORMS_OF}) AS form FROM (SELECT DISTINCT t FROM terms)),
 met AS (SELECT DISTINCT t, title FROM forms JOIN titles ON title LIKE '%' || form || '%'),
 hit AS (SELECT query_id, title, count(*) FILTER (length(t) > 2) AS n, count(DISTINCT t) AS n_terms FROM terms JOIN met USING (t) GROUP BY query_id, title),
 found AS (SELECT query_id, title, n, n_long, CASE WHEN n_terms = n_all THEN regexp_matches(title, pattern) ELSE false END AS strict FROM hit JOIN need USING (query_id)),
 scored AS (SELECT *, CAST(n + CASE WHEN strict THEN n_long + 1 ELSE 0 END AS INTEGER) AS hits FROM found JOIN posts USING (title)),
 pool AS (
  SELECT *, count(*) OVER (PARTITION BY query_id) AS total FROM scored WHERE hits >= CASE WHEN n_long >= 3 THEN 2 ELSE 1 END
  AND query_id NOT IN (SELECT query_id FROM scored WHERE strict GROUP BY query_id HAVING count(*) >= 25)
 ),
 top AS (SELECT * FROM pool QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, post_id) <= 3000)
SELECT query_id, post_id, hits, CAST(row_number() OVER (PARTITION BY query_id ORDER BY hits DESC, score DESC, post_id) AS INTEGER) AS rank, total FROM top QUALIFY rank <= 40"""


@query(MANY_PAGES)
def search_pages_of_benchmark(spark, d):
    """Every benchmark text as a query with slips: the pages that searching one by one gives."""
    queries = V.table(spark, d, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    return manysearch.search_pages(_doc_posts(spark, d), queries).select("query_id", "post_id", "hits", "rank", "total")


# two words that often stand in order: strict matches, enough of them for more than one tier
PAIR = ["th", "en"]


@query(f"SELECT source_id AS query_id, post_id, tier, rank, total FROM (SELECT 1 AS source_id, post_id, CASE WHEN place <= 200 THEN 0 WHEN place <= 1000 THEN 1 ELSE 2 END AS tier, rank, (SELECT count(*) FROM ({_matching(PAIR)})) AS total FROM ({_tiered(_matching(PAIR), PAIR)})) WHERE rank <= 100000")
def search_tiers(spark, d):
    """All strict matches of a pair of terms with the tier and rank that the many-query search gives them."""
    queries = spark.createDataFrame([(1, " ".join(PAIR))], "query_id int, text string")
    return manysearch.search_pages(_doc_posts(spark, d), queries, limit=100_000).select("query_id", "post_id", "tier", "rank", "total")


BLOGS = f"SELECT blog_id, key AS n, left(coalesce(one_line, ''), 110) AS o, {IDX(K.SOURCE_SLUGS, 'source')} AS s, {MASK} AS tm, median_points AS m, CAST(year(make_timestamp(last_seen * 1000000)) AS INTEGER) AS l, round({QUALITY}, 3) AS q FROM ({RANKED})"


SRC = f"SELECT *, n || ' ' || o AS x FROM ({BLOGS}) WHERE regexp_matches(n || ' ' || o, '(?i)src')"


@query(f"SELECT blog_id, n, (SELECT count(*) FROM ({SRC})) AS total FROM (SELECT *, row_number() OVER (ORDER BY {_order_of_matches('x', ['src'])}, blog_id) AS rank FROM ({SRC})) WHERE rank <= 3")
def search_blogs(spark, d):
    return search.search_blogs(blogs.blog_rows(_ranked(spark, d)), "src", hide=False, limit=3).select("blog_id", "n", "total")


@query(f"SELECT blog_id, n FROM ({SRC}) ORDER BY m DESC, blog_id LIMIT 3")
def search_blogs_by_points(spark, d):
    return search.search_blogs(blogs.blog_rows(_ranked(spark, d)), "src", hide=False, mode="points", limit=3).select("blog_id", "n")


def _browse_blogs(mode: str, order: str) -> None:
    def run(spark, d):
        return search.search_blogs(blogs.blog_rows(_ranked(spark, d)), "", topic_mask=0b10101, mode=mode, limit=5).select("blog_id", "n")

    run.__name__ = f"blogs_by_{mode}"
    query(f"SELECT blog_id, n FROM ({BLOGS}) WHERE (tm & 21) <> 0 AND ({K.HIDDEN_MASK} & (1 << s)) = 0 ORDER BY {order}, blog_id LIMIT 5")(run)


for _mode, _order in {"relevance": "q DESC", "points": "m DESC", "date": "l DESC", "oldest": "l"}.items():
    _browse_blogs(_mode, _order)


# --- batches and links ----------------------------------------------------------------

NUMBERED = f"SELECT *, row_number() OVER (ORDER BY key) - 1 AS rn FROM ({CANDIDATES(V.LINE_STORIES, 3)})"


@query(f"""SELECT CAST(rn // 150 AS BIGINT) AS batch, CAST(rn % 150 AS BIGINT) AS pos, key, (rn % 150 + 1) || '. key=' || key || ' | home=' || home || ' | hn_stories=' || n_stories || ' median_pts=' || median_points || ' max_pts=' || max_points
 || chr(10) || '   top_titles: ' || array_to_string(list_transform(sample_titles[1:4], lambda t: left(t, 110)), ' :: ') || chr(10) AS text FROM ({NUMBERED})""")
def compact_batches(spark, d):
    return batches.compact_lines(stories.aggregate_blogs(V.line_stories(spark, d)))


@query(f"SELECT count(*) AS n_blogs, CAST(max(rn // 150) + 1 AS BIGINT) AS n_batches, 150 AS per_batch FROM ({NUMBERED})")
def batch_manifest(spark, d):
    return writers.batch_manifest(batches.compact_lines(stories.aggregate_blogs(V.line_stories(spark, d))), 150)


def _feeds_of(spark, d):
    rows = _entries_of_blogs(spark, d).groupBy("key").agg(F.slice(F.sort_array(F.collect_list(F.struct(F.col("pos"), F.col("title"), F.lit("a summary").alias("summary")))), 1, 6).alias("entries"))
    rows = rows.select("key", "entries", F.concat(F.lit("Feed of "), "key").alias("feed_title"), F.lit(1).alias("seq"))
    # records without entries, of these keys and of all publishers, and an older one of each key
    empty = V.doc_stories(spark, d).select("key").distinct().select("key", F.array().cast(rows.schema["entries"].dataType).alias("entries"), F.lit("An empty feed").alias("feed_title"), F.lit(2).alias("seq"))
    older = rows.select("key", F.slice("entries", 1, 1).alias("entries"), F.lit("An older record").alias("feed_title"), F.lit(0).alias("seq"))
    return rows.unionByName(empty).unionByName(older)


YEAR_OF = lambda t: f"year(make_timestamp({t} * 1000000))"
TITLE_RATE = lambda p: f"format('{{:.2f}}', len(list_filter(sample_titles, lambda t: regexp_matches(t, '(?i){_q(p)}'))) / CAST(greatest(len(sample_titles), 1) AS DOUBLE))"


@query(f"""SELECT CAST(rn // 150 AS BIGINT) AS batch, CAST(rn % 150 AS BIGINT) AS pos, key, concat_ws(chr(10), '### ' || (rn % 150 + 1) || '. ' || key,
 'home=' || home || ' stories=' || n_stories || ' median_pts=' || median_points || ' max_pts=' || max_points || ' per_month=' || format('{{:.2f}}', n_stories / greatest((last_seen - first_seen) / CAST(2629800 AS DOUBLE), 1)) || ' active=' || {YEAR_OF('first_seen')} || '-' || {YEAR_OF('last_seen')}
 || ' craft_rate=' || {TITLE_RATE(K.CRAFT_TITLE)} || ' event_rate=' || {TITLE_RATE(K.EVENT_TITLE)}, 'top_hn_titles: ' || array_to_string(list_transform(sample_titles[1:8], lambda t: left(t, 95)), ' | '),
 'url_slugs: ' || array_to_string(list_transform(sample_urls[1:4], lambda u: regexp_extract(u, '^https://[^/]*/(.*)$', 1)), ' | '), 'feed_title: ' || left('Feed of ' || f.key, 90),
 array_to_string(list_transform(f.t[1:4], lambda t: '  feed: ' || left(t, 85) || ' -- a summary'), chr(10))) AS text
FROM (SELECT *, row_number() OVER (ORDER BY key) - 1 AS rn FROM ({CANDIDATES(V.DOC_STORIES, 5)})) AS c LEFT JOIN (SELECT 'src' || (feed_ord % 20) || '.example' AS key, list(title ORDER BY pos) AS t FROM ({V.FEED_ENTRIES}) WHERE ts > 0 AND feed_ord % 20 % 7 <> 6 GROUP BY 1) AS f USING (key)""")
def evidence_blocks(spark, d):
    return batches.evidence_blocks(stories.aggregate_blogs(V.doc_stories(spark, d)), _feeds_of(spark, d))


LINKS = f"SELECT page_id AS i, url, CAST(page_id * 11 % 900 AS INTEGER) AS day FROM pages"
STATUS = "SELECT page_id AS i, CAST(CASE page_id % 11 WHEN 0 THEN -1 WHEN 1 THEN 404 WHEN 2 THEN 503 WHEN 3 THEN 301 ELSE 200 END AS INTEGER) AS status FROM pages"


def _links(spark, d):
    return V.table(spark, d, "pages").select(F.col("page_id").alias("i"), "url", (F.col("page_id") * 11 % 900).cast("int").alias("day"))


def _status(spark, d):
    code = F.element_at(F.array(*[F.lit(x) for x in (-1, 404, 503, 301, 200, 200, 200, 200, 200, 200, 200)]), (F.col("page_id") % 11 + 1).cast("int"))
    return V.table(spark, d, "pages").select(F.col("page_id").alias("i"), code.alias("status"))


@query(f"SELECT i, host, CAST(row_number() OVER (PARTITION BY host ORDER BY day, i) - 1 AS INTEGER) AS queue_pos, (row_number() OVER (PARTITION BY host ORDER BY day, i) - 1) * CAST(0.25 AS DOUBLE) AS start_s FROM (SELECT *, lower(regexp_extract(url, '^[^:]+://([^/?#]*)', 1)) AS host FROM ({LINKS}))")
def crawl_plan(spark, d):
    return posts.crawl_plan(_links(spark, d)).select("i", "host", "queue_pos", "start_s")


@query(f"SELECT i, day FROM ({LINKS}) WHERE i NOT IN (SELECT doc_id FROM labels)")
def pending_links(spark, d):
    """Links without a row in a table of those done, here the labels."""
    return blogs.pending(_links(spark, d), V.table(spark, d, "labels").select(F.col("doc_id").alias("i")), "i").select("i", "day")


@query(f"SELECT count(*) AS checked, count(*) FILTER (status <= 0 OR status >= 400) AS dead, round(100.0 * count(*) FILTER (status <= 0 OR status >= 400) / count(*), 3) AS dead_pct FROM ({STATUS})")
def link_summary(spark, d):
    return posts.link_summary(_status(spark, d))


@query(f"""SELECT p.post_id, topic_mask | CASE WHEN s.status <= 0 OR s.status >= 400 THEN 32768 ELSE 0 END AS topic_mask FROM ({DOC_POSTS}) AS p LEFT JOIN ({STATUS}) AS s ON s.i = p.post_id""")
def dead_posts(spark, d):
    return posts.mark_dead(_doc_posts(spark, d), _status(spark, d)).select("post_id", "topic_mask")


@query(f"SELECT i, CASE WHEN i % 3 = 0 THEN url || '/moved' ELSE '' END AS final FROM ({LINKS})")
def final_urls(spark, d):
    moved = F.when(F.col("i") % 3 == 0, F.concat("url", F.lit("/moved"))).otherwise(F.col("url"))
    return _links(spark, d).select("i", urls.final_url(F.col("url"), moved).alias("final"))


@query(f"SELECT post_id, url, day FROM (SELECT p.post_id, rtrim(b.home, '/') || p.path AS url, p.day FROM ({WHOLE_INDEX}) AS p JOIN ({RANKED}) AS b USING (blog_id))")
def loaded_index(spark, d):
    """The index written to files and read back."""
    path, scanned = _folder(spark, "index"), V.doc_stories(spark, d).agg(F.count(F.lit(1)).alias("n_stories_scanned"))
    ranked = _ranked(spark, d)
    rows, table = _whole_index(spark, d, ranked), blogs.blog_rows(ranked)
    writers.write_index(rows, table, posts.index_meta(rows, table, scanned, V.AS_OF), path)
    return readers.load_index(spark, path).withColumnRenamed("i", "post_id")


@query(f"""SELECT hn_id, CASE WHEN hn_id % 7 = 0 THEN 'https://web.archive.org/web/' ELSE '' END || rtrim(home, '/') || path AS url, CASE WHEN hn_id > 0 THEN 'https://news.ycombinator.com/item?id=' || hn_id END AS discussion
FROM ({STORY_POSTS}) JOIN (SELECT blog_id, home FROM ({RANKED})) USING (blog_id)""")
def post_links(spark, d):
    """Addresses of posts, every seventh a dead one."""
    ranked = _ranked(spark, d)
    rows = _story_posts(spark, d, ranked).join(blogs.blog_rows(ranked).select("blog_id", "h"), "blog_id")
    dead = rows.withColumn("topic_mask", F.when(F.col("hn_id") % 7 == 0, F.col("topic_mask").bitwiseOR(K.FLAG_DEAD)).otherwise(F.col("topic_mask")))
    return posts.post_links(dead).select("hn_id", "url", "discussion")


@query(f"SELECT \"objectID\", title, points, created_at_i FROM ({V.PAGE_STORIES})")
def read_stories(spark, d):
    """Stories written as JSON lines and read back, beside a file of broken lines."""
    path = _folder(spark, "stories")
    writers.write_stories(V.page_stories(spark, d).drop("seq"), f"{path}/good")
    V.table(spark, d, "pages").select(F.concat(F.lit('{"objectID": '), F.col("page_id").cast("string")).alias("value")).write.text(f"{path}/broken")
    return readers.read_stories(spark, f"{path}/*").select("objectID", "title", "points", "created_at_i")


@query(f"SELECT count(*) AS n_blogs, count(*) FILTER (key IN (SELECT 'src' || (feed_ord % 20) || '.example' FROM ({V.FEED_ENTRIES}) WHERE ts > 0 AND feed_ord % 20 % 7 <> 6)) AS n_with_feed FROM ({CANDIDATES(V.DOC_STORIES, 5)})")
def evidence_stats(spark, d):
    return batches.evidence_stats(stories.aggregate_blogs(V.doc_stories(spark, d)), _feeds_of(spark, d))


@query(f"SELECT page_id, CASE WHEN n > 2 AND list_contains({sorted(K.PUBLIC_SUFFIXES)}, array_to_string(labels[n - 1 : n], '.')) THEN array_to_string(labels[n - 2 : n], '.') ELSE array_to_string(labels[greatest(n - 1, 1) : n], '.') END AS domain FROM (SELECT page_id, string_split({HOST}, '.') AS labels, len(string_split({HOST}, '.')) AS n FROM pages)")
def registrable_domains(spark, d):
    return V.table(spark, d, "pages").select("page_id", urls.registrable_domain(urls.host_of(F.col("url"))).alias("domain"))


@query(f"SELECT DISTINCT key FROM ({EXPECTED}) WHERE key NOT IN (SELECT key FROM ({GIVEN}))")
def missing_keys(spark, d):
    return checks.missing_keys(_given(spark, d), _expected(spark, d)).select("key").distinct()


@query("SELECT 'd' || lpad(CAST(doc_id AS VARCHAR), 8, '0') AS key FROM (SELECT DISTINCT doc_id FROM labels WHERE doc_id NOT IN (SELECT page_id FROM pages))")
def unexpected_keys(spark, d):
    """Labels against keys that the pages are expected to have."""
    wanted = V.table(spark, d, "pages").select(F.concat(F.lit("d"), F.lpad(F.col("page_id").cast("string"), 8, "0")).alias("key"))
    return checks.unexpected_keys(_given(spark, d), wanted).select("key").distinct()


SUFFIX_RULES = ["com", "org", "net", "*.example.com", "!m.example.com", "example.net"]


@query(f"""WITH h AS (SELECT DISTINCT {HOST} AS host FROM pages), l AS (SELECT host, string_split(host, '.') AS l, len(string_split(host, '.')) AS n FROM h),
 s AS (SELECT host, l, n, CASE WHEN host LIKE '%example.com' AND n > 2 THEN CASE WHEN l[n - 2] = 'm' THEN 2 ELSE 3 END WHEN host LIKE '%example.net' THEN 2 ELSE 1 END AS k FROM l)
SELECT host, array_to_string(l[greatest(n - k, 1) : n], '.') AS domain FROM s""")
def suffix_domains(spark, d):
    """Domains by a table of suffix rules, with a wildcard and an exception to it."""
    rules = spark.createDataFrame([(r,) for r in SUFFIX_RULES], "rule string")
    return urls.registrable_domains(V.table(spark, d, "pages").select(urls.host_of(F.col("url")).alias("host")), rules)


@query("""SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN CAST(floor(epoch(ts)) AS BIGINT) END AS published, CASE WHEN event_id % 3 = 0 THEN 'Timeout' WHEN event_id % 3 = 1 THEN 'no-feed' WHEN event_id % 5 = 0 THEN 'empty' END AS error FROM events""")
def feed_outcomes(spark, d):
    """Dates in the forms that feeds give them, and what became of each fetch."""
    e, ts = F.col("event_id"), F.col("ts").cast("timestamp")
    rfc, iso = F.date_format(ts, "EEE, dd MMM yyyy HH:mm:ss 'GMT'"), F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    published, updated = F.when(e % 5 == 1, "soon").when(e % 5 > 2, rfc), F.when((e % 5).isin(1, 2), iso)
    outcome = scoring.feed_error(F.when(e % 3 != 1, "https://x.example/feed"), F.when(e % 5 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("x"))), F.when(e % 3 == 0, "Timeout"))
    return V.table(spark, d, "events").select("event_id", scoring.feed_date(published, updated).alias("published"), outcome.alias("error"))


@query("SELECT CAST(event_id AS VARCHAR) AS \"objectID\", CAST(floor(epoch(ts)) AS BIGINT) AS created_at_i FROM events WHERE event_id % 5 <> 2")
def ingest_stream(spark, d):
    """Events as story files, some rows twice and some without a time, taken in incrementally."""
    from pubweave.streaming.ingest import ingest_stream as ingest

    base = _folder(spark, "ingest")
    events = V.table(spark, d, "events").select(F.col("event_id").cast("string").alias("objectID"), "event_type", F.when(F.col("event_id") % 5 != 2, F.unix_timestamp("ts")).alias("created_at_i"))
    rows = events.select("objectID", F.col("event_type").alias("title"), F.lit("https://x.example/").alias("url"), F.lit(30).alias("points"), F.lit(0).alias("num_comments"), F.lit("a").alias("author"), "created_at_i")
    rows.write.json(f"{base}/in/first")
    rows.filter("cast(objectID as long) % 3 = 0").write.json(f"{base}/in/second")
    ingest(spark, f"{base}/in/*", f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{base}/out").select("objectID", "created_at_i")


# --- files read back, crawls and streams ----------------------------------------------


# a line per label in folders that stand for files; some lines are broken, have no key, an empty one or an unknown source
LABEL_LINES = f"""SELECT CASE ord % 19 WHEN 3 THEN '' WHEN 4 THEN NULL ELSE key END AS key, CASE WHEN ord % 23 = 5 THEN 'nowhere' ELSE source END AS source,
  ord % 29 = 6 AS broken, 'cls_' || (ord * 7 % 5) AS file, ord FROM ({V.LABEL_ROWS})"""


def _label_files(spark, d):
    i = F.col("ord")
    rows = V.label_rows(spark, d).withColumns({"key": F.when(i % 19 == 3, "").when(i % 19 != 4, F.col("key")), "source": F.when(i % 23 == 5, "nowhere").otherwise(F.col("source"))})
    line = F.to_json(F.struct("key", "source", "is_programming_blog", "topics", "kind", "one_line", "confidence"))
    lines = rows.select(F.when(i % 29 == 6, F.left(line, F.lit(9))).otherwise(line).alias("value"), F.concat(F.lit("cls_"), (i * 7 % 5).cast("string"), F.lit(".jsonl")).alias("file"), "ord")
    path = _folder(spark, "labels")
    lines.repartition("file").sortWithinPartitions("file", "ord").drop("ord").write.partitionBy("file").text(path)
    return path


@query(f"""SELECT key, source, one_line FROM (SELECT l.*, v.one_line FROM ({LABEL_LINES}) AS l JOIN ({V.LABEL_ROWS}) AS v USING (ord))
WHERE NOT broken AND key <> '' AND source <> 'nowhere' QUALIFY row_number() OVER (PARTITION BY key ORDER BY file DESC, ord DESC) = 1""")
def read_labels(spark, d):
    return readers.read_labels(spark, _label_files(spark, d))[0].select("key", "source", "one_line")


@query(f"SELECT count(*) FILTER (broken) AS n_malformed, count(*) FILTER (broken OR coalesce(key, '') = '' OR source = 'nowhere') AS n_bad FROM ({LABEL_LINES})")
def read_labels_bad(spark, d):
    return readers.read_labels(spark, _label_files(spark, d))[1]


@query(f"SELECT key, 'Feed of ' || key AS feed_title, CAST(row_number() OVER (PARTITION BY key ORDER BY pos) - 1 AS INTEGER) AS pos, title, ts AS published FROM ({V.FEED_ENTRIES})")
def read_feeds(spark, d):
    """Feed records written as JSON lines and read back, entry by entry."""
    entry = F.struct("pos", "title", "url", F.col("ts").alias("published"))
    entries = F.transform(F.sort_array(F.collect_list(entry)), lambda e: F.struct(e["title"].alias("title"), e["url"].alias("url"), e["published"].alias("published")))
    path = _folder(spark, "feeds")
    V.feed_entries(spark, d).groupBy("key").agg(entries.alias("entries")).withColumn("feed_title", F.concat(F.lit("Feed of "), "key")).write.json(path)
    return readers.feed_entries(readers.read_feeds(spark, path)).select("key", "feed_title", "pos", "title", "published")


@query(f"SELECT key, source, 'source' AS part FROM ({LAST}) UNION ALL SELECT key, NULL, 'deny' FROM ({LAST}) WHERE toxic = 1")
def read_overrides(spark, d):
    """The labels of all publishers as a document of hand overrides, read back."""
    rows, path = _labels(spark, d), _folder(spark, "overrides")  # a row per publisher, as such a document has
    listed = F.collect_list(F.struct("key", "source"))
    rows.agg(F.to_json(F.struct(F.map_from_entries(listed).alias("source"), F.collect_list(F.when(F.col("toxic") == 1, F.col("key"))).alias("deny"))).alias("value")).write.text(path)
    source, deny = readers.read_overrides(spark, path)
    return source.select("key", "source", F.lit("source").alias("part")).unionByName(deny.select("key", F.lit(None).cast("string").alias("source"), F.lit("deny").alias("part")))


@query(f"SELECT key, n_stories, total_points, median_points, array_to_string(sample_titles, ' | ') AS titles, CAST(row_number() OVER (ORDER BY n_stories DESC, total_points DESC, key) AS INTEGER) AS place FROM ({CANDIDATES(V.DOC_STORIES, 3)})")
def written_candidates(spark, d):
    """Candidates written as JSON lines in order, and read back with their places."""
    path = _folder(spark, "candidates")
    writers.write_candidates(stories.aggregate_blogs(V.doc_stories(spark, d)), path)
    lines = spark.read.schema(readers.CANDIDATE).json(path).select("*", F.struct(F.col("_metadata.file_name"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("at"))
    numbered = number_sorted(lines, "at", name="n")
    return numbered.select("key", "n_stories", "total_points", "median_points", F.array_join("sample_titles", " | ").alias("titles"), (F.col("n") + 1).cast("int").alias("place"))


@query(f"""SELECT CAST(rn // 150 AS INTEGER) AS batch, string_agg((rn % 150 + 1) || '. key=' || key || ' | home=' || home || ' | hn_stories=' || n_stories || ' median_pts=' || median_points || ' max_pts=' || max_points
 || chr(10) || '   top_titles: ' || array_to_string(list_transform(sample_titles[1:4], lambda t: left(t, 110)), ' :: ') || chr(10), chr(10) || chr(10) ORDER BY rn) AS text FROM ({NUMBERED}) GROUP BY 1""")
def written_batches(spark, d):
    """Batch files written and read back, a file to a batch."""
    path = _folder(spark, "batches")
    writers.write_batches(batches.compact_lines(stories.aggregate_blogs(V.line_stories(spark, d))), path)
    return spark.read.text(path, wholetext=True).select("batch", F.expr("left(value, length(value) - 1)").alias("text"))


@query(f"""SELECT i, host, CAST(row_number() OVER (PARTITION BY host ORDER BY day, i) - 1 AS INTEGER) AS queue_pos FROM (
  SELECT *, lower(regexp_extract(url, '^[^:]+://([^/?#]*)', 1)) AS host FROM ({LINKS}) ORDER BY day, i LIMIT 120)""")
def crawl_plan_limited(spark, d):
    """The 120 oldest links, which is what a run of that limit asks for."""
    return posts.crawl_plan(_links(spark, d), limit=120).select("i", "host", "queue_pos")


CAPPED = f"""WITH RECURSIVE e AS MATERIALIZED (
  SELECT key, feed_ord, dense_rank() OVER (ORDER BY feed_ord) AS feed, {_canonical()} AS cu, ts, pos FROM ({VALID}) WHERE key NOT IN ({FIREHOSE}) AND title NOT LIKE 'Re: %'
  QUALIFY row_number() OVER (PARTITION BY key, cu ORDER BY ts DESC, pos) = 1
), r AS (
  SELECT CAST(0 AS BIGINT) AS feed, CAST([] AS VARCHAR[]) AS taken, CAST([] AS VARCHAR[]) AS own
  UNION ALL
  SELECT feed, list_concat(any_value(taken), coalesce(list(cu) FILTER (cu IS NOT NULL AND n <= 12), [])), coalesce(list(cu) FILTER (cu IS NOT NULL AND n <= 12), []) FROM (
    SELECT r.feed + 1 AS feed, r.taken, e.cu, row_number() OVER (ORDER BY e.ts DESC NULLS LAST, e.pos) AS n
    FROM r LEFT JOIN e ON e.feed = r.feed + 1 AND NOT list_contains(r.taken, e.cu) WHERE r.feed < (SELECT max(feed) FROM e)) GROUP BY feed
)
SELECT e.key, e.cu AS canonical_url, e.ts FROM e JOIN (SELECT feed, unnest(own) AS cu FROM r) AS o USING (feed, cu)"""
SQL["capped_feed_entries"] = CAPPED


def _answers(url: str) -> tuple[int, str, str, str]:
    """A web of a home page per number, by remainders of five: one that links to its feed, one with a
    feed at the second usual address, one whose feed is gone, one that is down but for an address, one without."""
    m = re.match(r"https://p(\d+)\.example(.*)$", url)
    n, path = int(m[1]), m[2]
    kind = n % 5
    if kind == 0:
        return (200, "text/html", '<link type="application/rss+xml" href="/own.xml">', url) if path == "" else (200, "text/plain", f"<rss>{n}</rss>", url) if path == "/own.xml" else (404, "", "", url)
    if kind == 1 and path == K.FEED_PATHS[1]:
        return 200, "application/xml", f"<feed>{n}</feed>", url
    if kind == 2:
        return (200, "text/html", '<link type="application/atom+xml" href="/gone">', url) if path == "" else (410, "text/html", "gone", url)
    if kind == 3:
        if path != K.FEED_PATHS[3]:
            raise ConnectionError(url)
        return 200, "text/html", f'<?xml version="1.0"?><rss>{n}</rss>', url
    return 404, "text/html", "", url


@query(f"""SELECT page_id, CASE page_id % 5 WHEN 0 THEN home || '/own.xml' WHEN 1 THEN home || '{K.FEED_PATHS[1]}' WHEN 2 THEN home || '/gone' WHEN 3 THEN home || '{K.FEED_PATHS[3]}' END AS feed,
 CASE page_id % 5 WHEN 0 THEN '<rss>' || page_id || '</rss>' WHEN 1 THEN '<feed>' || page_id || '</feed>' WHEN 3 THEN '<?xml version="1.0"?><rss>' || page_id || '</rss>' END AS content,
 CASE page_id % 5 WHEN 2 THEN 'empty' WHEN 4 THEN 'no-feed' END AS error FROM (SELECT page_id, 'https://p' || page_id || '.example' AS home FROM pages)""")
def fetched_feeds(spark, d):
    """A blog per page, fetched from a web that is a function of the address."""
    i = F.col("page_id").cast("string")
    homes = V.table(spark, d, "pages").select(i.alias("key"), F.concat(F.lit("https://p"), i, F.lit(".example")).alias("home"))
    return feeds.fetch_feeds(homes, _answers, 8).select(F.col("key").cast("long").alias("page_id"), "feed", "content", "error")


def _probe(method: str, url: str) -> tuple[int, str]:
    """An answer by the last digits of the address."""
    import ssl

    n = int(url.rpartition("=")[2]) % 10
    errors = {0: ssl.SSLError, 1: ConnectionError, 2: TimeoutError, 3: ValueError}
    if n in errors:
        raise errors[n](url)
    if n == 4:
        return (405, url) if method == "HEAD" else (200, url)
    if n == 5:
        return (503, url) if method == "HEAD" else (502, url)
    return (404, url) if n == 6 else (200, url + "/moved") if n == 7 else (200, url)


@query("""SELECT page_id AS i, CAST([-2, -3, -4, -1, 200, 502, 404, 200, 200, 200][page_id % 10 + 1] AS INTEGER) AS status, CASE WHEN page_id % 10 = 7 THEN url || '#n=' || page_id || '/moved' ELSE '' END AS final FROM pages""")
def checked_links(spark, d):
    """Every page's link, checked on a web that is a function of the address."""
    links = _links(spark, d).withColumn("url", F.concat("url", F.lit("#n="), F.col("i").cast("string")))
    return feeds.check_links(posts.crawl_plan(links), _probe, 0.0, 8).select("i", "status", "final")


@query("SELECT CAST(event_id AS VARCHAR) AS \"objectID\", CAST(floor(epoch(ts)) AS BIGINT) AS created_at_i FROM events WHERE event_id % 4 <> 1")
def pulled_pages(spark, d):
    """Events as a source of pages, newest first, some without the points that are asked for."""
    from pubweave.streaming.ingest import pull_pages, removed

    table = V.table(spark, d, "events").select(F.col("event_id").cast("string").alias("objectID"), F.unix_timestamp("ts").alias("created_at_i"), F.when(F.col("event_id") % 4 == 1, 3).otherwise(30).alias("points"))
    base = _folder(spark, "pull")
    # a request: at most 20,000 stories
    pull_pages(spark, V.pager_of(table, f"{base}/source", 20_000), f"{base}/out", f"{base}/state", 2_000_000_000, stop_after=2)
    removed(spark, f"{base}/source")
    return spark.read.parquet(f"{base}/out").select("objectID", "created_at_i")


@query("SELECT 'u' || user_id AS key, count(*) AS n FROM events WHERE event_id % 2 = 0 OR user_id NOT IN (SELECT user_id FROM events WHERE event_id % 2 = 0) GROUP BY 1")
def worked_keys(spark, d):
    """Work on keys in two runs: the second leaves alone what the first has done."""
    from pubweave.streaming.ingest import work_stream

    base, table = _folder(spark, "work"), V.table(spark, d, "events")
    for k in (0, 1):
        table.filter(F.col("event_id") % 2 == k).groupBy(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("key")).agg(F.count(F.lit(1)).alias("n")).write.json(f"{base}/in/{k}")
        work_stream(spark, f"{base}/in/*", "key string, n long", "key", f"{base}/done", f"{base}/checkpoint", lambda df: df).awaitTermination()
    return spark.read.parquet(f"{base}/done").select("key", "n")


RULED = f"""WITH h AS (SELECT page_id, {HOST} AS host, regexp_extract(url, '^[a-z]+://[^/?#]*/+([^/;?#]+)', 1) AS first FROM pages WHERE {_part(1)} IN ('http', 'https'))
SELECT page_id, host AS key, 'https://' || host AS home FROM h WHERE host LIKE '%.%'"""


@query(RULED)
def publisher_keys_by_rules(spark, d):
    """Publishers by a table of suffix rules, with a wildcard and an exception to it."""
    rules = spark.createDataFrame([(r,) for r in SUFFIX_RULES], "rule string")
    return stories.with_blog_key(V.table(spark, d, "pages").select("page_id", "url"), rules).select("page_id", "key", "home")


@query(f"SELECT post_id, day, points, title FROM ({INDEX}) WHERE blog_id = 1")
def read_blog(spark, d):
    """One blog's posts out of an index written to files."""
    path, scanned, ranked = _folder(spark, "index"), V.doc_stories(spark, d).agg(F.count(F.lit(1)).alias("n_stories_scanned")), _ranked(spark, d)
    rows, table = _index(spark, d, ranked), blogs.blog_rows(ranked)
    writers.write_index(rows, table, posts.index_meta(rows, table, scanned, V.AS_OF), path, shelves=4)
    return readers.read_blog(spark, path, 1).select("post_id", "day", "points", "title")
