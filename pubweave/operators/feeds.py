"""Entries of the blogs' own feeds: parsing, date and firehose rules, caps and claims."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from pubweave.functions import scoring, titles, urls
from pubweave.operators.storage import checkpointed

FEED_DOCUMENT = "key string, feed_title string, pos int, title string, url string, published long, summary string"


def well_formed(document: str):
    """The root of a feed's XML, mended where it isn't well-formed: bare ampersands, entities of
    HTML, control characters; items that stay broken are left out. Document types go unread,
    so no entity of theirs is ever expanded. None where nothing can be read."""
    import html
    import re
    from xml.etree import ElementTree

    text = re.sub(r"<!DOCTYPE[^>\[]*(\[.*?\]\s*)?>", "", document, flags=re.S | re.I)

    def read(part: str):
        try:
            return ElementTree.fromstring(part)
        except (ElementTree.ParseError, ValueError):
            return None

    root = read(text)
    if root is not None:
        return root
    text = re.sub(r"^\s*<\?xml[^>]*\?>", "", re.sub(r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "", text)).strip()
    text = re.sub(r"&(?!(?:amp|lt|gt|quot|apos);|#)(\w+;)", lambda m: html.unescape(m[0]) if html.unescape(m[0]) != m[0] else "&amp;" + m[1], text)
    text = re.sub(r"&(?!(?:amp|lt|gt|quot|apos|#\d+|#x[0-9a-fA-F]+);)", "&amp;", text)
    root = read(text)
    if root is not None:
        return root
    items = re.findall(r"<(item|entry)\b[^>]*>(.*?)</\1>", text, re.S)
    whole = [x for tag, body in items if (x := read(f"<{tag}>{re.sub(r'(</?)[A-Za-z]+:', chr(92) + '1', body)}</{tag}>")) is not None]
    if not whole:
        return None
    out = ElementTree.Element("channel")
    if title := re.search(r"<title[^>]*>([^<]*)</title>", text.split(f"<{items[0][0]}")[0]):
        ElementTree.SubElement(out, "title").text = html.unescape(title[1])
    out.extend(whole)
    return out


def parse_feed_documents(df: DataFrame, limit: int = 200) -> DataFrame:
    """Entries of RSS and Atom documents (key, content): those with a link and a title among
    the first ``limit``. What isn't well-formed is mended as far as that goes (``well_formed``);
    a document that can't be read has no entries."""

    def local(tag: str) -> str:
        return tag.rpartition("}")[2].lower()

    def text_of(item, *names: str) -> str | None:
        for name in names:
            for x in item:
                if local(x.tag) == name and "".join(x.itertext()).strip():
                    return "".join(x.itertext()).strip()
        return None

    def link_of(item) -> str | None:
        for x in item:
            if local(x.tag) == "link" and (x.get("rel", "alternate") == "alternate") and (x.get("href") or (x.text or "").strip()):
                return x.get("href") or x.text.strip()
        return None

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, content in zip(batch["key"], batch["content"], strict=True):
                root = well_formed(content or "")
                if root is None:
                    continue
                top = next((x for x in root if local(x.tag) == "channel"), root)
                items = [x for x in root.iter() if local(x.tag) in ("item", "entry")][:limit]
                for pos, x in enumerate(items):
                    rows.append((key, text_of(top, "title"), pos, text_of(x, "title"), link_of(x), text_of(x, "pubdate", "published", "date"), text_of(x, "updated", "modified"), text_of(x, "description", "summary", "content")))
            yield pd.DataFrame(rows, columns=["key", "feed_title", "pos", "title", "url", "published", "updated", "summary"])

    raw = df.select("key", "content").mapInPandas(parse, "key string, feed_title string, pos int, title string, url string, published string, updated string, summary string")
    return raw.filter("url <> '' and title <> ''").select("key", "feed_title", "pos", "title", "url", scoring.feed_date(F.col("published"), F.col("updated")).alias("published"), titles.clean_summary(F.col("summary")).alias("summary"))


def valid_entries(entries: DataFrame, as_of: int) -> DataFrame:
    """Entries (key, title, url, ts, pos) with a usable date, of feeds that are no forums."""
    return entries.filter(scoring.valid_entry_date(F.col("ts"), as_of) & ~urls.is_forum_host(F.col("key")))


def firehose_feeds(entries: DataFrame, n: int = 12, days: int = 7) -> DataFrame:
    """Keys of feeds whose n newest entries span less than so many days."""
    w = Window.partitionBy("key").orderBy(F.desc("ts"), "pos")
    top = entries.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n)
    span = top.groupBy("key").agg(F.max("ts").alias("newest"), F.max(F.when(F.col("_rn") == n, F.col("ts"))).alias("nth"))
    return span.filter(F.col("newest") - F.col("nth") < days * 86_400).select("key")


def new_feed_entries(entries: DataFrame, posts: DataFrame) -> DataFrame:
    """Entries with their canonical URL, of those not indexed yet."""
    rows = entries.withColumn("canonical_url", urls.canonical_url(F.col("url")))
    return rows.join(posts.select("canonical_url").distinct(), "canonical_url", "left_anti")


def cap_feed_entries(entries: DataFrame, cap: int = 12) -> DataFrame:
    """At most ``cap`` entries of each feed, the newest; a URL goes to the first feed (by
    feed_ord) that takes it, and the others take their next entry instead.

    Input: (key, feed_ord, canonical_url, title, ts, pos), without indexed URLs. Reply
    titles and empty ones never count. Each round every feed proposes its newest entries
    that weren't refused, and a URL refuses all but the first feed; this ends, as each round
    takes a row away, in the result of going through the feeds one by one. A URL that a feed
    proposes is lost to all later feeds, wherever it stands in them: they can't get it any
    more. Rounds carry keys and times only, and write once; what is chosen meets its row at
    the end. Feeds of the same entries in the same order settle one a round.
    """
    rows = entries.withColumn("title", titles.clean_title(F.col("title"))).filter(F.col("title").isNotNull() & ~titles.is_reply_title(F.col("title")))
    cols = rows.columns
    newest = Window.partitionBy("key", "canonical_url").orderBy(F.desc("ts"), "pos")
    whole = checkpointed(rows.withColumn("_rn", F.row_number().over(newest)).filter("_rn = 1").drop("_rn"))
    left = whole.select("key", "feed_ord", "canonical_url", "ts", "pos")
    by_time = Window.partitionBy("key").orderBy(F.desc("ts"), "pos")
    while True:
        proposed = left.withColumn("_rn", F.row_number().over(by_time)).filter(F.col("_rn") <= cap).drop("_rn")
        first = proposed.groupBy("canonical_url").agg(F.min("feed_ord").alias("_first"))
        # a URL that some feed proposes now goes to that feed or to one before it, so later feeds lose it in any place
        refused = F.coalesce(F.col("feed_ord") > F.col("_first"), F.lit(False))
        seen = Observation()
        judged = left.join(first, "canonical_url", "left").withColumn("_refused", refused).observe(seen, F.count_if("_refused").alias("n"))
        left = checkpointed(judged.filter("not _refused").select(*left.columns))
        if not (seen.get or {}).get("n"):
            chosen = left.withColumn("_rn", F.row_number().over(by_time)).filter(F.col("_rn") <= cap).select("key", "canonical_url")
            return whole.join(chosen, ["key", "canonical_url"], "left_semi").select(*cols)


def feed_summary(feeds: DataFrame, entries: DataFrame, as_of: int) -> DataFrame:
    """One row: feeds, feeds with entries, entries with an unusable date, forum feeds, firehoses."""
    valid = scoring.valid_entry_date(F.col("ts"), as_of)
    a = feeds.agg(F.count(F.lit(1)).alias("n_feeds"), F.count_if(urls.is_forum_host(F.col("key"))).alias("n_forums"))
    b = entries.agg(F.countDistinct("key").alias("n_with_entries"), F.count_if(~valid).alias("n_bad_dates"))
    return a.crossJoin(b).crossJoin(firehose_feeds(valid_entries(entries, as_of)).agg(F.count(F.lit(1)).alias("n_firehoses")))


def fetch_feeds(blogs: DataFrame, fetcher: Callable[[str], tuple[int, str, str, str]], partitions: int = 200) -> DataFrame:
    """(key, home, feed, content, error) for each blog: its platform's feed, the one its home
    page links to, or the first conventional address that answers with one.

    ``fetcher(url)`` gives (status, content type, body, final url) or raises. A home page or an
    address that fails counts as one without a feed, and the next is tried; a feed that fails
    or answers with an error is empty. Whatever else one blog raises is its own error. A
    host's blogs are fetched one after the other, by one task.
    """
    todo = blogs.select("key", "home", urls.platform_feed(F.col("home")).alias("known"), urls.candidate_feed_urls(F.col("home")).alias("guesses"), urls.host_of(F.col("home")).alias("host"))
    # a platform with a rule is never guessed at, even where the rule gives no address
    todo = todo.withColumn("platform", F.col("host").rlike(r"(^|\.)medium\.com$|^dev\.to$|\.substack\.com$"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import re
        from urllib.parse import urljoin

        from pubweave import constants as K

        def tried(url: str) -> tuple | None:
            try:
                return fetcher(url)
            except Exception:  # a page that fails is as good as none: the next address is tried
                return None

        def found(b) -> str | None:
            if b.known or b.platform:
                return b.known
            home = tried(b.home)
            if home and home[0] < 400:
                for tag in re.findall(K.FEED_LINK_TAG, home[2][:200_000], re.I):
                    if m := re.search(K.HREF, tag, re.I):
                        return urljoin(home[3], m[1])
            for url in b.guesses:
                got = tried(url)
                if got and got[0] < 400 and ("xml" in got[1].lower() or got[2].lstrip()[:200].startswith("<?xml")):
                    return got[3]
            return None

        def fetch(b) -> tuple:
            try:
                url = found(b)
                if not url:
                    return b.key, b.home, None, None, "no-feed"
                got = tried(url)
                body = got[2] if got and got[0] < 400 else None
                return b.key, b.home, url, body, None if body else "empty"
            except Exception as e:  # one blog's failure is its own
                return b.key, b.home, None, None, type(e).__name__

        for batch in batches:
            yield pd.DataFrame([fetch(b) for b in batch.itertuples()], columns=["key", "home", "feed", "content", "error"])

    return todo.repartition(partitions, "host").sortWithinPartitions("host").mapInPandas(run, "key string, home string, feed string, content string, error string")


def check_links(plan: DataFrame, fetcher: Callable[[str, str], tuple[int, str]], delay: float = 0.25, partitions: int = 200, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep, hosts_at_once: int = 1000) -> DataFrame:
    """(i, url, status, final) for a crawl plan: a host's links by one task, oldest first, with a
    pause of ``delay`` seconds between them. ``fetcher(method, url)`` gives (status, final url).
    HEAD comes first, and a ranged GET after 403, 405, 501 or a server error; failures count -2
    TLS, -3 connection, -4 time-out, -1 else.

    A task goes on with whichever of its hosts may be asked first, so the pauses of one host are
    filled with the links of others. It holds the links of ``hosts_at_once`` hosts, which
    ``crawl_plan(per_host=...)`` bounds; further hosts stream in as those are done.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import heapq
        import ssl
        from collections import deque

        def probe(url: str) -> tuple[int, str]:
            try:
                status, final = fetcher("HEAD", url)
                if status in (403, 405, 501) or status >= 500:
                    status, final = fetcher("GET", url)
                return status, final if final != url else ""
            except ssl.SSLError:
                return -2, ""
            except TimeoutError:
                return -4, ""
            except ConnectionError:
                return -3, ""
            except Exception:  # recorded as the link's status
                return -1, ""

        links = ((r.host, r.i, r.url) for batch in batches for r in batch.itertuples())  # host by host
        ahead = next(links, None)

        def next_host() -> tuple[str, deque] | None:
            """The next host's links, one by one from the stream: its queue is all that is held."""
            nonlocal ahead
            if ahead is None:
                return None
            host, queue = ahead[0], deque()
            while ahead is not None and ahead[0] == host:
                queue.append(ahead[1:])
                ahead = next(links, None)
            return host, queue

        free: list = []  # (when a host may be asked, its number, its queue)
        number, rows = 0, []
        while True:
            while len(free) < hosts_at_once and (found := next_host()):
                heapq.heappush(free, (clock(), number, found[1]))
                number += 1
            if not free:
                break
            when, n, queue = heapq.heappop(free)
            if when > clock():
                sleep(when - clock())
            i, url = queue.popleft()
            rows.append((i, url, *probe(url)))
            if queue:
                heapq.heappush(free, (clock() + delay, n, queue))
            if len(rows) >= 1000:
                yield pd.DataFrame(rows, columns=["i", "url", "status", "final"])
                rows = []
        yield pd.DataFrame(rows, columns=["i", "url", "status", "final"])

    return plan.repartition(partitions, "host").sortWithinPartitions("host", "queue_pos").mapInPandas(run, "i long, url string, status int, final string")
