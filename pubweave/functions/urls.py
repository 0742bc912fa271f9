"""URL functions. All are built-in expressions; null URLs give null unless said otherwise."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pubweave import constants as K

_URL = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


def url_parts(url: Column) -> Column:
    """struct(scheme, netloc, path, params, query, fragment); lenient: any text splits."""
    part = lambda i: F.regexp_extract(url, _URL, i)
    return F.struct(
        F.lower(part(1)).alias("scheme"), part(2).alias("netloc"), F.regexp_replace(part(3), r";[^/]*$", "").alias("path"),
        F.regexp_extract(part(3), r";([^/]*)$", 1).alias("params"), part(4).alias("query"), part(5).alias("fragment"),
    )


def is_tracking(key: Column) -> Column:
    return F.coalesce(key.rlike(rf"(?i)^(?:{K.TRACKING_KEYS})$"), F.lit(False))


def _plain(text: Column) -> Column:
    """Percent-decoded; text with a broken escape stays as it is."""
    return F.coalesce(F.try_url_decode(text), text)


def _coded(text: Column) -> Column:
    return F.replace(F.replace(F.url_encode(text), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def netloc_of(url: Column) -> Column:
    """Lower-case host with port and user, less one leading ``www.``"""
    return F.regexp_replace(F.lower(F.regexp_extract(url, _URL, 2)), r"^www\.", "")


def canonical_url(url: Column) -> Column:
    """https, bare host, path without closing slashes, sorted query without tracking keys,
    and a fragment only where it routes (``!`` or ``/``). Null: empty."""
    p = url_parts(url)
    pairs = F.transform(
        F.filter(F.split(p["query"], "&"), lambda x: x != ""),
        lambda x: F.struct(_plain(F.substring_index(x, "=", 1)).alias("k"), F.when(F.contains(x, F.lit("=")), _plain(F.regexp_replace(x, r"(?s)^[^=]*=", ""))).otherwise("").alias("v")),
    )
    kept = F.array_sort(F.filter(pairs, lambda x: ~is_tracking(x["k"])))
    query = F.array_join(F.transform(kept, lambda x: F.concat(_coded(x["k"]), F.lit("="), _coded(x["v"]))), "&")
    path = F.regexp_replace(p["path"], r"/+$", "")
    fragment = F.when(p["fragment"].rlike(r"^[!/]"), F.concat(F.lit("#"), p["fragment"])).otherwise("")
    whole = F.concat(F.lit("https://"), netloc_of(url), F.when(path == "", "/").when(path.startswith("/"), path).otherwise(F.concat(F.lit("/"), path)), F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""), fragment)
    return F.when(url.isNull(), "").otherwise(whole)


def host_of(url: Column) -> Column:
    """Lower-case host without port, less one leading ``www.``"""
    return F.regexp_replace(F.substring_index(F.lower(F.regexp_extract(url, _URL, 2)), ":", 1), r"^www\.", "")


def registrable_domain(host: Column, suffixes: list[str] | None = None) -> Column:
    """One label under the longest public suffix; the last two labels where none is listed;
    a host that is a suffix or has one label stays."""
    listed = "|".join(s.replace(".", r"\.") for s in (suffixes or K.PUBLIC_SUFFIXES))
    own = F.regexp_extract(host, rf"([^.]+\.(?:{listed}))$", 1)
    two = F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1)
    return F.when(own != "", own).when(two != "", two).otherwise(host)


def registrable_domains(hosts: DataFrame, rules: DataFrame, host: str = "host") -> DataFrame:
    """(host, domain) of the distinct hosts, by a table of public-suffix rules (rule): one label
    under the longest suffix that fits. ``*.x`` fits any label under x, ``!y`` names a domain
    that such a rule doesn't make a suffix. Without a fitting rule the last label is the
    suffix; a host that is a suffix itself stays. The rules are joined, so there may be any
    number; null hosts have no row.
    """
    own = hosts.select(F.col(host).alias("host")).filter("host is not null").distinct().withColumn("labels", F.split("host", r"\."))
    tails = own.select("host", "labels", F.explode(F.sequence(F.lit(1), F.size("labels"))).alias("n"))  # n labels from the end
    tail = lambda n: F.array_join(F.slice("labels", F.size("labels") - n + 1, F.greatest(n, F.lit(0))), ".")
    parent = F.when(F.col("n") > 1, F.concat(F.lit("*."), tail(F.col("n") - 1)))
    tests = tails.select("host", "labels", "n", F.explode(F.array(F.struct(tail(F.col("n")).alias("rule"), F.lit(0).alias("cut")), F.struct(parent.alias("rule"), F.lit(0).alias("cut")), F.struct(F.concat(F.lit("!"), tail(F.col("n"))).alias("rule"), F.lit(1).alias("cut")))).alias("t"))
    fits = tests.select("host", "n", "t.rule", "t.cut").join(rules.select("rule").distinct(), "rule")
    best = fits.groupBy("host").agg(F.max(F.struct("cut", "n")).alias("best")).select("host", (F.col("best.n") - F.col("best.cut")).alias("n"))
    found = own.join(best, "host", "left").select("host", "labels", F.least(F.coalesce("n", F.lit(1)) + 1, F.size("labels")).alias("n"))
    return found.select("host", tail(F.col("n")).alias("domain"))


def blog_key(url: Column, domain: Column | None = None) -> Column:
    """struct(key, home) of the publisher, null where there is none: not http(s), a host
    without a dot, or the bare root or a generic route of a platform whose authors are paths.
    The host's registrable domain is found by the short list of suffixes unless it is given."""
    host = host_of(url)
    domain = registrable_domain(host) if domain is None else domain
    scheme = F.lower(F.regexp_extract(url, _URL, 1))
    first = F.regexp_extract(F.regexp_extract(url, _URL, 3), r"^/*([^/;]+)", 1)
    of = lambda k: F.struct(k.alias("key"), F.concat(F.lit("https://"), k).alias("home"))
    generic = (first == "") | F.lower(first).isin(K.GENERIC_SEGMENTS) | first.rlike(r"^(19|20)\d\d$")
    return (
        F.when(~scheme.isin("http", "https") | ~host.contains("."), None)
        .when(domain.isin(K.SUBDOMAIN_PLATFORMS) & (host != domain), of(host))
        .when((domain.isin(K.PATH_PLATFORMS) | host.isin(K.PATH_PLATFORMS)) & generic, None)
        .when(domain.isin(K.PATH_PLATFORMS) | host.isin(K.PATH_PLATFORMS), of(F.concat_ws("/", host, first)))
        .when(url.isNotNull(), of(host))
    )


def denied(key: Column, domain: Column | None = None) -> Column:
    """Hosts that are no blogs, whatever their path; a null key isn't denied."""
    host = F.substring_index(key, "/", 1)
    ends = F.lit(False)
    for s in K.DENIED_SUFFIXES:
        ends = ends | host.endswith(s)
    found = host.isin(K.DENIED_HOSTS) | (registrable_domain(host) if domain is None else domain).isin(K.DENIED_HOSTS) | ends | host.rlike(f"(?i){K.DENIED_LABELS}")
    return F.coalesce(found, F.lit(False))


def is_forum_host(key: Column) -> Column:
    return F.coalesce(F.substring_index(key, "/", 1).rlike(f"(?i){K.FORUM_HOST}"), F.lit(False))


def slugs(url: Column, limit: int = 6) -> Column:
    """The first path segments that aren't empty, 40 characters of each, joined by ``/``. Null: empty."""
    parts = F.filter(F.split(url_parts(F.coalesce(url, F.lit("")))["path"], "/"), lambda x: x != "")
    return F.array_join(F.transform(F.slice(parts, 1, limit), lambda x: F.left(x, F.lit(40))), "/")


def post_path(url: Column, fragment: bool = True) -> Column:
    """Path (``/`` if empty), query and (not for feed entries) fragment of a URL, without line
    ends. Stories give their canonical URL, feed entries their own."""
    p = url_parts(url)
    tail = F.concat(F.when(p["path"] == "", "/").otherwise(p["path"]), F.when(p["query"] != "", F.concat(F.lit("?"), p["query"])).otherwise(""))
    if fragment:
        tail = F.concat(tail, F.when(p["fragment"] != "", F.concat(F.lit("#"), p["fragment"])).otherwise(""))
    return F.regexp_replace(tail, r"[\r\n]", "")


def url_join(base: Column, ref: Column) -> Column:
    """A reference resolved against a page: absolute, ``//host``, ``/path``, ``?query``,
    ``#fragment`` or relative, with ``.`` and ``..`` segments taken out."""
    p = url_parts(base)
    root = F.concat(p["scheme"], F.lit("://"), p["netloc"])
    folder = F.regexp_replace(p["path"], r"[^/]*$", "")
    joined = F.when(ref.startswith("/"), ref).otherwise(F.concat(F.when(folder == "", "/").otherwise(folder), ref))
    path, tail = F.regexp_extract(joined, r"(?s)^([^?#]*)(.*)$", 1), F.regexp_extract(joined, r"(?s)^([^?#]*)(.*)$", 2)
    start = F.array().cast("array<string>")

    def step(done: Column, x: Column) -> Column:
        up = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
        return F.when(x == "..", up).when(x == ".", done).otherwise(F.concat(done, F.array(x)))

    clean = F.array_join(F.aggregate(F.split(F.regexp_replace(path, "^/", ""), "/"), start, step), "/")
    clean = F.when(path.rlike(r"/\.{1,2}$") & (clean != ""), F.concat(clean, F.lit("/"))).otherwise(clean)
    same = F.concat(root, p["path"])
    return (
        F.when(ref == "", base)
        .when(ref.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), ref)
        .when(ref.startswith("//"), F.concat(p["scheme"], F.lit(":"), ref))
        .when(ref.startswith("?"), F.concat(same, ref))
        .when(ref.startswith("#"), F.concat(F.regexp_replace(base, r"(?s)#.*$", ""), ref))
        .otherwise(F.concat(root, F.lit("/"), clean, tail))
    )


def discover_feed_link(html: Column, url: Column) -> Column:
    """The first RSS or Atom link with an href in the first 200,000 characters of a page."""
    tags = F.regexp_extract_all(F.left(html, F.lit(200_000)), F.lit(f"(?i){K.FEED_LINK_TAG}"), F.lit(0))
    hrefs = F.filter(F.transform(tags, lambda t: F.regexp_extract(t, f"(?i){K.HREF}", 1)), lambda h: h != "")
    return F.when(F.size(hrefs) > 0, url_join(url, F.try_element_at(hrefs, F.lit(1))))


def platform_feed(home: Column) -> Column:
    """Feed address of a home page on a platform that has a rule for it, else null."""
    p = url_parts(home)
    host, path = F.lower(p["netloc"]), F.regexp_replace(p["path"], r"^/+|/+$", "")
    return (
        F.when(host.endswith(".substack.com"), url_join(home, F.lit("/feed")))
        .when((host == "medium.com") | host.endswith(".medium.com"), F.when(path != "", F.concat(F.lit("https://medium.com/feed/"), path)))
        .when(host == "dev.to", F.when(path != "", F.concat(F.lit("https://dev.to/feed/"), path)))
    )


def candidate_feed_urls(home: Column) -> Column:
    """Conventional feed addresses of a home page, in the order in which to try them."""
    return F.transform(F.array(*map(F.lit, K.FEED_PATHS)), lambda path: url_join(home, path))


def looks_like_feed(content_type: Column, body: Column) -> Column:
    return F.lower(F.coalesce(content_type, F.lit(""))).contains("xml") | F.coalesce(body.rlike(r"(?U)^\s*<\?xml"), F.lit(False))


def final_url(url: Column, final: Column) -> Column:
    """Where a request ended, if elsewhere; else empty."""
    return F.coalesce(F.when(final != url, final), F.lit(""))
