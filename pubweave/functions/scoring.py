"""Dates, scores and packed columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pubweave import constants as K

YEAR_S, MONTH_S = 31_557_600, 2_629_800


def day_number(epoch: Column) -> Column:
    """Days since 2006-01-01, 0 to 65535."""
    return F.greatest(F.lit(0), F.least(F.floor((epoch - K.DAY0) / 86400), F.lit(65535))).cast("int")


def clip_points(points: Column) -> Column:
    return F.least(F.coalesce(points, F.lit(0)), F.lit(65535)).cast("int")


def blog_quality(median: Column, n: Column) -> Column:
    """Log of the median points, drawn to that of 88 by the weight of eight stories."""
    return (n * F.log(F.greatest(median, F.lit(1))) + 8 * F.log(F.lit(88.0))) / (n + 8)


def _recency(epoch: Column, as_of: int) -> Column:
    return 1 / (1 + F.greatest(F.lit(0.0), (F.lit(as_of) - epoch) / YEAR_S) / 6)


def post_score(points: Column, epoch: Column, as_of: int) -> Column:
    """0 to 255, mostly by points and a little by age."""
    strength = F.log10(F.greatest(points, F.lit(1))) / F.log10(F.lit(3000.0))
    return F.greatest(F.lit(0), F.least(F.lit(255), (255 * (0.78 * strength + 0.22 * _recency(epoch, as_of))).cast("int")))


def feed_score(epoch: Column, as_of: int) -> Column:
    return (120 * _recency(epoch, as_of)).cast("int")


def cadence(n: Column, first: Column, last: Column) -> Column:
    return n / F.greatest((last - first) / MONTH_S, F.lit(1.0))


def utc_year(epoch: Column) -> Column:
    """Calendar year in UTC, whatever the session's time zone."""
    return F.year(F.date_add(F.lit("1970-01-01").cast("date"), F.floor(epoch / 86400).cast("int")))


def _bit(slug: Column) -> Column:
    return F.try_element_at(F.create_map(*[x for i, s in enumerate(K.TOPIC_SLUGS) for x in (F.lit(s), F.lit(1 << i))]), slug)


def topic_mask(topics: Column) -> Column:
    """Bits of the topics of weight 0.25 or more in array<struct(slug, weight)>; where none
    is, that of the first topic. Unknown slugs and null have no bit."""
    heavy = F.filter(topics, lambda t: t["weight"] >= 0.25)
    mask = F.aggregate(heavy, F.lit(0), lambda acc, t: acc.bitwiseOR(F.coalesce(_bit(t["slug"]), F.lit(0))))
    first = F.coalesce(_bit(F.try_element_at(topics, F.lit(1))["slug"]), F.lit(0))
    return F.coalesce(F.when(mask != 0, mask).otherwise(first), F.lit(0))


def index_of(slug: Column, slugs: list[str]) -> Column:
    return F.try_element_at(F.create_map(*[x for i, s in enumerate(slugs) for x in (F.lit(s), F.lit(i))]), slug)


def pack_topic_mask(mask: Column, rule_fired: Column, feed: bool = False) -> Column:
    flags = F.when(rule_fired, K.FLAG_KIND_RULE).otherwise(0)
    return mask.bitwiseOR(flags).bitwiseOR(F.lit(K.FLAG_FEED if feed else 0)).cast("int")


def pack_kind_source(kind: Column, source: Column) -> Column:
    return kind.bitwiseOR(F.shiftleft(source, 3)).cast("int")


def hn_id(object_id: Column) -> Column:
    return F.coalesce(F.expr("cast(null as bigint)") if object_id is None else object_id.try_cast("bigint"), F.lit(0).cast("long"))


def feed_date(published: Column, updated: Column) -> Column:
    """Epoch seconds of the first of the dates in RFC 822 or ISO form, one without a zone taken as
    UTC whatever the session's; null if neither is."""
    def parse(text: Column) -> Column:
        bare = F.regexp_replace(F.trim(text), r"^[A-Za-z]{3,9},?\s+", "")
        zone = F.regexp_replace(bare, r"\s+(GMT|UTC|UT|Z)$", " +0000")
        tries = [F.try_to_timestamp(zone, F.lit(f)) for f in ("d MMM yyyy HH:mm:ss Z", "d MMM yyyy HH:mm Z")]
        day = F.when(bare.rlike(r"^\d{4}-\d\d-\d\d$"), F.concat(bare, F.lit("T00:00:00Z")))
        naive = F.when(bare.rlike(r"^\d{4}-\d\d-\d\d[T ][\d:.]+$"), F.concat(bare, F.lit("Z")))
        return F.coalesce(*tries, F.coalesce(day, naive, bare).try_cast("timestamp"))

    return F.unix_timestamp(F.coalesce(parse(published), parse(updated)))


def feed_error(feed: Column, entries: Column, failure: Column) -> Column:
    return F.coalesce(failure, F.when(feed.isNull(), "no-feed"), F.when(F.coalesce(F.size(entries), F.lit(0)) <= 0, "empty"))


def is_hidden(source: Column) -> Column:
    return source.isin(K.HIDDEN_SOURCES)


def is_dead(status: Column) -> Column:
    """No answer (0 or a negative code) or an error status."""
    return (status <= 0) | (status >= 400)


def valid_entry_date(epoch: Column, as_of: int) -> Column:
    return F.coalesce((epoch != 0) & (epoch >= K.DAY0) & (epoch <= as_of + 172_800), F.lit(False))
