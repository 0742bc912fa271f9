"""Title and summary functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pubweave import constants as K


def norm_title(title: Column) -> Column:
    """Lower-case ASCII letters and digits of a title, without a closing year or bracket tags."""
    t = F.regexp_replace(F.regexp_replace(title, K.YEAR_SUFFIX, ""), f"(?i){K.BRACKET_TAG}", " ")
    return F.regexp_replace(F.lower(t), r"[^a-z0-9]+", "")


def clean_title(title: Column) -> Column:
    """One line, trimmed; null where nothing is left."""
    return F.nullif(F.regexp_replace(F.regexp_replace(title, r"[\r\n]", " "), r"^\s+|\s+$", ""), F.lit(""))


def kind_rule(title: Column) -> Column:
    """Slug of the first kind rule that fires, else null."""
    out = F.lit(None).cast("string")
    for kind, pattern in reversed(K.KIND_RULES):
        out = F.when(title.rlike(f"(?iu){pattern}"), kind).otherwise(out)
    return out


def kind_or_fallback(rule: Column, source: Column, label_kind: Column) -> Column:
    """The rule's kind, else the source's, else the blog's own if it is one, else deep-dive."""
    by_source = F.create_map(*[F.lit(x) for kv in K.FALLBACK_KIND.items() for x in kv])
    return F.coalesce(rule, F.try_element_at(by_source, source), F.when(label_kind.isin(K.KIND_SLUGS), label_kind), F.lit("deep-dive"))


def is_craft(title: Column) -> Column:
    return F.coalesce(title.rlike(f"(?iu){K.CRAFT_TITLE}"), F.lit(False))


def is_event(title: Column) -> Column:
    return F.coalesce(title.rlike(f"(?iu){K.EVENT_TITLE}"), F.lit(False))


def is_reply_title(title: Column) -> Column:
    return F.coalesce(title.rlike(f"(?iu){K.REPLY_TITLE}"), F.lit(False))


def clean_summary(html: Column) -> Column:
    """Text of a summary: no tags, single spaces, 300 characters. Null: empty."""
    text = F.regexp_replace(F.regexp_replace(F.coalesce(html, F.lit("")), r"<[^>]+>", " "), r"\s+", " ")
    return F.left(F.trim(text), F.lit(300))


def title_rate(titles: Column, test) -> Column:
    """Share of an array of titles that pass a test; 0 for none."""
    return F.size(F.filter(titles, test)) / F.greatest(F.size(titles), F.lit(1))
