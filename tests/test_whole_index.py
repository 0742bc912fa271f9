"""The index has the feed entries of every listed publisher, counted apart from its SQL."""

import pytest

from pubweave.plans import views as V
from pubweave.plans.queries import QUERIES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def n_posts(spark):
    """Stories, and each dated feed entry that a publisher of the index is given."""
    listed = {r.n for r in QUERIES["blog_table"](spark, SF).collect()}
    entries = V.feed_entries(spark, SF).filter("ts > 0").collect()
    return QUERIES["story_posts"](spark, SF).count() + sum(f"src{e.feed_ord % 20}.example" in listed for e in entries)


def test_all_posts(spark, n_posts):
    assert QUERIES["all_posts"](spark, SF).count() == n_posts


def test_index_meta(spark, n_posts):
    assert QUERIES["index_meta"](spark, SF).first().n_posts == n_posts


def test_loaded_index(spark, n_posts):
    assert QUERIES["loaded_index"](spark, SF).count() == n_posts
