"""The pipeline's de-duplications keep exactly one row of every group, whatever the ids."""

import corpus_pipeline
import pytest

from pubweave.llm import exactdedup, neardedup

TEXT = " ".join(f"w{i}" for i in range(100))
EDIT = TEXT + " more"
LONE = " ".join(f"x{i}" for i in range(100))
KIND = "doc_id long, text string, source string"


def stay(spark, stage, rows):
    return sorted(stage(spark, spark.createDataFrame(rows, KIND), "").collect(), key=repr)


@pytest.mark.parametrize("stage", [corpus_pipeline.exact_dedup, corpus_pipeline.near_dedup])
def test_repeated_rows_and_null_ids(spark, stage):
    rows = [(1, TEXT, "a"), (1, TEXT, "a"), (1, TEXT, "b"), (None, TEXT, "a"), (None, LONE, "a"), (None, LONE, "a"), (None, LONE, "b"), (7, None, "a"), (7, "", "a"), (8, "one", "a")]
    got = stay(spark, stage, rows)
    assert [(r.doc_id, r.text or "") for r in got] == sorted([(1, TEXT), (7, ""), (8, "one"), (None, LONE)], key=repr)
    assert got == stay(spark, stage, rows[::-1])


def test_near_copies_without_ids_or_under_one_id(spark):
    rows = [(3, TEXT, "a"), (None, EDIT, "a"), (None, LONE, "a"), (None, LONE + " more", "a"), (5, TEXT + " 1", "a"), (3, TEXT + " 2", "a")]
    got = stay(spark, corpus_pipeline.near_dedup, rows)
    assert sorted((r.doc_id is None, r.doc_id) for r in got) == [(False, 3), (True, None)]
    assert got == stay(spark, corpus_pipeline.near_dedup, rows[::-1])


@pytest.mark.parametrize("stage", [exactdedup.drop_exact_duplicates, neardedup.drop_near_duplicates])
def test_columns_of_any_name_are_kept(spark, stage):
    """Repeated rows too, as they take a way of their own."""
    names = ["_wr_id", "_wr_text", "_xd_digest", "_xd_keep", "_nd_id", "row", "id", "at", "a.b"]
    rows = [(i, t, *(f"{n}:{i}" for n in names)) for i, t in ((1, "one"), (1, "one"), (2, "two"), (3, "one"), (None, "two"), (None, None))]
    df = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names))
    kept = stage(df)
    assert kept.columns == df.columns
    got = [tuple(r) for r in kept.collect()]
    assert sorted((r[1] or "") for r in got) == ["", "one", "two"] and set(got) <= set(rows)


def test_text_ids(spark):
    df = spark.createDataFrame([("a", "one"), ("b", "one"), ("b", "one"), (None, "one"), ("c", "two")], "doc_id string, text string")
    found = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exactdedup.exact_duplicates(df).collect()}
    assert found == {("a", "b", 4, False), ("b", "b", 4, True), (None, "b", 4, False), ("c", "c", 1, True)}
    assert sorted(r.doc_id for r in exactdedup.drop_exact_duplicates(df).collect()) == ["b", "c"]
    assert sorted(r.doc_id for r in neardedup.drop_near_duplicates(df).collect()) == ["a", "c"]
