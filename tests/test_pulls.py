"""Pulls of many pages against taking them in one by one."""

import random

import pytest
from pyspark.sql import functions as F

from pubweave.plans import views
from pubweave.streaming import ingest

START = 2_000_000_000


def source(rows, size):
    """Stories (id, time, points), newest first, ``size`` to a page, and the cursors asked for."""
    asked = []
    stories = [{"objectID": i, "created_at_i": t, "points": p} for i, t, p in sorted(rows, key=lambda r: (-(r[1] or 0), r[0] or ""))]

    def pager(cursor):
        asked.append(cursor)
        return [s for s in stories if s["created_at_i"] is None or s["created_at_i"] <= cursor][:size]

    return pager, asked


def one_by_one(pager, table, stop_after, oldest):
    cursor, dry, total = START, 0, 0
    while page := [s for s in pager(cursor) if s["created_at_i"] is not None and s["objectID"] is not None]:
        fresh = {}
        for s in page:
            if s["points"] >= 25 and s["objectID"] not in table:
                fresh.setdefault(s["objectID"], s["created_at_i"])
        table |= fresh
        total += len(fresh)
        last = min(cursor, *(s["created_at_i"] for s in page), cursor)
        dry = 0 if fresh else dry + 1
        cursor = last if fresh else last - 1
        if last <= oldest or stop_after and dry >= stop_after:
            break
    return total


def stored(spark, out):
    rows = spark.read.parquet(out).select("objectID", "created_at_i").collect()
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: r[1] for r in rows}


def test_pages_are_stored_together(spark, tmp_path):
    out = tmp_path / "out"
    pager, asked = source([(str(i), 1_700_000_000 + i, 30) for i in range(300)], 10)
    assert ingest.pull_pages(spark, pager, str(out), str(tmp_path / "state"), START, stop_after=2) == 300
    assert len(list(out.glob("*/*.parquet"))) < 200 and len(asked) < 45  # one by one, nearly a file for each story
    assert stored(spark, str(out)) == {str(i): 1_700_000_000 + i for i in range(300)}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_as_one_by_one(spark, tmp_path, seed):
    rng, rows, table = random.Random(seed), [], {}
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    for size, stop_after, oldest, n in ((6, 0, 1_160_000_000, 60), (6, 2, 1_160_000_000, 40), (5, 1, START - 1200, 40)):
        low = START - 4000 + len(rows) * 20
        for _ in range(n):  # new ones, some at one time, some below the bar, and known ones that have come up again
            i = rng.choice(rows)[0] if rows and rng.random() < 0.1 else None if rng.random() < 0.03 else str(rng.randrange(10**6))
            rows.append((i, rng.choice([None, low] + [rng.randrange(low, low + 800)] * 12), rng.choice([3, 30, 30, 30])))
        pager, asked = source(rows, size)
        plainly, asked_plainly = source(rows, size)
        want = one_by_one(plainly, table, stop_after, oldest)
        assert ingest.pull_pages(spark, pager, out, state, START, stop_after, oldest=oldest) == want
        assert stored(spark, out) == table and len(asked) < 2 * len(asked_plainly)


def test_broken_off_between_the_pages_and_their_place(spark, tmp_path, monkeypatch):
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    # at the end of every page a time is cut in two
    pager, _ = source([(str(i), 1_700_000_000 + i // 4, 30) for i in range(150)], 10)
    keep = ingest._keep_offset

    def full(spark, path, **at):
        if "storing" not in at and at["cursor"] < 1_700_000_020:
            raise OSError
        keep(spark, path, **at)

    monkeypatch.setattr(ingest, "_keep_offset", full)
    with pytest.raises(OSError):
        ingest.pull_pages(spark, pager, out, state, START, stop_after=2)
    monkeypatch.undo()
    before = len(stored(spark, out))
    assert 60 < before < 150 and ingest.pull_pages(spark, pager, out, state, START, stop_after=2) == 150 - before
    assert len(stored(spark, out)) == 150


def test_a_table_as_a_source_of_pages(spark, tmp_path):
    rng = random.Random(5)
    rows = [(str(i), rng.choice([None, 50, rng.randrange(100)])) for i in range(300)]
    table = spark.createDataFrame(rows, "objectID string, created_at_i long")
    request = views.pager_of(table, str(tmp_path / "source"), 20)
    for cursor in (1000, 99, 70, 50, 49, 12, 3, 0, -1):
        want = table.filter(F.col("created_at_i") <= cursor).orderBy(F.desc("created_at_i"), "objectID").limit(20)
        assert request(cursor) == [r.asDict() for r in want.collect()]
