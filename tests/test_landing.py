"""Listing pages, reconciliation, manifests and snapshots."""

from __future__ import annotations

from datetime import date

import pytest

from quarterdeck.operators import (
    EmptyListing,
    FailedItems,
    landing_summary,
    latest_snapshot,
    listing_links,
    manifest,
    raise_on_failures,
    reconcile,
    require_listing,
    run_summary,
    unpublished,
)
from quarterdeck.operators import landing
from quarterdeck.sinks import land_snapshot
from quarterdeck.sources import landing_inventory

PAGE = """<pre><a href="?C=N;O=D">Name</a> <A HREF="/pub/">up</A>
<A HREF="/pub/pr/pr.class">pr.class</A> <a Href="pr.data">d</a>
<A HREF="/pub/pr/pr.class">again</A> <a href="">none</a> <a href='pr.quoted'>q</a></pre>"""


def names(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "filename string")


def test_links(spark):
    df = spark.createDataFrame([(1, PAGE), (2, "no links"), (3, None)], "page_id int, html string")
    got = sorted(tuple(r) for r in listing_links(df).collect())
    assert got == [
        (1, 2, "pr.class", "/pub/pr/pr.class"),
        (1, 3, "pr.data", "pr.data"),
        (1, 4, "pr.class", "/pub/pr/pr.class"),
    ]


@pytest.mark.parametrize("retain, action", [(True, "retain"), (False, "delete")])
def test_reconcile(spark, retain, action):
    got = reconcile(names(spark, "a", "b", "b"), names(spark, "b", "c", "c"), retain)
    assert sorted(tuple(r) for r in got.collect()) == [
        ("a", "new", "fetch"),
        ("b", "present", "fetch"),
        ("c", "unpublished", action),
    ]
    summary = sorted(tuple(r) for r in landing_summary(got).collect())
    assert summary == [("new", "fetch", 1), ("present", "fetch", 1), ("unpublished", action, 1)]


def test_unpublished_uses_the_listing_not_the_fetches(spark):
    got = unpublished(names(spark, "a", "b"), names(spark, "z", "b", "c", "c"), ordered=True)
    assert [r.filename for r in got.collect()] == ["c", "z"]


def test_empty_listing_raises(spark):
    with pytest.raises(EmptyListing):
        require_listing(names(spark))
    assert require_listing(names(spark, "a")).count() == 1


def test_run_summary_and_failures(spark):
    outcomes = spark.createDataFrame(
        [("a", False), ("b", True), ("c", True), ("d", None)], "filename string, failed boolean"
    )
    known = reconcile(names(spark, "a", "b"), names(spark, "z"), retain=False)
    assert run_summary(outcomes, known).first().asDict() == {
        "downloaded": 1,
        "failed": 3,
        "unpublished": 1,
        "deleted": 1,
    }
    published = []

    def publish(df):
        published.extend(sorted(r.filename for r in df.collect()))
        return "log.failures"

    with pytest.raises(FailedItems, match=r"^3 item\(s\) failed; all are listed in log.failures$") as raised:
        raise_on_failures(outcomes, publish=publish)
    assert published == sorted(r.filename for r in raised.value.failures.collect()) == ["b", "c", "d"]
    with pytest.raises(FailedItems, match=r"^3 item\(s\) failed$"):
        raise_on_failures(outcomes)
    raise_on_failures(outcomes.where("NOT failed"))


def test_null_names_are_no_names(spark):
    listed, landed = names(spark, "a", None), names(spark, None, "b")
    assert sorted(r.filename for r in reconcile(listed, landed).collect()) == ["a", "b"]
    assert [r.filename for r in unpublished(listed, landed).collect()] == ["b"]


def test_manifest(spark):
    d = [date(2024, 1, i) for i in (1, 2, 9)]
    rows = [("a", d[0]), ("a", d[2]), ("b", d[0]), ("b", d[0]), ("c", d[1])]
    df = spark.createDataFrame(rows, "filename string, seen_on date")
    got = {r.filename: (r.first_seen, r.last_seen, r.retired_on) for r in manifest(df).collect()}
    assert got == {
        "a": (d[0], d[2], None),
        "b": (d[0], d[0], d[1]),
        "c": (d[1], d[1], d[2]),
    }


def test_snapshots_and_partition_pruning(spark, tmp_path):
    path = str(tmp_path / "raw")
    for day, values in {"2024-01-01": [1, 2], "2024-01-02": [3], "2024-01-10": [4, 5]}.items():
        land_snapshot(spark.createDataFrame([(v,) for v in values], "v int"), path, day)
    land_snapshot(spark.createDataFrame([(6,)], "v int"), path, "2024-01-10")
    df = latest_snapshot(spark.read.parquet(path))
    assert [tuple(r) for r in df.collect()] == [(6, date(2024, 1, 10))]
    assert "PartitionFilters: [isnotnull(ingest_date" in df._jdf.queryExecution().toString()


def test_inventory_lists_files_only(spark, tmp_path):
    (tmp_path / "one.txt").write_text("abc")
    (tmp_path / "folder").mkdir()
    (tmp_path / "folder" / "two.txt").write_text("x")
    got = landing_inventory(spark, str(tmp_path)).collect()
    assert [(r.filename, r.bytes) for r in got] == [("one.txt", 3)]
