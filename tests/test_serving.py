"""Stored layouts: what a period, a point and a page read."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlark.sources import serving


def scan_metrics(df):
    """Rows, files and partition filters of the scans of a query that has run."""
    df.collect()
    plan, found = df._jdf.queryExecution().executedPlan(), []

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        if name == "FileSourceScanExec":
            found.append((node.metrics().apply("numOutputRows").value(), node.metrics().apply("numFiles").value(), node.partitionFilters().mkString(" ")))
        for k in range(node.children().size()):
            walk(node.children().apply(k))

    walk(plan)
    return found


instant = dt.datetime.fromisoformat


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Thirty days of 400 stations by the hour in one file per day of several row groups; written as text."""
    path = str(tmp_path_factory.mktemp("serving") / "readings")
    rows = spark.range(30 * 24 * 400).select(
        F.concat(F.lit("station-"), F.col("id") % 400).alias("station"), F.date_format(F.lit(dt.datetime(2024, 1, 1)) + F.make_dt_interval(hours=F.floor(F.col("id") / 400).cast("int")), "dd/MM/yyyyHH:mm:").alias("time"),
        F.col("id").cast("double").alias("v"))
    rows = rows.unionByName(spark.createDataFrame([("station-1", "no time", 1.0), ("station-1", None, 1.0), ("station-1", "03/01/202423:59:", None)], "station string, time string, v double"))
    serving.write_by_day(rows, path, "time", ["station"], text_format=True, row_group_bytes=16 << 10)
    return path


def test_a_period_reads_its_days(spark, stored):
    df = serving.read_period(spark, stored, "time", instant("2024-01-03 12:00:00"), instant("2024-01-05 11:00:00"), ["station", "v"])
    [(rows, _, filters)] = scan_metrics(df)
    assert df.count() == 48 * 400
    assert "day" in filters and rows == 3 * 24 * 400 + 1


def test_a_point_reads_one_row_group_of_one_day(spark, stored):
    df = serving.lookup(spark, stored, "time", instant("2024-01-10 05:00:00"), station="station-77")
    [(rows, files, filters)] = scan_metrics(df)
    assert [tuple(r) for r in df.collect()] == [("station-77", dt.datetime(2024, 1, 10, 5), float((9 * 24 + 5) * 400 + 77))]
    assert "day" in filters and files == 1 and rows <= 24 * 400 / 4
    # a station that does not exist, yet sorts between two that do, is ruled out by the bloom filter
    none = serving.lookup(spark, stored, "time", instant("2024-01-10 05:00:00"), station="station-77x")
    assert scan_metrics(none)[0][0] == 0 and none.count() == 0


def test_pages_cost_alike_and_ties_are_stable(spark, tmp_path):
    path, order = str(tmp_path / "listing"), [F.desc("k")]
    df = spark.range(5000).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"), F.lit(None).cast("string").alias("n"))
    serving.write_listing(df.repartition(5), path, order, slab_rows=100)
    want = [(r["k"], r["v"]) for r in df.orderBy(F.desc("k"), "v").collect()]
    for number in (1, 2, 13, 100, 200):
        got = serving.page(spark, path, number, 25)
        assert [(rows, files) for rows, files, _ in scan_metrics(got)] == [(100, 1)] and got.columns == df.columns
        assert [(r["k"], r["v"]) for r in got.collect()] == want[(number - 1) * 25:number * 25]
    assert serving.page(spark, path, 201, 25).count() == 0
    assert [r["v"] for r in serving.page(spark, path, 2, 90).collect()] == [v for _, v in want[90:180]]


def test_an_empty_listing(spark, tmp_path):
    path = str(tmp_path / "listing")
    serving.write_listing(spark.range(0).withColumn("k", F.lit(1)), path, [F.col("id")])
    assert serving.page(spark, path, 1, 10).count() == 0
