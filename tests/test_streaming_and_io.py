"""Streams equal batches, writes can be repeated, pages are parsed."""

import datetime as dt
import glob
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from ledgerlark import schemas
from ledgerlark.operators.nested import dominant_value, normalise_records
from ledgerlark.operators.rules import Rule, explode_rules
from ledgerlark.queries import load
from ledgerlark.queries.registry import ORACLES, QUERIES
from ledgerlark.sources import chart_pages, io
from ledgerlark.streaming import gold

COLUMNS = [f.name for f in schemas.TRACE.fields]


def trace(i, at, agent="a", ok=True, ms=100):
    return dict(idtrace=str(i), idconversation=f"c{i % 2}", codagent=agent, nmagent=agent, nmowner="o", nmsquad="s", codidentity="u", descidentitytype="PERSON", coddomain="d", codsubdomain="x",
                nmmodel="m", nmtool="t", flgsuccess=ok, amntdurationms=ms + i, qtyintoken=i, qtyouttoken=2 * i, amntcostin=None, amntcostout=None, tsstart=at)


def test_stream_equals_batch(spark, tmp_path):
    day = dt.datetime(2024, 1, 2)
    first = [trace(1, day - dt.timedelta(minutes=1)), trace(2, day), trace(3, day + dt.timedelta(minutes=1), "b", False)]
    second = [trace(3, day + dt.timedelta(minutes=1), "b", False), trace(4, day + dt.timedelta(hours=2)), trace(5, day - dt.timedelta(hours=49))]  # one repeat, one two days late
    for n, rows in enumerate((first, second)):
        spark.createDataFrame(rows, schemas.TRACE).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        newest = max(glob.glob(str(tmp_path / "in" / "*.parquet")), key=os.path.getmtime)
        os.utime(newest, (1_700_000_000 + n, 1_700_000_000 + n))
    stream = gold.gold_stream(gold.read_traces(spark, str(tmp_path / "in"), 1), str(tmp_path / "gold"), str(tmp_path / "ckpt"), ["kpis", "tool_invocations"], available_now=True)
    stream.awaitTermination(120)
    expected = gold.kpis(spark.createDataFrame(first + second[1:], schemas.TRACE))
    root = str(tmp_path / "gold")
    stored = gold.read_gold(spark, root, "kpis").select(*expected.columns)
    plain = lambda df: sorted([tuple(str(v) for v in r) for r in df.collect()])
    assert plain(stored) == plain(expected)
    gone = gold.expire(spark, root, dt.date(2024, 1, 1))
    # of each table: the day's cells by hour and by keys, and its rows of three grains
    assert len(gone) == 10 and all("2023-12-30" in g for g in gone)
    assert {str(r[0]) for r in gold.read_gold(spark, root, "kpis").select("dtbucket").distinct().collect()} == {"2024-01-01", "2024-01-02"}


def test_recent_traces_keep_the_whole_window(spark):
    day = dt.datetime(2024, 1, 3)
    rows = spark.range(6000).select(*[F.lit(v).cast(f.dataType).alias(f.name) if f.name not in ("idtrace", "tsstart") else
                                      F.col("id").cast("string").alias("idtrace") if f.name == "idtrace" else (F.lit(day) - F.make_dt_interval(secs=F.col("id") * 60)).cast("timestamp_ntz").alias("tsstart")
                                      for f, v in ((f, trace(1, day)[f.name]) for f in schemas.TRACE.fields)])
    assert gold.recent_traces(rows).count() == 48 * 60 + 1


def test_chart_page(spark):
    page = ("Highcharts.chart('container', { /* c */ xAxis: {categories: ['01/03/202501:00:','01/03/202502:00:',]}, // note\n"
            " series: [{name: 'PM', data: [10.5, 12]}], });")
    df = spark.createDataFrame([("s", page), ("none", "<html></html>")], "station string, html string")
    rows = [tuple(r) for r in chart_pages.extract_chart_series(df, "html").collect()]
    assert rows == [("s", "01/03/202501:00:", 10.5), ("s", "01/03/202502:00:", 12.0)]
    # two slashes inside a text are no comment
    url = page.replace("'PM'", "'http://x'")
    assert chart_pages.extract_chart_series(spark.createDataFrame([("s", url)], "station string, html string"), "html").count() == 2


def test_period_filter_is_chronological(spark):
    df = spark.createDataFrame([("02/01/202501:00:", 1.0), ("01/02/202501:00:", 2.0), ("15/01/202501:00:", None)], "READING_DATETIME string, v double")
    lit = lambda s: F.lit(s).cast("timestamp_ntz")
    kept = io.read_period(df, "READING_DATETIME", lit("2025-01-01"), lit("2025-01-31"), ["v"], text_format=True)
    assert [r["v"] for r in kept.collect()] == [1.0]


def test_rules_with_null_conditions_and_keys(spark):
    df = spark.createDataFrame([("a", 1), ("b", None), (None, 1)], "k string, v int")
    rows = explode_rules(df, "k", [Rule("r", F.col("v") == 1, "fired")], ["k"]).collect()
    assert sorted((r["k"] or "", r["reglas_mensaje"], r["estado"]) for r in rows) == [
        ("", "Factura OK", "OK"), ("", "fired", "OBSERVADA"), ("a", "fired", "OBSERVADA"), ("b", "Factura OK", "OK")]


def test_ok_needs_every_row_of_the_key_clean(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0), ("b", 0)], "k string, v int")
    rows = explode_rules(df, "k", [Rule("r", F.col("v") == 1, "fired")], ["k"], unique_key=False).collect()
    assert sorted((r["k"], r["reglas_mensaje"]) for r in rows) == [("a", "fired"), ("b", "Factura OK")]


def test_decimal_normaliser(spark):
    schema = schemas.struct(schemas.field("totales", schemas.struct(schemas.number("subtotal"))),
                            schemas.field("items", schemas.array(schemas.struct(schemas.number("importe")))))
    raw = spark.sql("SELECT named_struct('subtotal', 1.00000000055D) AS totales, CAST(NULL AS array<struct<importe: double>>) AS items")
    row = normalise_records(raw, schema).first()
    assert str(row["totales"]["subtotal"]) == "1.000000001" and row["items"] == []


def test_dominant_value_ties(spark):
    df = spark.createDataFrame([(["b", "a", "a", "b"],), (["z", "y"],), ([],)], "v array<string>")
    assert [r[0] for r in df.select(dominant_value(F.col("v"))).collect()] == ["b", "z", None]


@pytest.mark.parametrize("name", ["a1_group_measures", "w1_top1_per_key", "j7_not_in_sets", "d3_spanish_date", "u6_tagged_layouts"])
def test_query_agrees_with_its_sql(spark, name):
    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("tables not present")
    load()
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    cursor = con.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    theirs = sorted(repr(tuple(r)) for r in cursor.fetchall())
    mine = sorted(repr(tuple(r)) for r in QUERIES[name](spark, folder).select(*columns).collect())
    assert mine == theirs


def test_every_oracle_has_its_query():
    load()
    assert set(ORACLES) <= set(QUERIES) and len(QUERIES) > 200
