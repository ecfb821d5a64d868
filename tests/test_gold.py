"""The gold sink: cells that add up, commits, and a stream that knows its traces."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlark import schemas
from ledgerlark.sources.commits import CommittedTables
from ledgerlark.streaming import gold

DAY = dt.datetime(2024, 1, 2)


def trace(i, at, agent="a", conversation="c", ms=100, ok=True, tool="t"):
    return dict(idtrace=str(i), idconversation=conversation, codagent=agent, nmagent=agent, nmowner="o", nmsquad=None, codidentity="u", descidentitytype="PERSON", coddomain="d", codsubdomain="x",
                nmmodel="m", nmtool=tool, flgsuccess=ok, amntdurationms=ms, qtyintoken=i, qtyouttoken=None, amntcostin=None, amntcostout=None, tsstart=at)


def frame(spark, rows):
    return spark.createDataFrame(rows, schemas.TRACE)


def plain(df):
    columns = sorted(df.columns)
    return sorted(tuple(str(r[c]) for c in columns) for r in df.collect())


def some_traces(n, seed):
    draw = random.Random(seed)
    return [trace(seed * 1000 + i, DAY + dt.timedelta(minutes=draw.randrange(150)), draw.choice("ab"), draw.choice("xyz"), draw.choice([1, 5, 5, 70, None]), draw.random() < 0.8, draw.choice(["t", None]))
            for i in range(n)]


def test_many_batches_give_the_tables_of_one(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(gold, "FAN_IN", 2)
    root, everything = str(tmp_path / "gold"), []
    for n in range(6):
        rows = some_traces(12, n)
        everything += rows
        gold.write_gold(frame(spark, rows), n, root, ["agent_metrics"])
    assert plain(gold.read_gold(spark, root, "agent_metrics")) == plain(gold.agent_metrics(frame(spark, everything)))
    day = [parts for key, parts in CommittedTables(spark, root).state().members["agent_metrics_cells"].partitions.items() if "unit=day" in key]
    assert max(len(parts) for parts in day) <= 3 and max(level for parts in day for _, level in parts) == 2


def test_all_tables_after_two_batches(spark, tmp_path):
    root = str(tmp_path / "gold")
    first, second = some_traces(30, 1), some_traces(30, 2)
    second.append(trace(9, DAY - dt.timedelta(hours=60)))
    for n, rows in enumerate((first, second)):
        gold.write_gold(frame(spark, rows), n, root)
    whole = frame(spark, first + second)
    for name, summary in gold.SUMMARIES.items():
        assert plain(gold.read_gold(spark, root, name)) == plain(summary.build(whole)), name
    assert plain(gold.read_gold(spark, root, gold.RECENT)) == plain(gold.recent_traces(whole))
    assert gold.read_gold(spark, root, gold.RECENT).count() == 60


def test_a_batch_makes_only_what_it_touches_anew(spark, tmp_path):
    root = str(tmp_path / "gold")
    keys = [trace(i, DAY + dt.timedelta(hours=i % 20), agent=f"a{i % 40}") for i in range(400)]
    gold.write_gold(frame(spark, keys), 0, root, ["kpis"])
    before = CommittedTables(spark, root).state()
    gold.write_gold(frame(spark, [trace(1000, DAY + dt.timedelta(hours=7, minutes=3), agent="a3")]), 1, root, ["kpis"])
    after = CommittedTables(spark, root).state()
    changed = {k for k, parts in after.members["kpis"].partitions.items() if parts != before.members["kpis"].partitions.get(k)}
    # the minute's hour in two grains, and of the day one group of keys
    assert {k for k in changed if "descgrain=day" not in k} == {f"descgrain={g}/dtbucket=2024-01-02/slot=7" for g in ("minute", "hour")}
    assert len([k for k in changed if "descgrain=day" in k]) == 1 < len([k for k in after.members["kpis"].partitions if "descgrain=day" in k])


def test_a_batch_that_dies_shows_nothing_and_counts_once(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "gold")
    first, second = frame(spark, some_traces(20, 1)), frame(spark, some_traces(20, 2))
    gold.write_gold(first, 0, root, ["kpis", "tool_invocations"])
    old = plain(gold.read_gold(spark, root, "kpis"))
    with monkeypatch.context() as dying:
        def lost(self, state):
            raise RuntimeError("lost")
        dying.setattr(CommittedTables, "commit", lost)
        with pytest.raises(RuntimeError):
            gold.write_gold(second, 1, root, ["kpis", "tool_invocations"])
    assert plain(gold.read_gold(spark, root, "kpis")) == old
    for _ in range(2):  # the retry, and once more
        gold.write_gold(second, 1, root, ["kpis", "tool_invocations"])
    whole = first.unionByName(second)
    assert plain(gold.read_gold(spark, root, "kpis")) == plain(gold.kpis(whole))
    assert plain(gold.read_gold(spark, root, "tool_invocations")) == plain(gold.tool_invocations(whole))


def test_a_trace_sent_again_counts_once_also_after_a_restart(spark, tmp_path):
    source, root, checkpoint = (str(tmp_path / n) for n in ("in", "gold", "checkpoint"))
    first = [trace(1, DAY), trace(2, DAY + dt.timedelta(hours=1)), trace(2, DAY + dt.timedelta(hours=1))]
    again = [trace(1, DAY + dt.timedelta(days=1)), trace(3, DAY - dt.timedelta(days=2)), trace(2, DAY, ms=5)]
    for rows in (first, again):
        frame(spark, rows).write.mode("append").parquet(source)
        gold.gold_stream(gold.read_traces(spark, source), root, checkpoint, ["kpis"], available_now=True).awaitTermination(120)
    want = frame(spark, [first[0], first[1], again[1]])
    assert plain(gold.read_gold(spark, root, "kpis")) == plain(gold.kpis(want))


def test_traces_later_than_the_delay_are_dropped(spark, tmp_path):
    source, root, checkpoint = (str(tmp_path / n) for n in ("in", "gold", "checkpoint"))
    for rows in ([trace(1, DAY)], [trace(2, DAY - dt.timedelta(hours=30)), trace(3, DAY - dt.timedelta(hours=20))]):
        frame(spark, rows).write.mode("append").parquet(source)
        gold.gold_stream(gold.read_traces(spark, source), root, checkpoint, ["interactions"], available_now=True, delay="1 day").awaitTermination(120)
    assert {str(r["dtdate"]) + "/" + str(r["idxhour"]) for r in gold.read_gold(spark, root, "interactions").collect()} == {"2024-01-02/0", "2024-01-01/4"}


def test_percentiles_from_merged_counts(spark):
    draw = random.Random(3)
    values = [draw.randrange(1, 400) for _ in range(700)] + [10**6]
    rows = [trace(i, DAY + dt.timedelta(minutes=i % 180), ms=v) for i, v in enumerate(values)] + [trace(9999, DAY, ms=None)]
    out = gold.agent_metrics(frame(spark, rows)).where("descgrain = 'day'").first()
    for name, q in gold.PERCENTILES.items():
        assert float(out[name]) == pytest.approx(np.quantile(values, q), abs=0.006)
    assert out["cntops"] == len(rows)
    per_hour = gold.latency_percentiles(frame(spark, rows), ["codagent"]).where("descgrain = 'hour'").orderBy("tsbucket").collect()
    for h, r in enumerate(per_hour):
        assert r["amntdurationp95"] == pytest.approx(np.quantile([v for i, v in enumerate(values) if i % 180 // 60 == h], 0.95))


def test_tables_need_no_other_columns_than_they_name(spark):
    whole = frame(spark, some_traces(20, 3))
    for name, summary in gold.SUMMARIES.items():
        some = gold._wanted(whole, [name])
        assert set(some.columns) == {"idtrace", *summary.columns} and len(some.columns) < len(whole.columns)
        assert plain(summary.build(some)) == plain(summary.build(whole)), name
    both = gold._wanted(whole, ["interactions", "tool_invocations"])
    assert set(both.columns) == {"idtrace", *gold.INTERACTIONS.columns, *gold.TOOL_INVOCATIONS.columns}
    assert gold._wanted(whole, None).columns == gold._wanted(whole, ["interactions", gold.RECENT]).columns == whole.columns


def test_traces_are_not_dealt_out_by_their_model(spark):
    rows = [dict(trace(i, DAY), nmmodel=model) for i, model in enumerate(["m", "m", "other", None])]
    prices = spark.createDataFrame([("m", 2.0, 3.0)], "nmmodel string, price_in double, price_out double")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with a list whose size Spark does not know
    try:
        priced = gold.with_costs(frame(spark, rows).repartition(3), prices)
        assert priced.rdd.getNumPartitions() == 3  # as read, not one for each model
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert sorted((r["idtrace"], r["nmmodel"], r["amntcostin"]) for r in priced.collect()) == [("0", "m", 0), ("1", "m", 2), ("2", "other", None), ("3", None, None)]
