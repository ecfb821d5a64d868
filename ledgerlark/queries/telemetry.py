"""Agent telemetry: events stand in for traces."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.joins import literal_table
from ..schemas import TRACE
from ..sources.incremental import shared_folder
from ..streaming import gold
from .registry import Tables, query, r6, sql_r6

PRICES = [("model-0", "0.000003", "0.000015"), ("model-1", "0.000001", "0.000002")]
TRACES_SQL = """t0 AS (SELECT event_id::VARCHAR AS idtrace, 'c' || (user_id % 50) AS idconversation, event_type AS codagent, upper(event_type) AS nmagent, 'owner' AS nmowner,
  'squad' || (user_id % 3) AS nmsquad, 'u' || user_id AS codidentity, CASE WHEN user_id % 5 = 0 THEN 'PROCESS' ELSE 'PERSON' END AS descidentitytype,
  'corp' AS coddomain, 'area' || (user_id % 4) AS codsubdomain, 'model-' || (user_id % 3) AS nmmodel, CASE WHEN event_id % 4 <> 0 THEN 'tool' || (event_id % 3) END AS nmtool,
  event_id % 10 <> 0 AS flgsuccess, floor(value * 100)::INTEGER AS amntdurationms, (props->>'k')::INTEGER AS qtyintoken, 2 * (props->>'k')::INTEGER AS qtyouttoken, ts AS tsstart FROM events),
traces AS (SELECT t0.*, (qtyintoken * pin)::DECIMAL(18,6) AS amntcostin, (qtyouttoken * pout)::DECIMAL(18,6) AS amntcostout FROM t0
  LEFT JOIN (VALUES ('model-0', 0.000003::DECIMAL(18,6), 0.000015::DECIMAL(18,6)), ('model-1', 0.000001::DECIMAL(18,6), 0.000002::DECIMAL(18,6))) p(m, pin, pout) ON nmmodel = m),
grained AS (SELECT traces.*, g AS descgrain, CASE g WHEN 'minute' THEN date_trunc('minute', tsstart) WHEN 'hour' THEN date_trunc('hour', tsstart) ELSE date_trunc('day', tsstart) END::TIMESTAMP AS tsbucket,
  tsstart::DATE AS dtbucket FROM traces, (SELECT unnest(['minute', 'hour', 'day']) AS g))"""
_MEAN = "(((sum(amntdurationms::BIGINT) * 200 + count(*)) // (2 * count(*)))::DECIMAL(18,2) / 100)::DECIMAL(18,2)"


def _rate(condition: str) -> str:
    return f"(((count(*) FILTER ({condition}) * 20000 + count(*)) // (2 * count(*)))::DECIMAL(18,4) / 10000)::DECIMAL(5,4)"


def traces(t: Tables):
    e, user, k = t.events, F.col("user_id"), F.from_json("props", "k int")["k"]
    text = lambda c: c.cast("string")
    base = e.select(
        text(F.col("event_id")).alias("idtrace"), F.concat(F.lit("c"), text(user % 50)).alias("idconversation"), F.col("event_type").alias("codagent"),
        F.upper("event_type").alias("nmagent"), F.lit("owner").alias("nmowner"), F.concat(F.lit("squad"), text(user % 3)).alias("nmsquad"),
        F.concat(F.lit("u"), text(user)).alias("codidentity"), F.when(user % 5 == 0, "PROCESS").otherwise("PERSON").alias("descidentitytype"),
        F.lit("corp").alias("coddomain"), F.concat(F.lit("area"), text(user % 4)).alias("codsubdomain"), F.concat(F.lit("model-"), text(user % 3)).alias("nmmodel"),
        F.when(F.col("event_id") % 4 != 0, F.concat(F.lit("tool"), text(F.col("event_id") % 3))).alias("nmtool"), (F.col("event_id") % 10 != 0).alias("flgsuccess"),
        F.floor(F.col("value") * 100).cast("int").alias("amntdurationms"), k.alias("qtyintoken"), (2 * k).alias("qtyouttoken"), F.col("ts").alias("tsstart"))
    prices = literal_table(t.spark, PRICES, "nmmodel string, pin string, pout string").select(
        "nmmodel", F.col("pin").cast("decimal(18,6)").alias("price_in"), F.col("pout").cast("decimal(18,6)").alias("price_out"))
    return gold.with_costs(base, prices)


@query("g1_traces", f"WITH {TRACES_SQL} SELECT idtrace, codagent, nmmodel, flgsuccess, amntdurationms, qtyintoken, amntcostin, amntcostout, tsstart FROM traces")
def _(t):
    return traces(t).select("idtrace", "codagent", "nmmodel", "flgsuccess", "amntdurationms", "qtyintoken", "amntcostin", "amntcostout", "tsstart")


KPIS_SQL = f"""WITH {TRACES_SQL} SELECT nmowner, nmsquad, codagent, nmagent, codidentity, coddomain, codsubdomain, descgrain, tsbucket, dtbucket, count(DISTINCT idconversation)::INTEGER AS cntconversations,
  count(*) AS cntinteractions, sum(qtyintoken)::BIGINT AS qtyintoken, sum(qtyouttoken)::BIGINT AS qtyouttoken, {_MEAN} AS amntlatencyavg FROM grained GROUP BY ALL"""


@query("g2_kpis", KPIS_SQL)
def _(t):
    return gold.kpis(traces(t))


INTERACTIONS_SQL = f"""WITH {TRACES_SQL} SELECT nmowner, nmsquad, codagent, codidentity, descidentitytype, coddomain, codsubdomain, tsstart::DATE AS dtdate, strftime(tsstart, '%a') AS descdayofweek,
  hour(tsstart)::INTEGER AS idxhour, count(*) AS cntinteractions FROM traces GROUP BY ALL"""


@query("g3_interactions", INTERACTIONS_SQL)
def _(t):
    return gold.interactions(traces(t))


COSTS_SQL = f"""WITH {TRACES_SQL} SELECT nmowner, nmsquad, codagent, nmagent, codidentity, nmmodel, descgrain, tsbucket, dtbucket, sum(qtyintoken)::BIGINT AS qtyintoken, sum(qtyouttoken)::BIGINT AS qtyouttoken,
  sum(amntcostin)::DECIMAL(18,6) AS amntcostin, sum(amntcostout)::DECIMAL(18,6) AS amntcostout FROM grained GROUP BY ALL"""


@query("g4_token_costs", COSTS_SQL)
def _(t):
    return gold.token_costs(traces(t))


_POINT = "quantile_cont(amntdurationms::DOUBLE, {})::DECIMAL(18,2) AS amntdurationp{}"
AGENTS_SQL = f"""WITH {TRACES_SQL} SELECT nmowner, nmsquad, codagent, nmagent, codidentity, nmmodel, descgrain, tsbucket, dtbucket, count(*)::INTEGER AS cntops, {_MEAN} AS amntdurationavg,
  {_rate('flgsuccess')} AS pctsuccessrate, (sum(amntcostin) + sum(amntcostout))::DECIMAL(18,6) AS amntcosttotal, {', '.join(_POINT.format(p / 100, p) for p in (50, 95, 99))} FROM grained GROUP BY ALL"""


@query("g5_agent_metrics", AGENTS_SQL)
def _(t):
    return gold.agent_metrics(traces(t))


@query("g5_latency_percentiles", f"""WITH {TRACES_SQL} SELECT codagent, nmmodel, descgrain, tsbucket, {sql_r6('quantile_cont(amntdurationms::DOUBLE, 0.5)')} AS amntdurationp50,
  {sql_r6('quantile_cont(amntdurationms::DOUBLE, 0.95)')} AS amntdurationp95, {sql_r6('quantile_cont(amntdurationms::DOUBLE, 0.99)')} AS amntdurationp99 FROM grained GROUP BY ALL""")
def _(t):
    points = gold.latency_percentiles(traces(t), ["codagent", "nmmodel"]).drop("dtbucket")
    return points.withColumns({p: r6(p) for p in gold.PERCENTILES})


TOOLS_SQL = f"""WITH {TRACES_SQL} SELECT nmowner, nmsquad, codagent, codidentity, nmtool, descgrain, tsbucket, dtbucket, count(*)::INTEGER AS cntinvocations, {_MEAN} AS amntdurationavg,
  {_rate('NOT flgsuccess')} AS pcterrorrate FROM grained WHERE nmtool IS NOT NULL GROUP BY ALL"""


@query("g6_tool_invocations", TOOLS_SQL)
def _(t):
    return gold.tool_invocations(traces(t))


RECENT_SQL = f"""WITH {TRACES_SQL} SELECT * EXCLUDE (idconversation, descidentitytype, nmmodel, nmtool), tsstart::DATE AS dsstart FROM traces
WHERE tsstart >= (SELECT max(tsstart) FROM traces) - INTERVAL 48 HOUR"""


@query("g7_recent_traces", RECENT_SQL)
def _(t):
    return gold.recent_traces(traces(t))


#: The tables' traces span weeks and come at once, so an id is kept longer than in a live stream.
DELAY = "1000 days"


def _sent(t: Tables, source: str, traces) -> None:
    """Trace files for the stream to find."""
    traces.select(*[F.col(f.name).cast(f.dataType) for f in TRACE.fields]).write.mode("append").parquet(source)


@query("g1_unique_traces", f"WITH {TRACES_SQL} SELECT idtrace, codagent, amntdurationms, tsstart FROM traces")
def _(t):
    source, out, checkpoint = (shared_folder(t.spark, n) for n in ("traces", "unique", "checkpoint"))
    first, again = traces(t), traces(t).where(F.col("idtrace").cast("bigint") % 3 == 0)
    # a third comes again with another day and duration; the second run starts from the first one's checkpoint
    for some in (first, again.withColumns({"tsstart": F.col("tsstart") + F.expr("interval 1 day"), "amntdurationms": F.lit(0)})):
        _sent(t, source, some)
        unique = gold.unique_traces(gold.read_traces(t.spark, source), DELAY)
        unique.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return t.spark.read.schema(TRACE).parquet(out).select("idtrace", "codagent", "amntdurationms", "tsstart")


def sink(t: Tables, table: str):
    """The table after three runs of the stream: most traces, then late ones of all days with some repeated, and those all again."""
    root, source, checkpoint = (shared_folder(t.spark, n) for n in ("gold", "traces", "checkpoint"))
    number = F.col("idtrace").cast("bigint")
    late = traces(t).where(number % 7 >= 2).where(number % 7 <= 3)
    for some in (traces(t).where(number % 7 != 3), late, late):
        _sent(t, source, some)
        gold.gold_stream(gold.read_traces(t.spark, source), root, checkpoint, [table], available_now=True, delay=DELAY, layout=gold.Layout(hours=24, groups=1)).awaitTermination()
    return gold.read_gold(t.spark, root, table)


for _name, _sql in (("kpis", KPIS_SQL), ("interactions", INTERACTIONS_SQL), ("token_costs", COSTS_SQL), ("agent_metrics", AGENTS_SQL), ("tool_invocations", TOOLS_SQL), ("recent_traces", RECENT_SQL)):
    query(f"g8_{_name}_sink", _sql)(lambda t, name=_name: sink(t, name))


@query("g8_gold_sink", f"""WITH {TRACES_SQL} SELECT descgrain, dtbucket, count(*) AS rows, sum(cntinteractions)::BIGINT AS traces FROM ({KPIS_SQL.replace('WITH ' + TRACES_SQL, '')}) GROUP BY 1, 2""")
def _(t):
    return sink(t, "kpis").groupBy("descgrain", "dtbucket").agg(F.count(F.lit(1)).alias("rows"), F.sum("cntinteractions").alias("traces"))
