"""Summary tables over agent traces, computed in batch and kept by micro-batches.

Tables: KPIs, interactions, token cost, agent metrics, tool invocations, recent traces.

Every summary goes through *cells*: counts and exact sums per dimensions, minute and, where a measure needs it, one more
value (the conversation, the duration).  Cells add up: minutes to hours and days, and batches to each other, so distinct counts are
distinct values of merged cells and percentiles come from merged counts of values.

The sink never reads a stored trace again.  A micro-batch is cut into cells once, by minute and by day, and these are appended to the
stored ones; then only the summaries of the hours it touches and of the days' key groups it touches are made anew, from their cells.
Cells of many batches are merged whenever ``FAN_IN`` have been merged equally often.  All tables change by one commit that also names
the batch, so readers see a whole batch or nothing of it and a repeated batch changes nothing.  Traces sent twice are dropped
before, by the stream's state (``unique_traces``).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import asdict, dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import floor_to
from ..schemas import TRACE
from ..sources.commits import CommittedTables, Member, State, appended, merge_due, partition_value

# --- fixed values -----------------------------------------------------------
GRAINS = ["minute", "hour", "day"]
INTERVAL = "10 seconds"
RECENT_HOURS = 48
PERCENTILES = {"amntdurationp50": 0.50, "amntdurationp95": 0.95, "amntdurationp99": 0.99}
# --- end of fixed values ----------------------------------------------------

BUCKET = ["descgrain", "tsbucket", "dtbucket"]
#: Batches merged at once, and how long a trace that comes again is recognised.
FAN_IN, DELAY = 4, "7 days"


def exact_mean(total: Column, n: Column, scale: int, kind: str) -> Column:
    """total / n rounded half up to ``scale`` decimals, by whole numbers only."""
    unit = 10 ** scale
    scaled = F.floor((total.cast("decimal(38,0)") * (2 * unit) + n) / (n * 2))
    return (scaled.cast("decimal(38,0)") / unit).cast(kind)


def _total(column: str) -> Column:
    return F.sum(F.col(column).cast("bigint"))


def _how_often(condition: Column) -> Column:
    return F.sum(F.when(condition, 1).otherwise(0).cast("bigint"))


def _mean_duration() -> Column:
    return exact_mean(F.sum("duration"), F.sum("timed"), 2, "decimal(18,2)")


def _duration() -> dict[str, Column]:
    return {"duration": _total("amntdurationms"), "timed": F.count("amntdurationms")}


def _count() -> dict[str, Column]:
    return {"n": F.count(F.lit(1))}


@dataclass(frozen=True)
class Summary:
    """A table by its cells: ``sums`` add up traces, ``measures`` read merged cells, ``detail`` is one more value cells are kept by."""

    dims: list[str]
    sums: Callable[[], dict[str, Column]]
    measures: Callable[[], dict[str, Column]]
    detail: str | None = None
    #: Columns of traces that ``sums`` and ``where`` read besides.
    reads: list[str] = field(default_factory=list)
    where: str | None = None
    grains: list[str] = field(default_factory=lambda: GRAINS)
    #: Bucket columns of a table without grains, from ``tsbucket``; they go before its measures.
    bucket: Callable[[], dict[str, Column]] | None = None

    def cells(self, traces: DataFrame, unit: str = "minute") -> DataFrame:
        """dims, ``at`` (start of the minute, hour or day), ``detail`` and the sums."""
        if self.where is not None:
            traces = traces.where(self.where)
        return traces.groupBy(*self.dims, floor_to(unit, F.col("tsstart")).alias("at"), *self._value()).agg(*[c.alias(n) for n, c in self.sums().items()])

    def _value(self) -> list[Column]:
        return [F.col(self.detail).alias("detail")] if self.detail else []

    def merged(self, cells: DataFrame, *more: str) -> DataFrame:
        """Cells of several batches as one."""
        return cells.groupBy(*more, *self.dims, "at", *(["detail"] if self.detail else [])).agg(*[F.sum(n).alias(n) for n in self.sums()])

    def summed(self, cells: DataFrame, grains: list[str]) -> DataFrame:
        """The table's rows of some grains, from cells of the finest of them or finer."""
        buckets = F.array(*[F.struct(F.lit(g).alias("descgrain"), floor_to(g, F.col("at")).alias("tsbucket")) for g in grains])
        spread = cells.withColumn("__b", F.explode(buckets)).select("*", "__b.*").drop("__b")
        measures = self.measures()
        out = spread.groupBy(*self.dims, "descgrain", "tsbucket").agg(*[c.alias(n) for n, c in measures.items()])
        columns = self.bucket() if self.bucket else {"descgrain": F.col("descgrain"), "tsbucket": F.col("tsbucket"), "dtbucket": F.to_date("tsbucket")}
        return out.select(*self.dims, *[c.alias(n) for n, c in columns.items()], *measures)

    def build(self, traces: DataFrame) -> DataFrame:
        """The whole table from traces: each counted once, in its minute.

        Most cells hold few traces, so the task that reads a file would hold a cell for nearly each of its rows: traces are
        spread before they are summed up.
        """
        partitions = int(traces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        return self.summed(self.cells(traces.repartition(partitions, *self.dims, "tsstart"), self.grains[0]), self.grains)

    @property
    def columns(self) -> list[str]:
        """Columns of traces that the table is made from."""
        return [*self.dims, *self.reads, *([self.detail] if self.detail else []), "tsstart"]

    @property
    def date_column(self) -> str:
        return "dtdate" if self.bucket else "dtbucket"


def _percentiles() -> dict[str, Column]:
    """Interpolated, from how often each duration occurs; a key's counts are at most one per millisecond that a trace can last."""
    return {name: F.percentile("detail", F.lit(q), F.col("n")) for name, q in PERCENTILES.items()}


AGENT_DIMENSIONS = ["nmowner", "nmsquad", "codagent", "nmagent", "codidentity", "nmmodel"]
KPIS = Summary(
    ["nmowner", "nmsquad", "codagent", "nmagent", "codidentity", "coddomain", "codsubdomain"],
    lambda: {**_count(), "tokens_in": _total("qtyintoken"), "tokens_out": _total("qtyouttoken"), **_duration()},
    lambda: {"cntconversations": F.count_distinct("detail").cast("int"), "cntinteractions": F.sum("n"), "qtyintoken": F.sum("tokens_in"), "qtyouttoken": F.sum("tokens_out"),
             "amntlatencyavg": _mean_duration()}, "idconversation", ["qtyintoken", "qtyouttoken", "amntdurationms"])
INTERACTIONS = Summary(
    ["nmowner", "nmsquad", "codagent", "codidentity", "descidentitytype", "coddomain", "codsubdomain"], _count, lambda: {"cntinteractions": F.sum("n")}, grains=["hour"],
    bucket=lambda: {"dtdate": F.to_date("tsbucket"), "descdayofweek": F.date_format("tsbucket", "E"), "idxhour": F.hour("tsbucket")})
TOKEN_COSTS = Summary(
    AGENT_DIMENSIONS,
    lambda: {"tokens_in": _total("qtyintoken"), "tokens_out": _total("qtyouttoken"), "cost_in": F.sum("amntcostin"), "cost_out": F.sum("amntcostout")},
    lambda: {"qtyintoken": F.sum("tokens_in"), "qtyouttoken": F.sum("tokens_out"), "amntcostin": F.sum("cost_in").cast("decimal(18,6)"), "amntcostout": F.sum("cost_out").cast("decimal(18,6)")},
    reads=["qtyintoken", "qtyouttoken", "amntcostin", "amntcostout"])
AGENT_METRICS = Summary(
    AGENT_DIMENSIONS,
    lambda: {**_count(), **_duration(), "ok": _how_often(F.col("flgsuccess")), "cost_in": F.sum("amntcostin"), "cost_out": F.sum("amntcostout")},
    lambda: {"cntops": F.sum("n").cast("int"), "amntdurationavg": _mean_duration(), "pctsuccessrate": exact_mean(F.sum("ok"), F.sum("n"), 4, "decimal(5,4)"),
             "amntcosttotal": (F.sum("cost_in") + F.sum("cost_out")).cast("decimal(18,6)"), **{n: p.cast("decimal(18,2)") for n, p in _percentiles().items()}}, "amntdurationms",
    ["flgsuccess", "amntcostin", "amntcostout"])
TOOL_INVOCATIONS = Summary(
    ["nmowner", "nmsquad", "codagent", "codidentity", "nmtool"],
    lambda: {**_count(), **_duration(), "failed": _how_often(~F.col("flgsuccess"))},
    lambda: {"cntinvocations": F.sum("n").cast("int"), "amntdurationavg": _mean_duration(), "pcterrorrate": exact_mean(F.sum("failed"), F.sum("n"), 4, "decimal(5,4)")},
    reads=["amntdurationms", "flgsuccess"], where="nmtool IS NOT NULL")

SUMMARIES = {"kpis": KPIS, "interactions": INTERACTIONS, "token_costs": TOKEN_COSTS, "agent_metrics": AGENT_METRICS, "tool_invocations": TOOL_INVOCATIONS}
RECENT = "recent_traces"
TABLES = [*SUMMARIES, RECENT]

kpis: Callable[[DataFrame], DataFrame] = KPIS.build
interactions: Callable[[DataFrame], DataFrame] = INTERACTIONS.build
token_costs: Callable[[DataFrame], DataFrame] = TOKEN_COSTS.build
agent_metrics: Callable[[DataFrame], DataFrame] = AGENT_METRICS.build
tool_invocations: Callable[[DataFrame], DataFrame] = TOOL_INVOCATIONS.build


def with_costs(traces: DataFrame, prices: DataFrame) -> DataFrame:
    """Costs from a price per token and model (columns nmmodel, price_in, price_out).

    The price list, a row per model, is broadcast: a shuffle would leave all traces to as many tasks as there are models.
    """
    priced = traces.drop("amntcostin", "amntcostout").join(F.broadcast(prices), "nmmodel", "left")
    return priced.withColumns({
        "amntcostin": (F.col("qtyintoken") * F.col("price_in")).cast("decimal(18,6)"),
        "amntcostout": (F.col("qtyouttoken") * F.col("price_out")).cast("decimal(18,6)"),
    }).drop("price_in", "price_out")


def latency_percentiles(traces: DataFrame, dims: list[str]) -> DataFrame:
    """Interpolated percentiles of the durations per dims and bucket of every grain: one count per key, minute and value, merged into hours and days."""
    return Summary(dims, _count, _percentiles, "amntdurationms").build(traces.where(F.col("amntdurationms").isNotNull()))


def _recent_columns(traces: DataFrame) -> DataFrame:
    return traces.drop("idconversation", "descidentitytype", "nmmodel", "nmtool").withColumn("dsstart", F.to_date("tsstart"))


def recent_traces(traces: DataFrame, hours: int = RECENT_HOURS) -> DataFrame:
    """Single traces of the last hours before the newest one."""
    last = traces.agg(F.max("tsstart").alias("t")).scalar()
    return _recent_columns(traces.where(F.col("tsstart") >= last - F.make_dt_interval(hours=F.lit(hours))))


PLACE = ["unit", "dtbucket", "slot"]


@dataclass(frozen=True)
class Layout:
    """How a day is cut into what a batch makes anew: hours of a slot of minutes and hours, and groups of keys of a day's rows.

    Small pieces suit a stream of the present, one piece a day suits loads of many days; a folder keeps the layout it was made with.
    """

    hours: int = 1
    groups: int = 4

    def slot(self, summary: Summary, unit: str, hour: Column) -> Column:
        return F.pmod(F.xxhash64(*summary.dims), F.lit(self.groups)).cast("int") if unit == "day" else F.floor(hour / self.hours).cast("int")


# --- the stream --------------------------------------------------------------------------------------

def read_traces(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """Trace files as a stream."""
    reader = spark.readStream.schema(TRACE)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def unique_traces(traces: DataFrame, delay: str = DELAY) -> DataFrame:
    """A stream's traces, each id once: the first that comes counts, whatever time a later one carries.

    Ids are kept in the state store until ``delay`` after their event; traces that come later than ``delay`` after the newest event are
    dropped, as their day has expired.
    """
    timed = traces.withColumn("__event", F.col("tsstart").cast("timestamp")).withWatermark("__event", delay)
    return timed.dropDuplicatesWithinWatermark(["idtrace"]).drop("__event")


def _wanted(traces: DataFrame, tables: list[str] | None) -> DataFrame:
    """The id and the columns that some tables are made from, so that no others are shuffled and kept."""
    names = tables or TABLES
    if RECENT in names:
        return traces
    read = {"idtrace", *(c for name in names for c in SUMMARIES[name].columns)}
    return traces.select(*[c for c in traces.columns if c in read])


def gold_stream(traces: DataFrame, root: str, checkpoint: str, tables: list[str] | None = None, available_now: bool = False, delay: str = DELAY, layout: Layout | None = None):
    """Keep the tables from a stream, every ten seconds or once over what is available."""
    writer = (unique_traces(_wanted(traces, tables), delay).writeStream.option("checkpointLocation", checkpoint)
              .foreachBatch(lambda batch, batch_id: write_gold(batch, batch_id, root, tables, checkpoint, layout or Layout())))
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=INTERVAL)).start()


# --- the sink ----------------------------------------------------------------------------------------

def _placed(summary: Summary, cells: DataFrame, unit: str, layout: Layout) -> DataFrame:
    """Cells with their place: those finer than a day lie by date and slot of hours, those of a day by date and group of keys."""
    return cells.withColumns({"unit": F.lit(unit), "dtbucket": F.to_date("at"), "slot": layout.slot(summary, unit, F.hour("at"))})


def _units(summary: Summary) -> dict[str, list[str]]:
    """The units cells are stored in, with the grains that are summed up from them."""
    fine = [g for g in summary.grains if g != "day"]
    return {**({fine[0]: fine} if fine else {}), **({"day": ["day"]} if "day" in summary.grains else {})}


def _merge(tables: CommittedTables, name: str, member: Member, touched: list[str], merged: Callable[[DataFrame], DataFrame]) -> None:
    """Put the last folders of touched partitions together where enough have gathered."""
    due = {key: n for key in touched if (n := merge_due(member.partitions[key], FAN_IN)) > 1}
    if not due:
        return
    folders = [f for key, n in due.items() for f, _ in member.partitions[key][-n:]]
    rows = merged(tables.read_folders(member, folders))
    new = tables.stage(name, rows.select(*[F.col(f.name).cast(f.dataType) for f in member.schema.fields]), member.partition_by, spread="keys")
    for key, n in due.items():
        level = 1 + max(level for _, level in member.partitions[key][-n:])
        member.partitions[key][-n:] = [(folder, level) for folder, _ in new.partitions[key]]


def _refresh(tables: CommittedTables, state: State, name: str, batch: DataFrame, layout: Layout) -> None:
    """Add a batch's cells to a summary and make the rows of the places it touches anew."""
    summary, cells_name = SUMMARIES[name], f"{name}_cells"
    fresh = None
    for unit in _units(summary):
        cells = _placed(summary, summary.cells(batch, unit), unit, layout)
        fresh = cells if fresh is None else fresh.unionByName(cells)
    new = tables.stage(cells_name, fresh, PLACE, spread="keys")
    if not new.partitions:
        return
    member = state.members[cells_name] = appended(state.members.get(cells_name), new)
    touched = [*new.partitions]
    _merge(tables, cells_name, member, touched, lambda cells: summary.merged(cells, *PLACE))
    rows = None
    for unit, grains in _units(summary).items():
        keys = [k for k in touched if partition_value(k, "unit") == unit]
        cells = tables.read_folders(member, [f for k in keys for f, _ in member.partitions[k]])
        some = summary.summed(cells, grains)
        some = some.withColumn("slot", layout.slot(summary, unit, F.col("idxhour") if summary.bucket else F.hour("tsbucket")))
        rows = some if rows is None else rows.unionByName(some)
    place = [summary.date_column, "slot"] if summary.bucket else ["descgrain", "dtbucket", "slot"]
    made = tables.stage(name, rows, place, spread="keys")
    kept = state.members[name].partitions if name in state.members else {}
    state.members[name] = Member(made.schema, place, {**kept, **made.partitions})


def write_gold(batch: DataFrame, batch_id: int, root: str, tables: list[str] | None = None, stream: str = "", layout: Layout = Layout()) -> None:
    """Add a micro-batch of traces, none of which came before, to the tables, however late its rows.

    Batches are numbered per ``stream``; one that is committed already is left alone.  Old days go by ``expire``, never on arrival.
    """
    store = CommittedTables(batch.sparkSession, root)
    state = store.state().copy()
    done = state.notes.setdefault("batches", {})
    if batch_id <= done.get(stream, -1):
        return
    layout = Layout(**state.notes.setdefault("layout", asdict(layout)))
    batch = batch.persist()
    try:
        newest = batch.agg(F.max("tsstart").cast("string")).first()[0]
        for name in (tables or TABLES) if newest else []:
            if name in SUMMARIES:
                _refresh(store, state, name, batch, layout)
                continue
            new = store.stage(name, _recent_columns(batch).withColumn("slot", F.floor(F.hour("tsstart") / layout.hours).cast("int")), ["dsstart", "slot"])
            state.members[name] = appended(state.members.get(name), new)
            _merge(store, name, state.members[name], [*new.partitions], lambda rows: rows)
            state.notes["newest"] = max(state.notes.get("newest", ""), newest)
    finally:
        batch.unpersist()
    done[stream] = batch_id
    store.commit(state)


def read_gold(spark: SparkSession, root: str, table: str, hours: int = RECENT_HOURS) -> DataFrame:
    """A table as of the newest committed batch; files outside its dates are not read where a filter names them."""
    store = CommittedTables(spark, root)
    state = store.state()
    if table != RECENT:
        return store.read(table, state=state).drop("slot")
    first = F.lit(state.notes["newest"]).cast("timestamp_ntz") - F.make_dt_interval(hours=F.lit(hours))
    return store.read(table, state=state).drop("slot").where((F.col("tsstart") >= first) & (F.col("dsstart") >= F.to_date(first)))


def expire(spark: SparkSession, root: str, before: date, older_than: float = 3600.0) -> list[str]:
    """Leave days older than ``before`` out of all tables and their cells, and delete files that nothing names any more; the partitions that went."""
    store = CommittedTables(spark, root)
    state, gone = store.state().copy(), []
    for name, member in state.members.items():
        column = next(c for c in member.partition_by if c in ("dtbucket", "dtdate", "dsstart"))
        old = [k for k in member.partitions if date.fromisoformat(partition_value(k, column)) < before]
        gone += [f"{name}/{k}" for k in old]
        for k in old:
            del member.partitions[k]
    if gone:
        store.commit(state)
    store.vacuum(older_than=older_than)
    return gone
