"""Plans and steps that must not gather in the driver or in one task what grows with the rows."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerlark.operators import joins, nested
from ledgerlark.plans import reports
from ledgerlark.streaming import gold


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_nearby_counts_are_not_broadcast(spark):
    day = dt.datetime(2024, 1, 1)
    rows = [(n, n % 3 or None, day + dt.timedelta(days=n % 7), float(n * 40)) for n in range(30)]
    orders = spark.createDataFrame(rows, "id int, k int, d timestamp, amount double")
    counted = {
        "days": (joins.nearby_date_counts(orders, orders, ["k"], "d", "d", 2, 1), lambda a, b: -2 <= (b[2] - a[2]).days <= 1),
        "amounts": (joins.nearby_amount_counts(orders, orders, ["k"], "amount", "amount", 90), lambda a, b: abs(a[3] - b[3]) <= 90),
        "months": (joins.same_period_counts(orders, orders, ["k"], "d", "d", "MM", "n_near"), lambda a, b: a[2].month == b[2].month),
    }
    for name, (found, near) in counted.items():
        expected = {a[0]: sum(a[1] is not None and a[1] == b[1] and near(a, b) for b in rows) for a in rows}
        assert {r.id: r.n_near for r in found.collect()} == expected, name
        assert "Broadcast" not in plan_of(found), name


def test_values_are_counted_without_shuffling_them(spark):
    texts = [(1, "b a a b c"), (2, "x"), (2, "y y x x"), (3, None), (4, ""), (None, "p q q"), (None, "p p"), (5, "d d e")]
    docs = spark.createDataFrame(texts, "id int, text string")
    found = nested.dominant_values(docs, "id", F.split("text", " "), "word")
    assert {r.id: r.word for r in found.collect()} == {1: "b", 2: "x", 3: None, 4: "", None: "p", 5: "d"}
    final = plan_of(found).split("Initial Plan")[0]
    assert final.count("Exchange") == 1 and final.index("Exchange") > final.index("Generate"), "arrays travel whole"


def test_traces_are_spread_before_they_are_summed_up(spark):
    day = dt.datetime(2024, 1, 1)
    rows = [(f"a{n % 3}", day + dt.timedelta(minutes=n), n) for n in range(50)]
    traces = spark.createDataFrame(rows, "codagent string, tsstart timestamp_ntz, amntdurationms int")
    found = gold.latency_percentiles(traces, ["codagent"])
    days = {r.codagent: r.amntdurationp50 for r in found.where("descgrain = 'day'").collect()}
    assert days == {"a0": 24.0, "a1": 25.0, "a2": 24.5}
    final = plan_of(found).split("Initial Plan")[0]
    # the plan is printed from its end, so what comes first stands last
    assert "REPARTITION" in final[final.rindex("Aggregate"):], "a task sums up all traces of its file"


def test_delivery_rows_are_shuffled_once_in_tasks_of_bounded_rows(spark, monkeypatch):
    monkeypatch.setattr(reports, "TASK_ROWS", 1)
    rows = [(f"f{n // 2}", f"n{n // 2}" if n < 8 else None, "2024", f"m{n % 4 // 2}") for n in range(10)]
    alerts = spark.createDataFrame(rows + [(None, None, "2024", "m0"), ("f9", "n9", "2023", "m0")], "num_factura_documento_ocr string, num_siniestro string, processed_date string, reglas_mensaje string")
    claims = [("f0", "n0", None), ("f0", "n0", reports.REGULAR), ("f1", "n1", "ESPECIAL"), ("f4", None, "ESPECIAL"), (None, None, "ESPECIAL")]
    snapshot = spark.createDataFrame(claims, "factura string, num_siniestro string, tip_caso_especial string").withColumns({c: F.lit(c) for c in reports.SNAPSHOT if c != "tip_caso_especial"})
    headers = spark.createDataFrame([("f-0", "old", "1"), ("f-0", "new", "2"), ("f0", "other", "1")], "invoice_number string, batch_name string, processed_date string")
    found = reports.delivery(alerts, snapshot, headers, "2024")
    seen = sorted((r.num_factura_documento_ocr or "", r.reglas_mensaje, r.tip_caso_especial, r.bandeja or "", r.flag_ocurrenciaActual, r.num_lote or "") for r in found.collect())
    regular = [("", "m0", reports.REGULAR, "", 0, "")] + [(f"f{n}", f"m{n % 2}", reports.REGULAR, "", 0, "") for n in (2, 3, 4)]
    assert seen == sorted([("f0", "m0", reports.REGULAR, "bandeja", 1, lot) for lot in ("new", "other")] + [("f1", "m1", "ESPECIAL", "bandeja", 1, "")] + regular)
    final = plan_of(found).split("Initial Plan")[0]
    after = final[:final.index("Join")]
    assert "Exchange" not in after, "joined rows are shuffled again to be compared"
    assert ", 12)" in final, "tasks are as many as the rows ask for"
