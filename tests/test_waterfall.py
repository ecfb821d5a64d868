"""The one-pass waterfall against the step-by-step definition."""

import datetime as dt
import os
import random
import time

from pyspark.sql import functions as F

from ledgerlark import session
from ledgerlark.operators import waterfall
from ledgerlark.operators.waterfall import BLOCKS, MatchRule, _cover, _pieces, match_waterfall

INVOICE = "id string, number string, k1 string, k2 string, amount bigint, as_of date"
CLAIM = "factura string, c1 string, c2 string, c_amount bigint, since date, occurred date"


def rules():
    c = F.col
    return [
        MatchRule(1, "a", (c("k1"), c("k2")), (c("c1"), c("c2"))),
        MatchRule(2, "b", (c("k1"),), (c("c1"),), between=(c("amount") - 12, c("amount") + 12, c("c_amount")), widths=(1, 5)),
        MatchRule(3, "c", (c("number"),), (c("factura"),)),
        MatchRule(4, "d", (c("k2"),), (c("c2"),), unique=True),
        MatchRule(5, "e", (c("amount"),), (c("c_amount"),), dated=False),
    ]


def matches(rule, i, c):
    dated = c["since"] is not None and c["since"] <= i["as_of"]
    equal = lambda a, b: a is not None and a == b
    if rule == 1:
        return equal(i["k1"], c["c1"]) and equal(i["k2"], c["c2"]) and dated
    if rule == 2:
        return equal(i["k1"], c["c1"]) and abs(i["amount"] - c["c_amount"]) <= 12 and dated
    if rule == 3:
        return equal(i["number"], c["factura"]) and dated
    if rule == 4:
        return equal(i["k2"], c["c2"]) and dated
    return i["amount"] == c["c_amount"]


def by_hand(invoices, claims):
    """Rule by rule, earlier ids excluded, as NOT IN would."""
    claims = [dict(t) for t in {tuple(c.items()) for c in claims}]
    done, void, out = set(), False, {}
    for rule in (1, 2, 3, 4, 5):
        found = {}
        for i in invoices:
            if void or i["id"] in done:
                continue
            hits = [c for c in claims if matches(rule, i, c)]
            if hits:
                found.setdefault(i["id"], (i, hits))
        if rule == 4:
            found = {k: v for k, v in found.items() if len(v[1]) == 1}
        for key, (i, hits) in found.items():
            if key is None:
                void = True
                continue
            order = lambda c: (c["occurred"], c["factura"])
            other = [c for c in hits if c["factura"] != i["number"]]
            out[key] = (rule, len(hits), max(hits, key=order)["factura"], max(other, key=order)["factura"] if other else None)
        done |= set(found)
    return out


def random_case(seed, nameless=False):
    r = random.Random(seed)
    day = lambda: dt.date(2024, 1, 1) + dt.timedelta(days=r.randrange(30))
    pick = lambda p, n: None if r.random() < 0.1 else f"{p}{r.randrange(n)}"
    invoices = [dict(id=f"i{n}", number=f"f{n}", k1=pick("a", 4), k2=pick("b", 6), amount=r.randrange(-60, 60), as_of=day()) for n in range(40)]
    if nameless:
        invoices.append(dict(id=None, number=None, k1="a1", k2="b1", amount=3, as_of=dt.date(2024, 2, 1)))
    claims = [dict(factura=f"f{r.randrange(60)}", c1=pick("a", 4), c2=pick("b", 6), c_amount=r.randrange(-60, 60), since=day(), occurred=day()) for _ in range(50)]
    return invoices, claims


def run(spark, invoices, claims):
    inv = spark.createDataFrame([tuple(i.values()) for i in invoices], INVOICE)
    cl = spark.createDataFrame([tuple(c.values()) for c in claims], CLAIM)
    found = match_waterfall(inv, cl.withColumn("settled", F.col("since")), rules(), id="id", own="number", as_of=F.col("as_of"), since=F.col("since"),
                            other="factura", payload=["occurred", "factura", "c1", "c2", "c_amount", "settled"], newest=["occurred", "factura"])
    return {r["id"]: (r["rule"], r["n_matches"], r["best"]["factura"], r["best_other"]["factura"] if r["best_other"] else None) for r in found.collect()}


def test_random_cases(spark):
    for seed in range(4):
        invoices, claims = random_case(seed)
        assert run(spark, invoices, claims) == by_hand(invoices, claims), seed


def test_null_id_voids_later_rules(spark):
    for seed in (11, 12):
        invoices, claims = random_case(seed, nameless=True)
        assert run(spark, invoices, claims) == by_hand(invoices, claims), seed


def test_any_interval_is_a_few_pieces(spark):
    r = random.Random(5)
    spans = [(r.randrange(-800_000, 100_000), length) for length in (0, 1, 7, 8, 9, 400, 7300, 730_000, -1, -50) for _ in range(40)]
    rows = spark.createDataFrame([(n, low, low + length) for n, (low, length) in enumerate(spans)], "n int, low bigint, high bigint")
    covers = {x.n: (x.low, x.high, x.pieces) for x in rows.select("*", _cover(F.col("low"), F.col("high"), BLOCKS).alias("pieces")).collect()}
    for low, high, pieces in covers.values():
        assert len(pieces) <= 100
        spans_of = sorted((int(p.split(":")[1]) * BLOCKS[int(p.split(":")[0])], BLOCKS[int(p.split(":")[0])]) for p in pieces)
        at = low
        for start, width in spans_of:
            assert start == at
            at += width
        assert at == high + 1 or (not pieces and high < low)
    inside = spark.createDataFrame([(low, high, v) for low, high in ((3, 5000),) for v in (2, 3, 70, 5000, 5001)], "low bigint, high bigint, v bigint")
    met = inside.select("v", F.size(F.array_intersect(_cover(F.col("low"), F.col("high"), BLOCKS), F.array(*_pieces(F.col("v"), BLOCKS)))).alias("n")).collect()
    assert {x.v: x.n for x in met} == {2: 0, 3: 1, 70: 1, 5000: 1, 5001: 0}


def test_crowded_and_sparse_keys_agree(spark, monkeypatch):
    for few in (0, 8):
        monkeypatch.setattr(waterfall, "FEW", few)
        for nameless in (False, True):
            invoices, claims = random_case(21, nameless)
            assert run(spark, invoices, claims) == by_hand(invoices, claims), (few, nameless)


def test_sparse_keys_need_no_pieces(spark, monkeypatch):
    """An invoice whose key holds few claims is never multiplied by the pieces of its interval."""
    monkeypatch.setattr(waterfall, "_cover", lambda *_: F.raise_error(F.lit("cut into pieces")).cast("array<string>"))
    invoices, claims = random_case(3)
    assert run(spark, invoices, claims) == by_hand(invoices, claims)


def test_overlapping_intervals_of_an_invoice_count_a_claim_once(spark, monkeypatch):
    day = dt.date(2024, 1, 1)
    invoices = [dict(id="i", number="n", k1="a", k2=None, amount=amount, as_of=day) for amount in (10, 13, 13)]
    claims = [dict(factura=f"f{v}", c1="a", c2=None, c_amount=v, since=day, occurred=day) for v in (-3, -2, 0, 1, 6, 22, 23, 25, 26)]
    for few in (0, 32):
        monkeypatch.setattr(waterfall, "FEW", few)
        assert run(spark, invoices, claims) == {"i": (2, 7, "f6", "f6")}


def test_rows_are_shuffled_before_the_rules_multiply_them(spark, monkeypatch):
    plans = {}
    kept = waterfall.written

    def watched(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return kept(df, name)

    monkeypatch.setattr(waterfall, "written", watched)
    invoices, claims = random_case(7)
    assert run(spark, invoices, claims) == by_hand(invoices, claims)
    entries = plans["waterfall-entries"]
    # the plan is printed from its end, so what comes first stands last
    assert entries.count("Exchange") == 1 and entries.index("Exchange") > entries.index("Generate"), "entries are shuffled with their payload"
    assert "waterfall-probes" not in plans, "all probes are written"


def test_tasks_of_many_claims_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr(waterfall, "TASK_CLAIMS", 5)
    plans = {}
    kept = waterfall.written

    def watched(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return kept(df, name)

    monkeypatch.setattr(waterfall, "written", watched)
    invoices, claims = random_case(9)
    assert run(spark, invoices, claims) == by_hand(invoices, claims)
    assert ", 10), REPARTITION_BY_NUM" in plans["waterfall-entries"]


def match(spark, invoices, claims):
    inv = spark.createDataFrame([tuple(i.values()) for i in invoices], INVOICE)
    cl = spark.createDataFrame([tuple(c.values()) for c in claims], CLAIM)
    return match_waterfall(inv, cl, rules(), id="id", own="number", as_of=F.col("as_of"), since=F.col("since"),
                           other="factura", payload=["occurred", "factura", "c1", "c2", "c_amount"], newest=["occurred", "factura"])


def test_a_matched_invoice_asks_no_later_rule_and_only_what_was_found_stays(spark, monkeypatch):
    tables, open_ids = [], []
    kept = waterfall.written

    def watched(df, name):
        table = kept(df, name)
        tables.append((name, [f.removeprefix("file:").replace("///", "/") for f in table.inputFiles()]))
        if name == "waterfall-left":
            open_ids.extend(r.id for r in table.select("id").collect())
        return table

    monkeypatch.setattr(waterfall, "written", watched)
    monkeypatch.setattr(waterfall, "TASK_CLAIMS", 5)
    for few, nameless in ((0, False), (32, False), (32, True)):
        monkeypatch.setattr(waterfall, "FEW", few)
        tables.clear(), open_ids.clear()
        invoices, claims = random_case(5, nameless)
        found = {r.id: r.rule for r in match(spark, invoices, claims).collect()}
        assert found == {k: v[0] for k, v in by_hand(invoices, claims).items()}
        first = min(found.values())
        assert sorted(open_ids) == sorted(i["id"] for i in invoices if i["id"] and found.get(i["id"]) != first) or nameless
        for name, files in tables:
            assert all(os.path.exists(f) == (name == "waterfall-found") for f in files), name
        steps = [name for name, _ in tables].count("waterfall-found")
        assert steps == len(rules()) or nameless and steps >= max(found.values())


def test_shuffles_of_the_rules_leave_the_disk(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        files = blocks.getAllFiles()
        return {name for name in (files.apply(n).getName() for n in range(files.size())) if name.startswith("shuffle_")}

    invoices, claims = random_case(6)
    before = shuffled()
    matched = match(spark, invoices, claims)
    until = time.time() + 20
    while shuffled() - before and time.time() < until:  # they are deleted in the background
        time.sleep(0.2)
    assert not shuffled() - before
    assert spark.conf.get(session._FREE_SHUFFLES, None) is None, "the session's own setting is left"
    assert {r.id: r.rule for r in matched.collect()} == {k: v[0] for k, v in by_hand(invoices, claims).items()}
