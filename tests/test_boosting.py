"""Boosted trees against growth by plain loops."""

import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlark.operators import boosting
from ledgerlark.operators.boosting import BoostParameters

P = BoostParameters(trees=12, step=0.1, depth=4, row_share=0.9, column_share=0.7, min_gain=0.3, l1=0.4, l2=2.0, bins=16, seed=39)
NAMES = ["a", "b", "c", "d"]


def table(n, seed=1):
    draw = np.random.default_rng(seed)
    x = np.column_stack([draw.normal(size=n), draw.integers(0, 5, n), draw.normal(size=n).round(1), draw.random(n)])
    y = 3 * (x[:, 0] > 0.2) + x[:, 1] + 2 * x[:, 2] * (x[:, 3] > 0.5) + draw.normal(size=n) / 5
    x[::17, 2] = np.nan
    return x, y


def frame(spark, x, y):
    rows = [(i, *[None if np.isnan(v) else float(v) for v in r], float(t)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, f"row bigint, {', '.join(f'{c} double' for c in NAMES)}, y double")


def by_hand(x, y, p):
    """Predictions of the rows themselves, with cuts at inverted quantiles and every cut of every node tried one by one."""
    cuts = [np.unique(np.quantile(v[~np.isnan(v)], np.arange(1, p.bins) / p.bins, method="inverted_cdf")) for v in x.T]
    margin, soft = np.full(len(y), y.mean()), lambda g: np.sign(g) * max(abs(g) - p.l1, 0)
    value = lambda g, n: soft(g) ** 2 / (n + p.l2)

    def grown(g, rows, drawn, columns, depth):
        """(weights of rows, whether it is a leaf)"""
        mine = [r for r in rows if drawn[r]]
        total = sum(g[r] for r in mine)
        leaf = -soft(total) / (len(mine) + p.l2)
        best = (1e-6, None)
        for c in columns if depth else []:
            for at in cuts[c]:
                left = [r for r in mine if np.isnan(x[r, c]) or x[r, c] <= at]
                if 0 < len(left) < len(mine):
                    gl = sum(g[r] for r in left)
                    gain = value(gl, len(left)) + value(total - gl, len(mine) - len(left)) - value(total, len(mine))
                    if gain > best[0] + 1e-9:
                        best = (gain, (c, at))
        if best[1] is None:
            return {r: leaf for r in rows}, True
        c, at = best[1]
        goes = lambda r: np.isnan(x[r, c]) or x[r, c] <= at
        (a, one), (b, two) = grown(g, [r for r in rows if goes(r)], drawn, columns, depth - 1), grown(g, [r for r in rows if not goes(r)], drawn, columns, depth - 1)
        if one and two and best[0] < p.min_gain:
            return {r: leaf for r in rows}, True
        return {**a, **b}, False

    for k in range(p.trees):
        g, drawn = margin - y, boosting.drawn_rows(np.arange(len(y)), k, p)
        weights, _ = grown(g, range(len(y)), drawn, boosting.drawn_columns(x.shape[1], k, p), p.depth)
        margin = margin + p.step * np.array([weights[r] for r in range(len(y))])
    return margin


@pytest.fixture(scope="module")
def data():
    return table(300)


def predictions(spark, data, fitted, fit=0):
    rows = boosting.predict(frame(spark, *data).select("y", *reversed(NAMES), "row"), fitted.model(fit)).collect()
    return np.array([r["prediction"] for r in sorted(rows, key=lambda r: r["row"])])


def test_one_task_and_cluster_grow_what_plain_loops_grow(spark, data):
    want, df = by_hand(*data, P), frame(spark, *data).repartition(3)
    here = boosting.fit_boosted(df, NAMES, "y", "row", P)
    assert np.abs(predictions(spark, data, here) - want).max() < 1e-9
    there = boosting.fit_boosted(df, NAMES, "y", "row", P, one_task=0)
    assert np.abs(predictions(spark, data, there) - want).max() < 1e-9


def test_margins_are_written_between_trees(spark, data, monkeypatch):
    monkeypatch.setattr(boosting, "TREES_PER_TABLE", 2)
    p = BoostParameters(trees=5, depth=2, bins=8)
    there = boosting.fit_boosted(frame(spark, *data), NAMES, "y", "row", p, one_task=0)
    assert np.abs(predictions(spark, data, there) - by_hand(*data, p)).max() < 1e-9


def test_fits_next_to_each_other(spark, data):
    p, fits = BoostParameters(trees=4, depth=3, bins=8, l2=0.5), {0: "row < 100", 1: "row < 250"}
    x, y = data
    for one_task in (boosting.ONE_TASK, 150, 0):
        fitted = boosting.fit_boosted(frame(spark, *data), NAMES, "y", "row", p, fits, one_task)
        assert fitted.base[0] == pytest.approx(y[:100].mean()) and fitted.base[1] == pytest.approx(y[:250].mean())
        assert len(fitted.model(0).trees) == len(fitted.model(1).trees) == 4
        if one_task == boosting.ONE_TASK:
            kept = [predictions(spark, data, fitted, f) for f in fits]
        else:
            assert all(np.allclose(predictions(spark, data, fitted, f), kept[f], atol=1e-9) for f in fits)


def test_penalties_and_gain(spark, data):
    free = boosting.fit_boosted(frame(spark, *data), NAMES, "y", "row", BoostParameters(trees=1, depth=3, l2=0.0)).model()
    firm = boosting.fit_boosted(frame(spark, *data), NAMES, "y", "row", BoostParameters(trees=1, depth=3, l2=50.0, l1=5.0)).model()
    assert np.abs(firm.trees[0].weights).max() < np.abs(free.trees[0].weights).max()
    none = boosting.fit_boosted(frame(spark, *data), NAMES, "y", "row", BoostParameters(trees=1, depth=3, min_gain=1e9)).model()
    assert len([c for c in none.trees[0].column if c >= 0]) == 0


def test_a_saved_model_predicts_the_same(spark, data, tmp_path):
    model = boosting.fit_boosted(frame(spark, *data), NAMES, "y", "row", P).model()
    boosting.as_table(spark, model).write.parquet(str(tmp_path / "m"))
    again = boosting.from_table(spark.read.parquet(str(tmp_path / "m")))
    assert again.columns == NAMES and len(again.trees) == P.trees
    one, two = ([r["prediction"] for r in boosting.predict(frame(spark, *data), m).orderBy("row").collect()] for m in (model, again))
    assert one == two
    shares = model.importances()
    assert sum(shares.values()) == pytest.approx(1) and again.importances() == pytest.approx(shares)


def test_rows_without_label_and_constant_features(spark):
    df = spark.createDataFrame([(0, 1.0, 5.0, 2.0), (1, 1.0, None, 4.0), (2, 1.0, 7.0, None)], "row bigint, a double, b double, y double")
    model = boosting.fit_boosted(df, ["a", "b"], "y", "row", BoostParameters(trees=3)).model()
    assert model.base == 3.0
    assert boosting.predict(df, model).count() == 3
    assert boosting.predict(df.where(F.lit(False)), model).count() == 0


def test_sums_hold_a_few_numbers_a_row():
    draw = np.random.default_rng(2)
    codes, node, gradient = draw.integers(0, 16, (20_000, 60)).astype(np.uint8), draw.integers(0, 4, 20_000), draw.normal(size=20_000)
    tracemalloc.start()
    g, n = boosting.sums(codes, node, gradient, 4, 16)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < codes.nbytes * 4  # one number of 8 bytes for each row and column would be 8 times as much
    for k, column, cut in ((0, 0, 0), (3, 59, 15), (2, 17, 8)):
        here = (node == k) & (codes[:, column] == cut)
        assert n[k, column, cut] == here.sum() and g[k, column, cut] == pytest.approx(gradient[here].sum())
