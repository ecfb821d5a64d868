"""Gradient-boosted regression trees with penalties on leaf weights, grown from histograms.

Features are cut into bins at quantiles.  A tree grows level by level: for each node, feature and bin the gradients and the rows
are summed up, the best cut of every node is taken, and its rows go left or right.  With G and H the sums of a node, its weight is
-T(G) / (H + l2) and its score T(G)^2 / (H + l2), where T brings G nearer to zero by l1; a cut gains what the scores of its two sides exceed the node's
by, and cuts that gain less than ``min_gain`` and have no cut below them are taken back.  The loss is the squared error, so H counts rows.

Where the sums are made depends on the rows of a fit: up to ``ONE_TASK`` of them go to one task, which grows all trees (several fits, such as folds, run next to each
other).  Beyond that every level is one aggregation on the cluster: tasks sum up their rows, sums meet by fit and node, and only the best cut of
each node comes to the driver.  Both ways share the code for sums and cuts.

Draws of rows and columns are hashes of seed, tree and row, so a fit does not depend on partitions.  Null and NaN features lie
below all values; rows without a label are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.incremental import written

#: Rows of a fit that one task may hold (a byte per feature and row), and trees between two written margins.
ONE_TASK, TREES_PER_TABLE = 1 << 19, 16
#: Least gain of a cut while a tree grows.
_ANY_GAIN = 1e-6
NODE = "tree int, node int, feature string, threshold double, left int, right int, weight double, gain double"
TREES = "fit int, tree int, node int, feature int, cut int, left int, right int, weight double, gain double"


@dataclass(frozen=True)
class BoostParameters:
    trees: int = 100
    step: float = 0.3
    depth: int = 6
    row_share: float = 1.0
    column_share: float = 1.0
    min_gain: float = 0.0
    l1: float = 0.0
    l2: float = 1.0
    bins: int = 64
    seed: int = 0


def spread(x: np.ndarray) -> np.ndarray:
    """Bits of 64-bit numbers mixed (a bijection)."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def drawn_rows(rows: np.ndarray, tree: int, p: BoostParameters) -> np.ndarray:
    """Which rows (by number) a tree is grown from."""
    if p.row_share >= 1:
        return np.ones(len(rows), bool)
    salt = np.uint64((p.seed * 1_000_003 + tree) % (1 << 63))
    return (spread(rows.astype(np.uint64) + spread(np.array([salt]))) >> np.uint64(11)) < np.uint64(int(p.row_share * (1 << 53)))


def drawn_columns(n: int, tree: int, p: BoostParameters) -> np.ndarray:
    """Which columns a tree may cut, ascending."""
    return np.sort(np.random.default_rng((p.seed, tree)).permutation(n)[:max(1, int(p.column_share * n))])


def _soft(g: np.ndarray, l1: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0)


def weight(g, n, p: BoostParameters):
    return -_soft(g, p.l1) / (n + p.l2)


def score(g, n, p: BoostParameters):
    return _soft(g, p.l1) ** 2 / (n + p.l2)


def sums(codes: np.ndarray, node: np.ndarray, gradient: np.ndarray, nodes: int, bins: int) -> tuple[np.ndarray, np.ndarray]:
    """Gradients and rows by node, column and bin; ``codes`` holds the bin of each row and column.

    Columns go one by one, so that what is held beside the sums is a few numbers a row, not a few for each row and column.
    """
    shape, size = (nodes, codes.shape[1], bins), nodes * bins
    g, n, start = np.empty(shape), np.empty(shape, np.int64), node * bins
    for k, column in enumerate(np.ascontiguousarray(codes.T)):
        at = start + column
        g[:, k] = np.bincount(at, gradient, size).reshape(nodes, bins)
        n[:, k] = np.bincount(at, minlength=size).reshape(nodes, bins)
    return g, n


def best_cuts(g: np.ndarray, n: np.ndarray, p: BoostParameters) -> list[tuple[int, int, float, float, int] | None]:
    """Of each node the column, the last bin to the left, the gain, and the gradient and rows to the left; the first of equals; None without a gain.

    Only bins with rows are tried: to cut after an empty one is to cut after the last one before it that has some.
    """
    nodes, width, bins = g.shape
    all_g, all_n = g[:, 0].sum(1), n[:, 0].sum(1)
    cells = np.flatnonzero(n)
    left_n = n.cumsum(2).ravel()[cells]
    node = cells // (width * bins)
    inner = left_n < all_n[node]
    cells, node, left_n = cells[inner], node[inner], left_n[inner]
    left_g = g.cumsum(2).ravel()[cells]
    gain = score(left_g, left_n, p) + score(all_g[node] - left_g, all_n[node] - left_n, p) - score(all_g, all_n, p)[node]
    starts = np.searchsorted(node, np.arange(nodes + 1)).tolist()
    out: list = [None] * nodes
    for k in range(nodes):
        if starts[k] < starts[k + 1]:
            at = starts[k] + int(gain[starts[k]:starts[k + 1]].argmax())
            if gain[at] > _ANY_GAIN:
                column, cut = divmod(int(cells[at]) - k * width * bins, bins)
                out[k] = column, cut, float(gain[at]), float(left_g[at]), int(left_n[at])
    return out


class Tree:
    """Nodes as lists: column (-1 for a leaf), last bin to the left, children, gain, and sums of gradients and rows."""

    def __init__(self, g: float, n: int):
        self.column, self.cut, self.left, self.right, self.gain, self.g, self.n = [-1], [-1], [-1], [-1], [0.0], [g], [n]
        self.weights = np.zeros(1)

    def split(self, node: int, column: int, cut: int, gain: float, g: float, n: int) -> None:
        self.column[node], self.cut[node], self.gain[node] = column, cut, gain
        self.left[node], self.right[node] = len(self.g), len(self.g) + 1
        for gs, ns in ((g, n), (self.g[node] - g, self.n[node] - n)):
            for values, value in ((self.column, -1), (self.cut, -1), (self.left, -1), (self.right, -1), (self.gain, 0.0), (self.g, gs), (self.n, ns)):
                values.append(value)

    def prune(self, p: BoostParameters) -> None:
        """Take back cuts of little gain from the leaves up, then weigh the nodes."""
        for node in range(len(self.g) - 1, -1, -1):
            a, b = self.left[node], self.right[node]
            if a >= 0 and self.column[a] < 0 and self.column[b] < 0 and self.gain[node] < p.min_gain:
                self.column[node], self.left[node], self.right[node], self.gain[node] = -1, -1, -1, 0.0
        self.weights = p.step * weight(np.array(self.g), np.array(self.n), p)

    def closed(self) -> Tree:
        """The same with arrays, for a tree that is done."""
        for name, kind in (("column", np.int32), ("cut", np.int32), ("left", np.int32), ("right", np.int32), ("gain", np.float64)):
            setattr(self, name, np.array(getattr(self, name), kind))
        self.g = self.n = None
        return self

    def nodes_of(self, codes: np.ndarray) -> np.ndarray:
        """The node that each row ends in."""
        column, cut, left, right = (np.asarray(x) for x in (self.column, self.cut, self.left, self.right))
        node, inner = np.zeros(len(codes), np.int64), np.arange(len(codes)) if self.column[0] >= 0 else np.zeros(0, np.int64)
        while len(inner):
            at = node[inner]
            node[inner] = np.where(codes[inner, column[at]] <= cut[at], left[at], right[at])
            inner = inner[column[node[inner]] >= 0]
        return node


def grow(codes: np.ndarray, gradient: np.ndarray, columns: np.ndarray, p: BoostParameters) -> Tree:
    """One tree over rows that are at hand."""
    tree = Tree(float(gradient.sum()), len(gradient))
    some, frontier, rows, place = codes[:, columns], [0], np.arange(len(gradient)), np.zeros(len(gradient), np.int64)
    for _ in range(p.depth):
        if not len(rows):
            break
        g, n = sums(some[rows], place, gradient[rows], len(frontier), p.bins)
        side, following = np.full((len(frontier), 2), -1), []
        column, cut = np.zeros(len(frontier), np.int64), np.zeros(len(frontier), np.int64)
        for k, found in enumerate(best_cuts(g, n, p)):
            if found:
                column[k], cut[k] = found[:2]
                tree.split(frontier[k], int(columns[found[0]]), *found[1:])
                for right, child in enumerate((tree.left[frontier[k]], tree.right[frontier[k]])):
                    if tree.n[child] > 1:  # a single row cannot be cut
                        side[k, right] = len(following)
                        following.append(child)
        place = side[place, (some[rows, column[place]] > cut[place]).astype(np.int64)]
        rows, place, frontier = rows[place >= 0], place[place >= 0], following
    tree.prune(p)
    return tree


@dataclass
class BoostedModel:
    """Trees of one fit over named features, and the value they start from."""

    columns: list[str]
    cuts: list[np.ndarray]
    base: float = 0.0
    trees: list[Tree] = field(default_factory=list)

    def codes(self, features: list[np.ndarray]) -> np.ndarray:
        """Bins of rows; null and NaN lie in the first one."""
        out = np.zeros((len(features[0]) if features else 0, len(features)), np.uint8)
        for k, (x, cuts) in enumerate(zip(features, self.cuts)):
            out[:, k] = np.where(np.isnan(x), 0, np.searchsorted(cuts, x, "left"))
        return out

    def predicted(self, codes: np.ndarray) -> np.ndarray:
        out = np.full(len(codes), self.base)
        for tree in self.trees:
            out += tree.weights[tree.nodes_of(codes)]
        return out

    def importances(self) -> dict[str, float]:
        """Mean gain of the cuts of each feature, as shares of their sum."""
        column, gain = (np.concatenate([np.asarray(getattr(t, n)) for t in self.trees] or [np.zeros(0)]) for n in ("column", "gain"))
        column, gain = column[column >= 0].astype(int), gain[column >= 0]
        times = np.bincount(column, minlength=len(self.columns))
        means = np.bincount(column, gain, len(self.columns)) / np.maximum(times, 1)
        return dict(zip(self.columns, (means / max(means.sum(), 1e-300)).tolist()))


@dataclass
class Fitted:
    """What ``fit_boosted`` leaves: the trees of all fits as a written table (feature and cut as numbers), of which ``model`` loads one."""

    columns: list[str]
    cuts: list[np.ndarray]
    base: dict[int, float]
    table: DataFrame

    def model(self, fit: int = 0) -> BoostedModel:
        rows = self.table.where(F.col("fit") == fit).drop("fit").toPandas()
        return BoostedModel(self.columns, self.cuts, self.base[fit], _unpacked(rows))


def _feature_arrays(batch: pa.RecordBatch, columns: list[str]) -> list[np.ndarray]:
    return [batch.column(c).cast(pa.float64()).to_numpy(zero_copy_only=False) for c in columns]


def quantile_cuts(df: DataFrame, columns: list[str], bins: int) -> list[np.ndarray]:
    """At most ``bins`` - 1 ascending cuts of each feature: a value lies in the bin of the first cut that is not below it."""
    points = [i / bins for i in range(1, bins)]
    rows = df.agg(*[F.percentile_approx(F.nanvl(F.col(c).cast("double"), F.lit(None)), points, 10_000).alias(f"c{n}") for n, c in enumerate(columns)]).first()
    return [np.unique(np.array(rows[f"c{n}"] or [], float)) for n in range(len(columns))]


def fit_boosted(df: DataFrame, columns: list[str], label: str, row: str, p: BoostParameters, fits: dict[int, str] | None = None, one_task: int = ONE_TASK) -> Fitted:
    """Trees for each of ``fits``, a condition on rows by number (one fit over all rows by default); ``row`` is a number that no other row has.

    The bins are cut on all rows that some fit uses.
    """
    spark, fits = df.sparkSession, fits or {0: "true"}
    used = df.where(F.col(label).isNotNull()).select(F.col(row).cast("bigint").alias("row"), F.col(label).cast("double").alias("label"), *columns,
                                                     F.array(*[F.when(F.expr(c), F.lit(k)) for k, c in fits.items()]).alias("fits"))
    used = used.withColumn("fits", F.array_compact("fits")).where(F.size("fits") > 0)
    model = BoostedModel(columns, quantile_cuts(used, columns, p.bins))

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = model.codes(_feature_arrays(batch, columns))
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("label"), batch.column("fits"), pa.array([c.tobytes() for c in codes], pa.binary())], ["row", "label", "fits", "codes"])

    rows = written(used.mapInArrow(binned, "row bigint, label double, fits array<int>, codes binary"), "boost-bins")
    sizes = rows.select(F.explode("fits").alias("fit"), "label").groupBy("fit").agg(F.count(F.lit(1)).alias("n"), F.avg("label").alias("base")).collect()
    base = {r["fit"]: r["base"] for r in sizes}
    small, large = ([r["fit"] for r in sizes if (r["n"] <= one_task) == here] for here in (True, False))
    parts = [_in_one_task(rows, small, base, len(columns), p)] if small else []
    parts += [_on_the_cluster(rows, large, base, len(columns), p)] if large else []
    table = parts[0].unionByName(parts[1]) if len(parts) > 1 else parts[0] if parts else spark.createDataFrame([], TREES)
    return Fitted(columns, model.cuts, base, written(table, "boost-trees"))


def _codes_of(column, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint8).reshape(-1, width)


def _in_one_task(rows: DataFrame, fits: list[int], base: dict[int, float], width: int, p: BoostParameters) -> DataFrame:
    """All trees of fits of at most ``one_task`` rows, each fit in a task of its own."""

    def fitted(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("row")
        fit, number, label = int(part["fit"].iloc[0]), part["row"].to_numpy(), part["label"].to_numpy()
        codes, margin, out = _codes_of(part["codes"], width), np.full(len(part), base[fit]), []
        for k in range(p.trees):
            drawn = drawn_rows(number, k, p)
            tree = grow(codes[drawn], (margin - label)[drawn], drawn_columns(width, k, p), p)
            margin += tree.weights[tree.nodes_of(codes)]
            out.append(_packed(fit, k, tree))
        return pd.concat(out)

    each = rows.select(F.explode("fits").alias("fit"), "row", "label", "codes").where(F.col("fit").isin(fits))
    return each.repartition(len(fits), "fit").groupBy("fit").applyInPandas(fitted, TREES)


def _packed(fit: int, k: int, tree: Tree) -> pd.DataFrame:
    return pd.DataFrame({"fit": fit, "tree": k, "node": range(len(tree.weights)), "feature": tree.column, "cut": tree.cut, "left": tree.left, "right": tree.right, "weight": tree.weights, "gain": tree.gain})


def _unpacked(rows: pd.DataFrame) -> list[Tree]:
    """Trees in their order from rows of ``TREES``."""
    rows = rows.sort_values(["tree", "node"])
    starts = np.flatnonzero(np.diff(rows["tree"].to_numpy(), prepend=-1))
    out = []
    for lo, hi in zip(starts, [*starts[1:], len(rows)]):
        some, tree = rows.iloc[lo:hi], Tree(0.0, 0)
        tree.column, tree.cut, tree.left, tree.right, tree.gain = (some[c].to_numpy() for c in ("feature", "cut", "left", "right", "gain"))
        tree.weights = some["weight"].to_numpy()
        out.append(tree.closed())
    return out


def _cutter(width: int, p: BoostParameters):
    """The best cut of a node from the sums of all tasks."""

    def cut(part: pd.DataFrame) -> pd.DataFrame:
        g, n = np.zeros(width * p.bins), np.zeros(width * p.bins, np.int64)
        for cells, gs, ns in zip(part["cells"], part["g"], part["n"]):
            cells = np.frombuffer(cells, np.int32)
            g[cells] += np.frombuffer(gs)
            n[cells] += np.frombuffer(ns, np.int64)
        g, n = g.reshape(1, width, p.bins), n.reshape(1, width, p.bins)
        found = best_cuts(g, n, p)[0] or (-1, -1, 0.0, 0.0, 0)
        return pd.DataFrame([(int(part["fit"].iloc[0]), int(part["node"].iloc[0]), float(g[0, 0].sum()), int(n[0, 0].sum()), *found)])

    return cut


def _on_the_cluster(rows: DataFrame, fits: list[int], base: dict[int, float], width: int, p: BoostParameters) -> DataFrame:
    """All trees of large fits: one aggregation for each level, for all fits at once; margins are written every few trees."""
    spark, trees = rows.sparkSession, {f: [] for f in fits}
    margins, at = rows.withColumn("margins", F.array(*[F.lit(float(base[f])) for f in fits])), 0

    def margin(batch: pa.RecordBatch, codes: np.ndarray, recent: list[list[Tree]]) -> np.ndarray:
        out = batch.column("margins").flatten().to_numpy().reshape(-1, len(fits)).copy()
        for k, some in enumerate(recent):
            for tree in some:
                out[:, k] += tree.weights[tree.nodes_of(codes)]
        return out

    for number in range(p.trees):
        columns = drawn_columns(width, number, p)
        if number - at >= TREES_PER_TABLE:
            recent, at = [trees[f][at:] for f in fits], number
            shared = spark.sparkContext.broadcast(recent)

            def moved(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    new = margin(batch, _codes_of(batch.column("codes").to_pylist(), width), shared.value)
                    yield batch.set_column(batch.schema.get_field_index("margins"), "margins", pa.array(list(new), pa.list_(pa.float64())))

            margins = written(margins.mapInArrow(moved, margins.schema), "boost-margins")
        growing = {f: Tree(0.0, 0) for f in fits}
        frontier = {f: [0] for f in fits}
        for level in range(p.depth):
            if not any(frontier.values()):
                break
            shared = spark.sparkContext.broadcast(([trees[f][at:] for f in fits], growing, frontier))

            def summed(batches: Iterator[pa.RecordBatch], shared=shared, columns=columns, number=number) -> Iterator[pa.RecordBatch]:
                recent, growing, frontier = shared.value
                held: dict[int, list[np.ndarray]] = {}
                for batch in batches:
                    codes, number_of = _codes_of(batch.column("codes").to_pylist(), width), batch.column("row").to_numpy()
                    now, drawn = margin(batch, codes, recent), drawn_rows(number_of, number, p)
                    label, inside = batch.column("label").to_numpy(), batch.column("fits").to_pylist()
                    for k, fit in enumerate(fits):
                        places = np.full(len(growing[fit].g), -1)
                        places[frontier[fit]] = np.arange(len(frontier[fit]))
                        place = places[growing[fit].nodes_of(codes)]
                        use = np.flatnonzero(drawn & (place >= 0) & np.fromiter((fit in i for i in inside), bool, len(inside)))
                        if len(use):
                            g, n = sums(codes[use][:, columns], place[use], (now[:, k] - label)[use], len(frontier[fit]), p.bins)
                            if fit in held:
                                held[fit][0] += g
                                held[fit][1] += n
                            else:
                                held[fit] = [g, n]
                for fit, (g, n) in held.items():
                    for k, node in enumerate(frontier[fit]):
                        cells = np.flatnonzero(n[k])
                        if len(cells):
                            yield pa.RecordBatch.from_arrays([pa.array([fit], pa.int32()), pa.array([node], pa.int32()), *[pa.array([x.tobytes()], pa.binary()) for x in
                                                              (cells.astype(np.int32), g[k].ravel()[cells], n[k].ravel()[cells].astype(np.int64))]], ["fit", "node", "cells", "g", "n"])

            sent = margins.mapInArrow(summed, "fit int, node int, cells binary, g binary, n binary")
            cuts = sent.groupBy("fit", "node").applyInPandas(_cutter(len(columns), p), "fit int, node int, all_g double, all_n bigint, feature int, cut int, gain double, g double, n bigint").collect()
            following = {f: [] for f in fits}
            for c in sorted(cuts, key=lambda c: (c["fit"], c["node"])):  # at most 2^depth rows per fit
                tree = growing[c["fit"]]
                if level == 0:
                    tree.g[0], tree.n[0] = c["all_g"], c["all_n"]
                if c["feature"] >= 0:
                    tree.split(c["node"], int(columns[c["feature"]]), c["cut"], c["gain"], c["g"], c["n"])
                    following[c["fit"]] += [child for child in (tree.left[c["node"]], tree.right[c["node"]]) if tree.n[child] > 1]
            frontier = following
        for f in fits:
            growing[f].prune(p)
            trees[f].append(growing[f].closed())
    return spark.createDataFrame(pd.concat([_packed(f, k, t) for f in fits for k, t in enumerate(trees[f])]), TREES)


def predict(df: DataFrame, model: BoostedModel, name: str = "prediction") -> DataFrame:
    """``df`` with the model's prediction; its columns are taken by name, whatever their order in ``df``."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = shared.value
            yield batch.append_column(name, pa.array(m.predicted(m.codes(_feature_arrays(batch, m.columns)))))

    return df.mapInArrow(scored, df.select("*", F.lit(0.0).alias(name)).schema)


def as_table(spark: SparkSession, model: BoostedModel) -> DataFrame:
    """The model as rows: its features in order (tree -1, by node), the value it starts from, and one row per node with its threshold."""
    heads = pd.DataFrame([(-1, k, c, np.nan, -1, -1, model.base, 0.0) for k, c in enumerate(model.columns)], columns=[c.split()[0] for c in NODE.split(", ")])
    nodes = []
    for k, t in enumerate(model.trees):
        inner = np.asarray(t.column) >= 0
        nodes.append(pd.DataFrame({"tree": k, "node": range(len(t.weights)), "feature": [model.columns[c] if c >= 0 else None for c in t.column],
                                   "threshold": [model.cuts[c][i] if ok else np.nan for c, i, ok in zip(t.column, t.cut, inner)],
                                   "left": t.left, "right": t.right, "weight": t.weights, "gain": t.gain}))
    return spark.createDataFrame(pd.concat([heads, *nodes]), NODE)


def from_table(table: DataFrame) -> BoostedModel:
    """The model of ``as_table``."""
    rows = table.toPandas()
    heads = rows[rows["tree"] < 0].sort_values("node")
    columns, nodes = heads["feature"].tolist(), rows[rows["tree"] >= 0].copy()
    inner = nodes["feature"].notna()
    cuts = [np.unique(nodes.loc[inner & (nodes["feature"] == c), "threshold"].to_numpy()) for c in columns]
    place = {c: k for k, c in enumerate(columns)}
    nodes["cut"] = [int(np.searchsorted(cuts[place[f]], t)) if ok else -1 for f, t, ok in zip(nodes["feature"], nodes["threshold"], inner)]
    nodes["feature"] = [place[f] if ok else -1 for f, ok in zip(nodes["feature"], inner)]
    return BoostedModel(columns, cuts, float(heads["weight"].iloc[0]), _unpacked(nodes))
