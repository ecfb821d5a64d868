"""Nearest neighbours by an inverted multi-index.

The two halves of the vectors are quantised apart, each by k-means centroids fitted on a bounded sample;
the pair of nearest centroids is a vector's cell.  A query visits cells in the order of the summed squared
distances of their two centroids, taken from a heap, until they hold the share of all entries that
found ``RECALL`` of the true neighbours on the sample.  Entries of visited cells are reranked by exact
distances.  All vectors are indexed.

Equal vectors are one entry, which keeps as many of its least ids as an answer can need.  Cells and their
visits are cut into parts of bounded size, so no task holds a whole crowded cell.

Defined results: vectors that are null, zero, hold null or non-finite components, or differ in length from
most, take no part; ties go to the smaller id; rows that repeat an id with the same vector answer once; with fewer candidates than asked for, all
are returned; no queries or no vectors give no rows; other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

SAMPLE, CELL_ENTRIES, MOST_CENTROIDS, PART, RECALL, NEIGHBOURS = 20_000, 200, 1024, 2048, 0.97, 10


def usable(vec: Column) -> Column:
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(vec.isNotNull() & finite & F.exists(vec, lambda x: x != 0), F.lit(False))


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T), 0)


def k_means(points: np.ndarray, k: int, rounds: int = 12, seed: int = 5) -> np.ndarray:
    centres = points[np.random.default_rng(seed).choice(len(points), k, replace=False)].copy()
    for _ in range(rounds):
        near = _squares(points, centres).argmin(1)
        sums, counts = np.zeros_like(centres), np.bincount(near, minlength=k)
        np.add.at(sums, near, points)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return centres


class MultiIndex:
    """Centroids of both halves, the entries of each cell, and how many entries a query has to see."""

    def __init__(self, first: np.ndarray, second: np.ndarray):
        self.first, self.second = first, second
        self.counts = np.zeros(len(first) * len(second), np.int64)
        self.wanted = 0

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        cut = self.first.shape[1]
        return _squares(vectors[:, :cut], self.first).argmin(1) * len(self.second) + _squares(vectors[:, cut:], self.second).argmin(1)

    def order(self, vector: np.ndarray) -> Iterator[int]:
        """Cells from the nearest on: a heap of centroid pairs by summed distance, each pair once."""
        cut = self.first.shape[1]
        one, two = _squares(vector[None, :cut], self.first)[0], _squares(vector[None, cut:], self.second)[0]
        by_one, by_two = one.argsort(kind="stable"), two.argsort(kind="stable")
        one, two, width = one[by_one].tolist(), two[by_two].tolist(), len(self.second)
        by_one, by_two = by_one.tolist(), by_two.tolist()
        heap = [(one[0] + two[0], 0, 0)]
        while heap:
            _, i, j = heapq.heappop(heap)
            yield by_one[i] * width + by_two[j]
            # (i, j) is reached from its row only, and rows open as their first pair is taken
            if j + 1 < len(two):
                heapq.heappush(heap, (one[i] + two[j + 1], i, j + 1))
            if j == 0 and i + 1 < len(one):
                heapq.heappush(heap, (one[i + 1] + two[0], i + 1, 0))

    def visited(self, vector: np.ndarray) -> list[int]:
        counts, seen, out = self.counts, 0, []
        for cell in self.order(vector):
            if counts[cell]:
                out.append(cell)
                seen += counts[cell]
                if seen >= self.wanted:
                    break
        return out


def fit_index(sample: np.ndarray, entries: int, recall: float = RECALL, neighbours: int = NEIGHBOURS, tests: int = 300) -> tuple[MultiIndex, float]:
    """Centroids from a sample, and the share of entries in whose cells ``recall`` of the sample's true neighbours lie."""
    k = int(np.clip(round((entries / CELL_ENTRIES) ** 0.5), 1, min(MOST_CENTROIDS, len(sample))))
    cut = max(1, sample.shape[1] // 2)
    first, second = sample[:, :cut], sample[:, cut:]
    index = MultiIndex(k_means(first, k), k_means(second, k) if second.shape[1] else np.zeros((1, 0)))
    cells = index.cells(sample)
    counts = np.bincount(cells, minlength=len(index.counts))
    probes = sample[np.random.default_rng(6).choice(len(sample), min(tests, len(sample)), replace=False)]
    distance = _squares(probes, sample)
    near = distance.argsort(1)[:, 1:neighbours + 1]
    needed = []
    for probe, best in zip(probes, near):
        place = np.zeros(len(counts), np.int64)
        place[np.fromiter(index.order(probe), np.int64)] = np.arange(len(counts))
        upto = np.cumsum(counts[np.argsort(place)])
        needed += (upto[place[cells[best]]] / len(sample)).tolist()
    return index, float(np.quantile(needed, recall)) if needed else 1.0


def nearest(vectors: DataFrame, is_query: Column, neighbours: int = NEIGHBOURS) -> DataFrame:
    """query_id, rank, vec_id and score (distance) of the nearest of ``vectors`` (vec_id, embedding) to each row of it that ``is_query`` marks."""
    spark = vectors.sparkSession
    clean = vectors.where(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    common = clean.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), "size").limit(1).collect()
    answer = "query_id bigint, vec_id bigint, score double"
    if not common:
        return spark.createDataFrame([], answer).select("query_id", F.lit(1).alias("rank"), "vec_id", "score")
    dimension = common[0]["size"]
    clean = clean.where(F.size("v") == dimension)
    # equal vectors: the least ids, one more than asked for, as a query may be one of them
    few = (clean.distinct().withColumn("place", F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))).where(F.col("place") <= neighbours + 1)
           .groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")))
    entries = stage(few, "ann-entries")
    total = entries.count()
    sample = np.stack(entries.orderBy(F.xxhash64("ids"), "ids").limit(SAMPLE).select("v").toArrow()["v"].combine_chunks().flatten().to_numpy().reshape(-1, dimension))
    index, share = fit_index(sample, total, neighbours=neighbours)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block = batch.column("v").flatten().to_numpy().reshape(-1, dimension)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(index.cells(block))], [*batch.schema.names, "cell"])

    celled = stage(entries.mapInArrow(placed, "v array<double>, ids array<bigint>, cell bigint"), "ann-index")
    sizes = celled.groupBy("cell").count().toArrow()  # at most MOST_CENTROIDS squared rows
    index.counts[sizes["cell"].to_numpy()] = sizes["count"].to_numpy()
    index.wanted = max(share * total, neighbours + 1)
    parts = np.maximum(1, -(-index.counts // PART))

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, block = batch.column("vec_id").to_pylist(), batch.column("v").flatten().to_numpy().reshape(-1, dimension)
            for one, v in zip(ids, block):
                cells = [(c, p) for c in index.visited(v) for p in range(parts[c])]
                n = len(cells)
                yield pa.RecordBatch.from_arrays([pa.array([one] * n, pa.int64()), pa.array([v.tolist()] * n, pa.list_(pa.float64())), pa.array([int(c) for c, _ in cells], pa.int64()),
                                                  pa.array([p for _, p in cells], pa.int64())], ["query_id", "q", "cell", "part"])

    queries = clean.where(is_query).distinct()
    asked = stage(queries.select("vec_id", "v").mapInArrow(visits, "query_id bigint, q array<double>, cell bigint, part bigint"), "ann-visits")
    crowds = asked.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / PART).alias("crowds"))
    asked = asked.join(crowds, "cell").withColumn("crowd", F.pmod(F.xxhash64("query_id"), F.col("crowds"))).drop("crowds")
    cell_parts = F.get(F.array(*[F.lit(1)]), F.lit(0)) if parts.max() == 1 else F.element_at(F.create_map(*[F.lit(x) for c in np.flatnonzero(parts > 1).tolist() for x in (c, int(parts[c]))]), F.col("cell"))
    held = (celled.withColumn("part", F.pmod(F.xxhash64("ids"), F.coalesce(cell_parts, F.lit(1)).cast("bigint"))).join(crowds, "cell")
            .withColumn("crowd", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("crowds") - 1))).drop("crowds"))

    def rerank(known: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})
        if known.empty or asking.empty:
            return empty
        x, q = np.stack(known["v"].to_numpy()), np.stack(asking["q"].to_numpy())
        rough, ids, out = _squares(q, x), known["ids"].to_numpy(), []
        for k, one in enumerate(asking["query_id"].to_numpy()):
            row = rough[k]
            bound = np.partition(row, neighbours)[neighbours] if len(row) > neighbours else np.inf
            at = np.flatnonzero(row <= bound * (1 + 1e-9) + 1e-9)
            score = np.sqrt(((x[at] - q[k]) ** 2).sum(1))
            found = sorted((s, int(i)) for s, a in zip(score.tolist(), at) for i in ids[a] if i != one)[:neighbours]
            out += [(one, i, s) for s, i in found]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]) if out else empty

    key = ["cell", "part", "crowd"]
    found = held.groupBy(*key).cogroup(asked.groupBy(*key)).applyInPandas(rerank, answer)
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id")))
    return ranked.where(F.col("rank") <= neighbours).select("query_id", "rank", "vec_id", "score")
