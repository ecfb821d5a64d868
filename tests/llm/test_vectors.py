import numpy as np
from helpers import FOLDER
from pyspark.sql import functions as F

from ledgerlark.llm import vectors


def exact(ids, x, query, n=10):
    out = []
    for i, v in zip(ids, x):
        if query(i):
            d = np.sqrt(((x - v) ** 2).sum(1))
            out += [(i, r + 1, j, s) for r, (s, j) in enumerate(sorted((s, j) for s, j in zip(d.tolist(), ids) if j != i)[:n])]
    return out


def test_cells_come_in_order_of_their_distance():
    draw = np.random.default_rng(4)
    index = vectors.MultiIndex(draw.normal(size=(6, 3)), draw.normal(size=(5, 3)))
    v = draw.normal(size=6)
    distance = lambda c: ((v[:3] - index.first[c // 5]) ** 2).sum() + ((v[3:] - index.second[c % 5]) ** 2).sum()
    order = list(index.order(v))
    assert sorted(order) == list(range(30)) and [distance(c) for c in order] == sorted(distance(c) for c in order)


def test_recall_against_brute_force(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = sorted(table.collect())
    ids, x = [r.vec_id for r in rows], np.array([r.embedding for r in rows], float)
    want = exact(ids, x, lambda i: i % 100 == 0)
    got = [tuple(r) for r in vectors.nearest(table, F.col("vec_id") % 100 == 0).collect()]
    assert len(got) == len(want) and len({(q, r) for q, r, _, _ in got}) == len(got)
    score = {(q, j): s for q, _, j, s in exact(ids, x, lambda i: i % 100 == 0, len(ids))}
    assert all(abs(score[q, j] - s) < 1e-12 for q, _, j, s in got)
    assert len({(q, j) for q, _, j, _ in got} & {(q, j) for q, _, j, _ in want}) / len(want) >= 0.9


def test_few_tied_and_unusable_vectors(spark):
    nan, inf = float("nan"), float("inf")
    good = [(0, [1.0, 0.0]), (100, [1.0, 0.0]), (3, [0.0, 1.0]), (2, [0.0, 1.0]), (7, [1.0, 1.0]), (7, [1.0, 1.0])]
    bad = [(1, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (200, [inf, 1.0]), (6, [None, 1.0]), (8, [1.0]), (None, [1.0, 2.0]), (300, [])]
    frame = spark.createDataFrame([(i, v, 1) for i, v in good + bad], "vec_id bigint, embedding array<float>, ids int")
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in vectors.nearest(frame, F.col("vec_id") % 100 == 0).collect()}
    two = 2 ** 0.5
    assert got == {(0, 1): (100, 0.0), (0, 2): (7, 1.0), (0, 3): (2, two), (0, 4): (3, two), (100, 1): (0, 0.0), (100, 2): (7, 1.0), (100, 3): (2, two), (100, 4): (3, two)}
    assert vectors.nearest(frame.limit(0), F.lit(True)).count() == 0 and vectors.nearest(frame, F.lit(False)).count() == 0


def test_a_crowd_of_equal_vectors(spark):
    frame = spark.range(3000).select(F.col("id").alias("vec_id"), F.when(F.col("id") < 2500, F.array(F.lit(1.0), F.lit(2.0))).otherwise(F.array(F.col("id") * 1.0, F.lit(1.0))).cast("array<float>").alias("embedding"))
    rows = vectors.nearest(frame, F.col("vec_id").isin(0, 2000)).orderBy("query_id", "rank").collect()
    assert [r.vec_id for r in rows] == [*range(1, 11), *range(10)] and all(r.score == 0 for r in rows)
