"""Mixing sources to target weights by pivotal dependent rounding.

A source's target over its size is the number of copies of each of its documents: a whole part, which
all get, and a fraction.  Fractions are rounded in pairs: mass moves at random from one document to the
other until one of them is integral, so the sum never changes, and of a group at most one document is
left with a fraction.  Documents of one source and size class are dealt out to groups of about
``GROUP``; what is left of each group meets in the next level of the tree, smaller by that factor, until
one group holds all of a source.  Pairs are neighbours by size, which keeps the words near the target.

Words are ``[^\\x20\\x09-\\x0D]+``.  Sources take the weights 1, 2, 3, repeating, by code point, null last;
a target stops at three times its source's size and the excess is shared out by weight.

Draws are hashes of seed, level and row, so reruns agree, whatever the partitions.  Defined results: a
null text has size 0; a source of size 0 has target 0 and its rows are not taken; rows that repeat in
doc_id and size are rounded one by one; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from fractions import Fraction
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage, text_key

GROUP, SEED, LIMIT, WEIGHTS = 4096, 20260728, 3, (1, 2, 3)
COLUMNS = ("id", "doc_id", "source", "size", "copies", "p")
ROWS = "id string, doc_id bigint, source string, size bigint, copies bigint, p double"


def word_count(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    trimmed = F.btrim(F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\f\r", "     "), F.lit(" "))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, " +"))).cast("bigint")


def targets(sizes: dict[str | None, int], weights: tuple[int, ...] = WEIGHTS, limit: int = LIMIT) -> dict[str | None, float]:
    """Target words of each source; exact fractions inside, so the order of summing does not matter."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    rest, open_, out = Fraction(sum(sizes.values())), [s for s in names if sizes[s]], {s: Fraction(0) for s in names}
    while open_:
        unit = rest / sum(weight[s] for s in open_)
        full = [s for s in open_ if unit * weight[s] > limit * sizes[s]]
        for s in full or open_:
            out[s] = Fraction(limit * sizes[s]) if full else unit * weight[s]
            rest -= out[s]
        open_ = [s for s in open_ if s not in full] if full else []
    return {s: float(x) for s, x in out.items()}


def _draw(level: int, a: str, b: str) -> float:
    return int.from_bytes(hashlib.blake2b(f"{SEED}|{level}|{a}|{b}".encode(), digest_size=7).digest(), "big") / (1 << 56)


def pivot(level: int, ids: list[str], p: list[float]) -> list[float]:
    """Round the probabilities in order, two at a time; at most one stays a fraction, the sum is kept."""
    out = [*p]
    at = None
    for k, q in enumerate(p):
        if q <= 0 or q >= 1:
            continue
        if at is None:
            at = k
            continue
        a, b, u = out[at], q, _draw(level, ids[at], ids[k])
        total = a + b
        if abs(total - 1) < 1e-9:
            first = u < a / total
            out[at], out[k], at = float(first), float(not first), None
        elif total < 1:
            first = u < a / total
            winner, loser = (at, k) if first else (k, at)
            out[winner], out[loser], at = total, 0.0, winner
        else:
            winner, loser = (at, k) if u < (1 - b) / (2 - total) else (k, at)
            out[winner], out[loser], at = 1.0, total - 1, loser
    return out


def _round_groups(rows: DataFrame, level: int, group: Column) -> DataFrame:
    """One level of the tree; a row whose fraction is settled has p = 0."""

    def settle(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "id"], kind="stable")
        q = np.array(pivot(level, pdf["id"].tolist(), pdf["p"].tolist()))
        return pdf.assign(copies=pdf["copies"] + (q == 1.0), p=np.where(q == 1.0, 0.0, q))[list(COLUMNS)]

    return rows.groupBy("source", group.alias("group")).applyInPandas(settle, ROWS)


def _dealt(rows: DataFrame, by: list[Column]) -> tuple[DataFrame, Column]:
    """Rows with their group: as many groups for each source (and class) as its rows need."""
    kind = F.to_json(F.struct(*by))
    counts = rows.groupBy(kind.alias("kind")).agg(F.ceil(F.count(F.lit(1)) / GROUP).alias("groups"))
    rows = rows.withColumn("kind", kind).join(counts, "kind")
    return rows, F.concat_ws("|", "kind", F.pmod(F.xxhash64("id"), F.col("groups")))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, limit: int = LIMIT) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, source): doc_id, source, size, source_size, target, copies."""
    spark = docs.sparkSession
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    # rows alike in all three are numbered, so each has a draw of its own and none depends on the partitions
    alike = stage(sized.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("rows")), "mix-sizes")
    sizes = {r["source"]: int(r["words"]) for r in alike.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("words")).collect()}
    goal = targets(sizes, weights, limit)
    share = {s: Fraction(goal[s]) / sizes[s] if sizes[s] else Fraction(0) for s in sizes}
    plan = [(s, sizes[s], goal[s], min(int(share[s]), limit), float(share[s] - int(share[s])) if share[s] < limit else 0.0) for s in sizes]
    plan = spark.createDataFrame(plan, "source string, source_size bigint, target double, copies bigint, p double")
    named = lambda c: F.coalesce(F.concat(F.lit("="), c), F.lit("-"))  # noqa: E731  null is a source of its own
    plan = plan.select(named(F.col("source")).alias("name"), "source_size", "target", "copies", "p")

    rows = (alike.withColumn("i", F.explode(F.sequence(F.lit(1), F.col("rows")))).withColumn("name", named(F.col("source")))
            .join(plan.select("name", "copies", "p"), "name")
            .select(F.to_json(F.struct("doc_id", "size", "i")).alias("id"), *COLUMNS[1:]))
    rest, group = _dealt(rows, [F.col("source"), F.length(F.bin("size"))])
    settled, level = [], 0
    while True:
        done = stage(_round_groups(rest, level, group), "mix-level")
        settled.append(done.where("p = 0"))
        rest = done.where("p > 0")
        if not rest.groupBy("source").count().where("count > 1").limit(1).count():
            break
        level += 1
        rest, group = _dealt(rest, [F.col("source")])
    last = F.pmod(F.xxhash64(F.lit(SEED), "id"), F.lit(1 << 30)) / (1 << 30)
    settled.append(rest.withColumn("copies", F.col("copies") + (last < F.col("p")).cast("bigint")))
    out = reduce(DataFrame.unionByName, [s.select("doc_id", "source", "size", "copies") for s in settled])
    return (out.withColumn("name", named(F.col("source"))).join(plan.drop("copies", "p"), "name")
            .select("doc_id", "source", "size", "source_size", "target", "copies"))


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, limit: int = LIMIT) -> DataFrame:
    """``docs`` with each row as often as the mix takes it."""
    key = F.to_json(F.struct("doc_id", "source", "size"))
    counted = mix(docs, weights, limit).groupBy(key.alias("k")).agg(*[F.count(F.when(F.col("copies") >= n, 1)).alias(f"at_least_{n}") for n in range(1, limit + 1)])
    held = docs.select(F.to_json(F.struct("doc_id", "source", word_count(F.col("text")).alias("size"))).alias("k"), text_key(F.coalesce("text", F.lit(""))).alias("t"),
                       F.struct(*[F.col(c) for c in docs.columns]).alias("row"))
    met = held.join(counted, "k").withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("t")))
    times = sum((F.when(F.col("n") <= F.col(f"at_least_{n}"), 1).otherwise(0) for n in range(1, limit + 1)), F.lit(0))
    return met.select("row", F.explode(F.array_repeat(F.lit(0), times)).alias("again")).select("row.*")
