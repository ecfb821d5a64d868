"""Quality classifier: a sparse ensemble of rules over statistics of the text.

Trees are grown over the statistics of labelled texts; every path from a root to a node is a rule, a
conjunction of comparisons; a logistic regression with a lasso penalty weighs the rules and leaves
most at zero.  What remains is compiled into one Spark column expression, which scores any frame
that holds the statistics.

The fit takes at most ``FIT_ROWS`` labelled rows, those with the least hash of their id.  Statistics are
taken of whole texts and of every row.

Defined results: null and empty texts score as texts of size 0; labels that are null, or that contradict
each other for one doc_id, teach nothing; without both classes to learn from, every score is the share
of label 1 (0.5 without labels); repeated rows score alike; other columns pass through unread.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import byte_rows, mixed, shingles, stage, word_hashes

FIT_ROWS, TREES, DEPTH, PENALTY = 20_000, 12, 4, 0.0005
STATISTICS = ("chars", "words", "word_length", "upper_share", "digit_share", "symbol_share", "stop_share", "blank_share", "other_share",
              "distinct_words", "distinct_runs", "top_word_share", "line_words", "lines")
Rule = tuple[tuple[int, bool, float], ...]


def _classes() -> np.ndarray:
    """For each byte: upper, lower, digit, symbol, stop, blank, first byte of another letter, later byte."""
    out = np.zeros((256, 8))
    for b in range(256):
        c = chr(b)
        kind = (7 if 128 <= b < 192 else 6 if b >= 192 else 0 if c.isupper() else 1 if c.islower() else 2 if c.isdigit() else
                5 if c in " \t\n\r\x0b\x0c" else 4 if c in ".,;:?'\"" else 3)
        out[b, kind] = 1
    return out


_KIND = _classes()


def statistics(data: np.ndarray) -> list[float]:
    """The statistics of one text, in the order of ``STATISTICS``; all are shares or plain sizes."""
    seen = np.bincount(data, minlength=256)
    upper, lower, digit, symbol, stop, blank, other, later = (seen @ _KIND).tolist()
    chars = len(data) - later
    hashes = word_hashes(data)
    words = len(hashes)
    if not words:
        return [chars, 0, 0, 0, 0, 0, 0, blank / max(chars, 1), 0, 1, 1, 0, 0, float(seen[10]) + 1]
    _, counts = np.unique(hashes, return_counts=True)
    runs = shingles(data)
    letters = max(upper + lower + other, 1)
    lines = float(seen[10]) + 1
    return [chars, words, (chars - blank) / words, upper / letters, digit / chars, symbol / chars, stop / chars, blank / chars, other / chars,
            len(counts) / words, len(np.unique(runs)) / len(runs), counts.max() / words, words / lines, lines]


def _names(columns: list[str]) -> list[str]:
    """Names for the statistics that no column has."""
    mark = "stat"
    while any(c.lower().startswith(mark) for c in columns):
        mark += "_"
    return [f"{mark}_{s}" for s in STATISTICS]


def with_statistics(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """``docs`` with its statistics of ``text`` as further columns, and their names."""
    names, at = _names(docs.columns), docs.columns.index("text")
    columns = [*docs.columns, *names]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([statistics(data) for data in byte_rows(batch.column(at))], float).reshape(-1, len(names))
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(values[:, k]) for k in range(len(names))]], columns)

    schema = T.StructType([*[T.StructField(f.name, f.dataType) for f in docs.schema.fields], *[T.StructField(n, T.DoubleType()) for n in names]])
    return docs.mapInArrow(measure, schema), names


def held_out(doc_id: Column) -> Column:
    """Rows that the fit never sees: crc32 of the id as text leaves 1 by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def tree_rules(model) -> list[Rule]:
    """Every path from a root to a node of a fitted forest as (statistic, at most?, threshold) conjunctions."""
    rules: dict[Rule, None] = {}

    def walk(node, path: Rule) -> None:
        if path:
            rules[path] = None
        if node.getClass().getSimpleName() == "InternalNode":
            feature, bound = node.split().featureIndex(), float(node.split().threshold())
            walk(node.leftChild(), (*path, (feature, True, bound)))
            walk(node.rightChild(), (*path, (feature, False, bound)))

    for tree in model.trees:
        walk(tree._call_java("rootNode"), ())
    return [*rules]


def rule_column(rule: Rule, names: list[str]) -> Column:
    """A rule as a condition on the statistics' columns."""
    return reduce(lambda a, b: a & b, [(F.col(names[k]) <= bound) if least else (F.col(names[k]) > bound) for k, least, bound in rule])


class RuleEnsemble:
    """Weighted rules with an intercept; ``score`` compiles them to a column."""

    def __init__(self, rules: list[tuple[Rule, float]], intercept: float):
        self.rules, self.intercept = rules, intercept

    def score(self, names: list[str]) -> Column:
        total = reduce(lambda a, b: a + b, [F.when(rule_column(r, names), F.lit(w)).otherwise(0.0) for r, w in self.rules], F.lit(self.intercept))
        return F.lit(1.0) / (F.exp(-total) + 1)


def fit(measured: DataFrame, names: list[str], labels: DataFrame, rows: int = FIT_ROWS) -> RuleEnsemble:
    """Learn from the rows of ``measured`` (doc_id and statistics) that ``labels`` (doc_id, quality) marks and that are not held out."""
    from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
    from pyspark.ml.functions import array_to_vector

    known = (labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.min("quality").alias("label"), F.max("quality").alias("most")).where("label = most"))
    sample = (measured.select("doc_id", *names).join(known.select("doc_id", F.col("label").cast("double").alias("label")), "doc_id")
              .orderBy(F.xxhash64("doc_id"), "doc_id", *names).limit(rows))
    sample = stage(sample.select("label", F.array(*names).alias("values")).repartition(4, "values"), "quality-sample")
    share = sample.groupBy("label").count().collect()
    of = {r["label"]: r["count"] for r in share}
    if len(of) < 2:
        part = (of.get(1.0, 0) + 1) / (sum(of.values()) + 2)
        return RuleEnsemble([], float(np.log(part / (1 - part))))
    rarer = min(of.values())
    forest = RandomForestClassifier(labelCol="label", featuresCol="x", weightCol="w", numTrees=TREES, maxDepth=DEPTH, seed=7, minInfoGain=1e-4)
    weighed = sample.withColumn("x", array_to_vector("values")).withColumn("w", F.when(F.col("label") == 1.0, rarer / of[1.0]).otherwise(rarer / of[0.0]))
    rules = tree_rules(forest.fit(weighed))
    if not rules:
        return RuleEnsemble([], float(np.log(of[1.0] / of[0.0])))
    columns = sample.select("label", *[F.get("values", F.lit(k)).alias(n) for k, n in enumerate(names)])
    fired = columns.select("label", array_to_vector(F.array(*[rule_column(r, names).cast("double") for r in rules])).alias("fired")).cache()
    lasso = LogisticRegression(labelCol="label", featuresCol="fired", elasticNetParam=1.0, regParam=PENALTY, maxIter=50, standardization=False).fit(fired)
    fired.unpersist()
    weights = lasso.coefficients.toArray()
    return RuleEnsemble([(r, float(w)) for r, w in zip(rules, weights) if w], float(lasso.intercept))


def scored(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs`` (doc_id, text)."""
    measured, names = with_statistics(docs.select("doc_id", "text"))
    measured = stage(measured.select("doc_id", *names), "quality-statistics")
    score = fit(measured, names, labels, rows).score(names)
    return (measured.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))


def good_documents(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with its own columns; the labels are learnt as in ``scored``."""
    # statistics meet the labels as numbers, so no text moves; the texts are read again for the decision
    measured, names = with_statistics(docs.select("doc_id", "text"))
    model = fit(measured, names, labels, rows)
    measured, names = with_statistics(docs)
    return measured.where(model.score(names) >= 0.5).select(*docs.columns)
