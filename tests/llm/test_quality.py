import math
import zlib

from helpers import FOLDER, documents, odd_docs, odd_rows
from pyspark.sql import functions as F

from ledgerlark.llm import quality


def test_held_out_accuracy_and_compiled_rules(spark):
    docs, labels = documents(spark), spark.read.parquet(f"{FOLDER}/labels.parquet")
    rows = {r.doc_id: r for r in quality.scored(docs, labels).collect()}
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in rows.items())
    marks = {r.doc_id: r.quality for r in labels.collect()}
    tested = [(marks[i], r.predicted) for i, r in rows.items() if r.held_out and i in marks]
    assert len(tested) > 80 and sum(a == b for a, b in tested) / len(tested) > 0.95
    kept = quality.good_documents(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted for r in rows.values())


def test_rules_compile_to_what_they_say(spark):
    model = quality.RuleEnsemble([(((0, True, 2.0), (1, False, 5.0)), 1.5), (((1, True, 5.0),), -2.0)], 0.25)
    frame = spark.createDataFrame([(1.0, 6.0), (3.0, 6.0), (1.0, 5.0)], "a double, b double")
    got = [r.s for r in frame.select(model.score(["a", "b"]).alias("s")).collect()]
    assert all(abs(g - 1 / (1 + math.exp(-x))) < 1e-12 for g, x in zip(got, (1.75, 0.25, -1.75)))


def test_odd_rows_and_missing_labels(spark):
    docs = odd_docs(spark)
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 0), (2, None, 0)], "doc_id bigint, quality int, toxic int")
    rows = quality.scored(docs, labels).collect()
    assert len(rows) == len(odd_rows()) and all(r.score == 0.5 and r.predicted == 1 for r in rows)
    assert quality.good_documents(docs, labels).columns == docs.columns
    assert quality.scored(docs.limit(0), labels.where(F.lit(False))).count() == 0
