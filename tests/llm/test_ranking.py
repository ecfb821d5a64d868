"""The ranked search against plain scoring of every document."""

from __future__ import annotations

import math
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from helpers import FOLDER, documents, odd_docs

from ledgerlark.llm import ranking
from ledgerlark.llm.ranking import RANKING_SQL

TERM = re.compile("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def cut(text):
    return Counter(w.translate(LOWER) for w in TERM.findall(text or ""))


def brute_force(docs, items, k=50):
    """{(item, rank): (doc_id, score)} for rows (doc_id, text) and (item_id, text)."""
    held = [(d, c) for d, t in docs if (c := cut(t))]
    n_docs, words = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = {}
    for item, text in items:
        own, scored = {*cut(text)}, []
        for d, c in held:
            m = 100 - 50 + 50 * sum(c.values()) * n_docs // words
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m)) for t in own & c.keys())
            if score:
                scored.append((-score, d is None, d or 0, d))
        for rank, (score, *_, d) in enumerate(sorted(scored)[:k], 1):
            out[item, rank] = (d, -score)
    return out


def rows_of(df):
    rows = df.collect()
    out = {(r["item_id"], r["rank"]): (r["doc_id"], r["score"]) for r in rows}
    assert len(out) == len(rows)
    return out


def pairs_of(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


@pytest.fixture(scope="module")
def items(spark):
    return spark.read.parquet(f"{FOLDER}/benchmark.parquet")


def test_documents_agree_with_plain_scoring(spark, items):
    docs = documents(spark).where("doc_id < 500")
    want = brute_force(pairs_of(docs, "doc_id", "text"), pairs_of(items, "item_id", "text"))
    assert rows_of(ranking.ranked(docs, items)) == want


def test_small_chunks_and_blocks_change_nothing(spark, items):
    docs, few = documents(spark).where("doc_id < 300"), items.where("item_id < 30")
    want = brute_force(pairs_of(docs, "doc_id", "text"), pairs_of(few, "item_id", "text"), 7)
    assert rows_of(ranking.ranked(docs, few, k=7, queries=11, chunk=16, first=2)) == want
    assert rows_of(ranking.ranked(docs, few, k=7, held=300, chunk=50)) == want


def test_bounds_hold_and_pairs_skip_more_than_single_terms(spark, items):
    docs, few = documents(spark), items.where("item_id < 40")
    block = next(ranking.blocks(few))
    raw = ranking.postings(docs.coalesce(1), block.vocabulary, 128).cache()
    total = raw.groupBy().sum("documents", "words").first()
    df = {r[0]: r[1] for r in raw.selectExpr("explode(arrays_zip(terms, sizes)) as t").groupBy("t.terms").sum("t.sizes").collect()}
    scoring = ranking.Scoring(block, total[0], total[1], df)
    chunks = [ranking.Chunk(b, n) for b in ranking.pair_index(raw, scoring).toArrow().to_batches() for n in range(len(b))]
    assert len(chunks) > 4
    with_pairs = single = everything = 0
    for own, pairs in scoring.queries:
        whole = []
        for chunk in chunks:
            scores = np.zeros(len(chunk.ids), np.int64)
            bounds, alone = chunk.bounds(own, pairs), chunk.bounds(own, [-1] * len(own))
            for n, t in enumerate(own):
                if t in chunk.slot:
                    places, impacts = chunk.postings(t)
                    scores[places] += impacts
                assert scores.max() <= bounds[n] <= alone[n]
            whole.append(scores)
        least = int(np.sort(np.concatenate(whole))[-10])
        for chunk, scores in zip(chunks, whole):
            places, found, scored = chunk.search(own, pairs, least)
            assert places.tolist() == np.flatnonzero(scores >= least).tolist() and found.tolist() == scores[places].tolist()
            with_pairs += scored
            places, _, scored = chunk.search(own, [-1] * len(own), least)
            assert places.tolist() == np.flatnonzero(scores >= least).tolist()
            single += scored
            everything += int((scores > 0).sum())
    assert with_pairs < 0.95 * single < 0.95 * everything, (with_pairs, single, everything)


def test_ties_repeats_nulls_and_clashing_names(spark):
    docs = [(7, "alpha beta"), (3, "alpha beta"), (None, "alpha beta"), (3, "alpha beta"), (9, "Alpha, ALPHA! beta2"), (5, ""), (6, None), (8, "Ärger é"), (4, "gamma delta epsilon")]
    asked = [(1, "alpha Beta beta"), (2, "ärger Ärger"), (3, None), (4, "..."), (5, "nothing here"), (6, "beta2"), (7, "é gamma")]
    frame = spark.createDataFrame([(*d, 1, 2, "x") for d in docs], "doc_id bigint, text string, score int, rank int, query string")
    queries = spark.createDataFrame([(*a, 1, "y") for a in asked], "item_id bigint, text string, doc_id int, score string")
    want = brute_force(docs, asked)
    assert rows_of(ranking.ranked(frame, queries)) == want
    assert [want[1, n][0] for n in range(1, 5)] == [3, 3, 7, None]
    assert rows_of(ranking.ranked(frame, queries, k=2, chunk=1)) == {at: x for at, x in want.items() if at[1] <= 2}


def test_repeated_queries_are_ranked_each(spark):
    frame = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id bigint, text string")
    queries = spark.createDataFrame([(1, "a"), (1, "a"), (None, "c")], "item_id bigint, text string")
    rows = sorted((str(r["item_id"]), r["rank"], r["doc_id"]) for r in ranking.ranked(frame, queries).collect())
    assert rows == [("1", 1, 1), ("1", 1, 1), ("None", 1, 2)]


def test_odd_rows_and_empty_tables(spark, items):
    docs, asked = odd_docs(spark), spark.createDataFrame([(1, "one two w5x5 words"), (2, "a" * 200_000)], "item_id bigint, text string")
    want = brute_force(pairs_of(docs, "doc_id", "text"), pairs_of(asked, "item_id", "text"))
    assert rows_of(ranking.ranked(docs, asked)) == want and want
    assert ranking.ranked(docs.limit(0), asked).count() == 0
    assert ranking.ranked(docs, asked.limit(0)).count() == 0


def test_sql_agrees(spark, items):
    db = duckdb.connect()
    for name in ("documents", "benchmark"):
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    want = {(i, r): (d, s) for i, r, d, s in db.execute(f"SELECT item_id, rank, doc_id, score FROM ({RANKING_SQL})").fetchall()}
    assert rows_of(ranking.ranked(documents(spark), items)) == want
