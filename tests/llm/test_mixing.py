import re

import pytest
from helpers import documents, odd_docs, odd_rows

from ledgerlark.llm import mixing


def test_targets_stop_at_the_limit_and_share_the_excess():
    goal = mixing.targets({"a": 10, "b": 1000, "c": 10, None: 80})
    assert goal["a"] <= 30 and goal["c"] == 30 and sum(goal.values()) == pytest.approx(1100)
    assert goal["a"] == 30 and goal[None] == 240 and goal["b"] == 800
    assert mixing.targets({}) == {} and mixing.targets({"z": 0}) == {"z": 0.0}


def test_rounding_keeps_the_sum_and_the_chances():
    p = [0.3, 0.6, 0.25, 0.85, 0.5, 0.7]
    hits, runs = [0] * len(p), 3000
    for run in range(runs):
        out = mixing.pivot(run, [f"{run}-{k}" for k in range(len(p))], p)
        assert sum(out) == pytest.approx(sum(p)) and sum(0 < q < 1 for q in out) <= 1
        for k, q in enumerate(out):
            hits[k] += q
    assert [h / runs for h in hits] == pytest.approx(p, abs=0.03)


def test_taken_words_come_near_the_targets_and_reruns_agree(spark):
    docs = documents(spark)
    rows = mixing.mix(docs).collect()
    text = {r.doc_id: r.text or "" for r in docs.collect()}
    assert sorted(r.doc_id for r in rows) == sorted(text)
    assert all(r.size == len(re.findall(r"[^\x20\x09-\x0D]+", text[r.doc_id])) and 0 <= r.copies <= 3 for r in rows)
    taken, goal, most = {}, {}, {}
    for r in rows:
        taken[r.source] = taken.get(r.source, 0) + r.size * r.copies
        goal[r.source] = r.target
        most[r.source] = max(most.get(r.source, 0), r.size)
    assert all(abs(taken[s] - goal[s]) <= max(most[s], 0.05 * goal[s]) for s in goal)
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted((r.doc_id, r.copies) for r in rows) == sorted((r.doc_id, r.copies) for r in again)


def test_odd_rows(spark):
    docs = odd_docs(spark)
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(odd_rows())
    by = {(r.doc_id, r.source): r for r in rows}
    assert by[None, None].size == 0 and by[2, "a"].target == 0 and by[2, "a"].copies == 0
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns and out.count() == sum(r.copies for r in rows)
    assert mixing.mix(docs.limit(0)).count() == 0 and mixing.mixed_documents(docs.limit(0)).count() == 0
