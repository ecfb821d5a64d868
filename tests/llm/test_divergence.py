"""The divergence audit against plain counting."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from functools import reduce

import duckdb
from helpers import FOLDER, documents, odd_docs

from ledgerlark.llm import divergence
from ledgerlark.llm.divergence import AUDIT_SQL

TERM = re.compile("[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_force(rows, min_docs=3, top=200):
    """The audit of rows (text, lang, source) in plain Python integers."""
    rows = [tuple(x or "" for x in r) for r in rows]
    docs, counts, langs = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        words = [w.translate(LOWER) for w in TERM.findall(text)]
        docs[lang].update(set(words))
        counts[lang, source].update(words)
        langs[lang].add(source)
    out = set()
    for lang, sources in langs.items():
        kept = sorted((t for t, n in docs[lang].items() if n >= min_docs), key=str.encode)
        whole = reduce(lambda a, b: a + b, (counts[lang, s] for s in sources), Counter())
        prob = {}
        for name, c in [*((s, counts[lang, s]) for s in sources), (None, whole)]:
            n = sum(c[t] for t in kept)
            prob[name] = [1 + 1_000_000_000 * (c[t] + 1) // (n + len(kept)) for t in kept]
        for s in sources:
            pairs = [(o, sum((p - q) ** 2 // q for p, q in zip(prob[s], prob[o]))) for o in sources - {s}]
            pairs.sort(key=lambda x: (-x[1], x[0].encode()))
            out |= {(lang, s, "pair", o, v, n + 1) for n, (o, v) in enumerate(pairs)}
            best = [(t, (p - q) ** 2 // q) for t, p, q in zip(kept, prob[s], prob[None]) if counts[lang, s][t] and p > q]
            best.sort(key=lambda x: (-x[1], x[0].encode()))
            out |= {(lang, s, "term", t, v, n + 1) for n, (t, v) in enumerate(best[:top])}
    return out


def rows_of(df):
    out = [tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect()]
    assert len(out) == len(set(out))
    return set(out)


def test_documents_agree_with_plain_counting(spark):
    docs = documents(spark).where("doc_id < 400")
    want = brute_force([tuple(r) for r in docs.select("text", "lang", "source").collect()])
    assert rows_of(divergence.audit(docs)) == want


def test_small_slices_passes_blocks_and_buffers_change_nothing(spark):
    docs = documents(spark).where("doc_id < 60")
    want = brute_force([tuple(r) for r in docs.select("text", "lang", "source").collect()], top=5)
    kept = divergence.vocabulary(docs)
    machines = divergence.transducers(kept, 50)
    assert len(divergence._passes(machines, 20_000)) > 1
    assert rows_of(divergence.audit(docs, top=5, size=50, most=20_000, cells=64, held=100)) == want


def test_ordinals_follow_the_order_of_bytes(spark):
    kept = divergence.vocabulary(documents(spark))
    for lang in ("en", "de"):
        rows = [(r["ordinal"], r["term"]) for r in kept.where(f"lang = '{lang}'").collect()]
        assert [t for _, t in sorted(rows)] == sorted((t for _, t in rows), key=str.encode)
        assert sorted(n for n, _ in rows) == [*range(len(rows))]


def test_ties_silent_groups_and_clashing_names(spark):
    texts = [("Ärzte ab AB Ab zz", "de", "x"), ("ärzte ab zz", "de", "x"), ("ab zz Ärzte, ärzte", "de", "y"), ("12 34", "de", "w"), (None, "de", None), ("solo", "fr", "x"),
             ("", None, "x"), ("a b", None, "y"), ("ﬁn ﬁn É", "es", "only"), ("ﬁn é", "es", "only"), ("ﬁn", "es", "only")]
    docs = spark.createDataFrame([(*t, 1, "k", 2, 3) for t in texts], "text string, lang string, source string, ordinal int, term string, n int, value int")
    assert rows_of(divergence.audit(docs)) == brute_force(texts)


def test_odd_rows_and_empty_tables(spark):
    docs = odd_docs(spark)
    assert rows_of(divergence.audit(docs)) == brute_force([tuple(r) for r in docs.select("text", "lang", "source").collect()])
    assert divergence.audit(docs.limit(0)).count() == 0


def test_large_counts_stay_exact():
    import numpy as np
    counts = np.array([0, 5, 1 << 40])
    assert divergence._p(counts, np.array(7 << 40)).tolist() == [1 + 10**9 * (int(c) + 1) // (7 << 40) for c in counts]


def test_sql_agrees(spark):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    want = set(db.execute(f"SELECT lang, source, part, item, value, rank FROM ({AUDIT_SQL})").fetchall())
    assert rows_of(divergence.audit(documents(spark))) == want
