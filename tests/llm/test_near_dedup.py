import numpy as np
from helpers import documents, odd_docs, odd_rows, texts_of

from ledgerlark.llm import minhash
from ledgerlark.llm.common import components, shingles, word_hashes


def bytes_of(text):
    return np.frombuffer(text.encode(), np.uint8)


def classes_by_brute_force(texts, sampler):
    """Components of all pairs of different texts that reach the similarity."""
    distinct = sorted(set(texts.values()))
    weights = [sampler.weights(bytes_of(t)) for t in distinct]
    parent = list(range(len(distinct)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders = {}
    for i, (ids, _) in enumerate(weights):
        for s in ids.tolist():
            holders.setdefault(s, []).append(i)
    pairs = {(a, b) for h in holders.values() for k, b in enumerate(h) for a in h[:k]}
    links = [p for p in pairs if sampler.similarity(weights[p[0]], weights[p[1]]) >= minhash.SIMILARITY]
    for a, b in links:
        parent[root(a)] = root(b)
    return {t: root(i) for i, t in enumerate(distinct)}, links


def test_words_and_shingles_follow_the_text():
    a, b = bytes_of("one two  three\nfour five six"), bytes_of("\tone two three four five six ")
    assert word_hashes(a).tolist() == word_hashes(b).tolist() and len(word_hashes(a)) == 6
    assert len(shingles(a)) == 2 and len(shingles(bytes_of("one two"))) == 1 and not len(shingles(bytes_of("  ")))
    long = "ab cde " * 200_000
    assert len(word_hashes(bytes_of(long))) == 400_000 and len(set(word_hashes(bytes_of(long)).tolist())) == 2
    assert len(word_hashes(bytes_of("x" * 3_000_000 + " y"))) == 2


def test_hashes_agree_as_often_as_the_weighted_similarity_says():
    sampler = minhash.Sampler(np.full(1 << minhash.FEATURE_BITS, 3), 1000, hashes=4000)
    words = [f"word{i}" for i in range(400)]
    a, b = bytes_of(" ".join(words)), bytes_of(" ".join(words[:340] + [f"new{i}" for i in range(30)]))
    same = (sampler.signature(a) == sampler.signature(b)).mean()
    assert abs(same - sampler.similarity(sampler.weights(a), sampler.weights(b))) < 0.03


def test_classes_match_brute_force(spark):
    family = " ".join(f"f{i}" for i in range(300))
    extra = [(10_000 + k, family.replace(f"f{k * 3} ", f"edit{k} "), "en", "s", 1) for k in range(60)]
    docs = documents(spark).unionByName(spark.createDataFrame(extra, "doc_id bigint, text string, lang string, source string, n_chars bigint"))
    texts = texts_of(docs)
    expected, links = classes_by_brute_force(texts, minhash.fit_sampler(docs))
    assert len(links) > 1000
    rows = minhash.near_duplicates(docs).collect()
    assert len(rows) == len(texts)
    least = {}
    for doc_id, text in texts.items():
        least[expected[text]] = min(doc_id, least.get(expected[text], doc_id))
    wrong = [r.doc_id for r in rows if r.class_id != least[expected[texts[r.doc_id]]]]
    assert len(wrong) <= 0.002 * len(rows)
    kept = minhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.class_id for r in rows}


def crowd_of(count, own, planted, shared=3, words=200):
    """Texts on one template of which each ends in ``own`` words of its own; the last ``planted`` pairs share some of these."""
    template = " ".join(f"t{i}" for i in range(words))
    rows = [(i, template + " " + " ".join(f"o{i}x{k}" for k in range(own))) for i in range(count)]
    for p in range(planted):
        twin = " ".join(f"p{p}x{k}" for k in range(shared))
        rows += [(count + 2 * p + side, f"{template} {twin} " + " ".join(f"q{p}y{side}x{k}" for k in range(own - shared))) for side in (0, 1)]
    return rows


def test_planted_pairs_in_a_crowd_just_below_the_similarity(spark):
    rows = crowd_of(3000, 15, 40)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(8)
    sampler = minhash.fit_sampler(docs)
    weights = [sampler.weights(bytes_of(text)) for _, text in rows]
    assert 0.76 < sampler.similarity(weights[0], weights[1]) < 0.8 < sampler.similarity(weights[3000], weights[3001]) < 0.84
    shares = [set(sampler.bands(bytes_of(rows[3000 + 2 * p][1]))) & set(sampler.bands(bytes_of(rows[3001 + 2 * p][1]))) for p in range(40)]
    assert all(shares)
    of = {r.doc_id: r.class_id for r in minhash.near_duplicates(docs).collect()}
    assert of == {i: i if i < 3000 else i - (i - 3000) % 2 for i, _ in rows}


def test_families_that_drift_stay_together(spark):
    rows = []
    for f in range(60):
        base = [f"f{f}w{i}" for i in range(200)]
        rows += [(len(rows) + k, " ".join(base[:-1] + [f"f{f}e{k}"])) for k in range(10)]
        once = base[:-15] + [f"f{f}m{i}" for i in range(15)]
        rows += [(len(rows), " ".join(once)), (len(rows) + 1, " ".join([f"f{f}n{i}" for i in range(15)] + once[15:]))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    sampler = minhash.fit_sampler(docs)
    weights, bands = [sampler.weights(bytes_of(t)) for _, t in rows], [set(sampler.bands(bytes_of(t))) for _, t in rows]
    assert all(sampler.similarity(weights[i], weights[j]) >= minhash.SIMILARITY for i, j in ((0, 10), (10, 11))) and sampler.similarity(weights[0], weights[11]) < minhash.SIMILARITY
    together = {f for f in range(60) if bands[12 * f + 10] & bands[12 * f + 11] and bands[12 * f + 10] & bands[12 * f]}
    assert len(together) > 50
    of = {r.doc_id: r.class_id for r in minhash.near_duplicates(docs).collect()}
    assert [f for f in together if of[12 * f + 11] != 12 * f or of[12 * f + 10] != 12 * f] == []


def test_odd_rows(spark):
    docs = odd_docs(spark)
    rows = [(r.doc_id, r.class_id, r.class_rows, r.class_texts) for r in minhash.near_duplicates(docs).collect()]
    assert len(rows) == len(odd_rows())
    assert sorted(r[1:] for r in rows if r[0] in (1, 2)) == [(1, 3, 1)] * 2
    assert sorted(r for r in rows if r[0] == 6) == [(6, 5, 3, 1), (6, 5, 3, 1), (6, 6, 1, 1)]
    kept = minhash.one_of_each(docs)
    assert kept.columns == docs.columns and kept.count() == 6
    assert minhash.near_duplicates(docs.limit(0)).count() == 0 and minhash.one_of_each(docs.limit(0)).count() == 0


def test_components_of_a_long_chain(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (200, 200)]
    out = {r.node: r.root for r in components(spark.createDataFrame(chain, "u bigint, v bigint")).collect()}
    assert out == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}
