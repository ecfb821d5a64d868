import hashlib
import random

from helpers import documents, odd_docs, odd_rows
from pyspark.sql import functions as F

from ledgerlark.llm import fingerprints


def test_edited_texts_and_likeness_by_brute_force(spark):
    docs = documents(spark)
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    order = sorted(texts, reverse=True)
    rows = {r.doc_id: r for r in fingerprints.document_fingerprints(docs, F.col("doc_id") % 50 == 0).collect()}
    assert sorted(rows) == sorted(texts)
    value = {i: int(r.fingerprint, 16) for i, r in rows.items()}
    same = {}
    for i, after in zip(order, order[1:] + order[:1]):
        r, text, half = rows[i], texts[i], len(texts[i]) // 2
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256((text[:len(text) - half] + texts[after][:half]).encode()).hexdigest()
        assert r.near_next == 1 - (value[i] ^ value[after]).bit_count() / 64 and r.near_edited == 1 - (value[i] ^ int(r.edited_fingerprint, 16)).bit_count() / 64
        assert same.setdefault(text, r.fingerprint) == r.fingerprint
        if i % 50 == 0:
            assert r.n_near == sum((value[i] ^ v).bit_count() <= fingerprints.RADIUS for v in value.values()) - 1
        else:
            assert r.n_near is None
    mean = lambda xs: sum(xs) / len(xs)
    assert mean([r.near_edited for r in rows.values()]) > mean([r.near_next for r in rows.values()]) + 0.1


def test_block_tables_find_all_within_the_radius(spark):
    draw = random.Random(3)
    base = [draw.getrandbits(64) for _ in range(40)]
    near = [b ^ sum(1 << k for k in draw.sample(range(64), draw.randint(0, 5))) for b in base for _ in range(10)]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    frame = lambda xs: spark.createDataFrame([(signed(x),) for x in xs] + [(None,)], "fingerprint bigint")
    got = {(r.query, r.fingerprint, r.distance) for r in fingerprints.within_radius(frame(base), frame(near)).collect()}
    assert got == {(signed(a), signed(b), (a ^ b).bit_count()) for a in base for b in near if (a ^ b).bit_count() <= 3}


def test_odd_rows(spark):
    docs = odd_docs(spark)
    rows = fingerprints.document_fingerprints(docs, F.col("doc_id") % 50 == 0).collect()
    assert len(rows) == len(odd_rows()) and all(r.near_next is not None for r in rows)
    assert {r.fingerprint for r in rows if r.n_chars == 0} == {"0" * 16}
    assert fingerprints.document_fingerprints(docs.limit(0), F.lit(True)).count() == 0
    one = fingerprints.document_fingerprints(docs.where("doc_id = 5"), F.lit(True)).collect()
    assert one[0].near_next == 1.0 and one[0].n_near == 0
