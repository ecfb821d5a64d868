import hashlib
import re

from helpers import documents, odd_docs, odd_rows
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlark.llm import pii

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    """The base patterns as they are written, with Python's own search."""
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            odd = sum(int(d) for d in digits[-1::-2]) + sum(sum(divmod(int(d) * 2, 10)) for d in digits[-2::-2])
            if {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True, "card": 13 <= len(digits) <= 19 and odd % 10 == 0, "phone": 9 <= len(digits) <= 15}[kind]:
                out.append((kind, m.start(), m.end()))
    return out


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.one_of(st.text("a.@+-0159 ()%é_", max_size=12), st.sampled_from(["4111 1111 1111 1111", "10.0.255.1", "+1 (124) 555-4766", "a@b.c", "@", "..", "1.2.3.4.5.6.7.8", "4111-1111-1111-1111"])), max_size=6).map("".join))
def test_base_spans_are_those_of_the_patterns(text):
    assert pii.base_spans(text) == plain_spans(text)


def test_long_runs_take_no_quadratic_time():
    for text in ("a" * 400_000, "1" * 400_000, "@" * 200_000, "a@" * 100_000, "1." * 200_000, "+1" * 200_000, "1 " * 200_000, "a.b@" * 50_000):
        base = pii.base_spans(text)
        pii.candidates(text, base)


def test_documents(spark):
    docs = documents(spark)
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    rows = pii.personal_data(docs).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = plain_spans(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for k, _, _ in base) for kind in pii.KINDS]
        named = [f"{k}:{s}:{e}" for k, s, e in base]
        assert r.base_sha256 == hashlib.sha256(",".join(named).encode()).hexdigest()
        spans = r.spans.split(",") if r.spans else []
        assert set(named) <= set(spans) and len(spans) == len(named) + r.n_added
        assert spans == sorted(spans, key=lambda x: (pii.KINDS.index(x.split(":")[0]), *map(int, x.split(":")[1:])))


def test_contexts_find_what_the_patterns_miss(spark):
    good, bad = "4111111111111111", "4111111111111112"
    rows = [(i, f"Please charge number{' card'} {good} of client w{i} today", None) for i in range(20)]
    rows += [(100, f"Please charge number card {bad} of client x today", None), (101, f"the serial {bad} belongs to engine y", None), (102, "token 00112233445566778899 is not one", None)]
    out = {r.doc_id: r for r in pii.personal_data(spark.createDataFrame(rows, "doc_id bigint, text string, x string")).collect()}
    start = rows[20][1].index(bad)
    assert out[100].spans == f"card:{start}:{start + 16}" and out[100].n_card == 0 and out[100].n_added == 1
    assert out[101].spans == "" and out[102].spans == ""


def test_contexts_bring_new_shapes(spark):
    rows = [(i, f"Please dial +1 (212) 555-{1000 + i} now, w{i}") for i in range(40)] + [(100 + i, f"write mail ann{i}@host.org soon, w{i}") for i in range(40)]
    rows += [(200, "Please dial 555-123-4567 now, x"), (201, "write mail user@localhost soon, x"), (202, "the part 555-123-4567 fits, x")]
    out = {r.doc_id: r for r in pii.personal_data(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert out[200].spans == "phone:12:24" and out[201].spans == "email:11:25" and out[202].spans == ""


def test_odd_rows(spark):
    docs = odd_docs(spark)
    rows = pii.personal_data(docs).collect()
    assert len(rows) == len(odd_rows()) and all(r.spans == "" for r in rows)
    assert pii.personal_data(docs.limit(0)).count() == 0
