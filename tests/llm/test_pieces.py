"""SentencePiece encoding against the library, and its way back."""

from __future__ import annotations

import hashlib

import sentencepiece
from helpers import documents, odd_docs, texts_of
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlark.llm import pieces
from ledgerlark.llm.queries import tokenizer_path

PATH = tokenizer_path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
OURS = pieces.PieceBpe(PATH)


def digests(text):
    ids = LIBRARY.encode(text)
    return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest()


CASES = ["", " ", "  ", "a", " a", "a ", "  a  b ", "a\nb", "\ta", "▁a ▁▁b", "▁", "x▁", "　x", "a\u0000b", "<s> hi</s> <unk> <0x41>",
         "é é \U0001f44d\U0001f3fd", "a" * 300, " " * 40 + "b" + " " * 17, "1234 5678", "   1", "▁" * 5 + "1", "�  \U000f0000", "in" * 200 + " " + "ü" * 90]


def test_known_cases_agree_with_the_library():
    for text in CASES:
        ids = OURS.encode(text)
        assert ids == LIBRARY.encode(text), text
        assert OURS.decode(ids) == LIBRARY.decode(ids), text


@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from("ab▁ thein1.\né中\U0001f44d\u0000́"), max_size=90))
def test_any_text_agrees_with_the_library(text):
    ids = OURS.encode(text)
    assert ids == LIBRARY.encode(text)
    assert OURS.decode(ids) == LIBRARY.decode(ids)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(3, 31999), max_size=20))
def test_any_ids_decode_as_in_the_library(ids):
    assert OURS.decode(ids) == LIBRARY.decode(ids)


def test_stretches_and_a_small_table_change_nothing():
    small = pieces.PieceBpe(PATH, table_chars=40, stretch=7)
    for text in CASES + [" ".join(f"word{i % 13}  x{i}" for i in range(300))]:
        assert small.encode(text) == LIBRARY.encode(text), text
    assert small.held <= 40 + pieces.WORD_CHARS + 1


def test_scan_and_heap_segment_alike():
    for text in ("▁therein" * 2, "▁▁▁▁the", "▁" + "ing" * 15, "▁" + "aab" * 14):
        assert OURS.segment(text) == OURS._segment_long(text)


def test_documents_agree_with_the_library(spark):
    docs = documents(spark)
    texts = texts_of(docs)
    rows = pieces.encode_texts(docs, PATH).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == digests(texts[r["doc_id"]])


def test_ids_come_back_as_texts(spark):
    docs = documents(spark).limit(200)
    back = {r["doc_id"]: r["text"] for r in pieces.decoded_texts(pieces.token_ids(docs, PATH), PATH).collect()}
    assert back == texts_of(docs)


def test_odd_rows(spark):
    docs = odd_docs(spark)
    want = sorted((str(r["doc_id"]), *digests(r["text"] or "")) for r in docs.collect())
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in pieces.encode_texts(docs, PATH).collect()) == want
    assert pieces.encode_texts(docs.limit(0), PATH).count() == 0
