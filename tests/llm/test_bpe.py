import hashlib
import time
import tracemalloc

import pyarrow as pa
from helpers import documents, odd_docs, odd_rows
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerlark.llm import bpe
from ledgerlark.llm.queries import tokenizer_path

PATH = tokenizer_path()
LIBRARY = Tokenizer.from_file(PATH)
PIECES = st.one_of(st.text(max_size=6), st.sampled_from(["'s", "'LL", "<|endoftext|>", "<|startoftext|>", " ", "\n", "the ", "aaaa", "ing", "ΑΣ", "é", "é", "　", "12", "\x1c"]))


@settings(max_examples=600, deadline=None)
@given(st.lists(PIECES, max_size=12).map("".join))
def test_any_text_encodes_and_decodes_as_the_library_does(text):
    text = text.encode("utf-8", "ignore").decode()
    expected = LIBRARY.encode(text, add_special_tokens=False).ids
    ours = bpe.encoder(PATH).encode(text)
    assert ours == expected and bpe.encoder(PATH).decode(ours) == LIBRARY.decode(expected, skip_special_tokens=False)


def test_letters_newer_than_the_tables_of_python():
    for c in (0x13460, 0x1C89, 0xA7CB, 0xA7CE, 0xA7DC, 0x10D50, 0x11BF0, 0x16EA0, 0x16D40, 0x1DF90, 0x323B0):
        for text in (f":{chr(c)}", f"a{chr(c)}1", chr(c)):
            assert bpe.encoder(PATH).encode(text) == LIBRARY.encode(text, add_special_tokens=False).ids, hex(c)


def expected_row(text):
    ids = LIBRARY.encode(text, add_special_tokens=False).ids
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(ids), sha(" ".join(map(str, ids))), sha(LIBRARY.decode(ids, skip_special_tokens=False))


def test_documents_and_odd_rows(spark):
    for docs, n in ((documents(spark), 1000), (odd_docs(spark), len(odd_rows()))):
        texts = sorted(expected_row(r.text or "") + (r.doc_id or -1,) for r in docs.select("doc_id", "text").collect())
        rows = bpe.encode_texts(docs, PATH).collect()
        assert len(rows) == n and sorted((r.n_tokens, r.ids_sha256, r.decoded_sha256, r.doc_id or -1) for r in rows) == texts
    assert bpe.encode_texts(docs.limit(0), PATH).count() == 0


def test_ids_and_texts_make_the_round_trip(spark):
    docs = documents(spark, "doc_id < 30")
    out = bpe.decoded_texts(bpe.token_ids(docs, PATH), PATH).collect()
    assert all(r.text.split() == bpe.encoder(PATH).decode(bpe.encoder(PATH).encode(t.text or "")).split() for r, t in zip(sorted(out), sorted(docs.select("doc_id", "text").collect())))


def test_full_caches_change_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "KEPT", 3)
    small = bpe.WordBpe(PATH)
    text = "one two three one two four five one the The thing things thing's"
    assert small.encode(text) == small.encode(text) == LIBRARY.encode(text, add_special_tokens=False).ids


def test_tables_of_stretches_stay_within_their_bound(monkeypatch):
    monkeypatch.setattr(bpe, "KEPT", 8)
    small = bpe.WordBpe(PATH)
    for n in range(40):
        small.encode(f"word{n} other.{n}")
        assert len(small.chunks) + len(small.older) <= 8


def test_building_an_encoder_takes_little_more_than_it_keeps():
    tracemalloc.start()
    try:
        kept = bpe.WordBpe(PATH)
        held, peak = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert kept.rank and peak < held + (50 << 20)


class Batches:
    """Stands for a frame: hands out the function that a task runs."""

    def select(self, *columns):
        return self

    def mapInArrow(self, run, schema):
        return run


def test_an_encoder_that_no_task_uses_is_let_go(monkeypatch):
    monkeypatch.setattr(bpe, "IDLE", 0.5, raising=False)
    bpe.encoder.cache_clear()
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["one two", None])], ["doc_id", "text"])
    task = bpe.encode_texts(Batches(), PATH)

    def slow(batches):  # a task that takes longer than ``IDLE``
        for b in batches:
            time.sleep(1)
            assert bpe.encoder.cache_info().currsize == 1
            yield b

    first = [b.to_pylist() for b in task(slow([batch]))]
    kept = bpe.encoder.cache_info().misses
    assert [b.to_pylist() for b in task(slow([batch]))] == first and bpe.encoder.cache_info().misses == kept
    time.sleep(1.5)
    assert bpe.encoder.cache_info().currsize == 0
    assert [b.to_pylist() for b in task([batch])] == first
