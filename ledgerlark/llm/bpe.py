"""BPE encoding by dynamic programming over prefixes, and decoding.

For every prefix of a word exactly one token can be the last of its encoding: a token that ends there
(an automaton over the vocabulary gives all of them) and that may follow the last token of what is left
of the prefix.  Two tokens may stand side by side if no merge across their border comes before the
merges that build them.  Back-pointers from the whole word give the ids.  Each step is linear in the word
and needs no merging of lists.

The tokenizer file holds byte-level symbols with ``</w>`` on the last one of a word; texts are brought to
NFC and lower case, and white space is dropped.  Special tokens in a text are ids of their own.  Words repeat, so
each task keeps the encodings of the words it has met, in a table of bounded size.  Tasks that follow each other in a
worker share its encoder, which is let go soon after the last of them.

Defined results: null and empty texts have no tokens; texts are encoded whole; equal texts have equal
rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import threading
import unicodedata
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

END, KEPT = "", 1 << 18
#: Seconds after which a worker lets go of an encoder that no task uses: workers go on to other stages, and a filled one takes hundreds of MB.
IDLE = 2.0
# --- fixed values: letters and digits of Unicode 16, and capitals of 16 and 17, which the tokenizer knows and Python's tables may not ---
LETTERS_16 = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D40, 0x10D65), (0x10D6F, 0x10D85),
    (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1),
    (0x113D3, 0x113D3), (0x116D0, 0x116E3), (0x11BC0, 0x11BE0), (0x11BF0, 0x11BF9), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16130, 0x16139),
    (0x16D40, 0x16D6C), (0x16D70, 0x16D79), (0x18CFF, 0x18CFF), (0x1CCF0, 0x1CCF9), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5FA)]
LOWER = {0xA7CB: 0x264, 0xA7DC: 0x19B, **{c: c + 1 for c in (0x1C89, 0xA7CC, 0xA7CE, 0xA7D2, 0xA7D4, 0xA7DA)},
         **{c: c + 32 for c in range(0x10D50, 0x10D66)}, **{c: c + 27 for c in range(0x16EA0, 0x16EB9)}}
# --- end of fixed values ---
COLUMNS = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"
_NEVER, _STRETCH = 1 << 60, 1 << 12


def _byte_symbols() -> list[str]:
    """The printable character that stands for each byte."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in plain else next(others)) for b in range(256)]


def _ranges(ordered: list[int]) -> list[list[int]]:
    """Runs of numbers that follow each other, as their first and last."""
    out: list[list[int]] = []
    for n in ordered:
        if out and n == out[-1][1] + 1:
            out[-1][1] = n
        else:
            out.append([n, n])
    return out


def _letters(kind) -> Iterator[str]:
    """All characters of a pattern's kind; looked for in stretches, as all of them at once would take 160 MB."""
    for start in range(0, 0x110000, _STRETCH):
        yield from kind.findall("".join([chr(c) for c in range(start, start + _STRETCH) if not 0xD800 <= c < 0xE000]))


class WordBpe:
    """Encoder of one tokenizer file; built once in each Python worker."""

    def __init__(self, path: str):
        import ahocorasick
        import regex

        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        model, suffix = data["model"], data["model"]["end_of_word_suffix"]
        inner = lambda s: s[:-len(suffix)] + END if s.endswith(suffix) else s
        self.token = {i: s for s, i in model["vocab"].items()}
        self.ids = {inner(s): i for s, i in model["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.token.update({i: s for s, i in self.special.items()})
        self.rank: dict[tuple[str, str], int] = {}
        self.built: dict[str, tuple[str, str, int]] = {}
        for rank, (a, b) in enumerate(m.split(" ") if isinstance(m, str) else m for m in model["merges"]):
            a, b = inner(a), inner(b)
            self.rank[a, b] = rank
            self.built.setdefault(a + b, (a, b, rank))
        self.automaton = ahocorasick.Automaton()
        for s in self.ids:
            if s in self.built or len(s.rstrip(END)) == 1:
                self.automaton.add_word(s, (s, len(s)))
        self.automaton.make_automaton()
        self.number = {i: str(i) for i in self.token}  # one string for each id, so that kept encodings share them
        self.bytes = _byte_symbols()
        self.split_ascii = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
        # the regex module may know newer letters than the tokenizer; those unassigned in Python's own tables count as marks
        new = [ord(c) for c in _letters(regex.compile(r"[\p{L}\p{N}]")) if unicodedata.category(c) == "Cn"]
        new = sorted({*new} - {c for a, b in LETTERS_16 for c in range(a, b + 1)})
        new = "".join([f"\\U{a:08x}" + (f"-\\U{b:08x}" if b > a else "") for a, b in _ranges(new)]) or r"\x00"
        self.split = regex.compile(rf"(?V1)'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}--[{new}]]+|[\p{{N}}--[{new}]]|[[^\s\p{{L}}\p{{N}}]{new}]+")
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.spines: dict[tuple[str, int], list[tuple[str, int]]] = {}
        self.fits: dict[tuple[str, str], bool] = {}
        self.words: dict[str, list[int]] = {}
        self.chunks: dict[str, tuple[int, str, str]] = {}
        self.older: dict[str, tuple[int, str, str]] = {}

    def spine(self, token: str, side: int) -> list[tuple[str, int]]:
        """Symbols at one edge of a token while it is built, each with the rank of the merge that uses it up."""
        found = self.spines.get((token, side))
        if found is None:
            found, used = [], _NEVER
            while True:
                found.append((token, used))
                if token not in self.built:
                    break
                left, right, used = self.built[token]
                token = (left, right)[side]
            found.reverse()
            self.spines[found[-1][0], side] = found
        return found

    def may_follow(self, a: str, b: str) -> bool:
        """Whether a and b, merged on their own, stay two tokens when they stand side by side."""
        known = self.fits.get((a, b))
        if known is None:
            left, right, i, j = self.spine(a, 1), self.spine(b, 0), 0, 0
            while True:
                (x, x_used), (y, y_used) = left[i], right[j]
                across = self.rank.get((x, y), _NEVER)
                # of equal ranks the leftmost pair is merged first
                if across < x_used and across <= y_used and across < _NEVER:
                    known = False
                    break
                if x_used == y_used == _NEVER:
                    known = True
                    break
                if x_used <= y_used:
                    i += 1
                else:
                    j += 1
            if len(self.fits) >= KEPT:
                self.fits.clear()
            self.fits[a, b] = known
        return known

    def word(self, word: str) -> list[int]:
        """Ids of one piece of text, as the pre-tokenizer cuts it."""
        known = self.words.get(word)
        if known is not None:
            return known
        # blanks are in no word, and all else that is printable in ASCII stands for itself
        symbols = (word if word.isascii() and word.isprintable() else "".join([self.bytes[b] for b in word.encode()])) + END
        last: list[str | None] = [None] * (len(symbols) + 1)
        fits = self.fits
        for end, (token, length) in self.automaton.iter(symbols):
            if last[end + 1] is None:
                left = last[end + 1 - length]
                if left is not None:
                    known = fits.get((left, token))
                    if known or known is None and self.may_follow(left, token):
                        last[end + 1] = token
                elif end + 1 == length:
                    last[length] = token
        at, out = len(symbols), []
        while at:
            token = last[at]
            out.append(self.ids[token])
            at -= len(token)
        out.reverse()
        if len(self.words) >= KEPT:
            self.words.clear()
        self.words[word] = out
        return out

    def chunk(self, chunk: str) -> tuple[int, str, str]:
        """Tokens of a stretch without blanks: how many, their ids and their strings, each joined by one space."""
        known = self.older.pop(chunk, None)
        if known is None:
            # lower case goes letter by letter, so a final sigma is as any other
            text = chunk.lower() if chunk.isascii() else unicodedata.normalize("NFC", chunk).replace("Σ", "σ").lower().translate(LOWER)
            if text.isascii():
                ids = self.word(text) if text.isalpha() else [i for word in self.split_ascii.findall(text) for i in self.word(word)]
            else:
                ids = [i for word in self.split.findall(text) for i in self.word(word)]
            known = len(ids), " ".join([self.number[i] for i in ids]), " ".join([self.token[i] for i in ids])
        if len(self.chunks) >= KEPT // 2:  # the latest half of ``KEPT`` stays at hand while the next ones gather
            self.older, self.chunks = self.chunks, {}
        self.chunks[chunk] = known
        return known

    def pieces(self, text: str) -> list[tuple[int, str, str]]:
        """Encodings of a text's stretches in order; stretches without tokens are left out."""
        out = []
        for n, part in enumerate(self.specials.split(text) if self.specials and "<|" in text else [text]):
            if n % 2:
                out.append((1, str(self.special[part]), part))
            else:
                known, get = self.chunk, self.chunks.get
                out += [p for c in part.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") if c and (p := get(c) or known(c))[0]]
        return out

    def encode(self, text: str) -> list[int]:
        return [int(i) for p in self.pieces(text) for i in p[1].split(" ")]

    def decode(self, ids: list[int]) -> str:
        """The tokens joined by one space, special ones too: the file names no decoder."""
        return " ".join([self.token[i] for i in ids if i in self.token])


@lru_cache(maxsize=2)
def encoder(path: str) -> WordBpe:
    return WordBpe(path)


_leaving: threading.Timer | None = None


@contextmanager
def lent_encoder(path: str) -> Iterator[WordBpe]:
    """The encoder for one task; tasks that follow within ``IDLE`` seconds find it as it is, after that it is let go."""
    global _leaving
    if _leaving:
        _leaving.cancel()
    try:
        yield encoder(path)
    finally:
        _leaving = threading.Timer(IDLE, encoder.cache_clear)
        _leaving.daemon = True
        _leaving.start()


def encode_texts(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, number of tokens, and digests of the ids and of the decoded text of every row of ``docs``.

    ``path`` is the tokenizer file, which must be at the same place on every machine.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with lent_encoder(path) as bpe:
            for batch in batches:
                n, ids, decoded = [], [], []
                for text in batch.column(1):
                    pieces = bpe.pieces(text.as_py() or "")
                    n.append(sum([p[0] for p in pieces]))
                    ids.append(hashlib.sha256(" ".join([p[1] for p in pieces]).encode()).hexdigest())
                    decoded.append(hashlib.sha256(" ".join([p[2] for p in pieces]).encode()).hexdigest())
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
                                                 ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(encode, f"doc_id bigint, {COLUMNS}")


def token_ids(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and the token ids themselves of every row."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with lent_encoder(path) as bpe:
            for batch in batches:
                ids = pa.array([bpe.encode(t.as_py() or "") for t in batch.column(1)], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0), ids], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(encode, "doc_id bigint, ids array<int>")


def decoded_texts(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and the decoded text of rows (doc_id, ids)."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with lent_encoder(path) as bpe:
            for batch in batches:
                texts = pa.array([bpe.decode(i.as_py() or []) for i in batch.column(1)], pa.string())
                yield pa.RecordBatch.from_arrays([batch.column(0), texts], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(decode, "doc_id bigint, text string")
