"""SentencePiece (BPE) encoding and decoding with a table of distinct marked words.

The model replaces each blank by a marker and puts one marker before the text.  No piece holds a marker after
another character, so no merge crosses the border before a run of markers: a *marked word*, a run of markers with what
follows up to the next one, is segmented alike wherever it stands.  A task segments each distinct marked word once, keeps
the outcome in its table and puts the ids of a text together by the positions of its words.  The table is bounded by
the characters it holds: the words met last stay while the next ones gather.  Nothing moves between tasks, so there is
no shuffle, nothing is broadcast and a lost task is simply run again.

Inside a word the adjacent pair that makes the best-scored piece is merged first, the leftmost of equals; a character
without a piece becomes its UTF-8 bytes.  Texts are worked through by stretches that end before a marked word, so memory does not
grow with what a long text encodes to.

Defined results: null and empty texts have no ids and decode to an empty text; equal texts have equal rows; texts are
encoded whole; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

MARK = "▁"
COLUMNS = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"
#: Characters of the words in a task's table (twice that while the older half is let go), of a word worth keeping, and of a stretch.
TABLE_CHARS, WORD_CHARS, STRETCH = 1 << 22, 256, 1 << 20
_NEVER = 1 << 60
_SHORT = 48
_NORMAL, _BYTE, _BPE = 1, 6, 2

Entry = tuple[int, str, str]


class PieceBpe:
    """Encoder and decoder of one model file; built once in each Python worker."""

    def __init__(self, path: str, table_chars: int = TABLE_CHARS, stretch: int = STRETCH):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        rules = model.normalizer_spec
        if model.trainer_spec.model_type != _BPE or not model.trainer_spec.byte_fallback or not rules.add_dummy_prefix or not rules.escape_whitespaces \
                or rules.remove_extra_whitespaces or rules.precompiled_charsmap or {p.type for p in model.pieces} - {_NORMAL, 2, 3, _BYTE}:
            raise ValueError(f"{path}: not a BPE model with byte fallback, one leading marker and no other normalisation")
        normal = [(i, p.piece, p.score) for i, p in enumerate(model.pieces) if p.type == _NORMAL]
        if any(MARK in s.lstrip(MARK) for _, s, _ in normal):
            raise ValueError(f"{path}: a piece holds a marker after another character, so marked words are not independent")
        place = {score: n for n, score in enumerate(sorted({score for *_, score in normal}, reverse=True))}
        self.ids = {s: i for i, s, _ in normal}
        self.rank = {s: place[score] for _, s, score in normal}
        self.byte = {int(p.piece[1:-1], 16): i for i, p in enumerate(model.pieces) if p.type == _BYTE}
        self.shown = {i: s.replace(MARK, " ") for i, s, _ in normal}
        self.raw = {i: b for b, i in self.byte.items()}
        self.unknown, self.unknown_shown = model.trainer_spec.unk_id, model.trainer_spec.unk_surface
        self.words, self.border = re.compile(f"{MARK}+[^{MARK}]*"), re.compile(f"(?<=[^ {MARK}])[ {MARK}]")
        self.table_chars, self.stretch = table_chars, stretch
        self.table: dict[str, Entry] = {}
        self.older: dict[str, Entry] = {}
        self.held = 0

    def segment(self, word: str) -> list[str]:
        """Pieces and left-over characters of a marked word."""
        if len(word) > _SHORT:
            return self._segment_long(word)
        parts, get = list(word), self.rank.get
        ranks = [get(a + b, _NEVER) for a, b in zip(parts, parts[1:])]
        while ranks:
            best = min(ranks)
            if best == _NEVER:
                break
            i = ranks.index(best)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = get(parts[i - 1] + parts[i], _NEVER)
            if i < len(ranks):
                ranks[i] = get(parts[i] + parts[i + 1], _NEVER)
        return parts

    def _segment_long(self, word: str) -> list[str]:
        """The same for a long word, with a heap of pairs in place of a scan."""
        parts: list[str | None] = list(word)
        after, before = [*range(1, len(parts)), -1], [*range(-1, len(parts) - 1)]
        heap = []

        def offer(left: int, right: int) -> None:
            if left >= 0 and right >= 0 and (rank := self.rank.get(parts[left] + parts[right])) is not None:
                heapq.heappush(heap, (rank, left, right, len(parts[left]), len(parts[right])))

        for i in range(len(parts) - 1):
            offer(i, i + 1)
        while heap:
            _, left, right, a, b = heapq.heappop(heap)
            if parts[left] is None or parts[right] is None or len(parts[left]) != a or len(parts[right]) != b or after[left] != right:
                continue  # one of the two has been merged meanwhile
            parts[left], parts[right] = parts[left] + parts[right], None
            after[left] = after[right]
            if after[left] >= 0:
                before[after[left]] = left
            offer(before[left], left)
            offer(left, after[left])
        return [p for p in parts if p is not None]

    def word_ids(self, word: str) -> list[int]:
        out = []
        for part in self.segment(word):
            i = self.ids.get(part)
            if i is None:
                out += [self.byte[b] for b in part.encode()]
            else:
                out.append(i)
        return out

    def entry(self, key: str) -> Entry:
        """Number of ids, the ids joined by commas, and the decoded text of the marked word MARK + ``key``."""
        known = self.older.pop(key, None)
        if known is None:
            ids = self.word_ids(MARK + key)
            known = len(ids), ",".join(map(str, ids)), self.surface(ids)
        if len(key) <= WORD_CHARS:
            if self.held > self.table_chars:
                self.older, self.table, self.held = self.table, {}, 0
            self.table[key] = known
            self.held += len(key) + 1
        return known

    def entries(self, text: str) -> Iterator[list[Entry]]:
        """Entries of a text's marked words in their order, by stretches."""
        get, entry, at = self.table.get, self.entry, 0
        while at < len(text):
            end = at + self.stretch
            found = self.border.search(text, end) if end < len(text) else None
            end = found.start() if found else len(text)
            part = text[at:end].replace(" ", MARK)
            if not at:
                part = MARK + part
            at = end
            keys = [w[1:] for w in self.words.findall(part)] if MARK + MARK in part else part[1:].split(MARK)
            table, out = self.table, []
            get = table.get
            for key in keys:
                known = get(key)
                if known is None:
                    known = entry(key)
                    if self.table is not table:
                        table = self.table
                        get = table.get
                out.append(known)
            yield out

    def encode(self, text: str) -> list[int]:
        return [int(i) for some in self.entries(text) for e in some for i in e[1].split(",")]

    def surface(self, ids: list[int]) -> str:
        """What ids stand for, leading blank included; runs of byte pieces are read as UTF-8, broken ones byte by byte as U+FFFD."""
        out, raw = [], bytearray()
        for i in [*ids, None]:
            if i in self.raw:
                raw.append(self.raw[i])
                continue
            if raw:
                out.append(_utf8(bytes(raw)))
                raw.clear()
            if i is not None:
                out.append(self.unknown_shown if i == self.unknown else self.shown.get(i, ""))
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        """The text of ids: the blank that the leading marker stands for is not part of it."""
        return self.surface(ids).removeprefix(" ")


def _utf8(raw: bytes) -> str:
    out, at = [], 0
    while at < len(raw):
        width = next((w for w in (1, 2, 3, 4) if _is_one(raw[at:at + w], w)), 0)
        out.append(raw[at:at + width].decode() if width else "�")
        at += width or 1
    return "".join(out)


def _is_one(raw: bytes, width: int) -> bool:
    try:
        return len(raw) == width and len(raw.decode()) == 1
    except UnicodeDecodeError:
        return False


@lru_cache(maxsize=2)
def encoder(path: str) -> PieceBpe:
    return PieceBpe(path)


def encode_texts(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, number of ids, and digests of the ids and of the decoded text of every row of ``docs``.

    ``path`` is the model file, which must be at the same place on every machine.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for batch in batches:
            counts, id_digests, text_digests = [], [], []
            for value in batch.column(1):
                n, ids, decoded, first = 0, hashlib.sha256(), hashlib.sha256(), True
                for some in bpe.entries(value.as_py() or ""):
                    n += sum([e[0] for e in some])
                    ids.update((("" if first else ",") + ",".join([e[1] for e in some])).encode())
                    shown = "".join([e[2] for e in some])
                    decoded.update((shown.removeprefix(" ") if first else shown).encode())
                    first = False
                counts.append(n)
                id_digests.append(ids.hexdigest())
                text_digests.append(decoded.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(id_digests, pa.string()), pa.array(text_digests, pa.string())],
                                             ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(encode, f"doc_id bigint, {COLUMNS}")


def token_ids(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and the ids themselves of every row."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for batch in batches:
            ids = pa.array([bpe.encode(t.as_py() or "") for t in batch.column(1)], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(encode, "doc_id bigint, ids array<int>")


def decoded_texts(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and the decoded text of rows (doc_id, ids)."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for batch in batches:
            texts = pa.array([bpe.decode(i.as_py() or []) for i in batch.column(1)], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), texts], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(decode, "doc_id bigint, text string")
