"""Ranked lexical search by MaxScore with bounds on pairs of terms.

Queries come in blocks of bounded size, and each block is matched against all documents:

1. Documents are cut into terms once; postings of the block's terms are written in chunks of up to ``CHUNK`` documents.  The
   statistics of the scores (documents, terms, documents of each term) cover the whole table.
2. The index: each chunk gets the impact of every posting, the greatest impact of every term, and for each pair of terms that
   follow each other in a query, from the most common on, the intersection of their two lists with its greatest joint impact.
3. The search: what the first terms of a query can give a document of a chunk is bounded term by term, where a term either adds its
   greatest impact or makes a pair with the one before it, which can add at most the greatest of the joint and the two single
   impacts.  That is less than both single ones wherever the best documents of the two differ.  Terms whose bound stays below the score
   of the k-th best document so far are not essential: documents that only they hold are skipped, and so is a chunk where
   all terms stay below.  The rest are scored from the essential lists on, and dropped as soon as the bound of what is still to come
   cannot lift them to that score.  Scores to beat start from a first search of a few files of the index and rise in each task from chunk to
   chunk; a chunk's documents never leave their task, only a task's k best of each query do.

Skipping changes no result: a document is left out only if ``k`` others score more.  All scores are integers, as the contract of the query says:
weight w = floor(1000 ln((2N + 2) / (2 df + 1))), m = 50 + (50 n N) div L, impact w * ((10^9 tf) div (1000 tf + 20 m)).

Defined results: a null text has no terms; documents without terms are not counted; rows that repeat are documents of their
own; ties go to the smaller doc_id, null last; a query without terms, or none of whose terms weighs anything, has no rows; queries that repeat are
ranked each; other columns are not read; empty tables give no rows.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage
from .terms import LETTERS_AND_DIGITS, terms

BEST = 50
#: Documents and postings of a chunk, queries and bytes of different terms of a block, files of the index that the first search reads.
CHUNK, POSTINGS, QUERIES, TERM_BYTES, FIRST = 2048, 1 << 19, 4096, 8 << 20, 2
_PLACES = pa.list_(pa.int32())
_RAW = pa.schema([("documents", pa.int64()), ("words", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())),
                  ("terms", _PLACES), ("sizes", _PLACES), ("places", _PLACES), ("tfs", _PLACES)])
_RAW_DDL = "documents bigint, words bigint, doc_ids array<bigint>, lengths array<bigint>, terms array<int>, sizes array<int>, places array<int>, tfs array<int>"
_INDEX = pa.schema([("doc_ids", pa.list_(pa.int64())), ("terms", _PLACES), ("sizes", _PLACES), ("places", _PLACES), ("impacts", pa.list_(pa.int64())),
                    ("tops", pa.list_(pa.int64())), ("shared", _PLACES), ("joint", pa.list_(pa.int64()))])
_INDEX_DDL = ("doc_ids array<bigint>, terms array<int>, sizes array<int>, places array<int>, impacts array<bigint>, tops array<bigint>, "
              "shared array<int>, joint array<bigint>")
_FOUND = pa.schema([("query", pa.int64()), ("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])


class QueryBlock:
    """Queries of bounded size: their numbers and ids, their terms as numbers, and the place of each term."""

    def __init__(self):
        self.numbers: list[int] = []
        self.ids: list[int | None] = []
        self.terms: list[list[int]] = []
        self.vocabulary: dict[bytes, int] = {}
        self.held = 0

    def add(self, number: int, item_id: int | None, text: str | None) -> None:
        known, own = self.vocabulary, []
        for term in dict.fromkeys(terms((text or "").encode(), LETTERS_AND_DIGITS)):
            if term not in known:
                known[term] = len(known)
                self.held += len(term)
            own.append(known[term])
        self.numbers.append(number)
        self.ids.append(item_id)
        self.terms.append(own)

    def full(self, queries: int, held: int) -> bool:
        return len(self.numbers) >= queries or self.held >= held


class Scoring:
    """Weights of a block's terms and the pairs that its queries make of them."""

    def __init__(self, block: QueryBlock, documents: int, words: int, holding: dict[int, int]):
        self.documents, self.words = documents, words
        self.weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * holding.get(t, 0) + 1))) for t in range(len(block.vocabulary))], np.int64)
        #: of each query its terms from the most common on, and the place of the pair that each makes with the one before
        ordered = [sorted((t for t in own if holding.get(t) and self.weights[t] > 0), key=lambda t: (-holding[t], t)) for own in block.terms]
        self.pairs = sorted({(min(a, b), max(a, b)) for own in ordered for a, b in zip(own, own[1:])})
        place = {pair: n for n, pair in enumerate(self.pairs)}
        self.queries = [(own, [-1, *(place[min(a, b), max(a, b)] for a, b in zip(own, own[1:]))]) for own in ordered]

    def impacts(self, term: np.ndarray, tf: np.ndarray, length: np.ndarray) -> np.ndarray:
        if len(length) and 50 * self.documents * int(length.max()) >= 1 << 63:
            length = length.astype(object)
        m = (50 + 50 * length * self.documents // self.words).astype(np.int64)
        tf = tf.astype(np.int64)
        return self.weights[term] * (1_000_000_000 * tf // (1000 * tf + 20 * m))


def blocks(items: DataFrame, queries: int = QUERIES, held: int = TERM_BYTES) -> Iterator[QueryBlock]:
    """The queries (item_id, text) of ``items`` in blocks; one block at a time is in the driver's memory."""
    block = QueryBlock()
    for number, r in enumerate(items.select("item_id", "text").toLocalIterator()):
        block.add(number, r["item_id"], r["text"])
        if block.full(queries, held):
            yield block
            block = QueryBlock()
    if block.numbers:
        yield block


def postings(docs: DataFrame, vocabulary: dict[bytes, int], chunk: int = CHUNK, most: int = POSTINGS) -> DataFrame:
    """Chunks of documents: how many have terms, how many terms those have, and the postings of ``vocabulary`` in them."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, n_docs, n_words = known.value, 0, 0
        ids, lengths, by_term, held = [], [], {}, 0

        def chunk_row() -> pa.RecordBatch:
            order = sorted(by_term)
            lists = [by_term[t] for t in order]
            row = [n_docs, n_words, [*ids], [*lengths], order, [len(x) for x in lists], [p for x in lists for p, _ in x], [f for x in lists for _, f in x]]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, _RAW.types)], schema=_RAW)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = terms((text.as_py() or "").encode(), LETTERS_AND_DIGITS)
                if not words:
                    continue
                n_docs += 1
                n_words += len(words)
                found = [(t, n) for w, n in Counter(words).items() if (t := place.get(w)) is not None]
                if found:
                    for t, n in found:
                        by_term.setdefault(t, []).append((len(ids), n))
                    ids.append(doc_id)
                    lengths.append(len(words))
                    held += len(found)
                if len(ids) >= chunk or held >= most:
                    yield chunk_row()
                    n_docs, n_words, held = 0, 0, 0
                    ids, lengths, by_term = [], [], {}
        if n_docs:
            yield chunk_row()

    return docs.select("doc_id", "text").mapInArrow(cut, _RAW_DDL)


def _arrays(batch: pa.RecordBatch, row: int, *names: str) -> list[np.ndarray]:
    return [batch.column(n)[row].values.to_numpy(zero_copy_only=False) for n in names]


def _joint(scoring: Scoring, term: np.ndarray, starts: np.ndarray, places: np.ndarray, impacts: np.ndarray, documents: int) -> tuple[list[int], list[int]]:
    """Of each pair in a chunk: how many documents hold both terms, and the most that both give one of them."""
    slot = {int(t): n for n, t in enumerate(term)}
    line, filled, shared, joint = np.zeros(documents, np.int64), None, [], []
    for a, b in scoring.pairs:
        if a not in slot or b not in slot:
            shared.append(0)
            joint.append(0)
            continue
        if filled != a:  # pairs are sorted, so the list of a first term is laid out once
            line[:] = 0
            at = slice(starts[slot[a]], starts[slot[a] + 1])
            line[places[at]] = impacts[at]
            filled = a
        at = slice(starts[slot[b]], starts[slot[b] + 1])
        first = line[places[at]]
        both = first > 0
        shared.append(int(both.sum()))
        joint.append(int((first + impacts[at])[both].max()) if shared[-1] else 0)
    return shared, joint


def pair_index(chunks: DataFrame, scoring: Scoring) -> DataFrame:
    """Chunks with impacts, greatest impacts of terms, and size and greatest joint impact of the pairs' intersections."""
    scores = chunks.sparkSession.sparkContext.broadcast(scoring)

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                length, term, sizes, places, tf = _arrays(batch, row, "lengths", "terms", "sizes", "places", "tfs")
                if not len(places):
                    continue
                starts = np.concatenate(([0], np.cumsum(sizes)))
                impacts = scores.value.impacts(np.repeat(term, sizes), tf, length[places])
                shared, joint = _joint(scores.value, term, starts, places, impacts, len(length))
                out = [batch.column("doc_ids")[row].as_py(), term, sizes, places, impacts, np.maximum.reduceat(impacts, starts[:-1]), shared, joint]
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(out, _INDEX.types)], schema=_INDEX)

    return chunks.mapInArrow(indexed, _INDEX_DDL)


class Chunk:
    """One chunk of the index, ready for queries."""

    def __init__(self, batch: pa.RecordBatch, row: int):
        self.ids = batch.column("doc_ids")[row].values
        term, sizes, self.places, self.impacts, self.tops, self.joint = _arrays(batch, row, "terms", "sizes", "places", "impacts", "tops", "joint")
        self.starts = np.concatenate(([0], np.cumsum(sizes)))
        self.slot = {int(t): n for n, t in enumerate(term)}

    def bounds(self, own: list[int], pairs: list[int]) -> list[int]:
        """The most that the first 1, 2, ... terms of a query can give a document here together.

        A term adds its greatest impact to the bound of those before it, or makes a pair with the last of them, whichever is less.
        """
        out, before, last = [], 0, 0
        for term, pair in zip(own, pairs):
            slot = self.slot.get(term)
            top = int(self.tops[slot]) if slot is not None else 0
            bound = (out[-1] if out else 0) + top
            if pair >= 0:
                bound = min(bound, before + max(last, top, int(self.joint[pair])))
            before, last = out[-1] if out else 0, top
            out.append(bound)
        return out

    def postings(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        at = slice(self.starts[self.slot[term]], self.starts[self.slot[term] + 1])
        return self.places[at], self.impacts[at]

    def search(self, own: list[int], pairs: list[int], least: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Places and scores of all documents with at least ``least``, and the number of documents scored."""
        upto = self.bounds(own, pairs)
        if not upto or upto[-1] < least:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        idle = bisect_left(upto, least)  # terms that together stay below ``least``
        scores = np.zeros(len(self.ids), np.int64)
        for t in own[idle:]:
            if t in self.slot:
                places, impacts = self.postings(t)
                scores[places] += impacts
        open_ = np.flatnonzero(scores)
        scored = len(open_)
        for n in range(idle - 1, -1, -1):
            open_ = open_[scores[open_] + upto[n] >= least]
            if not len(open_):
                break
            if own[n] in self.slot:
                places, impacts = self.postings(own[n])
                at = np.minimum(np.searchsorted(places, open_), len(places) - 1)
                scores[open_] += np.where(places[at] == open_, impacts[at], 0)
        open_ = open_[(scores[open_] >= least) & (scores[open_] > 0)]
        return open_, scores[open_], scored


class Best:
    """The ``k`` best documents of a query so far: scores, ids and which ids are null."""

    def __init__(self, k: int, least: int):
        self.k, self.least = k, least
        self.scores, self.ids, self.null = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def add(self, scores: np.ndarray, ids: pa.Array) -> None:
        null = ids.is_null().to_numpy(zero_copy_only=False)
        scores, null = np.concatenate((self.scores, scores)), np.concatenate((self.null, null))
        ids = np.concatenate((self.ids, ids.fill_null(0).to_numpy(zero_copy_only=False)))
        best = np.lexsort((ids, null, -scores))[:self.k]
        self.scores, self.ids, self.null = scores[best], ids[best], null[best]
        if len(best) == self.k:
            self.least = max(self.least, int(self.scores[-1]))


def _found(index: DataFrame, block: QueryBlock, scoring: Scoring, k: int, least: dict[int, int]) -> DataFrame:
    """(query, item_id, doc_id, score): the ``k`` best of each task's chunks, of those that reach ``least``."""
    work = index.sparkSession.sparkContext.broadcast((block.numbers, block.ids, scoring.queries, least))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, ids, queries, start = work.value
        best = [Best(k, start.get(n, 1)) for n in numbers]
        for batch in batches:
            for row in range(len(batch)):
                chunk = Chunk(batch, row)
                for own, query in zip(best, queries):
                    places, scores, _ = chunk.search(*query, own.least)
                    if len(places):
                        own.add(scores, chunk.ids.take(pa.array(places)))
        for number, item_id, own in zip(numbers, ids, best):
            n = len(own.scores)
            if n:
                yield pa.RecordBatch.from_arrays([pa.array([number] * n, pa.int64()), pa.array([item_id] * n, pa.int64()), pa.array(own.ids, pa.int64(), mask=own.null), pa.array(own.scores)], schema=_FOUND)

    return index.mapInArrow(search, "query bigint, item_id bigint, doc_id bigint, score bigint")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search_block(docs: DataFrame, block: QueryBlock, k: int, chunk: int, first: int) -> DataFrame:
    raw = stage(postings(docs, block.vocabulary, chunk), "rank-postings")
    total = raw.agg(F.sum("documents").alias("documents"), F.sum("words").alias("words")).first()
    holding = raw.select(F.explode(F.arrays_zip("terms", "sizes")).alias("t")).groupBy("t.terms").agg(F.sum("t.sizes").alias("n")).toArrow()  # at most the block's terms
    holding = dict(zip(holding["terms"].to_pylist(), holding["n"].to_pylist()))
    scoring = Scoring(block, total["documents"] or 0, total["words"] or 0, holding)
    index = stage(pair_index(raw, scoring), "rank-index")
    some = docs.sparkSession.read.schema(index.schema).parquet(*index.inputFiles()[:first])  # a file holds the chunks of one task
    start = _ranked(_found(some, block, scoring, k, {}), k).where(F.col("rank") == k).select("query", "score")
    least = {r["query"]: r["score"] for r in start.collect()}  # one row per query of the block
    return _found(index, block, scoring, k, least)


def ranked(docs: DataFrame, items: DataFrame, k: int = BEST, queries: int = QUERIES, held: int = TERM_BYTES, chunk: int = CHUNK, first: int = FIRST) -> DataFrame:
    """item_id, rank, doc_id and score of the ``k`` best of ``docs`` (doc_id, text) for each row of ``items`` (item_id, text)."""
    found = None
    for block in blocks(items, queries, held):
        some = _search_block(docs, block, k, chunk, first)
        found = some if found is None else found.unionByName(some)
    if found is None:
        found = docs.sparkSession.createDataFrame([], "query bigint, item_id bigint, doc_id bigint, score bigint")
    return _ranked(found, k).select("item_id", "rank", "doc_id", "score")


#: The same rows in DuckDB.
RANKING_SQL = rf"""
WITH w AS (
  SELECT id, doc_id, translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM (SELECT row_number() OVER () AS id, doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS x FROM documents)),
tf AS (SELECT id, doc_id, term, count(*) AS tf FROM w GROUP BY ALL),
lengths AS (SELECT id, sum(tf)::BIGINT AS n FROM tf GROUP BY id),
total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM lengths),
weights AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, total GROUP BY term, docs),
asked AS (
  SELECT DISTINCT number, item_id, translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM (SELECT row_number() OVER () AS number, item_id, unnest(regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS x FROM benchmark)),
scored AS (
  SELECT number, item_id, id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // words))))::BIGINT AS score
  FROM asked JOIN tf USING (term) JOIN weights USING (term) JOIN lengths USING (id), total GROUP BY number, item_id, id, doc_id),
placed AS (SELECT *, row_number() OVER (PARTITION BY number ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM placed WHERE rank <= {BEST}
"""
