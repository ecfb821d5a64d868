"""How far the sources of a language differ: an audit over a vocabulary held as a minimal acyclic transducer.

1. Documents are counted per (lang, term); terms in at least ``MIN_DOCS`` of a language are its vocabulary.
2. The kept terms are sorted over the cluster by range, which gives each its lexicographic ordinal, and each slice of
   ``SLICE`` consecutive ordinals of a language is built into a minimal acyclic transducer from term to ordinal.
3. The text is streamed through the transducers: a task counts the occurrences of each ordinal for each (lang, source).
   Machines are broadcast up to ``PASS_BYTES`` at once, by their measured size; a larger vocabulary takes further passes, so a
   task's memory does not grow with it.
4. Ordinals are cut into blocks of a bounded number of cells (sources of the language times ordinals).  A block is a dense
   matrix of counts, from which it sums up every pair of sources and picks the best terms of each; the sums of blocks add up and
   the best terms are ranked with ordinals for ties, whose order is that of the terms in UTF-8.

All arithmetic is on integers.  p = 1 + floor(1000000000 * (count + 1) / (N + V)), and a term's or pair's value is
floor((p - q)^2 / q), summed over the vocabulary for a pair.

Defined results: null text, lang and source are empty strings; rows that repeat count again; a language without kept terms has value 0 for
its pairs and no terms; a language of one source has no pairs; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage
from .terms import LETTERS, terms
from .transducer import Transducer

MIN_DOCS, TOP, SCALE = 3, 200, 1_000_000_000
#: Terms of a transducer, bytes of those broadcast for one pass, cells of a block, terms that a task holds before it hands on their counts.
SLICE, PASS_BYTES, CELLS, HELD = 1 << 16, 64 << 20, 1 << 18, 1 << 19


def _read(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])


def document_counts(docs: DataFrame, held: int = HELD) -> DataFrame:
    """(lang, term, docs): in how many rows of ``docs`` each term stands; summed in tasks before they are shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, Counter] = defaultdict(Counter)

        def rows() -> Iterator[pa.RecordBatch]:
            for lang, some in found.items():
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some), pa.string()), pa.array([*some], pa.binary()).cast(pa.string()), pa.array([*some.values()], pa.int64())], ["lang", "term", "docs"])
            found.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found[lang].update(set(terms((text.as_py()).encode(), LETTERS)))
                if sum(map(len, found.values())) > held:
                    yield from rows()
        yield from rows()

    return _read(docs).select("lang", "text").mapInArrow(count, "lang string, term string, docs bigint").groupBy("lang", "term").agg(F.sum("docs").alias("docs"))


def vocabulary(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, term, ordinal) of the kept terms, in the order of their UTF-8 bytes from 0 in each language; a written table."""
    kept = document_counts(docs).where(F.col("docs") >= min_docs)
    # sorted ranges; a row's place in its range and the sizes of the ranges before it make the ordinal
    ranged = stage(kept.repartitionByRange("lang", "term").sortWithinPartitions("lang", "term")
                   .select("lang", "term", F.monotonically_increasing_id().alias("place")), "audit-sorted")
    part = F.shiftright("place", 33)
    sizes = ranged.groupBy("lang", part.alias("part")).agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("lang").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("lang", "part", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    placed = ranged.withColumn("part", part).join(sizes, ["lang", "part"])
    return stage(placed.select("lang", "term", (F.col("base") + F.col("place") - F.col("first")).alias("ordinal")), "audit-terms")


def transducers(kept: DataFrame, size: int = SLICE) -> DataFrame:
    """One row per slice of a language's vocabulary: lang, base (its least ordinal), first (its least term), machine, bytes; a written table."""

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("ordinal")
        ordered = [t.encode() for t in rows["term"]]
        machine = Transducer.build(ordered).packed()
        return pd.DataFrame({"lang": [rows["lang"].iloc[0]], "base": [int(rows["ordinal"].iloc[0])], "first": [ordered[0]], "machine": [machine], "bytes": [len(machine) + len(ordered[0])]})

    built = kept.withColumn("slice", F.floor(F.col("ordinal") / size)).groupBy("lang", "slice").applyInPandas(build, "lang string, base bigint, first binary, machine binary, bytes bigint")
    return stage(built, "audit-transducers")


def _passes(machines: DataFrame, most: int) -> list[list[tuple[str, int]]]:
    """Slices (lang, base) by passes whose machines hold at most ``most`` bytes together, one at least."""
    out, room = [[]], most
    for r in machines.select("lang", "base", "bytes").orderBy("lang", "base").collect():
        if r["bytes"] > room and out[-1]:
            out.append([])
            room = most
        out[-1].append((r["lang"], r["base"]))
        room -= r["bytes"]
    return out


class Vocabulary:
    """The transducers of one pass, by language; unpacked once in a task."""

    def __init__(self, slices: list[tuple[str, int, bytes, bytes]]):
        self.slices: dict[str, list[tuple[bytes, int, Transducer]]] = defaultdict(list)
        for lang, base, first, machine in sorted(slices, key=lambda s: s[:2]):
            self.slices[lang].append((first, base, Transducer.unpacked(machine)))

    def ordinals(self, lang: str, some: list[bytes]) -> list[int]:
        """The ordinals of terms in ascending order, -1 for terms that no slice of this pass keeps."""
        out = np.full(len(some), -1, np.int64)
        slices = self.slices.get(lang, ())
        cuts = [bisect_right(some, first) for first, *_ in slices] + [len(some)]
        for n, (first, base, machine) in enumerate(slices):
            lo, hi = cuts[n], cuts[n + 1]
            lo -= lo > 0 and some[lo - 1] == first
            places = machine.ordinals(some[lo:hi])
            out[lo:hi] = np.where(places >= 0, places + base, out[lo:hi])
        return out.tolist()


def _recounted(docs: DataFrame, machines: DataFrame, slices: list[tuple[str, int]], held: int) -> DataFrame:
    """(lang, source, ordinal, n) of the terms of ``slices``; a row with ordinal -1 and n 0 for each group that occurs."""
    spark = docs.sparkSession
    rows = machines.where(F.struct("lang", "base").isin([F.struct(F.lit(lang), F.lit(base).cast("bigint")) for lang, base in slices])).select("lang", "base", "first", "machine").toLocalIterator() if slices else ()
    packed = spark.sparkContext.broadcast([tuple(bytes(x) if isinstance(x, bytearray) else x for x in r) for r in rows])

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Vocabulary(packed.value)
        found: dict[tuple[str, str], Counter] = defaultdict(Counter)
        places: dict[str, dict[bytes, int]] = defaultdict(dict)

        def counted() -> Iterator[pa.RecordBatch]:
            for (lang, source), some in found.items():
                place = places[lang]
                fresh = sorted(t for t in some if t not in place)
                place.update(zip(fresh, known.ordinals(lang, fresh)))
                at = [(o, n) for t, n in some.items() if (o := place[t]) >= 0] + [(-1, 0)]
                columns = [[lang] * len(at), [source] * len(at), *zip(*at)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64(), pa.int64()))], ["lang", "source", "ordinal", "n"])
            found.clear()
            if sum(map(len, places.values())) > held:
                places.clear()

        size = 0
        for batch in batches:
            for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                counts = found[lang, source]
                size -= len(counts)
                counts.update(terms(text.as_py().encode(), LETTERS))
                size += len(counts)
                if size > held:
                    yield from counted()
                    size = 0
        yield from counted()

    return _read(docs).mapInArrow(stream, "lang string, source string, ordinal bigint, n bigint")


def recounts(docs: DataFrame, kept: DataFrame, size: int = SLICE, most: int = PASS_BYTES, held: int = HELD) -> DataFrame:
    """(lang, source, ordinal, n): occurrences of the kept terms that a group has, and a row of ordinal -1 for each group; a written table."""
    machines = transducers(kept, size)
    out = None
    for slices in _passes(machines, most):
        some = _recounted(docs, machines, slices, held)
        out = some if out is None else out.unionByName(some)
    return stage(out.groupBy("lang", "source", "ordinal").agg(F.sum("n").alias("n")), "audit-counts")


def _p(n: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * (n + 1) / whole), exact."""
    if n.size and int(n.max()) >= (1 << 62) // SCALE:
        return (1 + SCALE * (n.astype(object) + 1) // whole.astype(object)).astype(np.int64)
    return 1 + SCALE * (n + 1) // whole


def _block(counts: pd.DataFrame, groups: pd.DataFrame, top: int) -> pd.DataFrame:
    """One block of a language: for every two sources the sum of their terms' values, and each source's best terms over the whole language."""
    groups = groups.sort_values("source")
    names, first, width = groups["source"].to_numpy(object), int(groups["first"].iloc[0]), int(groups["width"].iloc[0])
    matrix = np.zeros((len(names), width), np.int64)
    if len(counts):
        row = {s: i for i, s in enumerate(names)}
        matrix[counts["source"].map(row).to_numpy(), counts["ordinal"].to_numpy() - first] = counts["n"].to_numpy()
    here = np.flatnonzero(matrix.any(0))  # every kept term occurs, so what is empty lies beyond the last ordinal
    matrix = matrix[:, here]
    p = _p(matrix, groups["whole"].to_numpy()[:, None])
    out = []
    for i, name in enumerate(names):
        value = ((p[i] - p) ** 2 // p).sum(1)
        others = np.arange(len(names)) != i
        out.append(pd.DataFrame({"source": name, "other": names[others], "ordinal": -1, "value": value[others]}))
    if len(here):
        q = _p(matrix.sum(0), np.array(int(groups["all_whole"].iloc[0])))
        for i, name in enumerate(names):
            at = np.flatnonzero((matrix[i] > 0) & (p[i] > q))
            value = (p[i, at] - q[at]) ** 2 // q[at]
            best = np.lexsort((at, -value))[:top]
            out.append(pd.DataFrame({"source": name, "other": None, "ordinal": here[at[best]] + first, "value": value[best]}))
    return pd.concat(out).assign(lang=groups["lang"].iloc[0])[["lang", "source", "other", "ordinal", "value"]]


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, size: int = SLICE, most: int = PASS_BYTES, cells: int = CELLS, held: int = HELD) -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item, value and rank, as the module says, for every (lang, source) of ``docs``."""
    kept = vocabulary(docs, min_docs)
    counts = recounts(docs, kept, size, most, held)
    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    by_group = counts.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    by_lang = by_group.groupBy("lang").agg(F.count(F.lit(1)).alias("sources"), F.sum("n").alias("all_n")).join(sizes, "lang", "left").withColumn("v", F.coalesce("v", F.lit(0)))
    width = F.greatest(F.lit(1), F.floor(F.lit(cells) / F.col("sources")))
    groups = stage(by_group.join(by_lang, "lang").select("lang", "source", (F.col("n") + F.col("v")).alias("whole"), (F.col("all_n") + F.col("v")).alias("all_whole"), "v", width.alias("width")), "audit-groups")

    # a language without kept terms has one empty block, where its pairs get their zeros
    blocks = groups.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor(F.greatest(F.col("v") - 1, F.lit(0)) / F.col("width")))))
    blocks = blocks.select("lang", "block", "source", "whole", "all_whole", "width", (F.col("block") * F.col("width")).alias("first"))
    widths = groups.groupBy("lang").agg(F.first("width").alias("width"))
    placed = counts.where("ordinal >= 0").join(widths, "lang").select("lang", F.floor(F.col("ordinal") / F.col("width")).alias("block"), "source", "ordinal", "n")
    summed = (placed.groupBy("lang", "block").cogroup(blocks.groupBy("lang", "block"))
              .applyInPandas(lambda rows, heads: _block(rows, heads, top), "lang string, source string, other string, ordinal bigint, value bigint"))
    summed = stage(summed, "audit-blocks")

    pairs = summed.where("ordinal < 0").groupBy("lang", "source", F.col("other").alias("item")).agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ordinal")
    best = summed.where("ordinal >= 0").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    best = best.join(kept, ["lang", "ordinal"]).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")
    return pairs.unionByName(best)


#: The same rows in DuckDB.
AUDIT_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(text, '') AS t, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
w AS (
  SELECT id, lang, source, translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM (SELECT id, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS x FROM d)),
kept AS (SELECT lang, term FROM w GROUP BY ALL HAVING count(DISTINCT id) >= {MIN_DOCS}),
counts AS (SELECT lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM d),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
wholes AS (
  SELECT lang, source, coalesce(v, 0) + coalesce(sum(n), 0) AS whole
  FROM groups LEFT JOIN sizes USING (lang) LEFT JOIN counts USING (lang, source) GROUP BY lang, source, v),
p AS (
  SELECT lang, source, term, coalesce(n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(n, 0) + 1)) // whole::HUGEINT AS p
  FROM wholes JOIN kept USING (lang) LEFT JOIN counts USING (lang, source, term)),
q AS (
  SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 1)) // (sum(n) OVER (PARTITION BY lang) + v)::HUGEINT AS q
  FROM (SELECT lang, term, sum(n) AS n FROM counts GROUP BY ALL) JOIN sizes USING (lang)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(f, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum(((x.p - y.p) * (x.p - y.p)) // y.p) AS f
             FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) s
    ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
best AS (
  SELECT lang, source, term AS item, ((p - q) * (p - q)) // q AS value,
         row_number() OVER (PARTITION BY lang, source ORDER BY ((p - q) * (p - q)) // q DESC, term) AS rank
  FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, CAST(value AS BIGINT) AS value,
       CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM pairs
UNION ALL
SELECT lang, source, 'term', item, CAST(value AS BIGINT), CAST(rank AS INTEGER) FROM best WHERE rank <= {TOP}
"""
