"""Near-duplicate texts by improved consistent weighted sampling.

A text is its bag of five-word shingles, each weighted by TF-IDF.  A sampled hash picks a shingle
with the chance its weight gives it, the same for two texts with the chance of their weighted
Jaccard similarity.  ``BANDS`` bands of ``ROWS`` hashes make the buckets.  Buckets of up to ``SMALL`` texts are compared
whole.  A crowded bucket is compared with one leader at a time: first its most central member, the one whose buckets hold the most
texts, then the most central one that no leader has drawn into its class.  After each of ``ROUNDS`` rounds the classes are put together,
and members of one class are not compared again.  That joins most of a family at a cost in proportion to its members.  What such rounds leave
in a crowded bucket is finished exactly: two texts can reach the similarity only if their prefixes, the rarest
shingles up to a share of the weight, meet, and all pairs whose prefixes meet are compared, but for those already
in one class.  Every link is verified by the exact weighted Jaccard similarity of the whole texts.

Defined results: a null text is empty; texts without words are alike only if equal; repeated rows
and equal texts share a class; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import byte_rows, components, mixed, shingles, stage, text_key

BANDS, ROWS, SIMILARITY, FILTER_BITS = 14, 4, 0.8, 24
#: Texts of a bucket that is compared whole, rounds of leaders before the exact finish, and the bits of the table that orders shingles by rarity there.
SMALL, ROUNDS, RARITY_BITS = 7, 3, 22
#: Document frequencies are counted by hashed feature, as Spark ML's HashingTF does, with its number of features.
FEATURE_BITS = 18
#: Share of the documents from which on a shingle loses weight.
COMMON = 0.1
_DRAWS = 1 << 14


class Sampler:
    """The random numbers of all hashes, and the weights of shingles; small and the same everywhere."""

    def __init__(self, frequencies: np.ndarray, documents: int, hashes: int = BANDS * ROWS):
        draw = np.random.default_rng(20260728)
        self.r = draw.gamma(2.0, 1.0, _DRAWS).astype(np.float32)
        self.log_c = np.log(draw.gamma(2.0, 1.0, _DRAWS)).astype(np.float32)
        self.beta = draw.random(_DRAWS).astype(np.float32)
        self.factor = draw.integers(0, 1 << 63, hashes, np.uint64) * np.uint64(2) + np.uint64(1)
        self.shift = draw.integers(0, 1 << 63, hashes, np.uint64)
        # shingles in less than COMMON of the documents are equally rare: else the few edits of a copy would outweigh
        # all that it shares with a large family
        share = np.maximum(np.maximum(frequencies, 1) / max(documents, 1), COMMON)
        self.idf = np.sqrt(np.log1p(1 / share)).astype(np.float32)

    def weights(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Different shingles of a text, ascending, and their TF-IDF weights."""
        ids, counts = np.unique(shingles(data), return_counts=True)
        return ids, counts.astype(np.float32) * self.idf[(ids >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)]

    def signature(self, data: np.ndarray, block: int = 4096) -> np.ndarray | None:
        """One number per hash: the sampled shingle with its quantised weight."""
        ids, weights = self.weights(data)
        if not len(ids):
            return None
        logs, best, out = np.log(weights), None, None
        for at in range(0, len(ids), block):
            some = ids[at:at + block]
            pick = ((some[None, :] * self.factor[:, None] + self.shift[:, None]) >> np.uint64(50)).astype(np.int64)
            r, beta = self.r[pick], self.beta[pick]
            t = np.floor(logs[None, at:at + block] / r + beta)
            rank = self.log_c[pick] - r * (t - beta + 1)
            least = rank.argmin(1)
            rows = np.arange(len(least))
            found = mixed(some[least] + mixed(t[rows, least].astype(np.int64).astype(np.uint64) + np.uint64(77)))
            if best is None:
                best, out = rank[rows, least], found
            else:
                better = rank[rows, least] < best
                best, out = np.where(better, rank[rows, least], best), np.where(better, found, out)
        return out

    def bands(self, data: np.ndarray, rows: int = ROWS) -> list[int]:
        values = self.signature(data)
        if values is None:
            return []
        values = values.reshape(-1, rows)
        keys = np.arange(1, len(values) + 1, dtype=np.uint64)
        for k in range(rows):
            keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + values[:, k])
        return keys.view(np.int64).tolist()

    def similarity(self, a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
        """Weighted Jaccard: sum of the lesser weights over sum of the greater ones."""
        _, at, bt = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
        x, y = a[1][at].astype(float), b[1][bt].astype(float)
        both = np.minimum(x, y).sum()
        either = a[1].sum(dtype=float) + b[1].sum(dtype=float) - both
        return float(both / either) if either else 0.0


def _frequencies(texts: DataFrame, bits: int) -> tuple[np.ndarray, int]:
    """Over all rows of ``text``: the documents of every hashed feature, and the number of rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, rows = np.zeros(1 << bits, np.int64), 0
        for batch in batches:
            for data in byte_rows(batch.column(0)):
                seen[np.unique((shingles(data) >> np.uint64(64 - bits)).astype(np.int64))] += 1
                rows += 1
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(seen[at], rows))], ["feature", "n"])

    sums = (texts.select("text").mapInArrow(count, "feature bigint, n bigint").groupBy("feature").agg(F.sum("n").alias("n")).toArrow())
    feature, n = sums["feature"].to_numpy(), sums["n"].to_numpy()
    frequencies = np.zeros(1 << bits, np.int64)
    frequencies[feature[feature >= 0]] = n[feature >= 0]
    return frequencies, int(n[feature < 0].sum())


def fit_sampler(texts: DataFrame) -> Sampler:
    """The sampler for the document frequencies of all rows of ``text``."""
    return Sampler(*_frequencies(texts, FEATURE_BITS))


def _texts_of(texts: DataFrame, keys: DataFrame) -> DataFrame:
    """One row (key, text) for each of ``keys``.

    Texts that cannot be wanted are left out where they are read, by a bitmap of hashed keys of fixed size
    (``FILTER_BITS``); what passes meets the keys themselves.  So texts without a partner do not move.
    """
    size, part = 1 << FILTER_BITS, 1 << 15
    place = F.pmod(F.xxhash64("key"), F.lit(size))
    maps = keys.select(place.alias("p")).groupBy(F.floor(F.col("p") / part).alias("n")).agg(F.bitmap_construct_agg((F.col("p") % part)).alias("bits")).collect()
    packed = np.zeros((size // part, part // 8), np.uint8)
    for m in maps:
        packed[m["n"]] = np.frombuffer(m["bits"], np.uint8)
    bits = texts.sparkSession.sparkContext.broadcast(packed.reshape(-1))

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(1).to_numpy()
            yield batch.filter(pa.array((bits.value[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool))).select([0, 2])

    some = texts.select("key", place.alias("p"), "text").mapInArrow(likely, "key binary, text string")
    return some.join(keys, "key", "left_semi").groupBy("key").agg(F.first("text").alias("text"))


def _verified(pairs: DataFrame, texts: DataFrame, sampler, similarity: float) -> DataFrame:
    """Pairs (u, v) of text keys whose weighted Jaccard similarity reaches the threshold."""
    both = (pairs.join(texts.select(F.col("key").alias("u"), F.col("text").alias("a")), "u")
            .join(texts.select(F.col("key").alias("v"), F.col("text").alias("b")), "v"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s, last = sampler.value, (None, None)
        for batch in batches:
            keep = []
            for one, b, a in zip(batch.column(1).to_pylist(), byte_rows(batch.column(3)), byte_rows(batch.column(2))):
                if last[0] != one:
                    last = (one, s.weights(b))
                keep.append(s.similarity(last[1], s.weights(a)) >= similarity)
            yield batch.filter(pa.array(keep, pa.bool_())).select([0, 1])

    return both.select("u", "v", "a", "b").mapInArrow(compare, "u binary, v binary")


def _prefix_pairs(crowd: DataFrame, texts: DataFrame, sampler, similarity: float) -> DataFrame:
    """All pairs (u, v) of ``crowd`` (key, root) of different roots that can reach the similarity.

    With the shingles of all texts in one order, from rare to common, what two texts share lies from their first
    common shingle on in both.  So it weighs at most as much as the lighter of the two rests that start there, and a pair
    is possible only if that rest is as heavy as the similarity asks.  The order by rarity only saves pairs; any order is exact.
    """
    held = stage(texts.join(crowd, "key").select("key", "root", "text"), "near-crowd")
    frequencies, _ = _frequencies(held, RARITY_BITS)
    rarity = crowd.sparkSession.sparkContext.broadcast(frequencies.astype(np.int32))
    least = similarity * (1 - 1e-6)  # weights are float32

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, shingle, whole, rest = [], [], [], []
            for row, data in enumerate(byte_rows(batch.column(2))):
                ids, weights = sampler.value.weights(data)
                order = np.lexsort((ids, rarity.value[(ids >> np.uint64(64 - RARITY_BITS)).astype(np.int64)]))
                rests = np.cumsum(weights[order[::-1]].astype(float))[::-1]
                n = int((rests >= least * rests[0]).sum()) if len(rests) else 0
                at.append(np.full(n, row))
                shingle.append(ids[order[:n]].view(np.int64))
                whole.append(np.full(n, rests[0] if n else 0.0))
                rest.append(rests[:n])
            if at:
                places = pa.array(np.concatenate(at))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(places), batch.column(1).take(places), *[pa.array(np.concatenate(x)) for x in (shingle, whole, rest)]],
                                                 ["key", "root", "shingle", "whole", "rest"])

    entries = held.select("key", "root", "text").mapInArrow(prefixes, "key binary, root binary, shingle bigint, whole double, rest double")
    entries = stage(entries, "near-prefixes")
    # texts of the largest class of a shingle need no comparison among themselves, so only the others look for partners
    per_root = entries.groupBy("shingle", "root").agg(F.count(F.lit(1)).alias("n"))
    mixed_up = stage(per_root.groupBy("shingle").agg(F.max(F.struct("n", "root")).alias("top"), F.count(F.lit(1)).alias("roots")).where("roots > 1").select("shingle", F.col("top.root").alias("main")), "near-mixed")
    seen = stage(entries.join(mixed_up, "shingle"), "near-seen")
    lone = seen.where("root <> main").select("shingle", F.col("key").alias("u"), F.col("root").alias("ru"), F.col("whole").alias("wu"), F.col("rest").alias("su"))
    others = seen.select("shingle", F.col("key").alias("v"), F.col("root").alias("rv"), F.col("whole").alias("wv"), F.col("rest").alias("sv"))
    enough = F.least("su", "sv") >= (F.col("wu") + F.col("wv")) * F.lit(least / (1 + least))
    met = lone.join(others, "shingle").where((F.col("ru") != F.col("rv")) & enough)
    return met.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def near_duplicate_classes(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(key, root) of every text that is linked to another one; ``key`` is ``text_key`` of the text.

    ``docs`` needs a column ``text``.  Texts without a link are not listed: they are their own class.
    """
    spark = docs.sparkSession
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    sampler = spark.sparkContext.broadcast(fit_sampler(texts))
    texts = texts.select(text_key(F.col("text")).alias("key"), "text")

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bands = [sampler.value.bands(data) for data in byte_rows(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bands, pa.list_(pa.int64()))], ["key", "bands"])

    sketched = texts.mapInArrow(sketch, "key binary, bands array<bigint>")
    entries = stage(sketched.select("key", F.explode("bands").alias("bucket")).distinct(), "near-entries")
    sizes = entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = stage(entries.join(sizes, "bucket"), "near-shared")  # a text alone in its buckets has no partner
    central = shared.groupBy("key").agg(F.sum("size").alias("mates"))
    members = stage(shared.join(central, "key"), "near-members")
    held = stage(_texts_of(texts, members.select("key").distinct()), "near-texts")

    classes = stage(members.select("key", F.col("key").alias("root")).distinct(), "near-classes")
    few, crowded = members.where(F.col("size") <= SMALL), members.where(F.col("size") > SMALL).select("bucket", "key", "mates")
    # small buckets are compared whole, a crowded one with its most central member
    pairs = few.select("bucket", F.col("key").alias("u")).join(few.select("bucket", F.col("key").alias("v")), "bucket").where("u < v").select("u", "v")
    used = stage(_most_central(crowded), "near-leaders")
    pairs = pairs.unionByName(_led(crowded.select("bucket", "key"), used)).distinct()
    classes = _joined(classes, stage(_verified(pairs, held, sampler, similarity), "near-links"))
    for _ in range(ROUNDS):
        open_ = stage(_of_several_classes(crowded, classes), "near-open")
        # the next leader is the most central member that no earlier one has drawn into its class
        taken = used.join(classes.withColumnRenamed("key", "leader"), "leader").select("bucket", "root").distinct()
        leaders = stage(_most_central(open_.join(taken, ["bucket", "root"], "left_anti")), "near-leaders")
        roots = classes.select(F.col("key").alias("leader"), F.col("root").alias("leader_root"))
        met = open_.join(leaders.join(roots, "leader"), "bucket").where(F.col("root") != F.col("leader_root"))
        found = stage(_verified(met.select(F.least("key", "leader").alias("u"), F.greatest("key", "leader").alias("v")).distinct(), held, sampler, similarity), "near-links")
        if not found.limit(1).count():
            break
        classes, used = _joined(classes, found), stage(used.unionByName(leaders), "near-leaders")
    # crowded buckets that still hold several classes: a link between these may be unseen
    crowd = stage(_of_several_classes(crowded, classes).select("key", "root").distinct(), "near-open")
    if not crowd.limit(1).count():
        return classes
    return _joined(classes, stage(_verified(_prefix_pairs(crowd, held, sampler, similarity), held, sampler, similarity), "near-links"))


def _most_central(members: DataFrame) -> DataFrame:
    """(bucket, leader): of each bucket the member whose buckets hold the most texts."""
    order = Window.partitionBy("bucket").orderBy(F.desc("mates"), "key")
    return members.withColumn("place", F.row_number().over(order)).where(F.col("place") == 1).select("bucket", F.col("key").alias("leader"))


def _led(members: DataFrame, leaders: DataFrame) -> DataFrame:
    """Pairs (u, v) of members and the leader of their bucket."""
    return members.join(leaders, "bucket").where("key <> leader").select(F.least("key", "leader").alias("u"), F.greatest("key", "leader").alias("v"))


def _of_several_classes(members: DataFrame, classes: DataFrame) -> DataFrame:
    """Members with their class, of buckets that hold more than one."""
    rooted = members.join(classes, "key")
    split = rooted.groupBy("bucket").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a <> b").select("bucket")
    return rooted.join(split, "bucket", "left_semi")


def _joined(classes: DataFrame, links: DataFrame) -> DataFrame:
    """Classes (key, root) after links (u, v) between keys: links count once between two classes, so a crowd's links are few."""
    root = lambda name: classes.select(F.col("key").alias(name), F.col("root").alias(f"r{name}"))
    between = links.join(root("u"), "u").join(root("v"), "v").where("ru <> rv").select(F.least("ru", "rv").alias("u"), F.greatest("ru", "rv").alias("v")).distinct()
    merged = components(between, "near").select(F.col("node").alias("root"), F.col("root").alias("to"))
    return stage(classes.join(merged, "root", "left").select("key", F.coalesce("to", "root").alias("root")), "near-classes")


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id (least doc_id of the class), class_rows, class_texts.

    A class is a connected component of links; a null doc_id takes no part in the least one.
    """
    keyed = docs.select("doc_id", text_key(F.coalesce("text", F.lit(""))).alias("key"))
    classes = near_duplicate_classes(docs, similarity)
    per_text = stage(keyed.groupBy("key").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("rows")), "near-per-text")
    rooted = per_text.join(classes, "key", "left").withColumn("root", F.coalesce("root", "key"))
    per_class = rooted.groupBy("root").agg(F.min("first_id").alias("class_id"), F.sum("rows").alias("class_rows"), F.count(F.lit(1)).alias("class_texts"))
    of_text = rooted.select("key", "root").join(per_class, "root").drop("root")
    return keyed.join(of_text, "key").select("doc_id", "class_id", "class_rows", "class_texts")


def one_of_each(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` without the near duplicates: of each class one row stays, the least (doc_id, text); null ids come last."""
    classes = near_duplicate_classes(docs, similarity)
    held = docs.select(text_key(F.coalesce("text", F.lit(""))).alias("k"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("i"),
                       F.struct(*[F.col(c) for c in docs.columns]).alias("row"))
    order = F.struct((F.col("i") == "").alias("none"), F.col("row.doc_id").alias("id"), "k", "i")
    firsts = held.groupBy("k").agg(F.min(order).alias("first"))
    kept = (firsts.join(classes.withColumnRenamed("key", "k"), "k", "left").withColumn("root", F.coalesce("root", "k"))
            .groupBy("root").agg(F.min("first").alias("first")).select("first.k", "first.i"))
    # rows that repeat both id and text collapse to one, the same one in every run
    order = F.xxhash64(*[F.col("row").getField(c) for c, kind in docs.dtypes if not kind.startswith("map")])
    return held.join(kept, ["k", "i"], "left_semi").groupBy("k", "i").agg(F.min_by("row", order).alias("row")).select("row.*")
