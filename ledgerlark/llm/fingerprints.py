"""SimHash fingerprints and their search by permuted block tables, in DataFrame operations only.

A word votes with its length on each of 64 bits, for or against as the bits of its hash say, once for
each time it occurs; a fingerprint holds the signs of the sums.  Two counters share one long (32 bits each), so 32 sums serve
64 bits; a text may weigh up to four thousand million characters.

Search: 64 bits are cut into ``BLOCKS`` blocks.  Fingerprints that differ in at most ``RADIUS`` bits agree in
``BLOCKS - RADIUS`` whole blocks at least, so a table for each choice of that many blocks, keyed by their
bits, holds all of them; each meeting is verified by its distance.

The next document of each one (by descending doc_id) is found without one task for all: rows are dealt
out to ranges of doc_id, of which each also gets the first row of the one below.

Defined results: a null text is empty, and without words the fingerprint is 0; equal texts have equal fingerprints; rows of equal doc_id follow each other by
text, null ids come last; a single row is its own next one; rows that repeat are fingerprinted each; other columns are not read.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

BLOCKS, RADIUS, SEGMENTS = 6, 3, 64
_LANES = (1 << 32) | 1
_LEAST = -(1 << 63)


def words_of(text: Column) -> Column:
    return F.split(text, "[ \t\n\x0b\x0c\r]+")


def _votes(h: Column, weight: Column) -> list[Column]:
    """Sums of the votes for bits i and i + 32, in the low and the high half of each number."""
    return [F.sum(F.shiftrightunsigned(h, i).bitwiseAND(F.lit(_LANES)) * weight).alias(f"lanes{i}") for i in range(32)]


def _signs() -> Column:
    bits = []
    for i in range(32):
        low, high = F.col(f"lanes{i}").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(F.col(f"lanes{i}"), 32)
        bits.append(F.when(low * 2 > F.col("weight"), F.lit(1 << i)).otherwise(F.lit(0).cast("bigint")))
        bits.append(F.when(high * 2 > F.col("weight"), F.lit(1 << (i + 32) if i < 31 else _LEAST)).otherwise(F.lit(0).cast("bigint")))
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def fingerprints(texts: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, fingerprint) of rows (keys, text); the keys tell the rows apart."""
    words = texts.select(*keys, F.explode(words_of(F.col("text"))).alias("word"))
    words = words.select(*keys, F.xxhash64("word").alias("h"), F.length("word").cast("bigint").alias("w"))
    sums = words.groupBy(*keys).agg(F.sum("w").alias("weight"), *_votes(F.col("h"), F.col("w")))
    return sums.select(*keys, _signs().alias("fingerprint"))


def likeness(a: Column, b: Column) -> Column:
    """Share of the bits that agree."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(64.0)


def as_text(fingerprint: Column) -> Column:
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")


def _tables(blocks: int, radius: int) -> list[int]:
    """A mask of bits for each choice of blocks that must agree, as signed numbers."""
    edges = [64 * k // blocks for k in range(blocks + 1)]
    masks = [sum(1 << b for b in range(edges[k], edges[k + 1])) for k in range(blocks)]
    chosen = [sum(c) for c in combinations(masks, blocks - radius)]
    return [m - (1 << 64) if m >> 63 else m for m in chosen]


def within_radius(queries: DataFrame, known: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """(query, fingerprint, distance): every fingerprint of ``known`` within ``radius`` bits of one of ``queries``.

    Both hold a column ``fingerprint``; each different fingerprint counts once.
    """
    tables = _tables(blocks, radius)

    def keyed(df: DataFrame, name: str) -> DataFrame:
        df = df.select("fingerprint").where("fingerprint is not null").distinct()
        table = F.explode(F.array(*[F.xxhash64(F.lit(n), F.col("fingerprint").bitwiseAND(F.lit(mask))) for n, mask in enumerate(tables)]))
        return df.select(F.col("fingerprint").alias(name), table.alias("key"))

    distance = F.bit_count(F.col("query").bitwiseXOR(F.col("fingerprint")))
    met = keyed(queries, "query").join(keyed(known, "fingerprint"), "key").withColumn("distance", distance)
    return met.where(F.col("distance") <= radius).select("query", "fingerprint", "distance").distinct()


def with_next(docs: DataFrame) -> DataFrame:
    """row, doc_id, text, next_row and next_text of every row; text is never null."""
    spark = docs.sparkSession
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.coalesce("text", F.lit("")).alias("text"),
                       F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LEAST)).alias("k"))
    ids = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LEAST)).alias("k"))
    bounds = ids.agg(F.percentile_approx("k", [i / SEGMENTS for i in range(SEGMENTS + 1)], 10_000).alias("b")).collect()[0]["b"]
    if not bounds:
        return rows.select("row", "doc_id", "text", F.col("row").alias("next_row"), F.col("text").alias("next_text"))
    bounds = sorted(set(bounds))
    fine = -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // SEGMENTS)

    def range_of(lo: int, hi: int) -> Column:
        """The segment by bisection, then an equal slice of its ids."""
        if hi - lo > 1:
            mid = (lo + hi) // 2
            return F.when(F.col("k") < F.lit(bounds[mid]), range_of(lo, mid)).otherwise(range_of(mid, hi))
        width = max(1.0, float(bounds[lo + 1] - bounds[lo])) if lo + 1 < len(bounds) else 1.0
        slice_ = F.floor((F.col("k").cast("double") - float(bounds[lo])) * fine / width)
        return (F.greatest(F.lit(0), F.least(slice_, F.lit(fine - 1))) + lo * fine).cast("bigint")

    place = range_of(0, len(bounds))
    # one row for each range that has rows: at most (SEGMENTS + 1) * fine, so small enough to send to all tasks
    tops = ids.select(place.alias("range"), "k").groupBy("range").agg(F.max("k").alias("k"))
    up = Window.orderBy("range")
    tops = tops.select("k", F.coalesce(F.lead("range").over(up), F.min("range").over(Window.orderBy(F.lit(1)))).alias("also"))
    spread = rows.withColumn("range", place).join(F.broadcast(tops), "k", "left")
    spread = spread.withColumn("to", F.explode(F.when(F.col("also").isNull(), F.array(F.struct("range", F.lit(0).alias("guest"))))
                                               .otherwise(F.array(F.struct("range", F.lit(0).alias("guest")), F.struct(F.col("also").alias("range"), F.lit(1).alias("guest"))))))
    order = Window.partitionBy("to.range").orderBy("to.guest", F.desc("k"), "text")
    led = spread.select("row", "doc_id", "text", "to", F.lead("row").over(order).alias("next_row"), F.lead("text").over(order).alias("next_text"))
    return led.where("to.guest = 0").drop("to")


def edited(text: Column, other: Column) -> Column:
    """``text`` with its last half (rounded down, in code points) replaced by as much of the start of ``other``."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substr(text, F.lit(1), F.length(text) - half), F.substr(other, F.lit(1), half))


def document_fingerprints(docs: DataFrame, is_query: Column) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next; n_near for rows that ``is_query`` marks.

    ``n_near``: other rows of ``docs`` whose fingerprint is within ``RADIUS`` bits.
    """
    pairs = with_next(docs).select("row", "next_row", "doc_id", F.length("text").cast("bigint").alias("n_chars"), "text", edited(F.col("text"), F.col("next_text")).alias("edited"))
    kinds = F.explode(F.array(F.struct(F.lit(0).alias("kind"), F.col("text").alias("text")), F.struct(F.lit(1).alias("kind"), F.col("edited").alias("text"))))
    both = pairs.select("row", "next_row", "doc_id", "n_chars", F.sha2("edited", 256).alias("sha"), kinds.alias("k"))
    marks = fingerprints(both.select("row", "next_row", "doc_id", "n_chars", "sha", "k.kind", "k.text"), ["row", "next_row", "doc_id", "n_chars", "sha", "kind"])
    mine = (marks.groupBy("row", "next_row", "doc_id", "n_chars", "sha")
            .agg(F.max(F.when(F.col("kind") == 0, F.col("fingerprint"))).alias("fingerprint"), F.max(F.when(F.col("kind") == 1, F.col("fingerprint"))).alias("other")))
    mine = stage(mine, "fingerprints")
    next_ = mine.select(F.col("row").alias("next_row"), F.col("fingerprint").alias("next_fingerprint"))
    crowd = mine.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("rows"))
    near = (within_radius(mine.where(is_query), crowd).join(crowd, "fingerprint").groupBy(F.col("query").alias("fingerprint")).agg((F.sum("rows") - 1).alias("found")))
    return (mine.join(next_, "next_row", "left").join(near, "fingerprint", "left")
            .select("doc_id", "n_chars", F.col("sha").alias("edited_sha256"), as_text(F.col("fingerprint")).alias("fingerprint"), as_text(F.col("other")).alias("edited_fingerprint"),
                    likeness(F.col("fingerprint"), F.col("other")).alias("near_edited"), likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
                    F.when(is_query, F.col("found")).alias("n_near")))
