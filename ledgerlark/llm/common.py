"""Helpers the operators share: written stages, connected components, words of a text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.incremental import shared_folder

WHITE_SPACE = b" \t\n\x0b\x0c\r"
SHINGLE_WORDS = 5
_STRETCH = 1 << 20


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the cluster's shared folder and read it back: later plans start from the files."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_key(text: Column) -> Column:
    """16 bytes that stand for a text; equal texts have equal keys."""
    return F.unhex(F.md5(text))


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of undirected edges (u, v): one row (node, root) per node, root the least node.

    Each round takes the least label among a node's neighbours and then the label of that label,
    so long chains shrink by halves.  Rounds are written tables; a round that changes nothing ends it.
    """
    both = stage(edges.select("u", "v").where("u <> v")
                 .select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e"))
                 .select("e.*").distinct(), f"{name}-edges")
    labels = stage(both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("near"))
                   .select("node", F.least("node", "near").alias("root"), F.lit(True).alias("moved")), f"{name}-labels")
    while labels.where("moved").limit(1).count():
        near = (both.join(labels.select(F.col("node").alias("v"), "root"), "v")
                .groupBy(F.col("u").alias("node")).agg(F.min("root").alias("near")))
        stepped = (labels.select("node", F.col("root").alias("was")).join(near, "node")
                   .select("node", "was", F.least("was", "near").alias("to")))
        jumped = stepped.join(labels.select(F.col("node").alias("to"), "root"), "to")
        labels = stage(jumped.select("node", "root", (F.col("root") < F.col("was")).alias("moved")), f"{name}-labels")
    return labels.select("node", "root")


# --- words and shingles of a text, as 64-bit numbers -------------------------------------------------

_IS_WORD = np.ones(256, bool)
_IS_WORD[list(WHITE_SPACE)] = False
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _powers(base: np.uint64) -> np.ndarray:
    out = np.full(_STRETCH + 1, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_UP, _DOWN = _powers(_BASE), _powers(_BACK)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _stretch_hashes(data: np.ndarray) -> np.ndarray:
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = _IS_WORD[data]
    edges = np.flatnonzero(np.diff(inside))
    starts, ends = edges[::2], edges[1::2]
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _UP[:len(data)], out=total[1:])
    return mixed((total[ends] - total[starts]) * _DOWN[starts] + (ends - starts).astype(np.uint64))


def word_hashes(data: np.ndarray) -> np.ndarray:
    """One number per white-space separated word of UTF-8 bytes, in order; long texts go by stretches."""
    if len(data) <= _STRETCH:
        return _stretch_hashes(data)
    out, at = [], 0
    while at < len(data):
        end = min(at + _STRETCH, len(data))
        if end < len(data):
            breaks = np.flatnonzero(~_IS_WORD[data[at:end]])
            if len(breaks):
                end = at + int(breaks[-1]) + 1
            else:  # one word longer than a stretch: hashed by Python, whole
                stop = np.flatnonzero(~_IS_WORD[data[end:]])
                end = end + int(stop[0]) if len(stop) else len(data)
                number = np.array([hash_bytes(data[at:end].tobytes())], np.uint64)
                out.append(number)
                at = end
                continue
        out.append(_stretch_hashes(data[at:end]))
        at = end
    return np.concatenate(out)


def hash_bytes(data: bytes) -> int:
    import xxhash
    return xxhash.xxh64_intdigest(data)


def shingles(data: np.ndarray, words: int = SHINGLE_WORDS) -> np.ndarray:
    """Numbers of all runs of ``words`` words; a shorter text is one run; a text without words has none."""
    h = word_hashes(data)
    n = len(h) - words + 1
    if n < 1:
        n, words = min(1, len(h)), len(h)
    out = np.full(n, words, np.uint64)
    for k in range(words):
        out = (out ^ h[k:k + n]) * _BASE
        out ^= out >> np.uint64(29)
    return mixed(out)


def byte_rows(column: pa.Array) -> Iterator[np.ndarray]:
    """The UTF-8 bytes of each row of an Arrow string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, places, content = column.buffers()
    places = np.frombuffer(places, width)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(content, np.uint8) if content is not None and content.size else np.zeros(0, np.uint8)
    for start, end in zip(places[:-1].tolist(), places[1:].tolist()):
        yield data[start:end]
