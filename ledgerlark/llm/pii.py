"""Personal data by bootstrapped contextual extraction.

Base patterns find e-mail addresses, ip addresses, card and phone numbers.  They are the seeds: the words
before and after them, together with the shape of the text between, are lexical patterns.  Candidates
are stretches that look like an identifier but that no base pattern takes.  Seeds and candidates alike
are instances; instances with the same words around the same shape are one node of a graph between
patterns and instances.  Spark scores it round by round: a pattern is trusted for a kind by the share of
that kind among its known instances, if it has at least ``SUPPORT`` of them.  Apart from the shape, it is trusted by the
share among known and unknown instances alike, so words can vouch for a form not seen yet; an instance is found when the
patterns that hold it leave little doubt (noisy or); what is found counts as known in the next round.
Rounds end when one finds nothing.

Texts are read once.  What is kept of them are spans and the nodes of candidates; the graph is aggregated before
anything meets, so a common word or passage is one row.

Defined results: null and empty texts have no spans; base spans always stay, and an added one never
overlaps a base span or another added one of its text; rows that repeat are read each; other columns are not read; an empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage

KINDS = ("email", "ip", "card", "phone")
SUPPORT, TRUST = 5, 0.95

# fixed values: the base patterns
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile("[0-9]+")

#: Stretches that may be a number of a person: runs of digits joined by a few marks.
_NUMBER = re.compile(r"[+(]?[0-9]++(?:[\x20().+-]{1,3}[0-9]++)*+")
_ADDRESS = re.compile(r"\S++")
_MARKS = ".,;:!?*#$%&()[]\"'|<>"
_LEAST_DIGITS, CONTEXT = 7, 24

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def emails(text: str) -> list[Span]:
    """Leftmost matches, each at sign looked at once: what stands before it, back to the last match, is its local part."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        found = _DOMAIN.match(text, at)
        start = at
        if found:
            while start > free and text[start - 1] in _LOCAL:
                start -= 1
        if found and start < at:
            out.append(("email", start, found.end()))
            free = found.end()
            at = text.find("@", free)
        else:
            at = text.find("@", at + 1)
    return out


def base_spans(text: str) -> list[Span]:
    """The base patterns' spans, by kind and start; a match that fails its test is dropped whole."""
    out = emails(text) if "@" in text else []
    if "." in text:
        out += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or "0") < 256 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
    if "+" in text:
        out += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= sum(map(len, _DIGITS.findall(m[0]))) <= 15]
    return out


def shape_of(piece: str) -> str:
    """An identifier's form: runs of digits by their length, runs of letters as one a, marks as they are."""
    return re.sub("[0-9]+", lambda m: f"9{{{len(m[0])}}}" if len(m[0]) > 4 else "9", re.sub(r"[^\W\d_]+", "a", piece))


def _around(text: str, start: int, end: int) -> tuple[str, str]:
    """The word before and the word after, in lower case and without marks at their edges; only so far as ``CONTEXT`` reaches."""
    before = text[max(0, start - CONTEXT):start].split()
    after = text[end:end + CONTEXT].split()
    clean = lambda w: w.strip(_MARKS).lower()
    return clean(before[-1]) if before else "", clean(after[0]) if after else ""


def candidates(text: str, base: list[Span]) -> list[tuple[int, int]]:
    """Likely stretches that no base span touches, in order."""
    likely = []
    for m in _NUMBER.finditer(text):
        if m.end() - m.start() >= _LEAST_DIGITS and sum(map(len, _DIGITS.findall(m[0]))) >= _LEAST_DIGITS:
            if not (m.start() and text[m.start() - 1].isalnum()) and not (m.end() < len(text) and text[m.end()].isalnum()):
                likely.append((m.start(), m.end()))
    if "@" in text:
        for m in _ADDRESS.finditer(text):
            if "@" in m[0]:
                bare = m[0].strip(_MARKS)
                if len(bare) > 2 and "@" in bare[1:-1]:
                    start = m.start() + m[0].index(bare)
                    likely.append((start, start + len(bare)))
    taken, out, k, free = sorted((s, e) for _, s, e in base), [], 0, 0
    ends = list(accumulate((e for _, e in taken), max))
    for start, end in sorted(likely):
        while k < len(taken) and ends[k] <= start:
            k += 1
        if start >= free and (k == len(taken) or taken[k][0] >= end):
            out.append((start, end))
            free = end
    return out


_ROWS = ("doc_id bigint, counts array<bigint>, base array<struct<kind:int,start:bigint,end:bigint>>, base_sha256 string, "
         "nodes array<struct<kind:int,start:bigint,end:bigint,before:string,shape:string,after:string>>")
_SPAN = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())])
_NODE = pa.struct([*_SPAN, ("before", pa.string()), ("shape", pa.string()), ("after", pa.string())])


def read_texts(docs: DataFrame) -> DataFrame:
    """Base spans and nodes (kind null for a candidate) of every row's whole text."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, spans, digests, nodes = [], [], [], []
            for text in batch.column(1):
                text = text.as_py() or ""
                base = base_spans(text)
                spans.append([(KINDS.index(k), s, e) for k, s, e in base])
                counts.append([sum(k == kind for k, _, _ in base) for kind in KINDS])
                digests.append(hashlib.sha256(",".join([f"{k}:{s}:{e}" for k, s, e in base]).encode()).hexdigest())
                row = []
                for kind, s, e in [*spans[-1], *[(None, s, e) for s, e in candidates(text, base)]]:
                    before, after = _around(text, s, e)
                    row.append((kind, s, e, before, shape_of(text[s:e]), after))
                nodes.append(row)
            as_structs = lambda rows, kind: pa.array([[dict(zip(kind.names, x)) for x in row] for row in rows], pa.list_(kind))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.list_(pa.int64())), as_structs(spans, _SPAN), pa.array(digests), as_structs(nodes, _NODE)],
                                             ["doc_id", "counts", "base", "base_sha256", "nodes"])

    return docs.select("doc_id", "text").mapInArrow(read, _ROWS)


def found_nodes(seen: DataFrame, support: int = SUPPORT, trust: float = TRUST) -> DataFrame:
    """(before, shape, after, kind): the nodes of candidates that the scored graph takes for a kind.

    ``seen`` holds (kind, before, shape, after, n), aggregated; kind is null for candidates.
    """
    node = ["before", "shape", "after"]
    known, open_ = seen.where("kind is not null"), stage(seen.where("kind is null").select(*node, "n"), "pii-open")
    patterns = F.explode(F.array(F.struct(F.lit("before").alias("side"), F.col("before").alias("word")), F.struct(F.lit("after").alias("side"), F.col("after").alias("word"))))
    all_found = None
    while True:
        by_kind = known.select("kind", "shape", "n", patterns.alias("p")).groupBy("p", "shape", "kind").agg(F.sum("n").alias("n"))
        # of each pattern the best kind and its share of what is known there
        best = (by_kind.groupBy("p", "shape").agg(F.max(F.struct("n", (-F.col("kind")).alias("minus"))).alias("top"), F.sum("n").alias("known"))
                .where(F.col("known") >= support).select("p", "shape", (-F.col("top.minus")).alias("kind"), (F.col("top.n") / (F.col("known") + 0.1)).alias("share")))
        asked = open_.select(*node, "n", patterns.alias("p"))
        # the same apart from the shape, where all that is still unknown there counts against the pattern
        unknown = asked.groupBy("p").agg(F.sum("n").alias("unknown"))
        wide = (by_kind.groupBy("p", "kind").agg(F.sum("n").alias("n")).groupBy("p").agg(F.max(F.struct("n", (-F.col("kind")).alias("minus"))).alias("top"), F.sum("n").alias("known"))
                .where(F.col("known") >= support).join(unknown, "p")
                .select("p", (-F.col("top.minus")).alias("kind"), (F.col("top.n") / (F.col("known") + F.col("unknown") + 0.1)).alias("share")))
        likely = (F.col("kind") == KINDS.index("email")) == F.col("shape").contains("@")
        voices = asked.join(best, ["p", "shape"]).select(*node, "p", "kind", "share").unionByName(asked.join(wide, "p").where(likely).select(*node, "p", "kind", "share"))
        votes = voices.groupBy(*node, "p", "kind").agg(F.max("share").alias("share")).groupBy(*node, "kind").agg((1 - F.exp(F.sum(F.log(1.000001 - F.col("share"))))).alias("score"))
        top = votes.groupBy(*node).agg(F.max(F.struct("score", (-F.col("kind")).alias("minus"))).alias("top")).where(F.col("top.score") >= trust)
        new = stage(top.select(*node, (-F.col("top.minus")).alias("kind")), "pii-found")
        all_found = new if all_found is None else all_found.unionByName(new)
        if not new.limit(1).count():
            return all_found
        known = known.unionByName(open_.join(new, node).select(*[c for c in known.columns]))
        open_ = stage(open_.join(new, node, "left_anti"), "pii-open")


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans (base and added) and n_added of every row."""
    read = stage(read_texts(docs).withColumn("row", F.monotonically_increasing_id()), "pii-read")
    seen = stage(read.select(F.explode("nodes").alias("x")).groupBy("x.kind", "x.before", "x.shape", "x.after").agg(F.count(F.lit(1)).alias("n")), "pii-seen")
    found = found_nodes(seen)
    added = (read.select("row", F.explode("nodes").alias("x")).where("x.kind is null").select("row", "x.start", "x.end", "x.before", "x.shape", "x.after")
             .join(found, ["before", "shape", "after"]).groupBy("row").agg(F.collect_list(F.struct(F.col("kind").cast("int").alias("kind"), "start", "end")).alias("added")))
    met = read.drop("nodes").join(added, "row", "left")
    none = F.array().cast("array<struct<kind:int,start:bigint,end:bigint>>")
    spans = F.array_sort(F.concat("base", F.coalesce("added", none)))
    names = F.array(*map(F.lit, KINDS))
    text = F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")
    return met.select("doc_id", *[F.get("counts", F.lit(k)).alias(f"n_{kind}") for k, kind in enumerate(KINDS)], "base_sha256", text.alias("spans"),
                      F.coalesce(F.size("added"), F.lit(0)).alias("n_added"))
