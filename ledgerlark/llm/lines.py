"""Line dedup by a log-template tree, in DataFrame operations only.

The tree has a fixed depth: a line goes down by its number of tokens, then by its first ``LEADING``
tokens.  A token that holds a digit is a variable field, ``<*>``.  In a leaf, a position keeps the
tokens that recur there in at least ``min_docs`` texts; any other token is a variable field too.  A
line's template is its tokens so generalised; at least half of them must be constant.

A template recurs if at least ``min_docs`` different texts hold it, where a text of which more than half
(in characters) lies in such lines does not count: that is a copy of other documents, for document
dedup to judge, not a host of boilerplate.  Lines of recurring templates are dropped from all
documents.  Equal texts count once.

Lines are first counted by leaf, as numbers; only lines of leaves that reach ``min_docs`` are looked at
token by token.  The texts move once, to meet their decisions.

Defined results: null is an empty text of one empty line, and stays null; empty lines and lines of
fewer than ``min_tokens`` tokens are kept; repeated rows are treated alike; a text whose lines are all
dropped becomes empty and its row stays; other columns pass through unread; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage, text_key

LEADING, MIN_DOCS, MIN_TOKENS = 3, 10, 3
FIELD = "<*>"
BLANK = " \t\x0b\f\r"


def _generalised(token: Column) -> Column:
    return F.when(token.rlike("[0-9]"), F.lit(FIELD)).otherwise(token)


def _recurring(held: DataFrame, what: str, min_docs: int) -> DataFrame:
    """Values of ``what`` that at least ``min_docs`` different texts hold; rows of a text count once."""
    return (held.select(what, "key").distinct().groupBy(what).agg(F.count(F.lit(1)).alias("texts"))
            .where(F.col("texts") >= min_docs).select(what))


def _lines(docs: DataFrame, leading: int, min_tokens: int) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    lines = docs.select(text_key(text).alias("key"), F.length(text).alias("chars"), F.posexplode(F.split(text, "\n")).alias("position", "line"))
    lines = lines.withColumn("tokens", F.split(F.btrim("line", F.lit(BLANK)), f"[{BLANK}]+")).where(F.size("tokens") >= min_tokens)
    first = [_generalised(F.coalesce(F.get("tokens", F.lit(i)), F.lit(""))) for i in range(leading)]
    return lines.select("key", "chars", "position", F.length("line").alias("width"), "tokens", F.xxhash64(F.size("tokens"), *first).alias("leaf"))


def recurring_lines(docs: DataFrame, min_docs: int = MIN_DOCS, leading: int = LEADING, min_tokens: int = MIN_TOKENS) -> DataFrame:
    """(key, positions): for each text that has some, the places of its lines with a recurring template."""
    lines = _lines(docs, leading, min_tokens)
    leaves = stage(_recurring(lines, "leaf", min_docs), "line-leaves")
    lively = stage(lines.join(leaves, "leaf"), "line-lively")

    cells = lively.select("key", "chars", "position", "width", "leaf", F.size("tokens").alias("n"), F.posexplode("tokens").alias("at", "token"))
    cells = cells.withColumn("token", _generalised(F.col("token"))).withColumn("cell", F.xxhash64("leaf", "at", "token"))
    constant = _recurring(cells.where(F.col("token") != FIELD), "cell", min_docs).withColumn("fixed", F.lit(1))
    # equal texts repeat every row of a line equally often: ``times``, the rows of its first token, divides that out
    halves = [F.when(F.col("fixed") == 1, F.pmod(F.shiftright("cell", shift), F.lit(1 << 31))).otherwise(0) for shift in (0, 31)]
    shaped = (cells.join(constant, "cell", "left")
              .groupBy("key", "position", "chars", "width", "leaf", "n")
              .agg(F.count(F.when(F.col("at") == 0, 1)).alias("times"), F.count("fixed").alias("constants"), *[F.sum(h).alias(f"half{i}") for i, h in enumerate(halves)])
              .where(F.col("constants") * 2 >= F.col("n") * F.col("times"))
              .select("key", "position", "chars", "width", F.xxhash64("leaf", *[F.expr(f"half{i} div times") for i in (0, 1)]).alias("template")))
    shaped = stage(shaped, "line-shaped")

    often = shaped.join(_recurring(shaped, "template", min_docs), "template")
    hosts = often.groupBy("key", "chars").agg(F.sum("width").alias("inside")).where(F.col("inside") * 2 <= F.col("chars")).select("key")
    dropped = _recurring(often.join(hosts, "key"), "template", min_docs)
    return shaped.join(dropped, "template").groupBy("key").agg(F.collect_list("position").alias("positions"))


def drop_recurring_lines(docs: DataFrame, min_docs: int = MIN_DOCS, leading: int = LEADING, min_tokens: int = MIN_TOKENS) -> DataFrame:
    """``docs`` with ``text`` without its lines of recurring templates, then ``n_lines`` and ``n_dropped`` of each row."""
    decided = stage(recurring_lines(docs, min_docs, leading, min_tokens), "line-positions")
    held = docs.select(text_key(F.coalesce("text", F.lit(""))).alias("key"), F.struct(*[F.col(c) for c in docs.columns]).alias("row"))
    met = held.join(decided, "key", "left")
    lines = F.split(F.coalesce("row.text", F.lit("")), "\n")
    kept = F.array_join(F.filter(lines, lambda line, at: ~F.array_contains("positions", at)), "\n")
    text = F.when(F.col("positions").isNull(), F.col("row.text")).otherwise(kept)
    return met.select(*[text.alias(c) if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns],
                      F.size(lines).alias("n_lines"), F.coalesce(F.size("positions"), F.lit(0)).alias("n_dropped"))


#: The same rows in DuckDB, for doc_id, text, n_lines and n_dropped.
LINES_SQL = rf"""
WITH texts AS (SELECT DISTINCT coalesce(text, '') AS t FROM {{documents}}),
split AS (SELECT t, string_split(t, chr(10)) AS lines FROM texts),
lines AS (SELECT t, length(t) AS chars, unnest(lines) AS line, generate_subscripts(lines, 1) AS position FROM split),
tokens AS (
  SELECT t, chars, position, length(line) AS width,
         list_transform(regexp_split_to_array(trim(line, chr(32)||chr(9)||chr(11)||chr(12)||chr(13)), '[ \t\x0B\f\r]+'),
                        lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN '{FIELD}' ELSE x END) AS tokens
  FROM lines),
placed AS (SELECT *, len(tokens) AS n, tokens[1:{LEADING}] AS lead3 FROM tokens WHERE len(tokens) >= {MIN_TOKENS}),
leaves AS (SELECT n, lead3 FROM placed GROUP BY ALL HAVING count(DISTINCT t) >= {MIN_DOCS}),
lively AS (SELECT placed.* FROM placed JOIN leaves USING (n, lead3)),
cells AS (SELECT t, chars, position, width, n, lead3, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS place FROM lively),
fixed AS (SELECT n, lead3, place, token FROM cells WHERE token <> '{FIELD}' GROUP BY ALL HAVING count(DISTINCT t) >= {MIN_DOCS}),
shaped AS (
  SELECT t, chars, position, width, n, lead3, list(place || ':' || c.token ORDER BY place) FILTER (WHERE f.token IS NOT NULL) AS template
  FROM cells c LEFT JOIN fixed f USING (n, lead3, place, token)
  GROUP BY t, chars, position, width, n, lead3 HAVING count(f.token) * 2 >= n),
often AS (
  SELECT s.* FROM shaped s
  JOIN (SELECT n, lead3, template FROM shaped GROUP BY ALL HAVING count(DISTINCT t) >= {MIN_DOCS}) USING (n, lead3, template)),
hosts AS (SELECT t FROM often GROUP BY t, chars HAVING sum(width) * 2 <= chars),
dropped AS (SELECT n, lead3, template FROM often JOIN hosts USING (t) GROUP BY ALL HAVING count(DISTINCT t) >= {MIN_DOCS}),
positions AS (SELECT t, list(position) AS gone FROM shaped JOIN dropped USING (n, lead3, template) GROUP BY t)
SELECT d.doc_id,
       CASE WHEN p.t IS NULL THEN d.text ELSE array_to_string(list_filter(split.lines, lambda x, i: NOT list_contains(p.gone, i)), chr(10)) END AS text,
       CAST(len(split.lines) AS INTEGER) AS n_lines, CAST(coalesce(len(p.gone), 0) AS INTEGER) AS n_dropped
FROM {{documents}} d JOIN split ON split.t = coalesce(d.text, '') LEFT JOIN positions p ON p.t = split.t
"""


def with_lines_dropped(docs: DataFrame, **parameters) -> DataFrame:
    """``docs`` with its own columns only: ``text`` without recurring lines, ``n_chars`` (if there is one) of the new text."""
    out = drop_recurring_lines(docs.select(*docs.columns), **parameters)
    n_chars = F.when(F.col("n_dropped") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars")) if "n_chars" in docs.columns else None
    return out.select(*[n_chars.alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])
