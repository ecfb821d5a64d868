"""Nested data: documents seen as arrays of lines, lines as arrays of words."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import nested
from ..operators.rules import Rule, explode_rules
from .registry import Tables, query

_LINES = "lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents)"


def nested_documents(t: Tables):
    """doc_id, lines ARRAY<STRUCT<line, words ARRAY<STRUCT<word>>>>"""
    words = lambda line: F.transform(F.split(line, " "), lambda w: F.struct(w.alias("word")))
    lines = F.transform(F.split("text", "\n"), lambda x: F.struct(x.alias("line"), words(x).alias("words")))
    return t.documents.select("doc_id", lines.alias("lines"))


@query("n1_explode", f"WITH {_LINES} SELECT doc_id, line FROM lines")
def _(t):
    return nested.unnest(nested_documents(t), "lines", "l").select("doc_id", "l.line")


@query("n2_explode_outer", f"""WITH {_LINES}, long AS (SELECT doc_id, line FROM lines WHERE length(line) > 400)
SELECT doc_id, line FROM documents LEFT JOIN long USING (doc_id)""")
def _(t):
    longer = F.filter("lines", lambda l: F.length(l["line"]) > 400)
    kept = nested_documents(t).withColumn("lines", longer)
    return nested.unnest(kept, "lines", "l", outer=True).select("doc_id", "l.line")


@query("n3_first_element", f"WITH {_LINES} SELECT doc_id, line AS first FROM lines WHERE pos = 1")
def _(t):
    return nested_documents(t).select("doc_id", nested.first_element(F.col("lines"))["line"].alias("first"))


@query("n4_explode_chain", f"""WITH {_LINES}, words AS (SELECT doc_id, unnest(string_split(line, ' ')) AS word FROM lines)
SELECT doc_id, length(word)::INTEGER AS n, count(*) AS words FROM words GROUP BY 1, 2""")
def _(t):
    chain = nested.unnest_chain(nested_documents(t), ("lines", "l"), ("l.words", "w"))
    return chain.groupBy("doc_id", F.length("w.word").alias("n")).agg(F.count(F.lit(1)).alias("words"))


@query("n5_exists_nested", """
SELECT doc_id, CASE WHEN EXISTS (SELECT 1 FROM (SELECT unnest(string_split(text, chr(10))) AS line) WHERE
  list_bool_or(list_transform(string_split(line, ' '), lambda w: upper(w) LIKE 'TH%'))) THEN 1 ELSE 0 END AS flag FROM documents""")
def _(t):
    hit = nested.any_nested(F.col("lines"), "words", lambda w: F.upper(w["word"]).startswith("TH"))
    return nested_documents(t).select("doc_id", F.when(hit, 1).otherwise(0).alias("flag"))


@query("n6_rebuild_array", f"WITH {_LINES} SELECT doc_id, line, length(line)::INTEGER AS size, NULL::DECIMAL(38,9) AS total_afectos FROM lines")
def _(t):
    rebuilt = nested.rebuild(F.col("lines"), size=lambda l: F.length(l["line"]), total_afectos=lambda l: F.lit(None).cast("decimal(38,9)"))
    return (nested.unnest(nested_documents(t).withColumn("lines", rebuilt), "lines", "l")
            .select("doc_id", "l.line", "l.size", "l.total_afectos"))


@query("n7_struct_fields", "SELECT o_orderkey, o_orderstatus, o_totalprice * 2 AS doubled FROM orders")
def _(t):
    packed = t.orders.select("o_orderkey", F.struct("o_orderstatus", F.struct((F.col("o_totalprice") * 2).alias("doubled")).alias("inner")).alias("s"))
    return packed.select("o_orderkey", "s.o_orderstatus", "s.inner.doubled")


@query("n8_decimal_normaliser", """
SELECT o_orderkey, (o_totalprice::DECIMAL(18,2) / 8)::DECIMAL(38,9) AS subtotal, CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 1 END AS items,
  CASE WHEN o_orderstatus <> 'P' THEN (o_totalprice::DECIMAL(18,2) / 16)::DECIMAL(38,9) END AS importe FROM orders""")
def _(t):
    schema = T.StructType.fromDDL("totales struct<subtotal: decimal(38,9)>, items array<struct<importe: decimal(38,9)>>")
    price = F.col("o_totalprice")
    raw = t.orders.select("o_orderkey", F.struct((price / 8).alias("subtotal")).alias("totales"),
                          F.when(F.col("o_orderstatus") != "P", F.array(F.struct((price / 16).alias("importe")))).alias("items"))
    done = nested.normalise_records(raw, schema)
    return done.select("o_orderkey", "totales.subtotal", F.size("items").alias("items"),
                       nested.first_element(F.col("items"))["importe"].alias("importe"))


@query("n9_condition_messages", """
SELECT o_orderkey, unnest(list_filter([CASE WHEN o_totalprice > 400000 THEN 'alto' END, CASE WHEN o_orderstatus = 'P' THEN 'pendiente' END,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'urgente' END], lambda m: m IS NOT NULL)) AS reglas_mensaje FROM orders""")
def _(t):
    rules = [Rule("high", F.col("o_totalprice") > 400000, "alto"), Rule("open", F.col("o_orderstatus") == "P", "pendiente"),
             Rule("urgent", F.col("o_orderpriority") == "1-URGENT", "urgente")]
    fired = explode_rules(t.orders, "o_orderkey", rules, ["o_orderkey"])
    return fired.where(F.col("estado") == "OBSERVADA").drop("estado")
