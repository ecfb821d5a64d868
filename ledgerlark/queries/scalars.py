"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, money, text
from ..operators import timeseries as ts
from .registry import query, r6, sql_r6

_NAMES = "SELECT p_partkey, p_name, p_type, p_brand FROM part"


@query("f1_case_trim_length", """
SELECT p_partkey, upper(p_name) AS up, lower(p_type) AS low, trim('  ' || p_name || ' ') AS trimmed, length(p_name)::INTEGER AS n,
  reverse(p_name) AS back, rtrim(p_brand || '  ') AS right_trimmed FROM part""")
def _(t):
    return t.part.select("p_partkey", F.upper("p_name").alias("up"), F.lower("p_type").alias("low"),
                         F.trim(F.concat(F.lit("  "), "p_name", F.lit(" "))).alias("trimmed"), F.length("p_name").alias("n"),
                         F.reverse("p_name").alias("back"), F.rtrim(F.concat("p_brand", F.lit("  "))).alias("right_trimmed"))


@query("f2_nested_replace", "SELECT doc_id, replace(replace(replace(text, '.', ''), ',', ''), chr(10), ' ') AS flat FROM documents")
def _(t):
    flat = F.replace(F.replace(F.replace("text", F.lit("."), F.lit("")), F.lit(","), F.lit("")), F.lit("\n"), F.lit(" "))
    return t.documents.select("doc_id", flat.alias("flat"))


@query("f3_regexp_replace", r"SELECT doc_id, regexp_replace(regexp_replace(text, '[0-9]', '', 'g'), '([A-Za-z]) +([a-z])', '\1_\2', 'g') AS cleaned FROM documents")
def _(t):
    cleaned = F.regexp_replace(F.regexp_replace("text", "[0-9]", ""), "([A-Za-z]) +([a-z])", "$1_$2")
    return t.documents.select("doc_id", cleaned.alias("cleaned"))


@query("f4_regexp_extract", r"SELECT doc_id, nullif(regexp_extract(text, '\d+', 0), '') AS number FROM documents")
def _(t):
    return t.documents.select("doc_id", text.extract(F.col("text"), r"\d+").alias("number"))


@query("f5_regexp_contains", r"SELECT lang, count(*) AS n, count(*) FILTER (regexp_matches(text, '[A-Z]{2}')) AS shouting FROM documents GROUP BY 1")
def _(t):
    return t.documents.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("text").rlike("[A-Z]{2}")).alias("shouting"))


@query("f6_substr_position_concat", """
SELECT c_custkey, substr(c_name, 1, 4) || '-' || substr(c_name, 10) AS joined, strpos(c_name, '#')::INTEGER AS at,
  c_name || CASE WHEN c_nationkey > 5 THEN c_mktsegment END AS maybe FROM customer""")
def _(t):
    return t.customer.select("c_custkey", F.concat(F.substring("c_name", 1, 4), F.lit("-"), F.substr("c_name", F.lit(10))).alias("joined"),
                             F.instr("c_name", "#").alias("at"),
                             F.concat("c_name", F.when(F.col("c_nationkey") > 5, F.col("c_mktsegment"))).alias("maybe"))


@query("f7_lpad", "SELECT o_orderkey, 'F' || lpad(o_orderkey::VARCHAR, 8, '0') AS padded, lpad(o_orderkey::VARCHAR, 2, '0') AS cut FROM orders")
def _(t):
    key = F.col("o_orderkey").cast("string")
    return t.orders.select("o_orderkey", text.series_number(F.lit("F"), key).alias("padded"), F.lpad(key, 2, "0").alias("cut"))


@query("f8_split_offset", """
SELECT o_orderkey, string_split(o_orderpriority, '-')[1] AS first, string_split(o_orderpriority, '-')[3] AS missing,
  CASE WHEN len(string_split(o_orderpriority, '-')) = 2 THEN try_cast(string_split(o_orderpriority, '-')[1] AS BIGINT) END AS level FROM orders""")
def _(t):
    parts = F.split("o_orderpriority", "-")
    return t.orders.select("o_orderkey", F.get(parts, F.lit(0)).alias("first"), F.get(parts, F.lit(2)).alias("missing"),
                           F.when(F.size(parts) == 2, F.get(parts, F.lit(0)).try_cast("bigint")).alias("level"))


@query("f9_translate_accents", f"SELECT doc_id, translate(translate(text, '{text.DX_ACCENTED}', '{text.DX_PLAIN}'), '{text.GREEK_LOOKALIKES}', '{text.LATIN_LOOKALIKES}') AS plain FROM documents")
def _(t):
    plain = F.translate(F.translate("text", text.DX_ACCENTED, text.DX_PLAIN), text.GREEK_LOOKALIKES, text.LATIN_LOOKALIKES)
    return t.documents.select("doc_id", plain.alias("plain"))


@query("f10_strip_marks", f"SELECT doc_id, translate(text, '{text.MARKED}', '{text.UNMARKED}') AS plain FROM documents")
def _(t):
    return t.documents.select("doc_id", text.strip_marks(F.col("text")).alias("plain"))


@query("f12_scaled_numbers", f"""
SELECT o_custkey, {sql_r6('round(sum(o_totalprice) / 1000000 + 1e-9, 2)')} AS millions, round(round(sum(o_totalprice) / 1000000 + 1e-9, 2), 2)::DECIMAL(38,2)::VARCHAR || ' MM' AS label
FROM orders GROUP BY 1""")
def _(t):
    spend = t.orders.groupBy("o_custkey").agg((F.sum("o_totalprice") + F.lit(1e-3)).alias("s"))
    return spend.select("o_custkey", r6(money.scaled(F.col("s"))).alias("millions"), money.scaled_text(F.col("s")).alias("label"))


@query("f13_media_type", r"""
WITH u AS (SELECT page_id, CASE page_id % 4 WHEN 0 THEN url WHEN 1 THEN regexp_replace(url, '([?#].*)?$', '/a.b.pdf') WHEN 2 THEN regexp_replace(url, '([?#].*)?$', '/x.docx?v=1') ELSE regexp_replace(url, '([?#].*)?$', '/photo.png#top') END AS url FROM pages),
e AS (SELECT page_id, regexp_extract(regexp_extract(url, '^[a-zA-Z]+://[^/?#]+([^?#]*)', 1), '[^/.][^/]*\.([^./]+)$', 1) AS extension FROM u)
SELECT page_id, extension, CASE extension WHEN 'pdf' THEN 'application/pdf' WHEN 'jpg' THEN 'image/jpeg' WHEN 'png' THEN 'image/png' WHEN 'jpeg' THEN 'image/jpeg'
  WHEN 'pptx' THEN 'application/octet-stream' WHEN 'docx' THEN 'application/octet-stream' WHEN 'txt' THEN 'application/octet-stream' END AS media_type FROM e""")
def _(t):
    k, bare = F.col("page_id") % 4, r"([?#].*)?\z"
    url = (F.when(k == 0, F.col("url")).when(k == 1, F.concat(F.regexp_replace("url", r"[?#].*$", ""), F.lit("/a.b.pdf")))
           .when(k == 2, F.concat(F.regexp_replace("url", r"[?#].*$", ""), F.lit("/x.docx?v=1")))
           .otherwise(F.concat(F.regexp_replace("url", r"[?#].*$", ""), F.lit("/photo.png#top"))))
    return t.pages.select("page_id", text.url_extension(url).alias("extension"), text.media_type(url).alias("media_type"))


@query("f14_comma_list", """
WITH s AS (SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN replace(p_name, ' ', ' , ') WHEN 1 THEN p_name || ',' ELSE p_name || ', ,' || p_type END AS v FROM part)
SELECT p_partkey, CASE WHEN regexp_matches(v, '^[^,]+(,[^,]+)*$') AND NOT list_contains(list_transform(string_split(v, ','), lambda x: trim(x)), '')
  THEN array_to_string(list_transform(string_split(v, ','), lambda x: trim(x)), '|') END AS parts FROM s""")
def _(t):
    k = F.col("p_partkey") % 3
    v = (F.when(k == 0, F.replace("p_name", F.lit(" "), F.lit(" , "))).when(k == 1, F.concat("p_name", F.lit(",")))
         .otherwise(F.concat("p_name", F.lit(", ,"), "p_type")))
    return t.part.select("p_partkey", F.array_join(text.comma_list(v), "|").alias("parts"))


@query("f15_invoice_from_file", r"""
SELECT o_orderkey, CASE WHEN regexp_matches(f, '(\d+)_(\d+)_([A-Z]\d+)_(\d+)\.pdf') THEN regexp_extract(f, '(\d+)_(\d+)_([A-Z]\d+)_(\d+)\.pdf', 3) || '-' || regexp_extract(f, '(\d+)_(\d+)_([A-Z]\d+)_(\d+)\.pdf', 4) ELSE '' END AS invoice
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN 'scan.pdf' ELSE '2010275636' || (o_custkey % 7) || '_01_F' || (100 + o_custkey % 50) || '_' || lpad(o_orderkey::VARCHAR, 8, '0') || '.pdf' END AS f FROM orders)""")
def _(t):
    name = F.when(F.col("o_orderkey") % 9 == 0, F.lit("scan.pdf")).otherwise(F.concat(
        F.lit("2010275636"), (F.col("o_custkey") % 7).cast("string"), F.lit("_01_F"), (100 + F.col("o_custkey") % 50).cast("string"),
        F.lit("_"), F.lpad(F.col("o_orderkey").cast("string"), 8, "0"), F.lit(".pdf")))
    return t.orders.select("o_orderkey", text.invoice_from_file_name(name).alias("invoice"))


@query("f16_one_hot_inverse", "SELECT event_id, event_type FROM events")
def _(t):
    kinds = ["click", "error", "purchase", "signup", "view"]
    flags = ts.one_hot(t.events.select("event_id", "event_type"), "event_type", kinds)
    return ts.from_one_hot(flags, "event_type", kinds).select("event_id", "event_type")


@query("f20_parse_date", """
SELECT o_orderkey, CASE WHEN o_orderkey % 6 <> 0 THEN o_orderdate::DATE END AS d FROM orders""")
def _(t):
    written = F.when(F.col("o_orderkey") % 6 == 0, F.lit("20251399")).otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    return t.orders.select("o_orderkey", dates.feed_date(written).alias("d"))


@query("f21_parse_timestamp", """
SELECT event_id, CASE event_id % 3 WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN date_trunc('minute', ts) ELSE date_trunc('day', ts) END AS ts FROM events""")
def _(t):
    k = F.col("event_id") % 3
    written = (F.when(k == 0, F.date_format("ts", "d/M/yyyy HH:mm:ss")).when(k == 1, F.date_format("ts", "dd-MM-yy HH:mm"))
               .otherwise(F.date_format("ts", "dd/MM/yyyy")))
    return t.events.select("event_id", dates.mixed_timestamp(written).alias("ts"))


@query("f22_parse_datetime", "SELECT event_id, date_trunc('minute', ts) AS at FROM events")
def _(t):
    written = F.concat(F.lit("ingreso "), F.date_format("ts", "dd/MM/yyyy HH:mm"), F.lit(" hrs"))
    return t.events.select("event_id", dates.ddmmyyyy_hhmm(written).alias("at"))


@query("f23_format_date", """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS iso, strftime(o_orderdate, '%Y%m') AS ym, strftime(o_orderdate, '%Y%m%d') AS ymd,
  strftime(o_orderdate, '%B') AS month_name, strftime(o_orderdate, '%A') AS weekday_name, strftime(o_orderdate, '%Y-%m-01') AS first_day FROM orders""")
def _(t):
    patterns = {"iso": "yyyy-MM-dd", "ym": "yyyyMM", "ymd": "yyyyMMdd", "month_name": "MMMM", "weekday_name": "EEEE", "first_day": "yyyy-MM-01"}
    return t.orders.select("o_orderkey", *[F.date_format("o_orderdate", p).alias(n) for n, p in patterns.items()])


@query("f24_date_from_parts", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, try_cast((1990 + l_linenumber) || '-' || lpad((l_partkey % 13)::VARCHAR, 2, '0') || '-' || lpad((l_suppkey % 32)::VARCHAR, 2, '0') AS DATE) AS d FROM lineitem")
def _(t):
    d = dates.date_from_parts(1990 + F.col("l_linenumber"), F.col("l_partkey") % 13, F.col("l_suppkey") % 32)
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", d.alias("d"))


@query("f25_date_differences", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, date_diff('day', o_orderdate::DATE, l_shipdate::DATE)::INTEGER AS days,
  date_diff('month', o_orderdate::DATE, l_shipdate::DATE)::INTEGER AS months, date_diff('year', o_orderdate::DATE, l_shipdate::DATE)::INTEGER AS years
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def _(t):
    a, b = F.to_date("l_shipdate"), F.to_date("o_orderdate")
    return (t.lineitem.join(t.orders, t.lineitem.l_orderkey == t.orders.o_orderkey)
            .select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.datediff(a, b).alias("days"),
                    dates.months_crossed(a, b).alias("months"), dates.years_crossed(a, b).alias("years")))


@query("f26_date_arithmetic", "SELECT o_orderkey, o_orderdate::DATE + 30 AS plus, o_orderdate::DATE - 5 AS minus FROM orders")
def _(t):
    return t.orders.select("o_orderkey", F.date_add("o_orderdate", 30).alias("plus"), F.date_sub("o_orderdate", 5).alias("minus"))


@query("f27_month_start", "SELECT date_trunc('month', o_orderdate)::DATE AS periodo, count(*) AS n FROM orders GROUP BY 1")
def _(t):
    return t.orders.groupBy(dates.month_start(F.col("o_orderdate")).alias("periodo")).agg(F.count(F.lit(1)).alias("n"))


@query("f28_extract", "SELECT year(o_orderdate)::INTEGER AS y, month(o_orderdate)::INTEGER AS m, count(*) AS n FROM orders GROUP BY 1, 2")
def _(t):
    return t.orders.groupBy(F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m")).agg(F.count(F.lit(1)).alias("n"))


@query("f29_age_at_run", "SELECT o_orderkey, DATE '2002-01-15' - o_orderdate::DATE AS age FROM orders")
def _(t):
    today = F.lit("2002-01-15").cast("date")  # the run's date is always a parameter
    return t.orders.select("o_orderkey", F.datediff(today, "o_orderdate").cast("bigint").alias("age"))


@query("f30_time_parts", """
SELECT event_id, hour(ts)::INTEGER AS hour_ts, (isodow(ts) - 1)::INTEGER AS dayofweek_ts, month(ts)::INTEGER AS month_ts, dayofyear(ts)::INTEGER AS dayofyear_ts, year(ts)::INTEGER AS year_ts FROM events""")
def _(t):
    return ts.time_parts(t.events.select("event_id", "ts"), "ts").drop("ts")


@query("f31_hour_sequence", """
SELECT user_id, unnest(generate_series(a, b, INTERVAL 1 HOUR)) AS hour FROM (SELECT user_id, date_trunc('hour', min(ts)) AS a, date_trunc('hour', max(ts)) AS b FROM events GROUP BY 1)""")
def _(t):
    span = t.events.groupBy("user_id").agg(dates.floor_to("hour", F.min("ts")).alias("a"), dates.floor_to("hour", F.max("ts")).alias("b"))
    return span.select("user_id", F.explode(F.sequence("a", "b", F.expr("interval 1 hour"))).alias("hour"))


@query("f40_round_half", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_extendedprice) AS whole, round(l_quantity / 2) AS half FROM lineitem")
def _(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round("l_extendedprice").alias("whole"),
                             F.round(F.col("l_quantity") / 2, 0).alias("half"))


@query("f41_truncate", "SELECT c_custkey, trunc(c_acctbal)::BIGINT AS whole, trunc(-c_acctbal)::BIGINT AS negative FROM customer")
def _(t):
    return t.customer.select("c_custkey", money.truncate(F.col("c_acctbal")).alias("whole"), money.truncate(-F.col("c_acctbal")).alias("negative"))


@query("f42_modulo", "SELECT o_orderkey, o_orderkey % 5 AS m, o_totalprice::BIGINT % 7 AS p FROM (SELECT o_orderkey, trunc(o_totalprice) AS o_totalprice FROM orders)")
def _(t):
    return t.orders.select("o_orderkey", (F.col("o_orderkey") % 5).alias("m"), (money.truncate(F.col("o_totalprice")) % 7).alias("p"))


@query("f43_trigonometry", f"SELECT event_id, {sql_r6('sin(2 * pi() * hour(ts) / 24)')} AS s, {sql_r6('cos(2 * pi() * hour(ts) / 24)')} AS c, {sql_r6('value * value')} AS sq, {sql_r6('1 / (value + 1e-6)')} AS inv FROM events")
def _(t):
    angle, v = 2 * F.pi() * F.hour("ts") / 24, F.col("value")
    return t.events.select("event_id", r6(F.sin(angle)).alias("s"), r6(F.cos(angle)).alias("c"), r6(v * v).alias("sq"), r6(1 / (v + F.lit(1e-6))).alias("inv"))


@query("f44_coalesce_chain", """
SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 2 = 0 THEN 'a' END, CASE WHEN o_orderkey % 3 = 0 THEN 'b' END, CASE WHEN o_orderkey % 5 = 0 THEN 'c' END, 'z') AS first,
  nullif(o_orderstatus, 'P') AS no_p, ifnull(nullif(o_orderstatus, 'F'), '-') AS filled, if(o_totalprice > 100000, 'hi', 'lo') AS side FROM orders""")
def _(t):
    key = F.col("o_orderkey")
    first = F.coalesce(*[F.when(key % n == 0, v) for n, v in ((2, "a"), (3, "b"), (5, "c"))], F.lit("z"))
    return t.orders.select("o_orderkey", first.alias("first"), F.nullif("o_orderstatus", F.lit("P")).alias("no_p"),
                           F.ifnull(F.nullif("o_orderstatus", F.lit("F")), F.lit("-")).alias("filled"),
                           F.when(F.col("o_totalprice") > 100000, "hi").otherwise("lo").alias("side"))


@query("f45_safe_cast", r"""
SELECT o_orderkey, CASE WHEN regexp_matches(v, '^-?\d+$') THEN v::BIGINT END AS whole, try_cast(v AS DOUBLE) AS number, try_cast(v AS DECIMAL(38,9)) AS exact
FROM (SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN o_orderkey::VARCHAR WHEN 1 THEN o_totalprice::DECIMAL(18,2)::VARCHAR ELSE o_orderpriority END AS v FROM orders)""")
def _(t):
    k = F.col("o_orderkey") % 3
    v = (F.when(k == 0, F.col("o_orderkey").cast("string")).when(k == 1, F.col("o_totalprice").cast("decimal(18,2)").cast("string"))
         .otherwise(F.col("o_orderpriority")))
    return t.orders.select("o_orderkey", v.try_cast("bigint").alias("whole"), money.number_or_null(v).alias("number"),
                           money.number_or_null(v, money.NUMERIC).alias("exact"))


@query("f46_cast", "SELECT o_orderkey, string_split(o_orderpriority, '-')[1]::BIGINT AS level FROM orders")
def _(t):
    return t.orders.select("o_orderkey", F.split("o_orderpriority", "-")[0].cast("bigint").alias("level"))


@query("f47_quantise", "SELECT o_orderkey, (o_totalprice::DECIMAL(18,2) / 8)::DECIMAL(38,9) AS q FROM orders")
def _(t):
    return t.orders.select("o_orderkey", money.quantise(F.col("o_totalprice") / 8).alias("q"))


@query("f48_number_in_message", "SELECT o_orderkey, 'monto (S/. ' || o_totalprice::DECIMAL(18,2)::VARCHAR || ') para (' || coalesce(nullif(o_orderstatus, 'P'), '-') || ')' AS message FROM orders")
def _(t):
    message = F.concat(F.lit("monto (S/. "), F.col("o_totalprice").cast("decimal(18,2)").cast("string"), F.lit(") para ("),
                       F.coalesce(F.nullif("o_orderstatus", F.lit("P")), F.lit("-")), F.lit(")"))
    return t.orders.select("o_orderkey", message.alias("message"))
