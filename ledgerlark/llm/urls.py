"""URL filters with redirect equivalence, in DataFrame operations.

A rule names a host and a path: it fits the host and its subdomains where the path starts with the rule's;
the longest rule wins.  Pages that redirect to, or name as canonical, another address are aliases of it.
Connected components of these edges share decisions: a page without a rule is blocked if an
alias is, unless an alias is allowed explicitly; a page's own rule always stands.  Without either it is allowed.

An address stands for itself without scheme and fragment and with its host in lower case.  Relative addresses
are resolved against the page's.  Only pages with an edge take part in the components.

Defined results: a null url, or one without ``://``, has empty host and path, no rule and no aliases, and is
allowed; null or broken html has no edges; a page that points at itself changes nothing; repeated rows are
judged alike; other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, stage

#: verdict, host and path
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ADDRESS = r"(?s)^.*?://([^/?#]*)([^?#]*)(\?[^#]*)?"
_LINK, _META = r"(?is)<link\b[^>]*>", r"(?is)<meta\b[^>]*>"
_CANONICAL, _REFRESH = r"""(?i)\brel\s*=\s*["']?\s*canonical\b""", r"""(?i)\bhttp-equiv\s*=\s*["']?\s*refresh\b"""
_HREF, _TO = r"""(?i)\bhref\s*=\s*["']?\s*([^"'\s>]+)""", r"""(?i)\burl\s*=\s*["']?\s*([^"'\s>]+)"""


def host_of(url: Column) -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), _ADDRESS, 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _ADDRESS, 2)


def address_of(url: Column) -> Column:
    """What an address is known by: host, path and query; null without ``://``."""
    return F.when(F.contains(url, F.lit("://")), F.concat(host_of(url), path_of(url), F.regexp_extract(url, _ADDRESS, 3)))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The rule that wins, like ``net/``, and its verdict; null where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, named, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == named) | F.endswith(host, F.lit("." + named))) & F.startswith(path, F.lit(start))
        rule, verdict = F.when(fits, F.lit(named + start)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def alias_edges(pages: DataFrame) -> DataFrame:
    """(u, v): address of a page and an address that its html redirects to or calls canonical."""
    html = F.coalesce("html", F.lit(""))
    links = F.when(html.rlike("(?i)canonical"), F.filter(F.regexp_extract_all(html, F.lit(_LINK), F.lit(0)), lambda t: t.rlike(_CANONICAL)))
    metas = F.when(html.rlike("(?i)http-equiv"), F.filter(F.regexp_extract_all(html, F.lit(_META), F.lit(0)), lambda t: t.rlike(_REFRESH)))
    none = F.array().cast("array<string>")
    to = F.concat(F.transform(F.coalesce(links, none), lambda t: F.regexp_extract(t, _HREF, 1)), F.transform(F.coalesce(metas, none), lambda t: F.regexp_extract(t, _TO, 1)))
    found = (pages.where(F.contains("url", F.lit("://"))).select("url", F.explode(to).alias("to")).where(F.col("to") != "")
             .withColumn("to", F.replace("to", F.lit("&amp;"), F.lit("&"))))
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    whole = (F.when(F.contains("to", F.lit("://")), F.col("to")).when(F.startswith("to", F.lit("//")), F.concat(F.lit("http:"), "to"))
             .when(F.startswith("to", F.lit("/")), F.concat(F.lit("http://"), host, "to"))
             .when(F.startswith("to", F.lit("#")), F.col("url")).when(F.startswith("to", F.lit("?")), F.concat(F.lit("http://"), host, path, "to"))
             .otherwise(F.concat(F.lit("http://"), host, F.when(path == "", F.lit("/")).otherwise(F.regexp_extract(path, "(?s)^(.*/)", 1)), "to")))
    return found.select(address_of(F.col("url")).alias("u"), address_of(whole).alias("v")).where("u <> v")


def _parts(address: Column) -> tuple[Column, Column]:
    return F.regexp_extract(address, r"(?s)^([^/?]*)", 1), F.regexp_extract(address, r"(?s)^[^/?]*([^?]*)", 1)


def judged(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule and verdict of every page (page_id, url, html)."""
    aliases = components(alias_edges(pages), "url")
    _, explicit = rule_of(*_parts(F.col("node")), rules)
    said = (aliases.withColumn("said", explicit).groupBy("root")
            .agg(F.max(F.col("said") == "block").alias("blocked"), F.max(F.col("said") == "allow").alias("allowed")))
    shared = stage(aliases.join(said, "root").where(F.coalesce("blocked", F.lit(False)) & ~F.coalesce("allowed", F.lit(False))).select(F.col("node").alias("address")), "url-blocked")
    of_page = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), address_of(F.col("url")).alias("address"))
    rule, own = rule_of(F.col("host"), F.col("path"), rules)
    met = of_page.select("*", rule.alias("rule"), own.alias("own")).join(shared.withColumn("alias", F.lit("block")), "address", "left")
    return met.select("page_id", "host", "path", "rule", F.coalesce("own", "alias", F.lit("allow")).alias("verdict"))


def _sql_rule(host: str, path: str, pick: int) -> str:
    cases = [f"WHEN ({host} = '{h}' OR ends_with({host}, '.{h}')) AND starts_with({path}, '{p}') THEN '{(h + p, v)[pick]}'"
             for v, h, p in sorted(RULES, key=lambda r: -len(r[1] + r[2]))]
    return f"CASE {' '.join(cases)} END"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _sql_address(url: str) -> str:
    part = lambda k: f"regexp_extract({url}, {_quoted(_ADDRESS)}, {k})"
    return f"translate({part(1)}, '{UPPER}', '{LOWER}') || {part(2)} || {part(3)}"


#: The same rows in DuckDB.  Absolute, host-relative and relative targets are resolved as above.
URLS_SQL = f"""
WITH RECURSIVE p AS (
  SELECT page_id, url, coalesce(html, '') AS html, translate(regexp_extract(coalesce(url, ''), {_quoted(_ADDRESS)}, 1), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(coalesce(url, ''), {_quoted(_ADDRESS)}, 2) AS path, CASE WHEN contains(url, '://') THEN {_sql_address('url')} END AS address
  FROM pages),
t AS (
  SELECT url, host, path, address AS u, unnest(
    list_transform(list_filter(regexp_extract_all(html, {_quoted(_LINK)}), lambda x: regexp_matches(x, {_quoted(_CANONICAL)})), lambda x: regexp_extract(x, {_quoted(_HREF)}, 1))
    || list_transform(list_filter(regexp_extract_all(html, {_quoted(_META)}), lambda x: regexp_matches(x, {_quoted(_REFRESH)})), lambda x: regexp_extract(x, {_quoted(_TO)}, 1))) AS target
  FROM p WHERE address IS NOT NULL),
w AS (
  SELECT u, CASE WHEN contains(target, '://') THEN target WHEN starts_with(target, '//') THEN 'http:' || target
                 WHEN starts_with(target, '/') THEN 'http://' || host || target WHEN starts_with(target, '#') THEN url WHEN starts_with(target, '?') THEN 'http://' || host || path || target
                 ELSE 'http://' || host || CASE WHEN path = '' THEN '/' ELSE regexp_extract(path, '(?s)^(.*/)', 1) END || target END AS whole
  FROM (SELECT * REPLACE (replace(target, '&amp;', '&') AS target) FROM t WHERE target <> '')),
d AS (SELECT u, {_sql_address('whole')} AS v FROM w),
e AS (SELECT u, v FROM d WHERE u <> v UNION SELECT v, u FROM d WHERE u <> v),
reach(a, b) AS (SELECT u, u FROM e UNION SELECT r.a, e.v FROM reach r JOIN e ON r.b = e.u),
said AS (SELECT a, {_sql_rule("regexp_extract(b, '(?s)^([^/?]*)', 1)", "regexp_extract(b, '(?s)^[^/?]*([^?]*)', 1)", 1)} AS said FROM reach),
shared AS (SELECT a FROM said GROUP BY a HAVING count(*) FILTER (WHERE said = 'block') > 0 AND count(*) FILTER (WHERE said = 'allow') = 0)
SELECT page_id, host, path, {_sql_rule('host', 'path', 0)} AS rule,
       coalesce({_sql_rule('host', 'path', 1)}, CASE WHEN shared.a IS NOT NULL THEN 'block' END, 'allow') AS verdict
FROM p LEFT JOIN shared ON shared.a = p.address
"""
