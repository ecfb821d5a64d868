from helpers import FOLDER

from ledgerlark.llm import urls

PAGES = "page_id bigint, url string, html string, node string, root int"


def link(to):
    return f'<html><head><link href="{to}" rel="canonical"></head></html>'


ROWS = [
    (1, "http://a.net/x", ""), (2, "https://b.org/y?q=1&r=2#f", link("http://a.net/x")), (3, "http://c.org/z", '<meta http-equiv="refresh" content="0; URL=https://b.org/y?q=1&amp;r=2">'),
    (4, "http://d.org/fr/k", link("http://c.org/z")), (5, "http://e.com/", link("http://f.com/")), (6, "http://www.EXAMPLE.net/en/1", link("http://a.net/x")), (7, "http://example.net", None),
    (8, "http://my.example.com/de/1", None), (9, "http://g.com/dir/page", link("other")), (10, "http://g.com/dir/other", link("//example.com/de/9")), (11, None, link("http://a.net/")), (12, "no scheme", link("/x")), (13, "http://h.com/1", link("#top"))]


def test_rules_aliases_and_allow_precedence(spark):
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judged(spark.createDataFrame([(*r, None, 1) for r in ROWS], PAGES)).collect()}
    assert got[1] == ("a.net", "/x", "net/", "block")
    # 4 and 6 allow explicitly, so no alias of the component is blocked; 1 keeps its own rule
    assert got[2] == ("b.org", "/y", None, "allow") and got[3][3] == "allow" and got[4][2:] == ("org/fr/", "allow") and got[6] == ("www.example.net", "/en/1", "example.net/en/", "allow")
    assert got[5][3] == "allow" and got[7] == ("example.net", "", None, "allow") and got[8][2:] == ("example.com/de/", "block")
    assert got[9][2:] == (None, "block") and got[10][2:] == (None, "block")
    assert got[11] == got[12] == ("", "", None, "allow") and got[13][3] == "allow"


def test_blocks_reach_all_aliases_without_an_allow(spark):
    rows = [(*r, None, 1) for r in ROWS if r[0] not in (4, 6)]
    got = {r.page_id: r.verdict for r in urls.judged(spark.createDataFrame(rows, PAGES)).collect()}
    assert got[1] == got[2] == got[3] == "block"


def test_sql_says_the_same(spark, tmp_path):
    import duckdb
    frame = spark.createDataFrame([(*r, None, 1) for r in ROWS + [ROWS[1]]], PAGES)
    con = duckdb.connect()
    con.register("pages", frame.select("page_id", "url", "html").toArrow())
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(key, con.execute(urls.URLS_SQL).fetchall())) == sorted(key(r) for r in urls.judged(frame).collect())


def test_empty_tables_and_pages(spark):
    assert urls.judged(spark.createDataFrame([], PAGES)).count() == 0
    assert urls.judged(spark.read.parquet(f"{FOLDER}/pages.parquet")).count() == 250
