from lakeloom.llm import url_filter
from lakeloom.llm.queries import URL_RULES


def judged(spark, rows, **more):
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, host string")
    return {r.page_id: r for r in url_filter.judge(df, URL_RULES, **more).collect()}


def test_rules(spark):
    got = judged(spark, [
        (1, "http://a.example.com/en/x?q#f", None), (2, "HTTP://WWW.Example.COM/en/k", ""), (3, "https://d.net/fr/1", "x"), (4, "https://d.net/fr", None),
        (5, None, None), (6, "nohost", None), (7, "https://com", None), (8, "x://y://z.com/", None), (9, "https://notcom/", None), (10, "", "")])
    view = {k: (r.host, r.path, r.rule, r.verdict) for k, r in got.items()}
    assert view == {
        1: ("a.example.com", "/en/x", "example.com/en/", "block"), 2: ("www.example.com", "/en/k", "www.example.com/en/", "allow"),
        3: ("d.net", "/fr/1", "net/fr/", "block"), 4: ("d.net", "/fr", None, "allow"), 5: ("", "", None, "allow"), 6: ("", "", None, "allow"),
        7: ("com", "", None, "allow"), 8: ("y:", "//z.com/", None, "allow"), 9: ("notcom", "/", None, "allow"), 10: ("", "", None, "allow")}


def test_blocks_reach_aliases_and_allow_comes_first(spark):
    got = judged(spark, [
        (1, "http://a.example.com/en/x", '<link rel="canonical" href="https://b.org/y">'), (2, "https://b.org/y/", ""),
        (3, "https://c.org/z#f", "<META HTTP-EQUIV=refresh CONTENT='0; URL=//b.org/y'>"), (4, "https://d.net/es/2", None),
        (5, "https://d.net/it", '<link rel="canonical" href="es/2">'), (6, "https://e.org/", '<link href="https://shop.com/" rel=canonical>'),
        (7, "https://e.org/#x", '<link rel=canonical href="https://f.net/fr/2">'), (8, "https://g.org/", '<a rel=canonical href="https://b.org/y">'),
        (9, "https://h.org/", '<link rel="canonical" href="#top"><link rel=canonical href="javascript:x">'),
        (10, "https://f.net/fr/2", None), (10, "https://f.net/fr/2", None)])
    assert {k: r.verdict for k, r in got.items()} == {
        1: "block", 2: "block", 3: "block", 4: "block", 5: "block", 6: "allow", 7: "allow", 8: "allow", 9: "allow", 10: "block"}


def test_long_chains_and_given_redirects(spark):
    pages = [(i, f"https://site{i}.org/", f'<link rel=canonical href="https://site{i + 1}.org/">') for i in range(40)]
    moved = spark.createDataFrame([("https://site40.org/", "https://x.net/es/a")], "src string, dst string")
    got = judged(spark, pages, redirects=moved)
    assert {r.verdict for r in got.values()} == {"block"} and len({r.component for r in got.values()}) == 1


def test_empty_table(spark):
    assert judged(spark, []) == {}


def test_directory_targets_without_a_page(spark):
    got = judged(spark, [
        (1, "https://a.org/x", '<link rel="canonical" href="http://example.com/en/">'),
        (2, "https://b.org/x", '<meta http-equiv="refresh" content="0; url=http://d.net/fr/">'),
        (3, "https://c.org/x", '<link rel="canonical" href="http://example.com/en/"><link rel="canonical" href="http://www.example.com/en/">'),
        (4, "https://e.org/x", '<link rel="canonical" href="http://f.net/es">')])
    assert {k: r.verdict for k, r in got.items()} == {1: "allow", 2: "block", 3: "allow", 4: "allow"}
    got = judged(spark, [(1, "https://a.org/x", '<link rel="canonical" href="http://example.com/en/">')])
    assert got[1].verdict == "block"
    moved = spark.createDataFrame([("https://a.org/x", "http://d.net/es/")], "src string, dst string")
    assert judged(spark, [(1, "https://a.org/x", "")], redirects=moved)[1].verdict == "block"
