from flowlens.llm import urls


def rules(spark, rows=tuple(urls.RULES)):
    return spark.createDataFrame(list(rows), "rule string, action string")


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def link(target):
    return f'<LINK href="{target}" rel=canonical>'


def verdicts(spark, rows, **more):
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge(pages(spark, rows), rules(spark), **more).collect()}


def test_rules_and_addresses(spark):
    rows = [
        (1, "http://a.NET/x", None),
        (2, "http://www.example.net/en/1?q", None),
        (3, "https://example.com/de/", None),
        (4, "https://example.com/dE/", None),
        (5, "ftp://x.org/fr/a#b", None),
        (6, "http://net/", None),
        (7, "http://xnet/", None),
        (8, "http://e.net", None),
        (9, "http://e.net?a=://b.com/c", None),
        (10, "a://b://c.net/d", None),
    ]
    got = verdicts(spark, rows)
    assert got[1] == ("a.net", "/x", "net/", "block")
    assert got[2] == ("www.example.net", "/en/1", "example.net/en/", "allow")
    assert got[3][2:] == ("example.com/de/", "block") and got[4][2:] == (None, "allow")
    assert got[5] == ("x.org", "/fr/a", "org/fr/", "allow")
    assert got[6][2:] == ("net/", "block") and got[7][2:] == (None, "allow")
    assert got[8] == ("e.net", "", None, "allow") and got[9] == ("e.net", "", None, "allow")
    assert got[10][:2] == ("b:", "//c.net/d")


def test_blocks_travel_over_aliases_and_allow_comes_first(spark):
    rows = [
        (1, "http://a.net/x", None),
        (2, "http://b.com/y", '<link rel="canonical" href="http://a.net/x">'),
        (3, "https://c.com/q/z#f", link("../y?a=1&amp;b=2")),
        (4, "http://c.com/q/../y?a=1&b=2", link("//b.com/y")),
        (5, "http://f.com/1", '<meta http-equiv="refresh" content="0; url=http://z.net/">'),
        (6, "http://p.com/", link("http://bad.net/")),
        (7, "http://p.com/#top", link("http://x.org/fr/ok")),
        (8, "http://lone.com/", link("http://lone.com/")),
    ]
    got = {i: x[3] for i, x in verdicts(spark, rows).items()}
    assert got == {1: "block", 2: "block", 3: "block", 4: "block", 5: "block", 6: "allow", 7: "allow", 8: "allow"}


def test_all_links_of_a_page_count(spark):
    refresh = '<meta http-equiv="refresh" content="0; url=%s">'
    rows = [
        (1, "http://a.com/", link("http://b.com/") + link("http://x.net/")),
        (2, "http://c.com/", refresh % "http://d.com/" + refresh % "http://y.net/"),
        (3, "http://b.com/", None),
        (4, "http://d.com/", None),
        (5, "http://e.com/", link("http://f.com/") + refresh % "http://g.com/"),
        (6, "http://g.com/", link("http://h.net/")),
    ]
    assert {i: x[3] for i, x in verdicts(spark, rows).items()} == dict.fromkeys(range(1, 7), "block")


def test_redirect_logs_as_links(spark):
    own = [(1, "http://s.com/a", None), (2, "http://t.com/b", None)]
    log = spark.createDataFrame([("s.com/a", "m.com/"), ("m.com/", "k.net/c"), (None, "t.com/b")], "source string, target string")
    got = {i: x[3] for i, x in verdicts(spark, own, links=log).items()}
    assert got == {1: "block", 2: "allow"}


def test_edges(spark):
    rows = [(1, None, link("http://a.net/")), (2, "no address", None), (3, "", ""), (None, "http://a.net/", None), (4, "http://a.net/", None), (4, "http://a.net/", None)]
    frame = pages(spark, rows).selectExpr("*", "url AS host", "url AS rule", "page_id AS root", "url AS address")
    found = urls.judge(frame, rules(spark)).collect()
    assert len(found) == 6
    assert [(r.host, r.path, r.rule, r.verdict) for r in found if r.page_id in (1, 2, 3)] == [("", "", None, "allow")] * 3
    assert [r.verdict for r in found if r.page_id in (4, None)] == ["block"] * 3
    assert urls.judge(frame.where("page_id < 0"), rules(spark)).count() == 0
    assert {r.verdict for r in urls.judge(frame, rules(spark).where("false")).collect()} == {"allow"}
    tie = [("net/", "block"), ("net/", "allow")]
    assert urls.judge(frame.where("page_id = 4"), rules(spark, tie)).first().verdict == "allow"


def test_main_path_is_native(spark, sf):
    plan = urls.op5_url_filter(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
