from greenlake.llm import queries, url_filter

RULES = list(queries.RULES)


def judge(frame, urls, rules=RULES):
    u = frame([(i, x, "own") for i, x in enumerate(urls)], "page_id long, url string, verdict string")
    out = url_filter.judge_urls(u, frame(rules, "host string, path string, verdict string"))
    assert out.columns == ["page_id", "host", "path", "rule", "verdict"]
    return {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in out.collect()}


def test_rules_and_precedence(frame):
    got = judge(frame, [
        "http://A.Example.NET/en/x?q#f", "https://example.net/de/", "http://example.com/de/1", "http://x.org/fr/",
        "http://x.org/en/", "http://net/", "http://net", "notexample.net/en/", "ftp://notexample.net/en/", "http://b.com:80/a#x",
    ])
    assert got[0] == ("a.example.net", "/en/x", "example.net/en/", "allow")
    assert got[1] == ("example.net", "/de/", "net/", "block")
    assert got[2] == ("example.com", "/de/1", "example.com/de/", "block")
    assert got[3] == ("x.org", "/fr/", "org/fr/", "allow")
    assert got[4] == ("x.org", "/en/", None, "allow")
    assert got[5] == ("net", "/", "net/", "block")
    assert got[6] == ("net", "", None, "allow")
    assert got[7] == ("", "", None, "allow")
    assert got[8] == ("notexample.net", "/en/", "net/", "block")
    assert got[9] == ("b.com:80", "/a", None, "allow")


def test_nulls_repeats_long_and_no_rules(frame):
    long = "http://" + "a." * 2000 + "net/" + "p/" * 5000
    u = frame([(1, None), (1, None), (None, "http://a.net/"), (3, long), (4, "")], "page_id long, url string")
    rules = frame(RULES + [(None, "/", "block"), ("x", None, "block")], "host string, path string, verdict string")
    rows = url_filter.judge_urls(u, rules).collect()
    assert len(rows) == 5
    assert [r["rule"] for r in rows if r["page_id"] == 3] == ["net/"]
    assert [r["verdict"] for r in rows if r["page_id"] is None] == ["block"]
    none = url_filter.judge_urls(u, rules.where("false")).collect()
    assert len(none) == 5 and {r["verdict"] for r in none} == {"allow"}
    assert url_filter.judge_urls(u.where("false"), rules).count() == 0


def test_paths_without_slash_end_and_ties(frame):
    rules = [("a.com", "/eng", "block"), ("a.com", "/eng", "allow"), ("a.com", "/", "allow"), ("com", "", "block")]
    got = judge(frame, ["http://a.com/english", "http://a.com/e", "http://b.com"], rules)
    assert got[0][2:] == ("a.com/eng", "block")
    assert got[1][2:] == ("a.com/", "allow")
    assert got[2][2:] == ("com", "block")
