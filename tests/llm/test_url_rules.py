import pytest

from filedrop.llm.url_rules import HOST_RULES, PHRASE_RULES, Rule, host_rule, judge_urls, rule_index, with_target


@pytest.mark.parametrize("url, host, path, rule, action", [
    (None, "", "", None, None),
    ("no scheme.org/x", "", "", None, None),
    ("http://A.B.Org", "a.b.org", "", None, None),
    ("http://a.org/", "a.org", "/", "org/", "allow"),
    ("x://EXAMPLE.org/es/1?q#f", "example.org", "/es/1", "example.org/es/", "block"),
    ("http://www.example.org/en/100", "www.example.org", "/en/100", "example.org/en/1", "block"),
    ("http://badexample.org/es/", "badexample.org", "/es/", "org/", "allow"),
    ("http://q.com/fr/casino", "q.com", "/fr/casino", "com/fr/", "allow"),
    ("http://q.com/de/?a://b.org/", "q.com", "/de/", "com/de/", "block"),
    ("http://q.com/DE/", "q.com", "/DE/", None, None),
    ("http://q.net/best-Casino.html", "q.net", "/best-Casino.html", "casino", "block"),
    ("http://q.net/casinos", "q.net", "/casinos", None, None),
    ("http://q.net?x=casino", "q.net", "", None, None),
    ("a\nb://c.net#org/", "c.net", "", None, None),
])
def test_verdicts(spark, url, host, path, rule, action):
    df = spark.createDataFrame([(1, url), (None, url)], "page_id bigint, url string")
    for row in judge_urls(df, HOST_RULES + PHRASE_RULES).collect():
        assert (row["host"], row["path"], row["rule"], row["action"]) == (host, path, rule, action)


def test_rules_are_indexed_by_their_rarest_token(spark):
    urls = [f"http://example.org/en/{i}" for i in range(5)] + ["http://example.com/es/"]
    targets = with_target(spark.createDataFrame([(u,) for u in urls], "url string")).select("_target").distinct()
    index = {r["name"]: r["token"] for r in rule_index(targets, HOST_RULES).collect()}
    assert index["example.org/es/"] == "es" and index["org/"] == "org" and index["com/fr/"] == "fr"
    # The open end of a path is no whole token.
    assert host_rule("example.org/en/1", "block").tokens == ("example", "org", "en")


def test_rules_without_tokens_repeats_and_clashing_columns(spark):
    rows = [(1, "http://a.b/x" + "y" * 100_000, "h"), (1, "http://a.b/q", "h"), (1, "http://a.b/q", "h")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, host string").selectExpr(
        "*", "'t' as token", "'r' as rule", "'n' as _target")
    out = judge_urls(df, [Rule("long", "block", "y{50}", (), 1)])
    assert sorted((r["rule"] or "") for r in out.collect()) == ["", "", "long"] and out.filter("token = 't'").count() == 3
    assert judge_urls(df.limit(0), HOST_RULES).count() == 0
    assert judge_urls(df, []).filter("rule is null").count() == 3
