import random

from tradelake.llm import url_filters as U
from tradelake.llm.queries import URL_RULES


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, tail = rest[:end], rest[end:]
    stop = min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), tail[:stop]


def plain(url, rules):
    host, path = split(url)
    fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    if not fits:
        return host, path, None, "allow"
    h, p, v = max(fits, key=lambda r: (len(r[0]) + len(r[1]), len(r[0]), r[2]))
    return host, path, h + p, v


def urls():
    rng = random.Random(4)
    hosts = ["example.com", "www.example.com", "WWW.Example.COM", "notexample.com", "a.b.net", "net", "com", "x.org", "com.",
             ".net", "a..com", "example.com:80", "u@example.com"]
    paths = ["", "/", "/en", "/en/", "/en/1", "/es/9?x=/fr/", "/fr/#/en/", "/EN/1", "?q", "#f", "//en/"]
    out = [rng.choice(["http", "https", ""]) + "://" + rng.choice(hosts) + rng.choice(paths) for _ in range(400)]
    return out + [None, "", "example.com/en/1", "http://", "http://a://b/en/", "http://exämple.com/en/", "x" * 3000 + "://com/"]


def frame(spark, values):
    return spark.createDataFrame([(i, u, "h", "rule") for i, u in enumerate(values)], "page_id long, url string, html string, rule string")


def test_equals_every_url_against_every_rule(spark):
    values = urls()
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    for limit in (100, 0):  # rules broadcast, and joined by shuffle with salts
        got = {r.page_id: (r.host, r.path, r.rule, r.verdict)
               for r in U.judge(frame(spark, values), rules, broadcast_rules=limit).collect()}
        assert got == {i: plain(u, URL_RULES) for i, u in enumerate(values)}


def test_rules_of_any_form(spark):
    rules = [("example.com", "/en", "block"), ("example.com", "", "allow"), ("b.net", "/e", "block"), ("a.b.net", "/", "allow"),
             ("Org", "/", "block"), ("org", "/", "allow"), ("x.org", "/en/1", "allow")]
    listed = spark.createDataFrame(rules + [(None, "/", "block"), ("com", None, "block")], "host string, path string, verdict string")
    lower = [(h.lower(), p, v) for h, p, v in rules]
    values = urls()
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in U.judge(frame(spark, values), listed).collect()}
    assert got == {i: plain(u, lower) for i, u in enumerate(values)}


def test_host_and_path_are_not_mixed_up(spark):
    rules = [("ne", "t", "block"), ("x.org", "", "allow"), ("a#b", "/", "block"), ("com", "/#", "block")]
    listed = spark.createDataFrame(rules, "host string, path string, verdict string")
    values = ["http://net", "http://a.net/x", "http://ne/t", "http://ne", "http://a#b/", "http://com/#", "http://y.x.org"]
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in U.judge(frame(spark, values), listed).collect()}
    assert got == {i: plain(u, rules) for i, u in enumerate(values)}
    assert got[0][3] == "allow" and got[1][2] is None


def test_empty(spark):
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    assert U.judge(frame(spark, []), rules).count() == 0
    only = U.judge(frame(spark, ["http://x.com/en/"] * 2), rules.limit(0)).collect()
    assert [(r.rule, r.verdict) for r in only] == [(None, "allow")] * 2
