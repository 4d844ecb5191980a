from corpusmill.llm import url_templates
from corpusmill.llm.catalog import URL_RULES, op5_url_filter


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([i for i in (rest.find(c) for c in "/?#") if i >= 0], default=len(rest))
    host, rest = rest[:cut], rest[cut:]
    cut = min([i for i in (rest.find(c) for c in "?#") if i >= 0], default=len(rest))
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), rest[:cut]


def rule_of(host, path):
    best = None
    for said, rule in URL_RULES:
        name, _, tail = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + tail) and (best is None or len(rule) > len(best[1])):
            best = (said, rule)
    return best


def test_query_against_plain_python(spark):
    sf = "/root/testdata/sf0.01"
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = op5_url_filter(spark, sf).collect()
    assert len(got) == len(urls)
    for r in got:
        host, path = split(urls[r.page_id])
        rule = rule_of(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule and rule[1])
        assert r.verdict == rule[0] if rule else r.verdict == ("block" if r.labels and r.purity > 0.5 else "allow")


URLS = [
    None, "", "no scheme", "http://", "HTTP://EXAMPLE.com/en/1?x#y", "http://www.example.com/en/1", "http://a.www.example.com/en/", "http://notexample.com/en/1",
    "https://x.net/es/1", "https://x.net/es", "https://net/fr/9", "ftp://É.NET/fr/2#q", "http://h.org", "http://h.org?x=/en/", "http://h.org#://z", "a://b://c/d", "http://user@host.com:80/p", "http://x.net/es/1\n2",
]


def test_odd_urls(spark):
    df = spark.createDataFrame([(i, u, "r") for i, u in enumerate(URLS + URLS)], "page_id long, url string, rule string")
    out = url_templates.judge_urls(df, URL_RULES)
    assert out.columns == ["page_id", "url", "host", "path", "rule", "template", "labels", "purity", "verdict"]
    rows = out.collect()
    assert len(rows) == len(df.collect())
    for r in rows:
        host, path = split(r.url)
        rule = rule_of(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule and rule[1]), r.url
        assert r.verdict in ("allow", "block") and (not rule or r.verdict == rule[0])
    assert url_templates.judge_urls(df.limit(0), URL_RULES).count() == 0


def test_templates_generalise_merge_and_reject(spark):
    rows = []
    for i in range(200):
        rows.append((f"http://a.org/news/{i}", 0))
        rows.append((f"http://a.org/spam/{i}.html", 1))
        rows.append((f"http://b.org/p/slug-{i}-x", 1 if i % 2 else None))
        rows.append((f"http://c.org/{'de' if i % 2 else 'fr'}/{i}", 1))
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "page_id long, url string, bad int")
    out = url_templates.judge_urls(df, (), label="bad")
    got = {(r.host, r.template): (r.verdict, round(r.purity, 3)) for r in out.collect()}
    assert got["a.org", "news/{n}"][0] == "allow" and got["a.org", "spam/{n}.html"][0] == "block"
    assert [t for h, t in got if h == "b.org"] == ["p/{*}"]  # slugs vary: one wildcard child
    assert [t for h, t in got if h == "c.org"] == ["{~}/{n}"]  # branches alike: merged
    assert got["c.org", "{~}/{n}"][0] == "block"


def test_no_labels_block_nothing(spark):
    df = spark.createDataFrame([(1, "http://a.org/x"), (2, "http://a.org/y")], "page_id long, url string")
    assert {r.verdict for r in url_templates.judge_urls(df, ()).collect()} == {"allow"}


def test_plan_has_no_python(spark):
    df = spark.createDataFrame([(1, "http://a.org/x")], "page_id long, url string")
    plan = url_templates.judge_urls(df, URL_RULES)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_branches_without_labels_join_uniform_families(spark):
    rows = []
    for i in range(12):
        rows += [f"http://{h}/{lang}/{i}" for h in ("x.net", "y.net") for lang in ("es", "fr", "en", "de")]
        rows += [f"http://z.net/{lang}/{i}" for lang in ("es", "en")]  # one labelled branch shows nothing about its siblings
        rows += [f"http://m.com/{lang}/{i}" for lang in ("bad", "worse", "good", "new")]
        rows.append(f"http://h.org/en/{i}")
    rules = [("block", "net/es/"), ("block", "net/fr/"), ("allow", "y.net/fr/"), ("block", "m.com/bad/"), ("block", "m.com/worse/"), ("allow", "m.com/good/")]
    df = spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")
    out = [r for r in url_templates.judge_urls(df, rules).collect() if r.rule is None]
    got = {}
    for r in out:
        got.setdefault((r.host, r.path.split("/")[1]), set()).add((r.template, r.labels, r.verdict))
    assert got == {
        ("x.net", "en"): {("{~}/{n}", 24, "block")},
        ("x.net", "de"): {("{~}/{n}", 24, "block")},
        ("y.net", "en"): {("en/{n}", 0, "allow")},  # its siblings differ
        ("y.net", "de"): {("de/{n}", 0, "allow")},
        ("z.net", "en"): {("en/{n}", 0, "allow")},
        ("m.com", "new"): {("new/{n}", 0, "allow")},
        ("h.org", "en"): {("en/{n}", 0, "allow")},
    }


def test_templates_decide_pages_without_a_rule(spark):
    out = op5_url_filter(spark, "/root/testdata/sf0.01").collect()
    assert any(r.rule is None and r.verdict == "block" for r in out)
    assert all(r.labels > 0 and "{~}" in r.template for r in out if r.rule is None and r.verdict == "block")
