import random
import re

from blotterflow.llm.url_filter import RULES, judge_urls

SCHEMA = "page_id long, url string"


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host) :])[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def rule(host, path):
    fits = []
    for kind, text in RULES:
        name, _, start = text.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + start):
            fits.append((len(text), text, kind))
    return max(fits)[1:] if fits else (None, None)


def urls(seed, n=400):
    pick = random.Random(seed)
    hosts = ["Example.org", "a.example.org", "borg", "org", "x.com", "com", "EXAMPLE.com", "evil.net", "b.co", "xorg"]
    paths = ["", "/", "/en/1", "/en/12/", "/en/2", "/es/", "/es", "/fr/9", "/de/3", "/de", "/EN/1", "//fr/"]
    tails = ["", "?page=2&ref=x", "#top", "?u=http://y.org/", "?"]
    rows = [(i, f"{pick.choice(['http', 'https', ''])}://{pick.choice(hosts)}{pick.choice(paths)}{pick.choice(tails)}") for i in range(n)]
    return rows + [(n, None), (n + 1, ""), (n + 2, "no scheme/en/1"), (n + 3, "a://b.org\n/x"), (n + 3, "a://b.org\n/x"), (None, "://com/fr/")]


def test_hosts_paths_and_rules(spark):
    rows = urls(1)
    for r in judge_urls(spark.createDataFrame(rows, SCHEMA)).collect():
        host, path = parts(r.url)
        name, kind = rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, name), r.url
        assert r.verdict in ("allow", "block") and (kind is None or r.verdict == kind)
        assert 0 <= r.score <= 1


def test_trees_learn_the_suffix_and_shape(spark):
    """URLs that no rule fits are judged like the labelled ones they resemble."""
    good = [(i, f"http://n{i}.org/en/2{i}") for i in range(200)]
    bad = [(1000 + i, f"http://shop{i}.com/de/{i}?a=1&b=2&c={i}{i}{i}") for i in range(200)]
    unknown = [(5000, "http://shop7.com/it/9?a=1&b=2&c=555"), (5001, "http://shop.com/it/?a=1&b=2&c=7777")]
    out = judge_urls(spark.createDataFrame(good + bad + unknown, SCHEMA))
    assert {r.page_id: r.verdict for r in out.where("rule is null").collect()} == {5000: "block", 5001: "block"}


def test_same_result_again(spark):
    rows = urls(2)
    a = judge_urls(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    b = judge_urls(spark.createDataFrame(rows[::-1], SCHEMA).repartition(2)).collect()
    key = lambda r: (str(r.page_id), str(r.url), r.score, r.verdict)
    assert sorted(map(key, a)) == sorted(map(key, b))


def test_edges(spark):
    assert judge_urls(spark.createDataFrame([], SCHEMA)).count() == 0
    only = judge_urls(spark.createDataFrame([(1, "http://a.org/"), (2, "http://b.net/" + "x" * 50_000)], SCHEMA)).collect()
    assert sorted((r.page_id, r.verdict, r.score) for r in only) == [(1, "allow", 0.0), (2, "allow", 0.0)]
    df = spark.createDataFrame([(1, "http://a.org/", "old", 3)], SCHEMA + ", HOST string, depth int")
    out = judge_urls(df)
    assert out.columns == ["page_id", "url", "depth", "host", "path", "rule", "score", "verdict"]
