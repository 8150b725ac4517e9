import math
import random

from pyspark.sql import functions as F

from conftest import plan_of
from larder.llm import url_filter
from larder.llm.queries import URL_RULES


def _brute_parts(url):
    at = (url or "").find("://")
    if at < 0:
        return "", ""
    rest = url[at + 3 :]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    tail = rest[end:]
    return host, tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]


def _brute_rule(host, path):
    best = None
    for verdict, text in URL_RULES:
        h, _, p = text.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(text) > len(best[1])):
            best = (verdict, text)
    return best


URLS = [None, "", "no scheme", "http://", "http://A.Example.COM/en/x?y#z", "http://www.example.com/en/1", "http://example.com/en/", "http://example.com/en", "http://example.com", "http://xexample.com/en/", "ftp://b.net/es/1", "b.net/es/", "http://b.net/fr/?q=1", "http://B.NET#/fr/", "http://x.org/://y.com/", "http://com/a", "http://é.com/ü", "http://a.com?x=/en/"]


def test_parts_and_rules_against_brute_force(spark):
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS * 2)], "page_id long, url string, rule string")
    got = url_filter.filter_urls(pages, URL_RULES).collect()
    assert len(got) == 2 * len(URLS)
    for x in got:
        host, path = _brute_parts(x["url"])
        rule = _brute_rule(host, path)
        assert (x["host"], x["path"]) == (host, path)
        assert x["rule"] == (rule[1] if rule else None)
        assert x["verdict"] == (rule[0] if rule else x["verdict"]) and x["verdict"] in ("allow", "block")


def test_trees_learn_from_labelled_urls(spark):
    r = random.Random(2)
    rows = []
    for i in range(1200):
        bad = r.random() < 0.5
        slug = "".join(r.choices("0123456789" if bad else "abcdefgh", k=14))
        rows.append((i, f"http://{r.choice(['a', 'b', 'c'])}{i % 50}.{'net/es' if bad and i % 3 else 'com' if not bad and i % 3 else 'org'}/{slug}{'?a=1&b=2&c=3' if bad else ''}", bad))
    pages = spark.createDataFrame(rows, "page_id long, url string, bad boolean")
    got = url_filter.filter_urls(pages, [("allow", "com/"), ("block", "net/es/")]).join(pages.select("page_id", "bad"), "page_id").where(F.col("rule").isNull()).collect()
    assert len(got) > 300 and sum((x["verdict"] == "block") == x["bad"] for x in got) >= 0.95 * len(got)


def test_edges_and_plan(spark):
    schema = "page_id long, url string"
    assert url_filter.filter_urls(spark.createDataFrame([], schema), URL_RULES).count() == 0
    one = spark.createDataFrame([(1, "http://a.org/"), (2, "http://a.com/x")], schema)
    assert sorted((x["verdict"], x["score"]) for x in url_filter.filter_urls(one, URL_RULES).collect()) == [("allow", None)] * 2
    plan = plan_of(url_filter.with_features(spark.createDataFrame([(1, "u", "h", "p")], "page_id long, url string, host string, path string")))
    assert "Python" not in plan and "Arrow" not in plan


def test_statistics_are_of_all_labelled_urls_and_a_hot_url_hides_none(spark):
    seen = spark.createDataFrame([(f"http://d{i}.com/s{i}/x",) for i in range(300)], "url string")
    hot = seen.orderBy(F.pmod(F.xxhash64("url"), F.lit(1 << 40))).first()["url"]  # the first in the order of the hash
    urls = [hot] * 900 + [f"http://d{i % 150}.com/s{i}/abc" for i in range(300)] + [f"http://e{i % 100}.net/es/{i}{i}?a=1" for i in range(300)] + [f"http://f{i}.org/q" for i in range(20)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rules = [("allow", "com/"), ("block", "net/es/")]
    assert all(x["score"] is not None for x in url_filter.filter_urls(pages, rules, fit_rows=60).collect())
    host, path = url_filter.parts(F.col("url"))
    rule, verdict = url_filter.matched_rule(rules, F.col("host"), F.col("path"))
    rows = url_filter.with_features(pages.withColumn("host", host).withColumn("path", path).withColumn("verdict", verdict))
    _, tables, prior = url_filter.fit(rows, fit_rows=60)
    got = {x["domain"]: (x["domain_share"], x["domain_count"]) for x in tables["domain"].collect()}
    labelled, domains = urls[:1500], [u.split("/")[2] for u in urls[:1500]]
    assert set(got) == set(domains) and prior == 300 / 1500
    for domain, (share, count) in got.items():
        n = domains.count(domain)
        blocked = n if domain.endswith(".net") else 0
        assert abs(share - (blocked + url_filter.PRIOR * prior) / (n + url_filter.PRIOR)) < 1e-9
        assert abs(count - math.log1p(n * url_filter.PER / len(labelled))) < 1e-9
