import random
import re
from itertools import product

import pytest

from locusframe.llm import urls

RULES = "host string, path string, verdict string"
PAGES = "page_id long, url string, host string, rid int"


def split(url):
    found = re.search(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    return (re.sub("[A-Z]", lambda m: m[0].lower(), found[1]), found[2]) if found else ("", "")


def brute(url, rules, otherwise="allow"):
    host, path = split(url)
    fits = [r for r in rules if (host == r[0].lower() or host.endswith("." + r[0].lower())) and path.startswith(r[1])]
    best = max(fits, key=lambda r: (len(r[0]), len(r[1]), r[2] == "block"), default=None)
    return (host, path, best and best[0].lower() + best[1], best[2] if best else otherwise)


def made_urls():
    hosts = ["com", "COM", "a.com", "example.com", "www.example.com", "x.www.example.com", "badexample.com", "net", "a.b.net", "", ".", "a..com", "example.com.", "example.com:80", "ünï.com"]
    paths = ["", "/", "/en", "/en/", "/en/x?q=/es/", "/EN/", "/es/#a", "/fr/ü", "?x=/en/", "#/en/", "//en/", "/en/\nx"]
    out = [f"http://{h}{p}" for h, p in product(hosts, paths)]
    return out + [None, "", "example.com/en/", "://net/es/", "a://b://net/fr/", "http://" + "a." * 3000 + "com/" + "x" * 50_000]


@pytest.mark.parametrize("small", [10_000, 0])
def test_equals_brute_force_with_few_and_with_many_rules(spark, small):
    rules = [*urls.RULES, ("Net", "/es/", "allow"), ("b.net", "", "block"), ("x.www.example.com", "/en/x", "block")]
    rows = [(i, u, "h", 1) for i, u in enumerate(made_urls())] + [(0, "http://net/es/", "h", 1)] * 3 + [(None, "http://www.example.com/en/", None, None)]
    got = urls.judge(spark.createDataFrame(rows, PAGES), spark.createDataFrame(rules, RULES), small=small).collect()
    want = [(r[0], *brute(r[1], rules)) for r in rows]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_a_host_that_many_pages_share_is_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(urls, "HOT", 1 / 4)
    r = random.Random(3)
    rules = [("hot.com", "/", "block"), *((f"h{i}.com", f"/{i % 7}/", "block") for i in range(200))]
    rows = [(i, f"https://{'www.hot.com' if i % 3 else f'h{r.randint(0, 250)}.com'}/{r.randint(0, 9)}/x", "", 0) for i in range(900)]
    got = urls.judge(spark.createDataFrame(rows, PAGES), spark.createDataFrame(rules, RULES), small=10).collect()
    assert sorted(map(tuple, got), key=str) == sorted(((x[0], *brute(x[1], rules)) for x in rows), key=str)


def test_no_pages_no_rules_and_bad_rules(spark):
    rules = spark.createDataFrame(list(urls.RULES), RULES)
    assert urls.judge(spark.createDataFrame([], PAGES), rules).collect() == []
    none = urls.judge(spark.createDataFrame([(1, "http://a.com/x", "", 0)], PAGES), spark.createDataFrame([], RULES), otherwise="block").collect()
    assert [tuple(x) for x in none] == [(1, "a.com", "/x", None, "block")]
    with pytest.raises(ValueError):
        urls.judge(spark.createDataFrame([], PAGES), spark.createDataFrame([("a", None, "block")], RULES))
