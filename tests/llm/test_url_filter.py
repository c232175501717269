import random

import numpy as np
import xxhash

from lodestar.llm import digests, url_filter
from lodestar.llm.queries import URL_RULES

URLS = [
    None, "", "no scheme", "://", "http://", "http://a.com", "http://A.COM/", "https://www.example.com/en/x", "https://example.com/en/1?x#y",
    "http://m.Example.com/en/", "http://notexample.com/en/", "http://x.net/es/1", "http://net/fr/", "http://net/fr", "a://b://c.com/en/", "http://x.net#/es/",
    "http://x.net?/es/", "http://example.com:80/en/", "http://com/", "http://.com/", "http://" + "a." * 300 + "com/" + "p/" * 3000,
]


def brute(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


def judged(spark, urls, rules):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string").selectExpr("*", "1 AS host", "'r' AS rule", "'i' AS id")
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    return {r[0]: tuple(r)[1:] for r in url_filter.judge_urls(pages, table).collect()}


def test_rules(spark):
    assert judged(spark, URLS, URL_RULES) == {i: brute(u, URL_RULES) for i, u in enumerate(URLS)}


def test_random_rules(spark, monkeypatch):
    rnd = random.Random(2)
    host = lambda: ".".join(rnd.choice("abc") for _ in range(rnd.choice([1, 2, 3])))
    path = lambda: "/" + "".join(rnd.choice("/xy") for _ in range(rnd.randrange(4)))
    rules = list({(h := host(), p := rnd.choice(["", path()])): (h, p, rnd.choice(["allow", "block"])) for _ in range(60)}.values())
    urls = [f"http://{host()}{path()}" for _ in range(400)]
    monkeypatch.setattr(digests.publish, "__defaults__", (20,))  # several files
    assert judged(spark, urls, rules) == {i: brute(u, rules) for i, u in enumerate(urls)}


def test_no_rules_and_no_pages(spark):
    assert judged(spark, ["http://a.com/"], []) == {0: ("a.com", "/", None, "allow")}
    assert judged(spark, [], URL_RULES) == {}


def test_an_equal_digest_is_no_hit(spark, tmp_path):
    # two texts under one digest: the stored text decides
    part = [(5, b"one", b"1"), (5, b"two", b"2"), (9, b"three", b"3")]
    digests._write(str(tmp_path / "d"), part)
    array = digests.DigestArray(str(tmp_path / "d"))
    assert array.probe(np.array([5, 5, 5, 9, 7]), [b"two", b"one", b"none", b"three", b"x"]) == {0: b"2", 1: b"1", 3: b"3"}
    digests._write(str(tmp_path / "e"), [])
    assert digests.DigestArray(str(tmp_path / "e")).probe(np.array([1]), [b"x"]) == {}


def test_digest_is_that_of_spark(spark):
    for text in ("", "net/", "é" * 40):
        assert spark.sql(f"SELECT xxhash64('{text}')").first()[0] == digests.digest(text.encode())
    assert digests.digest(b"net/") % (1 << 64) == xxhash.xxh64_intdigest(b"net/", 42)
