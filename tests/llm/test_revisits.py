import random

import pytest

from lodestar.llm import revisits

DDL = "record_id bigint, kind string, url string, captured_at bigint, headers map<string,string>"


def records(seed):
    rnd = random.Random(seed)
    rows = []
    for i in range(300):
        kind = rnd.choice(["response", "revisit", "revisit"])
        # one address holds most records
        url = rnd.choice(["http://www.A.com/x/", "https://a.com/x#f", "http://a.com:80/x?utm_a=1", "http://b.org/?z=2&y=1", "http://b.org/?y=1&z=2", None])
        headers = rnd.choice([None, {"ETag": rnd.choice(['"1"', 'W/"1"', '"2"']), "Content-Length": str(i)}, {"Last-Modified": rnd.choice("mn"), "etag": None}, {"DATE": str(i), "Vary": "v", "X-Own": "x"}])
        rows.append((i, kind, url, rnd.choice([None, *range(50)]), headers))
    return rows


def key_of(url):
    return None if url is None else "a.com/x" if ".com" in url.lower() else "b.org?y=1&z=2"


def brute(rows):
    low = lambda h: {k.lower(): v for k, v in (h or {}).items()}
    out = {}
    for i, kind, url, at, headers in rows:
        if kind != "revisit":
            continue
        earlier = [r for r in rows if r[1] == "response" and key_of(r[2]) == key_of(url) and r[3] is not None and at is not None and url is not None and (r[3], r[0]) < (at, i)]
        if not earlier:
            out[i] = (None, "missing", None)
            continue
        found = max(earlier, key=lambda r: (r[3], r[0]))
        ours, theirs = low(headers), low(found[4])
        outcome = "unchecked"
        for name in ("etag", "last-modified"):
            a, b = ours.get(name), theirs.get(name)
            if a is not None and b is not None:
                outcome = "resolved" if a.removeprefix("W/") == b.removeprefix("W/") else "changed"
                break
        new = {k: v for k, v in ours.items() if k in revisits.PERMITTED and v is not None}
        out[i] = (found[0], outcome, None if outcome == "changed" else theirs | new)
    return out


@pytest.mark.parametrize("seed", range(2))
def test_revisits_are_resolved_as_by_brute_force(spark, seed):
    rows = records(seed)
    frame = spark.createDataFrame(rows, DDL).selectExpr("*", "1 AS full", "'k' AS key").repartition(4)
    got = {r["record_id"]: (r["refers_to"], r["outcome"], r["headers"]) for r in revisits.resolve_revisits(frame).collect()}
    assert got == brute(rows)


def test_no_records(spark):
    assert revisits.resolve_revisits(spark.createDataFrame([], DDL)).count() == 0


def test_canonical_urls(spark):
    urls = {
        "HTTP://WWW2.Example.org:443/A/b//?b=2&&utm_x=1&a=1#top": "example.org/A/b?a=1&b=2",
        "http://x.net": "x.net", "http://x.net/": "x.net", "plain": "plain", "": "", None: None,
    }
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    got = {r[0]: r[1] for r in df.select("url", revisits.canonical_url(df.url)).collect()}
    assert got == urls
