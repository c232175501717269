"""WARC revisit records resolved by an as-of join.

A revisit with status 304 says that a URL had not changed. It is resolved to
the latest earlier full response of the same canonical URL, if their
validators agree, and its permitted headers replace those of the response.

Records are sorted globally by (canonical URL, time, id) and cut into
segments, so a URL with much of all records is spread over tasks; only one
row per segment is carried on to the next ones. Payloads are not touched.

Earlier means before in the order of time and, at the same time, of record
id. A record without URL or time resolves to nothing and nothing resolves to
it, and a record of unknown kind is left out. Header names count in lower case, and of equal names the first counts;
null headers are none. Equal rows are resolved one by one. Without records
the result is empty. Columns not named here are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lodestar.llm.common import column
from lodestar.operators.segments import POSITION, SEGMENT, sorted_segments

#: Headers that a 304 may renew (fixed values); those that describe the payload stay.
PERMITTED = [
    "cache-control",
    "content-location",
    "date",
    "etag",
    "expires",
    "last-modified",
    "vary",
]


def canonical_url(url: Column) -> Column:
    """Host in lower case without www and default port, path without closing slashes, sorted query.

    Scheme, fragment, empty and ``utm_`` parameters are left out.
    """
    rest = F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    rest = F.regexp_replace(rest, r"#[\s\S]*$", "")
    host = F.lower(F.regexp_extract(rest, r"^[^/?]*", 0))
    host = F.regexp_replace(F.regexp_replace(host, r":(80|443)$", ""), r"^www[0-9]*\.", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/?]*([^?]*)", 1), "/+$", "")
    query = F.regexp_extract(rest, r"\?([\s\S]*)$", 1)
    parts = F.array_sort(
        F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.startswith(p, F.lit("utm_")))
    )
    tail = F.when(F.size(parts) > 0, F.concat(F.lit("?"), F.array_join(parts, "&"))).otherwise("")
    return F.concat(host, path, tail)


def _plain(headers: Column) -> Column:
    """Header entries with names in lower case, the first of equal names only."""
    entries = F.transform(
        F.map_entries(headers), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value"))
    )
    first = F.filter(
        entries,
        lambda e, i: ~F.exists(F.slice(entries, 1, i), lambda x: x["key"] == e["key"]),
    )
    return F.coalesce(F.map_from_entries(first), F.map_from_arrays(F.array(), F.array()).cast("map<string,string>"))


def _strong(etag: Column) -> Column:
    return F.regexp_replace(etag, "^W/", "")


def resolve_revisits(records: DataFrame) -> DataFrame:
    """One row per revisit: what it refers to, the outcome and the merged headers.

    ``records`` has record_id, kind (response or revisit), url, captured_at and
    headers (a map). Outcomes: ``resolved``; ``changed`` (a validator both have
    differs); ``unchecked`` (no validator in common); ``missing`` (no earlier response).
    """
    rows = records.select(
        column(records, "record_id").alias("record_id"),
        (column(records, "kind") == "response").alias("full"),
        canonical_url(column(records, "url")).alias("canonical_url"),
        column(records, "captured_at").alias("captured_at"),
        _plain(column(records, "headers")).alias("headers"),
    ).where("full IS NOT NULL")
    usable = F.col("canonical_url").isNotNull() & F.col("captured_at").isNotNull()
    # Records that resolve to nothing have no key; segments keep them from one task too.
    placed = rows.withColumn("key", F.when(usable, F.col("canonical_url")))
    order = [F.col(c).asc() for c in ("key", "captured_at", "record_id", "full")]
    stored = sorted_segments(placed, order)
    response = F.when(
        F.col("full") & F.col("key").isNotNull(), F.struct("record_id", "headers")
    )
    before = Window.partitionBy("key", SEGMENT).orderBy(POSITION).rowsBetween(
        Window.unboundedPreceding, -1
    )
    near = stored.withColumn("found", F.last(response, ignorenulls=True).over(before))
    carried = _carried(stored, response)
    joined = near.join(F.broadcast(carried), ["key", SEGMENT], "left")
    found = F.coalesce("found", "carried")
    revisits = joined.where(~F.col("full")).select(
        "record_id", "canonical_url", "headers", found.alias("found")
    )
    return revisits.select(
        "record_id",
        "canonical_url",
        F.col("found.record_id").alias("refers_to"),
        _outcome().alias("outcome"),
        F.when(F.col("found").isNotNull(), _merged()).alias("headers"),
    ).withColumn("headers", F.when(F.col("outcome").isin("resolved", "unchecked"), F.col("headers")))


def _carried(stored: DataFrame, response: Column) -> DataFrame:
    """For the first key of each segment, the last response of that key in earlier segments.

    There are two rows per segment here, however many records there are.
    """
    ends = stored.groupBy(SEGMENT).agg(
        F.min_by("key", POSITION).alias("first_key"), F.max_by("key", POSITION).alias("last_key")
    )
    last = (
        stored.join(F.broadcast(ends), [SEGMENT])
        .where(F.col("key") == F.col("last_key"))
        .groupBy(SEGMENT, "key")
        .agg(F.max_by(response, F.when(response.isNotNull(), F.col(POSITION))).alias("response"))
    )
    nothing = F.lit(None).cast(last.schema["response"].dataType)
    asks = ends.where("first_key IS NOT NULL").select(
        SEGMENT, F.col("first_key").alias("key"), nothing.alias("response"), F.lit(0).alias("turn")
    )
    gives = last.select(SEGMENT, "key", "response", F.lit(1).alias("turn"))
    window = Window.partitionBy("key").orderBy(SEGMENT, "turn")
    told = asks.unionByName(gives).withColumn(
        "carried", F.last("response", ignorenulls=True).over(window)
    )
    return told.where("turn = 0").select(SEGMENT, "key", "carried")


def _outcome() -> Column:
    ours, theirs = F.col("headers"), F.col("found.headers")

    def agree(name: str) -> Column:
        if name == "etag":
            return _strong(ours[name]) == _strong(theirs[name])
        return ours[name] == theirs[name]

    def both(name: str) -> Column:
        return ours[name].isNotNull() & theirs[name].isNotNull()

    outcome = F.when(F.col("found").isNull(), "missing")
    for name in ("etag", "last-modified"):
        outcome = outcome.when(both(name), F.when(agree(name), "resolved").otherwise("changed"))
    return outcome.otherwise("unchecked")


def _merged() -> Column:
    renewed = F.map_filter("headers", lambda k, v: k.isin(PERMITTED) & v.isNotNull())
    kept = F.map_filter("found.headers", lambda k, v: ~F.map_contains_key(renewed, k))
    return F.map_concat(kept, renewed)


def captures(pages: DataFrame) -> DataFrame:
    """WARC records for a table of pages, crawled in the order of their ids.

    Each page is a full response at its id in seconds, and is asked for again
    ``RECRAWL`` seconds later with its validator, which gives a 304.
    """
    etag = F.concat(F.lit('"'), F.md5(F.coalesce("html", F.lit(""))), F.lit('"'))
    at = F.col("page_id")
    full = pages.select(
        (at * 2).alias("record_id"),
        F.lit("response").alias("kind"),
        "url",
        at.alias("captured_at"),
        F.create_map(
            F.lit("Content-Type"), F.lit("text/html"),
            F.lit("Content-Length"), F.octet_length(F.coalesce("html", F.lit(""))).cast("string"),
            F.lit("Date"), at.cast("string"),
            F.lit("ETag"), etag,
        ).alias("headers"),
    )
    later = at + RECRAWL
    again = pages.select(
        (at * 2 + 1).alias("record_id"),
        F.lit("revisit").alias("kind"),
        "url",
        later.alias("captured_at"),
        F.create_map(
            F.lit("Content-Length"), F.lit("0"),
            F.lit("Cache-Control"), F.lit("max-age=600"),
            F.lit("Date"), later.cast("string"),
            F.lit("ETag"), etag,
        ).alias("headers"),
    )
    return full.unionByName(again)


#: Seconds from a page's capture to its revisit in ``captures``.
RECRAWL = 1000


def revisit_report(pages: DataFrame) -> DataFrame:
    """The revisits of ``captures``, with merged headers as one line of text."""
    resolved = resolve_revisits(captures(pages))
    entries = F.array_sort(F.map_entries("headers"))
    text = F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit(": "), e["value"])), "; ")
    return resolved.withColumn("headers", text)
