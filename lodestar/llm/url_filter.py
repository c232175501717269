"""URL rules looked up in a sorted digest array.

A rule names a host, a path and a verdict. It fits its host and all
subdomains of it, if the URL's path starts with the rule's; of the rules that
fit, the longest wins (of equally long ones, that with the longer host). Every
pair of a host suffix and a path prefix as long as some rule's path is hashed
and searched for in the array; a hit counts only if the stored rule is the
same string.

A null URL, or one without ``://``, has an empty host and path and fits no
rule. A URL that no rule fits gets the default verdict. Equal rows are judged
one by one. An empty table gives an empty result, and an empty rule list
leaves the default verdict to all. A rule named twice has the smaller verdict.
Columns other than the id and the URL are
not looked at.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from lodestar.llm.common import prepare_workers, column
from lodestar.llm.digests import digest, opened, publish

#: Verdict of a URL that no rule fits.
DEFAULT = "allow"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case and path; both empty without ``://``."""
    has = F.coalesce(F.contains(url, F.lit("://")), F.lit(False))
    rest = F.substring_index(url, "://", 1)
    rest = F.substr(url, F.char_length(rest) + 4)
    host = F.translate(
        F.regexp_extract(rest, "^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase
    )
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.when(has, host).otherwise(""), F.when(has, path).otherwise("")


def candidates(host: str, path: str, lengths: list[int]) -> Iterator[str]:
    """Every rule that could fit, longest first, and of equally long ones the longer host first."""
    suffixes = [host]
    while "." in suffixes[-1]:
        suffixes.append(suffixes[-1].split(".", 1)[1])
    fits = [(len(s) + n, len(s), s + path[:n]) for s in suffixes for n in lengths if n <= len(path)]
    for _, _, rule in sorted(fits, reverse=True):
        yield rule


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    id_column: str = "page_id",
    url_column: str = "url",
    default: str = DEFAULT,
) -> DataFrame:
    """Host, path, the winning rule and the verdict for every row of ``pages``.

    ``rules`` has the columns host, path (empty, or from a slash on) and verdict.
    """
    spark = pages.sparkSession
    prepare_workers(spark)
    # a host has no slash and a path begins with one, so host + path names one rule
    names = publish(rules, F.concat("host", "path"), F.col("verdict"))
    lengths = [r[0] for r in rules.select(F.char_length("path")).distinct().collect()]
    host, path = host_and_path(column(pages, url_column))
    parts = pages.select(
        column(pages, id_column).alias("id"), host.alias("host"), path.alias("path")
    )
    schema = T.StructType(
        [
            T.StructField(id_column, parts.schema["id"].dataType),
            T.StructField("host", T.StringType()),
            T.StructField("path", T.StringType()),
            T.StructField("rule", T.StringType()),
            T.StructField("verdict", T.StringType()),
        ]
    )

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = [opened(name) for name in names]
        for batch in batches:
            hosts, paths = batch["host"].to_pylist(), batch["path"].to_pylist()
            rows, texts = [], []
            for row, (h, p) in enumerate(zip(hosts, paths)):
                for rule in candidates(h, p, lengths):
                    rows.append(row)
                    texts.append(rule.encode())
            digests = np.fromiter(map(digest, texts), np.int64, len(texts))
            hits: dict[int, bytes] = {}
            for array in arrays:
                hits |= array.probe(digests, texts)
            rule_of: list[str | None] = [None] * len(hosts)
            verdicts = [default] * len(hosts)
            for i in sorted(hits):  # a row's candidates stand longest first
                if rule_of[rows[i]] is None:
                    rule_of[rows[i]], verdicts[rows[i]] = texts[i].decode(), hits[i].decode()
            yield pa.RecordBatch.from_arrays(
                [
                    batch["id"],
                    batch["host"],
                    batch["path"],
                    pa.array(rule_of, pa.string()),
                    pa.array(verdicts, pa.string()),
                ],
                names=schema.names,
            )

    return parts.mapInArrow(judge, schema)
