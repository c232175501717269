"""One query for each operator, over its whole table, and its SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lodestar.llm.common import table
from lodestar.llm.decontaminate import contamination_report
from lodestar.llm.exact_dedup import duplicate_classes
from lodestar.llm.jaccard_join import near_duplicates
from lodestar.llm.kd_shards import kd_shards
from lodestar.llm.language import language_report
from lodestar.llm.packing import pack
from lodestar.llm.pii import personal_data_report
from lodestar.llm.prefix_trie import prefix_trie, turn_sequences, with_shared_heads
from lodestar.llm.revisits import revisit_report
from lodestar.llm.secrets import secret_report
from lodestar.llm.token_counts import count_tokens
from lodestar.llm.url_filter import judge_urls
from lodestar.llm.whitening import whiten

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]):
    """Register a query; its SQL, if it has one, is its docstring's part after ``SQL:``."""
    QUERIES[run.__name__] = run
    _, found, sql = (run.__doc__ or "").partition("SQL:")
    if found:
        ORACLES[run.__name__] = sql.strip()
    return run


@query
def op1_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of nearly equal bytes."""
    docs = table(spark, sf_dir, "documents")
    return kd_shards(docs, ["n_chars", "lang", "source", "doc_id"], shards=16)


@query
def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return personal_data_report(table(spark, sf_dir, "documents"))


@query
def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    return contamination_report(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


@query
def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 3-word shingles have a Jaccard similarity of 0.9 or more."""
    return near_duplicates(table(spark, sf_dir, "documents"), size=3, least=90)


@query
def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    return language_report(table(spark, sf_dir, "documents"))


@query
def op6_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    r"""Every page's later revisit, resolved to the latest earlier response of its canonical URL.

    SQL:
    WITH r AS (
      SELECT page_id, url, '"' || md5(coalesce(html, '')) || '"' AS etag,
             strlen(coalesce(html, '')) AS size,
             regexp_replace(regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.-]*://', ''),
                            '#[\s\S]*$', '') AS rest
      FROM pages
    ), q AS (
      SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(rest, '^[^/?]*')),
                  ':(80|443)$', ''), '^www[0-9]*\.', '') AS host,
             regexp_replace(regexp_extract(rest, '^[^/?]*([^?]*)', 1), '/+$', '') AS path,
             list_sort(list_filter(string_split(regexp_extract(rest, '\?([\s\S]*)$', 1), '&'),
                  lambda p: p <> '' AND NOT starts_with(p, 'utm_'))) AS parts
      FROM r
    ), c AS (
      SELECT page_id, etag, size, host || path ||
             CASE WHEN len(parts) > 0 THEN '?' || array_to_string(parts, '&') ELSE '' END AS key
      FROM q
    ), joined AS (
      SELECT v.page_id, v.key, v.etag, v.page_id + 1000 AS later,
             max_by(f, f.page_id) AS f
      FROM c v LEFT JOIN c f ON f.key = v.key AND
           (f.page_id < v.page_id + 1000 OR
            f.page_id = v.page_id + 1000 AND f.page_id * 2 < v.page_id * 2 + 1)
      GROUP BY ALL
    )
    SELECT page_id * 2 + 1 AS record_id, key AS canonical_url, f.page_id * 2 AS refers_to,
           CASE WHEN f IS NULL THEN 'missing' WHEN f.etag = etag THEN 'resolved'
                ELSE 'changed' END AS outcome,
           CASE WHEN f.etag = etag THEN 'cache-control: max-age=600; content-length: ' || f.size ||
             '; content-type: text/html; date: ' || later || '; etag: ' || etag END AS headers
    FROM joined
    """
    return revisit_report(table(spark, sf_dir, "pages"))


#: The rules of op7 (fixed values): host, path, verdict.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


@query
def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    r"""The verdict on every page's URL.

    SQL:
    WITH rules(rhost, rpath, verdict) AS (
      VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
             ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')
    ), u AS (
      SELECT row_number() OVER () AS rid, page_id,
             CASE WHEN contains(url, '://') THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest
      FROM pages
    ), p AS (
      SELECT rid, page_id,
             translate(regexp_extract(rest, '^[^/?#]*'),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
      FROM u
    ), best AS (
      SELECT rid, max_by(rhost || rpath, length(rhost || rpath)) AS rule,
             max_by(verdict, length(rhost || rpath)) AS verdict
      FROM p JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
      GROUP BY rid
    )
    SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
    FROM p LEFT JOIN best USING (rid)
    """
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return judge_urls(table(spark, sf_dir, "pages"), rules)


@query
def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    return secret_report(table(spark, sf_dir, "documents"))


#: The vocabulary that documents are packed with.
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


@query
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 4096 tokens."""
    return pack(table(spark, sf_dir, "documents"), TOKENIZER)


@query
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of equal texts of every document.

    SQL:
    WITH d AS (
      SELECT doc_id, sha256(translate(coalesce(text, ''),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
      FROM documents
    ), g AS (
      SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1
    )
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
    FROM d JOIN g USING (text_sha256)
    """
    return duplicate_classes(table(spark, sf_dir, "documents"))


#: The vocabulary whose tokens are counted.
COUNTED = public_tokenizers.path("byte_bpe_50k.json")


@query
def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tokens of every document."""
    return count_tokens(table(spark, sf_dir, "documents"), COUNTED)


@query
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened principal components of every embedding."""
    return whiten(table(spark, sf_dir, "embeddings"))


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every prefix of the conversations, whose first turns come from one of a hundred.

    SQL:
    WITH t AS (
      SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS place
      FROM conversations WHERE conv_id IS NOT NULL
    ), c AS (
      SELECT conv_id, list({'role': role, 'text': text} ORDER BY place) AS turns FROM t GROUP BY 1
    ), h AS (
      SELECT conv_id, turns, conv_id - conv_id % 100 AS base,
             xor(4294967295, list_reduce(list_concat([4294967295::BIGINT],
                 list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
               lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], [0::BIGINT FOR b IN range(8)]),
                 lambda y, b: xor(y >> 1, (y % 2) * 3988292384)))) % 6 AS h
      FROM c
    ), r AS (
      SELECT h.conv_id, list_concat(coalesce(b.turns[1:h.h], []), h.turns[h.h + 1:]) AS turns
      FROM h LEFT JOIN c b ON b.conv_id = h.base
    ), p AS (
      SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS depth FROM r
    ), n AS (
      SELECT turns[1:depth] AS prefix, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
             (count(*) - 1) * coalesce(length(any_value(turns[depth].text)), 0) AS saved,
             sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(turns) = depth), '')) AS ends
      FROM p GROUP BY 1
    ), k AS (
      SELECT prefix[1:depth - 1] AS prefix, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1
    ), full_nodes AS (
      SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k USING (prefix)
    ), up AS (
      SELECT prefix[1:above] AS prefix, sum(saved) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
      FROM (SELECT *, unnest(range(0, depth + 1)) AS above FROM full_nodes) GROUP BY 1
    )
    SELECT f.conv_id, f.depth, q.conv_id AS parent_conv_id, f.n_convs, f.n_children, up.n_leaves,
           up.saved_tokens::BIGINT AS saved_tokens, f.ends AS ends_sha256
    FROM full_nodes f JOIN up USING (prefix)
    LEFT JOIN n q ON f.depth > 0 AND q.prefix = f.prefix[1:f.depth - 1]
    """
    return prefix_trie(with_shared_heads(turn_sequences(table(spark, sf_dir, "conversations"))))
