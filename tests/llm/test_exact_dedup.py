import hashlib
import string
from collections import defaultdict

import pytest

from llm.conftest import pairs
from lodestar.llm import exact_dedup

LOW = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def classes(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[(row[1] or "").translate(LOW)].append(row[0])
    return groups


def test_classes_are_those_of_brute_force(edge_docs, edge_rows):
    expected, kept = [], 0
    for text, ids in classes(edge_rows).items():
        known = [i for i in ids if i is not None]
        best = max(known) if known else None
        sha = hashlib.sha256(text.encode()).hexdigest()
        expected += [(i, best, len(ids), sha) for i in ids]
        kept += 1
    got = exact_dedup.duplicate_classes(edge_docs)
    assert pairs(got, "doc_id", "keep_id", "group_size", "text_sha256") == sorted(expected, key=repr)
    rows = got.where("kept").collect()
    assert len(rows) == kept and all(r["doc_id"] == r["keep_id"] for r in rows)


@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_one_row_of_each_class_stays(edge_docs, edge_rows, keep):
    got = exact_dedup.drop_duplicates(edge_docs, keep=keep)
    assert got.columns == edge_docs.columns
    pick = max if keep == "largest" else min
    expected = [pick([i for i in ids if i is not None], default=None) for ids in classes(edge_rows).values()]
    assert sorted(r[0] for r in got.select("doc_id").collect() if r[0] is not None) == sorted(i for i in expected if i is not None)
    assert got.count() == len(expected)


def test_many_runs_meet_in_rounds(spark):
    docs = spark.range(400).selectExpr("id AS doc_id", "concat('t', id % 30) AS text").repartition(9)
    runs = exact_dedup.digest_runs(docs)
    merged = exact_dedup.merge_runs(runs, fan_in=2)
    assert pairs(merged, "_keep_id", "_size") == sorted(
        ((max(i for i in range(400) if i % 30 == k), sum(i % 30 == k for i in range(400))) for k in range(30)), key=repr
    )


def test_empty_table(no_docs):
    assert exact_dedup.duplicate_classes(no_docs).count() == 0
    assert exact_dedup.drop_duplicates(no_docs).columns == no_docs.columns


def test_columns_of_the_names_of_places(spark):
    docs = spark.createDataFrame([(1, "A", 7), (3, "a", 8), (2, "b", 9)], "_file_hash bigint, `_file_place` string, x int")
    got = exact_dedup.drop_duplicates(docs, "_file_hash", "_file_place")
    assert got.columns == docs.columns and sorted(r["x"] for r in got.collect()) == [8, 9]
