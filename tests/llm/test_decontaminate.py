import hashlib
import re

import pytest

from lodestar.llm import decontaminate
from llm.conftest import WORDS

W = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEMS = [
    (0, "The old STONES; of the river, fell on and the rain a 42"),
    (1, "river of stones"),
    (2, "River... of stones"),
    (3, None),
    (4, "..."),
    (5, "niño été über the and on old a river fell the end of it all"),
    (5, "niño été über the and on old a river fell the end of it all"),
]


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute(text):
    words = W.findall(lower(text))
    hit, items = set(), set()
    for item, source in ITEMS:
        w = W.findall(lower(source))
        grams = [w[i : i + 10] for i in range(max(1, len(w) - 9))] if w else []
        for g in grams:
            for i in range(len(words) - len(g) + 1):
                if words[i : i + len(g)] == g:
                    hit.update(range(i, i + len(g)))
                    items.add(str(item))
    return words, hit, items


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame(ITEMS, "item_id bigint, text string")


@pytest.fixture(scope="module")
def texts(edge_rows):
    long = " ".join(WORDS) * 3
    planted = [(i, f"{long} {t} {t or ''}. {long}") for i, (_, t) in enumerate(ITEMS, 5000)]
    return {r[0]: r[1] for r in edge_rows if r[0] is not None} | dict(planted)


@pytest.mark.parametrize("blocks", [1, 4])
def test_words_hits_and_items(spark, benchmark, texts, blocks, monkeypatch):
    if blocks > 1:
        monkeypatch.setattr(decontaminate.find_benchmark, "__defaults__", ("text", 10, 300, False))
    docs = spark.createDataFrame([(k, v) for k, v in texts.items() if len(v or "") < 9000], "doc_id bigint, text string")
    hits = 0
    for r in decontaminate.contamination_report(docs, benchmark).collect():
        words, hit, items = brute(texts[r["doc_id"]])
        sha = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
        assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) == (len(words), len(hit), len(items), sha, bool(hit))
        hits += bool(hit)
    assert hits >= 5


def test_removal_keeps_columns_and_clean_documents(spark, edge_docs, edge_rows, benchmark):
    clean = decontaminate.remove_documents(edge_docs, benchmark)
    assert clean.columns == edge_docs.columns
    expected = [r[0] for r in edge_rows if not brute(r[1])[1]]
    assert sorted(map(str, expected)) == sorted(str(r[0]) for r in clean.select("doc_id").collect())
    cut = decontaminate.remove_spans(spark.createDataFrame([(1, "Aé, river-OF stones! end"), (2, None)], "doc_id int, text string"), benchmark)
    assert sorted(map(tuple, cut.collect())) == [(1, "Aé, ! end"), (2, None)]


def test_empty_tables(spark, no_docs, edge_docs, benchmark):
    assert decontaminate.contamination_report(no_docs, benchmark).count() == 0
    nothing = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.remove_documents(edge_docs, nothing).count() == edge_docs.count()


def test_a_window_of_very_many_items(spark):
    """The items of a window are joined, not broadcast; null ids and other columns of the benchmark do no harm."""
    items = spark.range(3000).selectExpr("if(id = 7, NULL, id) AS item_id", "'the old stones fell' AS text", "1 AS hash", "2 AS gram", "3 AS `window`")
    docs = spark.createDataFrame([(1, "on The old, stones FELL down"), (2, "the old stones"), (3, None)], "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in decontaminate.contamination_report(docs, items).collect()}
    ids = sorted(str(i) for i in range(3000) if i != 7)
    assert (got[1]["n_items"], got[1]["n_hit"]) == (2999, 4)
    assert got[1]["items_sha256"] == hashlib.sha256(",".join(ids).encode()).hexdigest()
    assert not got[2]["contaminated"] and got[3]["items_sha256"] == hashlib.sha256(b"").hexdigest()
