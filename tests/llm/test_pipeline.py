"""Every stage against a brute-force version, on its own input."""

import re

import corpus_pipeline
from llm.conftest import DDL, documents, prose
from llm.test_jaccard_join import brute as near
from lodestar.llm.language import language_report

LOW = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def test_stages(spark, tmp_path):
    import random

    rnd = random.Random(9)
    item = "an item of the benchmark that has quite a few words of its own in it"
    rows = documents(4, 150) + [(3000 + i, f"{prose(rnd, 40)} {item} {prose(rnd, 40)}", "en", "s", 1) for i in range(3)]
    rows = [r for r in rows if r[0] is not None and len(r[1] or "") < 5000]
    rows = list({r[0]: r for r in rows}.values())
    spark.createDataFrame(rows, DDL).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    sf = str(tmp_path)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "exact_dedup", "ngram_jaccard", "decontaminate", "packing"]
    texts = {r[0]: r[1] for r in rows}
    for name, stage in corpus_pipeline.STAGES:
        before = [r[0] for r in docs.select("doc_id").collect()]
        out = stage(spark, docs, sf)
        out.write.parquet(f"{sf}/{name}")
        expected = before
        if name == "language_id":
            said = {r["doc_id"]: r for r in language_report(docs).collect()}
            expected = [i for i in before if said[i]["lang_pred"] != "und" and said[i]["score"] >= 0.2]
            # no text with letters goes
            assert {i for i in before if any(c.isalpha() for c in texts[i] or "")} == set(expected)
        elif name == "exact_dedup":
            best = {}
            for i in before:
                best[LOW(texts[i])] = max(i, best.get(LOW(texts[i]), i))
            expected = best.values()
        elif name == "ngram_jaccard":
            expected = {c for _, _, c in near([(i, texts[i]) for i in before], 5, 80)}
        elif name == "decontaminate":
            words = re.findall(r"[0-9a-z]+", item)
            grams = [words[k : k + 10] for k in range(len(words) - 9)]

            def dirty(text):
                w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", LOW(text))
                return any(w[k : k + 10] in grams for k in range(len(w)))

            expected = [i for i in before if not dirty(texts[i])]
            assert len(expected) < len(before)
        docs = spark.read.parquet(f"{sf}/{name}")
        got = [r[0] for r in docs.select("doc_id").collect()]
        assert sorted(set(got)) == sorted(expected), name
        if name != "packing":
            assert docs.columns == [c.split()[0] for c in DDL.split(", ")] and len(got) == len(set(got))
    run = corpus_pipeline.run(spark, sf)
    assert sorted(map(tuple, run.select("doc_id", "start", "ids_crc32").collect())) == sorted(
        map(tuple, docs.select("doc_id", "start", "ids_crc32").collect())
    )
    assert corpus_pipeline.ORACLE_SQL is None
