import random
import re
from collections import defaultdict

import pytest

from lodestar.llm import jaccard_join


def shingles(text, size):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def brute(rows, size, least):
    sets = [shingles(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            both = len(x & sets[j])
            if both and 100 * both >= least * (len(x) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    least_id = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least_id[find(i)].append(d)
    return sorted(
        ((d, len(s), min(least_id[find(i)], default=None) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=repr
    )


def near_copies(seed):
    """A base text with many copies of a few changes, a passage many texts share, and lines."""
    rnd = random.Random(seed)
    word = lambda: f"w{rnd.randrange(4000)}"
    base, passage = [word() for _ in range(60)], [word() for _ in range(25)]
    rows = []
    for i in range(90):
        words = list(base)
        for _ in range(rnd.choice([0, 0, 1, 1, 2, 3, 5])):
            words[rnd.randrange(60)] = word()
        if rnd.random() < 0.2:
            words = words[: rnd.randrange(50, 60)]
        rows.append((i, " ".join(words)))
    for i in range(40):
        rows.append((100 + i, " ".join([word() for _ in range(rnd.choice([2, 8, 40]))] + passage)))
    for i in range(20):
        rows.append((200 + i, rnd.choice([None, "", "All rights reserved.", "all rights RESERVED.", "one", "a b c d e f g h i j", "a b c d e f g h i j k"])))
    rows.append((None, " ".join(base)))
    rows.append(rows[3])
    return rows


@pytest.mark.parametrize("seed, size, least, frequent", [(0, 3, 90, 3), (1, 5, 80, 3), (2, 1, 70, 4), (3, 3, 80, 32)])
def test_components_are_those_of_brute_force(spark, monkeypatch, seed, size, least, frequent):
    monkeypatch.setattr(jaccard_join, "FREQUENT", frequent)
    monkeypatch.setattr(jaccard_join, "MANY", 2 * frequent)
    monkeypatch.setattr(jaccard_join, "AHEAD", seed)
    monkeypatch.setattr(jaccard_join, "CROWDED", 10**seed)
    rows = near_copies(seed)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = jaccard_join.near_duplicates(docs, size, least)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, size, least)


def test_edge_documents(edge_docs, edge_rows):
    rows = [r[:2] for r in edge_rows if len(r[1] or "") < 5000]
    docs = edge_docs.where("text IS NULL OR length(text) < 5000")
    got = jaccard_join.near_duplicates(docs)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, 5, 80)


def test_one_document_of_each_component_stays(edge_docs, edge_rows):
    got = jaccard_join.drop_near_duplicates(edge_docs)
    assert got.columns == edge_docs.columns
    rows = [r[:2] for r in edge_rows if len(r[1] or "") < 5000]
    # empty texts link nothing, so all of them stay
    components = {c for _, n, c in brute(rows, 5, 80) if n}
    empty = sum(1 for _, n, _ in brute(rows, 5, 80) if not n)
    ids = [r[0] for r in got.where("text IS NULL OR length(text) < 5000").select("doc_id").collect()]
    assert len(ids) == len(components) + empty and components <= set(ids)


def test_empty_table(no_docs):
    assert jaccard_join.near_duplicates(no_docs).count() == 0
    assert jaccard_join.drop_near_duplicates(no_docs).count() == 0


def test_words_of_like_pattern_are_told_apart(spark):
    """Two Thue-Morse words, which collide under every polynomial modulo a power of two."""
    first = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    other = "".join("ba"[bin(i).count("1") % 2] for i in range(1024))
    docs = spark.createDataFrame([(1, f"x y {first}"), (2, f"x y {other}")], "doc_id bigint, text string")
    assert sorted(r["component_id"] for r in jaccard_join.near_duplicates(docs, 3, 90).collect()) == [1, 2]


def test_a_shared_passage_makes_few_candidates(spark, monkeypatch):
    """A third of 1200 texts is one passage: documents that are not similar are not paired."""
    rnd = random.Random(6)
    passage = [f"p{rnd.randrange(10**6)}" for _ in range(150)]
    rows = []
    for i in range(1200):
        own = [f"w{rnd.randrange(10**7)}" for _ in range(300)]
        cut = rnd.randrange(300)
        rows.append((i, " ".join(own[:cut] + passage + own[cut:])))
    rows += [(5000 + i, rows[i][1] + " more words here") for i in range(3)]
    seen = []
    real = jaccard_join.rare_candidates
    monkeypatch.setattr(jaccard_join, "rare_candidates", lambda postings, least: seen.append(joined(postings)) or real(postings, least))

    def joined(postings):
        return postings.groupBy("token").count().selectExpr("sum(count * (count - 1) / 2)").first()[0]

    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)).collect()}
    assert seen[0] < 20 * len(rows)
    assert got == {i: i for i in range(1200)} | {5000 + i: i for i in range(3)}


def test_copies_of_a_text_that_the_leader_only_shares_a_passage_with(spark, monkeypatch):
    """Documents that differ from their leader alike are given a leader of their own."""
    monkeypatch.setattr(jaccard_join, "FREQUENT", 4)
    monkeypatch.setattr(jaccard_join, "CROWDED", 16)
    rnd = random.Random(9)
    word = lambda: f"w{rnd.randrange(10**6)}"
    passage, own = [word() for _ in range(80)], [word() for _ in range(60)]
    rows = [(0, " ".join(passage))]
    for i in range(1, 60):
        words = passage + own
        words[rnd.randrange(140)] = word()
        rows.append((i, " ".join(words)))
    rounds = []
    real = jaccard_join.second_leaders
    monkeypatch.setattr(jaccard_join, "second_leaders", lambda *a: rounds.append(1) or real(*a))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = jaccard_join.near_duplicates(docs, 3, 90)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, 3, 90)


def test_columns_of_the_names_of_places(spark):
    docs = spark.createDataFrame([(1, "a b c", 7), (1, "a b c", 8), (2, "", 9)], "_file_hash bigint, _File_Place string, node int")
    got = jaccard_join.drop_near_duplicates(docs, 3, 90, "_file_hash", "_File_Place")
    assert got.columns == docs.columns and got.count() == 2
    near = jaccard_join.near_duplicates(docs, 3, 90, "_file_hash", "_File_Place")
    assert sorted(r["_file_hash"] for r in near.collect()) == [1, 1, 2]
