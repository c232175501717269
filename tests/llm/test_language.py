import random
import zlib

import numpy as np

from lodestar.llm import language

SOUNDS = {"aa": ["ba", "lo", "mi", "ru", "ten"], "bb": ["sch", "eit", "ung", "ör", "ge"], "cc": ["ção", "inho", "que", "lh", "os"]}


def texts(n=160, seed=1):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rnd.choice(list(SOUNDS))
        words = ["".join(rnd.choice(SOUNDS[lang]) for _ in range(rnd.choice([1, 2, 3]))) for _ in range(rnd.choice([8, 60]))]
        rows.append((i, " ".join(words), lang))
    return rows


def test_held_out_documents_are_recognised(spark):
    rows = texts()
    odd = [(900, None, "aa"), (901, "", "bb"), (902, "123 ...", "cc"), (903, "ba lo mi", None), (None, "ge ung", "bb")]
    docs = spark.createDataFrame(rows + odd, "doc_id bigint, text string, lang string")
    got = {r["doc_id"]: r for r in language.language_report(docs).collect()}
    for i, _, lang in rows:
        assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert got[i]["lang_pred"] == lang and 0 <= got[i]["score"] <= 1
    assert [got[i]["lang_pred"] for i in (900, 901, 902, 903)] == ["und", "und", "und", "aa"]
    assert got[900]["score"] == 0.0 and got[None]["held_out"] is False


def test_labels_of_held_out_documents_are_not_learnt(spark):
    rows = texts()
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    lied = [(i, t, "zz" if (i, t, l) in held else l) for i, t, l in rows]
    ddl = "doc_id bigint, text string, lang string"
    one, other = (language.language_report(spark.createDataFrame(r, ddl)) for r in (rows, lied))
    pick = lambda df: sorted((r["doc_id"], r["lang_pred"], round(r["score"], 6)) for r in df.collect())
    assert pick(one) == pick(other)


def test_presence_kernel_is_that_of_sets_of_ngrams():
    def grams(text):
        kept = "".join(c if c.isalpha() else " " for c in text.lower())
        return {kept[i : i + n] for n in range(1, 5) for i in range(len(kept) - n + 1)}

    row, other = np.zeros(language.BUCKETS, np.float32), np.zeros(language.BUCKETS, np.float32)
    assert language.mark_ngrams("abcabd", row) and language.mark_ngrams("ABD", other)
    # of " abcabd " and " abd ": blank, a, b, d, " a", ab, bd, "d ", abd, "bd ", "abd ", and no other
    assert int((row * other).sum()) == len(grams(" abcabd ") & grams(" abd "))
    assert not language.mark_ngrams("12 !", np.zeros(language.BUCKETS, np.float32))


def test_long_text_in_parts_has_the_same_ngrams(monkeypatch):
    rnd = random.Random(0)
    text = "".join(rnd.choice("abcdefé ") for _ in range(5000)).strip()
    whole, parts = np.zeros(language.BUCKETS, np.float32), np.zeros(language.BUCKETS, np.float32)
    language.mark_ngrams(text, whole)
    monkeypatch.setattr(language, "PART", 500)
    language.mark_ngrams(text, parts)
    assert (parts >= whole).all()


def test_pipeline_keeps_columns(edge_docs, edge_rows, no_docs):
    kept = language.keep_identified(edge_docs)
    assert kept.columns == edge_docs.columns
    letters = [r for r in edge_rows if any(c.isalpha() for c in r[1] or "")]
    assert kept.count() == len(letters)
    assert language.language_report(no_docs).count() == 0
    assert language.keep_identified(no_docs).columns == no_docs.columns


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "abc", None)], "doc_id bigint, text string, lang string")
    assert language.language_report(docs).first()["lang_pred"] == "und"


def test_documents_in_no_learnt_language_go(spark):
    rnd = random.Random(5)
    rows = texts(400)
    short = [(5000 + i, "".join(rnd.choice(SOUNDS[l]) for _ in range(2)), l) for i, l in enumerate(SOUNDS)]
    long = [(5100 + i, " ".join(t for _, t, x in rows if x == l) * 20, l) for i, l in enumerate(SOUNDS)]
    cyrillic = lambda: "".join(rnd.choice("бвгджзклмн") + rnd.choice("аеиоу") for _ in range(3))
    latin = lambda: "".join(rnd.choice(["wk", "zaf", "py", "hox", "vud"]) for _ in range(3))
    planted = [
        (6000 + i, " ".join(make() for _ in range(n)), None)
        for i, (make, n) in enumerate([(cyrillic, 10), (cyrillic, 300), (latin, 20), (latin, 3000)] * 3)
    ]
    ddl = "doc_id bigint, text string, lang string"
    mixed = [(7000, " ".join(next(t for _, t, x in rows if x == l and len(t) > 200) for l in SOUNDS), None)]
    good = rows + short + long + mixed
    kept = {r["doc_id"] for r in language.keep_identified(spark.createDataFrame(good + planted, ddl)).collect()}
    assert kept == {i for i, *_ in good}


def test_what_is_familiar_does_not_depend_on_the_number_of_languages():
    rnd = random.Random(6)
    every = {f"l{k:02}": ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(3)) for _ in range(6)] for k in range(12)}
    make = lambda sounds, n: " ".join("".join(rnd.choice(sounds) for _ in range(2)) for _ in range(n))
    examples = [(l, make(sounds, 60)) for _ in range(30) for l, sounds in every.items()]
    foreign = make(["жи", "шу", "цо"], 60)
    for count in (1, 2, 12):
        some = sorted(every)[:count]
        model = language.fit([e for e in examples if e[0] in some])
        for l in some:
            assert model.familiar(make(every[l], 60), model.languages.index(l))
            assert not model.familiar(foreign, model.languages.index(l))


def test_every_label_is_learnt(spark):
    rnd = random.Random(7)
    sounds = {f"l{k:02}": ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(4)) for _ in range(5)] for k in range(70)}
    make = lambda l, n: " ".join("".join(rnd.choice(sounds[l]) for _ in range(2)) for _ in range(n))
    rows = [(i * 100 + k, make(l, 30), l) for k, l in enumerate(sorted(sounds)) for i in range(8 if k else 5)]
    rows += [(90_000 + i, make("l00", 30).upper() + " ", None) for i in range(3)]
    sounds["long"] = ["жи", "шу", "цо"]
    rows += [(80_000 + i, make("long", 6000), "long") for i in range(8)] + [(90_010, make("long", 20), None)]
    assert all(len(t) > language.SAMPLE_CHARACTERS for _, t, l in rows if l == "long")
    found = language.language_report(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    got = {r["doc_id"]: r["lang_pred"] for r in found.collect()}
    assert got == {**{i: l for i, _, l in rows}, **{90_000 + i: "l00" for i in range(3)}, 90_010: "long"}
