import hashlib
import random
import re

import pytest

from lodestar.llm import pii


def digits(s):
    return [int(c) for c in s if c in "0123456789"]


def luhn(s):
    return sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(digits(s)[::-1])) % 10 == 0


BASE = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(digits(m)) <= 19 and luhn(m)),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(digits(m)) <= 15),
]


def brute(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p, ok in BASE for m in re.finditer(p, text or "") if ok(m[0])]


def check(df, texts):
    rows = df.collect()
    assert len(rows) == len(texts)
    for r in rows:
        spans = brute(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(",".join(spans).encode()).hexdigest(), texts[r["doc_id"]]
        counts = [sum(s.startswith(k) for s in spans) for k, *_ in BASE]
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == counts
        assert set(spans) <= set(r["spans"].split(",")) | {""}


def test_base_spans_are_those_of_the_plain_patterns(edge_docs, edge_rows):
    texts = {r[0]: r[1] for r in edge_rows}
    rows = pii.personal_data_report(edge_docs).dropDuplicates(["doc_id"])
    check(rows, texts)


@pytest.mark.parametrize("seed", range(3))
def test_random_text_of_telling_characters(spark, seed):
    rnd = random.Random(seed)
    alphabet = ["0123456789 -.+()@ab_é%", "0123456789 -", "12. ", "a@b.-_", "+1 ()."][seed % 5]
    texts = {i: "".join(rnd.choice(alphabet) for _ in range(rnd.choice([5, 40, 300]))) for i in range(400)}
    check(pii.personal_data_report(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")), texts)


def test_long_runs_end_in_time(spark):
    texts = {0: "1" * 20_000, 1: "a." * 10_000 + "@", 2: "1 " * 20_000, 3: "a@" + "b." * 20_000 + "c", 4: "+1" + "(" * 20_000 + "2", 5: "1." * 20_000}
    check(pii.personal_data_report(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")), texts)


def test_spans_of_the_method(spark):
    texts = {
        0: "IBAN DE89 3704 0044 0532 0130 00 here", 1: "IBAN DE88 3704 0044 0532 0130 00 here",
        2: "my ssn is 123-45-6789.", 3: "part 123-45-6789 of the list",
        4: "amex card 378282246310005", 5: "number 378282246310005",
    }
    found = pii.personal_data_report(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string"))
    got = {r["doc_id"]: r["spans"] for r in found.collect()}
    assert got == {0: "iban:5:32", 1: "", 2: "ssn:10:21", 3: "", 4: "card:10:25", 5: ""}


def test_ibans_before_capitals_and_digits(spark):
    de, plain = "DE89 3704 0044 0532 0130 00", "DE89370400440532013000"
    gb, no, mt = "GB29 NWBK 6016 1331 9268 19", "NO93 8601 1117 947", "MT84 MALT 0110 0001 2345 MTLC AST0 01S"
    cases = [
        ("IBAN {}", plain, " Bank"), ("IBAN {}", de, " Bitte"), ("IBAN {}", de, " BIC COBADEFFXXX"), ("Konto {}", de, " 12 Euro"),
        ("IBAN é {}", gb, " A"), ("iban {}", no, " 2024"), ("IBAN {}", mt, " BIC VALLMTMT"), ("IBAN {}", de, ""), ("IBAN XY12 {}", de, " OK"),
        ("IBAN DE12 {}", de, " Z"), ("IBAN {}", plain, ". Und"),
    ]
    texts = {i: head.format(iban) + after for i, (head, iban, after) in enumerate(cases)}
    expected = {i: f"iban:{t.index(c[1])}:{t.index(c[1]) + len(c[1])}" for (i, t), c in zip(texts.items(), cases)}
    texts[50], expected[50] = f"IBAN {de} {gb} {plain}", "iban:5:32,iban:33:60,iban:61:83"
    for i, wrong in enumerate([f"IBAN {plain}X", f"IBAN {plain[:-1]} Bank", f"IBAN X{plain} Bank", "IBAN DE88 3704 0044 0532 0130 00 Bank"]):
        texts[60 + i], expected[60 + i] = wrong, ""
    found = pii.personal_data_report(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string"))
    got = {r["doc_id"]: ",".join(s for s in r["spans"].split(",") if s.startswith("iban")) for r in found.collect()}
    assert got == expected


def test_many_heads_of_ibans_end_in_time(spark):
    texts = {0: "AB12 " * 20_000, 1: "DE89" * 20_000, 2: "DE89 370400440532013000 " * 2000}
    rows = pii.personal_data_report(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")).collect()
    assert {r["doc_id"]: r["spans"].count("iban") for r in rows}[2] == 2000


def test_empty_table(no_docs):
    assert pii.personal_data_report(no_docs).count() == 0


def test_very_many_matches_in_one_text(spark, monkeypatch):
    """Matches are located in blocks, and their surroundings read from parts, with the same result."""
    rnd = random.Random(11)
    kinds = ["bob{0}@mail.example.com", "10.0.{1}.7", "call +49 30 {0}5550", "IBAN DE89370400440532013000", "card 4111 1111 1111 1111", "\U0001F600 é {0}", "ssn 123-45-67{1}"]
    text = " ".join(rnd.choice(kinds).format(i, i % 90 + 10) for i in range(3000))
    docs = spark.createDataFrame([(0, text), (1, text[:900])], "doc_id bigint, text string")
    rows = {r["doc_id"]: r for r in pii.personal_data_report(docs).collect()}
    check(pii.personal_data_report(docs), {0: text, 1: text[:900]})
    monkeypatch.setattr(pii, "FEW", 10**9)
    whole = {r["doc_id"]: r for r in pii.personal_data_report(docs).collect()}
    assert rows == whole and rows[0]["spans"].count("iban") > 300
