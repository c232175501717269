import random

import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from lodestar.llm import token_counts
from lodestar.llm.queries import COUNTED, TOKENIZER, op11_token_counts
from llm.conftest import pairs

ODD = ["a", "É", " ", "  ", "\n", "\t", "\x1c", "\x85", "\u2028", "\u3000", "1", "½", "٣", "'s", "'", "'LL", "'ll", "!",
       "<|endoftext|>", "<|end", "😀", "\u200d", "漢字", "\u0301", "\u1c8a", "\U0001e5f0", "\ufeff", "\0", "ab" * 400]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(COUNTED)


@pytest.fixture(scope="module")
def counter():
    return token_counts.TokenCounter(COUNTED, token_counts.prove(COUNTED))


def expected(library, text):
    return len(library.encode(text or "", add_special_tokens=False).ids)


def test_proven_strings(library):
    whole = token_counts.prove(COUNTED).whole
    assert len(whole) > 49_000 and {"the", " the", "\n\n"} <= whole
    assert all(expected(library, s) == 1 for s in sorted(whole)[::50])


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(ODD), st.text(max_size=6))).map("".join))
def test_any_text(library, counter, text):
    assert counter.count(text) == expected(library, text)


def test_every_character(library, counter):
    """Each character between letters, digits, marks and blanks."""
    for start in range(0, 0x110000, 0x800):
        letters = [chr(c) for c in range(start, start + 0x800) if not 0xD800 <= c < 0xE000]
        for text in ("".join(f"a{c}1{c} {c}!{c}\n" for c in letters[:: 8 if start > 0x3000 else 1]),):
            assert counter.count(text) == expected(library, text)


def test_long_texts_and_forgetting(library, counter, monkeypatch):
    monkeypatch.setattr(token_counts, "LISTED", 50)
    monkeypatch.setattr(token_counts, "CACHED", 5)
    rnd = random.Random(2)
    for text in (" ".join(rnd.choice(ODD[:19]) * rnd.randrange(1, 4) for _ in range(3000)), "x" * 20_000, "\n" * 5_000):
        assert counter.count(text) == expected(library, text)


def test_edge_documents(edge_docs, edge_rows, no_docs, library):
    got = token_counts.count_tokens(edge_docs, COUNTED, limit=20)
    wanted = []
    for doc_id, text, *_ in edge_rows:
        n = expected(library, text)
        wanted.append((doc_id, len((text or "").encode()), n, n > 20))
    assert pairs(got, *got.columns) == sorted(wanted, key=repr)
    assert token_counts.count_tokens(no_docs, COUNTED).count() == 0


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        token_counts.prove(TOKENIZER)


def test_whole_table(spark, sf, library):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = op11_token_counts(spark, sf).collect()
    assert len(got) == len(docs)
    assert all(r["n_tokens"] == expected(library, docs[r["doc_id"]]) for r in got)
