import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from lodestar.llm import packing
from lodestar.llm.queries import TOKENIZER

ODD = [
    "İstanbul' don't x's. Σας, ﬁn ½ éa á. ́x ...'s a'll,' 12,34.5 '' naïve! 中文字,。 é'. é's, it'S  x　y",
    "<|endoftext|>", "", " ", "x" * 5000, "it's'", "rock'n'roll.'t", "a\x1cb\x85c a. b", "été, À! ×÷ «x».", "A.B,C;é!ß",
]


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(TOKENIZER)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def as_bytes(ids):
    return np.array(ids, dtype="<u4").tobytes()


def encode(ids, texts):
    raw = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, raw)])
    return ids.encode(np.frombuffer(b"".join(raw), dtype=np.uint8), offsets)


def test_ids_are_those_of_the_tokenizer(plain, edge_rows):
    texts = ODD + [r[1] or "" for r in edge_rows]
    ids = packing.TokenIds(TOKENIZER)
    for _ in range(2):  # new words, then remembered ones
        assert encode(ids, texts) == [as_bytes(plain(t)) for t in texts]


@pytest.mark.parametrize("different", [1, 7])
def test_words_of_equal_hash_keep_their_own_ids(plain, monkeypatch, different):
    hashes = packing.word_hashes
    monkeypatch.setattr(packing, "word_hashes", lambda parts: hashes(parts) % np.uint64(different))
    texts = ODD + ["ab cd ab ef, cd abc", "rain fell on old stones; rain fell", ""]
    assert encode(packing.TokenIds(TOKENIZER), texts) == [as_bytes(plain(t)) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("ab é'.,!\n«ß9İ×"), st.characters(codec="utf-8")), max_size=30), max_size=4))
def test_ids_of_any_text(texts):
    tokenizer = Tokenizer.from_file(TOKENIZER) if not hasattr(test_ids_of_any_text, "t") else test_ids_of_any_text.t
    tokenizer.encode_special_tokens = True
    test_ids_of_any_text.t = tokenizer
    got = encode(packing.token_ids(TOKENIZER), texts)
    assert got == [as_bytes(tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]


@given(st.lists(st.integers(1, 50), min_size=1, max_size=80))
def test_first_fit_decreasing(lengths):
    sequence, offset = packing.first_fit_decreasing(np.array(lengths), 50)
    room = {}
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fits = next(b for b in range(len(lengths)) if room.get(b, 50) >= lengths[i])
        assert (sequence[i], offset[i]) == (fits, 50 - room.get(fits, 50))
        room[fits] = room.get(fits, 50) - lengths[i]


def test_every_id_lies_in_one_piece(edge_docs, edge_rows, plain):
    got = packing.pack(edge_docs, TOKENIZER, capacity=64, group_pieces=40).toPandas()
    assert (got.groupby("sequence_id").length.sum() <= 64).all()
    placed = got.sort_values(["sequence_id", "offset"])
    assert (placed.offset == placed.groupby("sequence_id").length.cumsum() - placed.length).all()
    expected = []
    for row in edge_rows:
        ids = plain(row[1]) + [packing.END]
        for start in range(0, len(ids), 64):
            part = ids[start : start + 64]
            expected.append((row[0], start, len(part), zlib.crc32(as_bytes(part)), len(ids)))
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    rows = [tuple(None if x != x else int(x) for x in r) for r in got[columns].itertuples(index=False)]
    assert sorted(rows, key=repr) == sorted(expected, key=repr)
    # a group wastes little but in its last sequences
    assert got.length.sum() > 0.9 * 64 * got.sequence_id.nunique() - 64 * 40


def test_empty_table(no_docs):
    assert packing.pack(no_docs, TOKENIZER).count() == 0
