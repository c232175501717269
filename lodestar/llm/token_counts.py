"""Tokens of every text under a byte-level BPE vocabulary, mostly by looking up whole pre-tokens.

The vocabulary's pre-tokenizer cuts a text into pre-tokens, and merges never
cross their borders. Most pre-tokens are strings of the vocabulary that encode
alone as exactly one token. Which strings do is proved once, on the driver, by
encoding each with the tokenizer's own library; workers get the proven strings
and count their occurrences as one token each. Only other pre-tokens are merged
by the library, and a worker remembers the counts of those it met.

Pre-tokens are found by a regular expression. That it sees every character as
the library does is proved too: characters of one kind must come back as one
piece. A text with a character on which both differ, or with the string of an
added token (``<|endoftext|>``), goes to the library whole, with its defaults.

Null text counts as empty: no bytes, no tokens. Texts of any length are read
whole; long ones are not held as a list of pre-tokens. Repeated rows are
counted one by one. An empty table gives no rows. Columns other than the id
and the text are not looked at. What is broadcast is bounded by the vocabulary.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F, types as T
from tokenizers import Tokenizer

from lodestar.llm.common import column, prepare_workers

#: More tokens than this are over the limit.
LIMIT = 512
#: Characters of a text whose pre-tokens are listed at once; those of longer ones are taken one by one.
LISTED = 1 << 18
#: Merged pre-tokens that a worker remembers, and the longest of them.
CACHED, CACHED_LENGTH = 300_000, 64

#: The pre-tokens of a byte-level BPE (fixed values), in order of preference.
PRE_TOKENS = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
#: Kinds of characters with one of the kind that others may follow in a pre-token.
KINDS = {r"\p{L}": "a", r"\p{N}": "1", r"[^\p{White_Space}\p{L}\p{N}]": "!"}


@dataclass(frozen=True)
class Proof:
    """What holds of a vocabulary: strings that are one token, and texts that need the library."""

    whole: frozenset[str]
    added: tuple[str, ...]  # strings of added tokens
    odd: str  # characters that ``PRE_TOKENS`` may take for another kind


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: itself if it prints, else one from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def _pieces(tokenizer: Tokenizer, text: str) -> list[str]:
    return [text[start:end] for _, (start, end) in tokenizer.pre_tokenizer.pre_tokenize_str(text)]


def odd_characters(tokenizer: Tokenizer) -> set[str]:
    """Characters that the library may take for another kind than ``PRE_TOKENS`` does."""
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, sys.maxunicode + 1)]))
    odd = set()
    for kind, first in KINDS.items():
        # a piece holds one kind only, so one of its characters tells the kind of all
        for piece in _pieces(tokenizer, "".join(regex.findall(kind, every))):
            if len(_pieces(tokenizer, first + piece[0])) > 1:
                odd.update(piece)
    for space in regex.findall(r"\p{White_Space}", every):
        if any(len(_pieces(tokenizer, first + space)) == 1 for first in KINDS.values()):
            odd.add(space)
    return odd


@lru_cache(maxsize=4)
def prove(path: str) -> Proof:
    """Prove which strings of a vocabulary encode alone as one token, and what ``PRE_TOKENS`` cannot cut."""
    with open(path, encoding="utf-8") as file:
        parts = json.load(file)
    cut = parts.get("pre_tokenizer") or {}
    plain = (cut.get("type"), cut.get("add_prefix_space"), cut.get("use_regex")) == ("ByteLevel", False, True)
    if not plain or parts.get("normalizer") or parts["model"]["type"] != "BPE":
        raise ValueError(f"{path} is no plain byte-level BPE vocabulary")
    tokenizer = Tokenizer.from_file(path)
    letters = _byte_letters()
    strings, ids = [], []
    for token, number in tokenizer.get_vocab(with_added_tokens=False).items():
        try:
            strings.append(bytes(letters[x] for x in token).decode())
        except (KeyError, UnicodeDecodeError):
            continue  # part of a character: never a pre-token
        ids.append(number)
    encoded = tokenizer.encode_batch_fast(strings, add_special_tokens=False)
    whole = frozenset(s for s, i, e in zip(strings, ids, encoded) if e.ids == [i])
    added = tuple(a["content"] for a in parts.get("added_tokens", []))
    return Proof(whole, added, "".join(sorted(odd_characters(tokenizer))))


class TokenCounter(dict):
    """Tokens of each pre-token: one for the proven strings, others as the library merges them."""

    def __init__(self, path: str, proof: Proof):
        super().__init__(dict.fromkeys(proof.whole, 1))
        self.proven = len(self)
        self.proof = proof
        self.tokenizer = Tokenizer.from_file(path)
        self.pre_tokens = regex.compile(PRE_TOKENS)
        self.odd = set(proof.odd)

    def encoded(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def __missing__(self, piece: str) -> int:
        count = self.encoded(piece)
        if len(piece) <= CACHED_LENGTH:
            self[piece] = count
        return count

    def count(self, text: str) -> int:
        if len(self) > self.proven + CACHED:  # forget what was merged
            self.clear()
            self.update(dict.fromkeys(self.proof.whole, 1))
        if any(a in text for a in self.proof.added) or not (text.isascii() or self.odd.isdisjoint(text)):
            return self.encoded(text)
        if len(text) <= LISTED:
            return sum(map(self.__getitem__, self.pre_tokens.findall(text)))
        return sum(self[piece.group()] for piece in self.pre_tokens.finditer(text))


_counters: dict[str, TokenCounter] = {}


def token_counter(path: str, proof: Proof) -> TokenCounter:
    """One for each worker process, which runs many tasks."""
    if path not in _counters:
        _counters.clear()
        _counters[path] = TokenCounter(path, proof)
    return _counters[path]


def count_tokens(
    docs: DataFrame,
    tokenizer: str,
    limit: int = LIMIT,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per document: id, bytes, tokens, and whether these are more than ``limit``."""
    spark = docs.sparkSession
    prepare_workers(spark)
    proof = spark.sparkContext.broadcast(prove(tokenizer))
    rows = docs.select(
        column(docs, id_column).alias("id"), F.coalesce(column(docs, text_column), F.lit("")).alias("text")
    )
    schema = T.StructType(
        [
            T.StructField("id", rows.schema["id"].dataType),
            T.StructField("n_bytes", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
        ]
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = token_counter(tokenizer, proof.value)
        for batch in batches:
            texts = batch["text"]
            counts = [counter.count(text.as_py()) for text in texts]
            sizes = pa.compute.binary_length(texts).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch["id"], sizes, pa.array(counts, pa.int64())], names=schema.names
            )

    counted = rows.mapInArrow(count, schema)
    over = (F.col("n_tokens") > limit).alias("over_limit")
    return counted.select(F.col("id").alias(id_column), "n_bytes", "n_tokens", over)
