"""Documents packed into sequences by first-fit decreasing in random groups.

Each document becomes token ids and an end id, cut into pieces of at most one
sequence. Pieces are dealt at random into groups of about ``GROUP_PIECES``,
and each group is packed on its own: pieces in order of falling length, each
into the first sequence that has room. The sequences of a group are the leaves
of a tournament tree whose inner nodes hold the most room below them, so the
first fitting one is found in as many steps as the tree is high.

The pieces are stored before they are grouped: ids are computed once, and the
random place of a piece is the same after a lost executor. Only piece rows are
shuffled, never text or ids.

Null text counts as empty; an empty document is its end id alone. Repeated
rows are packed one by one, and spread over groups like others. An empty table
gives no pieces. Columns other than the id and the text are not looked at.
"""

from __future__ import annotations

import os
import string
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from lodestar.llm.common import column, prepare_workers
from lodestar.llm.tokens import LOWER, Words, text_slices, word_hashes
from lodestar.scratch import materialise

#: Tokens of a full sequence.
CAPACITY = 4096
#: The id that ends each document.
END = 2
#: Pieces of a group on average; groups are dealt by a hash, so they differ little.
GROUP_PIECES = 4096
#: Words whose ids a worker remembers, over all its tasks; it starts anew beyond that.
CACHED_WORDS = 300_000
#: Longer words are not remembered.
CACHED_BYTES = 64
#: Bytes of text whose distinct words are looked up together.
SLICE_BYTES = 1 << 20
#: Words that are given to the tokenizer as one text.
JOINED_WORDS = 500

# Kinds of bytes: white space, ASCII punctuation, and all others, which make words.
_SPACE, _MARK, _WORD = 0, 1, 2
_KINDS = np.full(256, _WORD, dtype=np.uint8)
_KINDS[list(b" \t\n\r\x0b\x0c")] = _SPACE
_KINDS[list(string.punctuation.encode())] = _MARK
# Between words and ASCII punctuation a token always ends, unless the text has an apostrophe,
# a control character, or anything beyond ASCII but the letters of Latin-1 (\xc3 and a byte).
_ODD = np.zeros(256, dtype=bool)
_ODD[[*b"'", *range(9), *range(0x0E, 0x20), 0x7F, 0xC2, *range(0xC4, 0x100)]] = True
_SIGNS = np.zeros(256, dtype=bool)
_SIGNS[[0x97, 0xB7]] = True


def find_parts(data: np.ndarray, offsets: np.ndarray) -> Words:
    """The parts of texts that are tokenized alone, in lower case.

    These are words and runs of punctuation; in odd texts what stands between white space.
    """
    data = LOWER[data]
    kinds = _KINDS[data]
    odd = _ODD[data]
    odd[1:] |= (data[:-1] == 0xC3) & _SIGNS[data[1:]]
    before = np.concatenate([[0], np.cumsum(odd)])[offsets]
    odd_text = np.repeat(np.diff(before) > 0, np.diff(offsets))
    kinds[odd_text & (kinds == _MARK)] = _WORD
    begins = offsets[:-1][offsets[:-1] < len(data)]
    change = np.ones(len(data), dtype=bool)
    change[1:] = kinds[1:] != kinds[:-1]
    change[begins] = True
    starts = np.flatnonzero(change)
    ends = np.append(starts[1:], len(data))
    inside = kinds[starts] != _SPACE
    starts, ends = starts[inside], ends[inside]
    text = np.searchsorted(offsets, starts, side="right") - 1
    return Words(data, starts, ends, text, len(offsets) - 1)


def unlike(parts: Words, same: np.ndarray) -> np.ndarray:
    """The parts whose bytes are not those of the parts ``same``, one for each."""
    sizes = parts.ends - parts.starts
    wrong = sizes != sizes[same]
    alike = np.flatnonzero(~wrong & (same != np.arange(len(same))))
    n = sizes[alike]
    ends = np.cumsum(n)
    total = int(ends[-1]) if len(ends) else 0
    place = np.arange(total, dtype=np.int32)
    own = np.repeat((parts.starts[alike] - ends + n).astype(np.int32), n) + place
    other = np.repeat((parts.starts[same[alike]] - ends + n).astype(np.int32), n) + place
    differs = np.flatnonzero(parts.data[own] != parts.data[other])
    wrong[alike[np.searchsorted(ends, differs, side="right")]] = True
    return np.flatnonzero(wrong)


class TokenIds:
    """Token ids of texts as little-endian unsigned 32-bit integers.

    The vocabulary ``word_bpe_49k`` lowers letters, looks at each run of letters
    on its own and marks its last token as the end of a word. So ids are found
    word by word, words are remembered, and new words of letters are given to the
    tokenizer many at a time. Strings of special tokens in a text are ordinary text.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.known: dict[bytes, bytes] = {}

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """Ids of the texts that lie one after the other in ``data``."""
        if len(self.known) > CACHED_WORDS:
            self.known.clear()
        parts = find_parts(data, offsets)
        _, first, which = np.unique(word_hashes(parts), return_index=True, return_inverse=True)
        apart = unlike(parts, first[which])  # another word of the same hash
        which[apart] = len(first) + np.arange(len(apart))
        first = np.concatenate([first, apart])
        spans = zip(parts.starts[first].tolist(), parts.ends[first].tolist())
        text = parts.data.tobytes()
        distinct = [text[s:e] for s, e in spans]
        ids = list(map(self.known.get, distinct))
        learnt = self._encode_parts([w for w, i in zip(distinct, ids) if i is None])
        self.known.update((w, i) for w, i in learnt.items() if len(w) <= CACHED_BYTES)
        ids = [learnt[w] if i is None else i for w, i in zip(distinct, ids)]
        # every part's ids, one after the other
        flat = np.frombuffer(b"".join(ids), dtype="<u4")
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        begins = np.cumsum(sizes) - sizes
        counts = sizes[which]
        ends = np.concatenate([[0], np.cumsum(counts)])
        take = np.repeat(begins[which] - ends[:-1], counts) + np.arange(ends[-1])
        every = flat[take]
        bounds = ends[parts.per_text()].tolist()
        return [every[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])]

    def _encode_parts(self, parts: list[bytes]) -> dict[bytes, bytes]:
        texts = [p.decode("utf-8", "replace") for p in parts]
        ids: dict[bytes, bytes] = {}
        letters = [i for i, text in enumerate(texts) if text.isalpha()]
        rest = [i for i, text in enumerate(texts) if not text.isalpha()]
        groups = [letters[i : i + JOINED_WORDS] for i in range(0, len(letters), JOINED_WORDS)]
        joined = [" ".join(texts[i] for i in group) for group in groups]
        for group, encoded in zip(groups, self._batch(joined)):
            ends = np.flatnonzero(self.ends_word[encoded]) + 1
            if len(ends) != len(group):  # a letter that is several characters in lower case
                rest += group
                continue
            flat, at = encoded.tobytes(), 0
            for i, end in zip(group, (ends * 4).tolist()):
                ids[parts[i]] = flat[at:end]
                at = end
        for i, encoded in zip(rest, self._batch([texts[i] for i in rest])):
            ids[parts[i]] = encoded.tobytes()
        return ids

    def _batch(self, texts: list[str]) -> list[np.ndarray]:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4") for e in encoded]


@lru_cache(maxsize=1)
def token_ids(path: str) -> TokenIds:
    """One for each worker process, which runs many tasks."""
    return TokenIds(path)


def pieces(
    docs: DataFrame,
    tokenizer: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    capacity: int = CAPACITY,
    end: int = END,
) -> DataFrame:
    """Token pieces of all documents, without the ids: place, length and checksum."""
    prepare_workers(docs.sparkSession)
    rows = docs.select(
        column(docs, id_column).alias("id"),
        F.coalesce(column(docs, text_column), F.lit("")).alias("text"),
    )
    schema = T.StructType(
        [
            T.StructField(id_column, rows.schema["id"].dataType),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids_crc32", T.LongType()),
            T.StructField("doc_tokens", T.LongType()),
        ]
    )
    last = np.array([end], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = token_ids(tokenizer)
        for batch in batches:
            for row, _, data, offsets in text_slices(batch["text"], SLICE_BYTES):
                out: list[tuple[int, int, int, int, int]] = []
                for i, ids in enumerate(ids_of.encode(data, offsets)):
                    ids += last
                    for start in range(0, len(ids), 4 * capacity):
                        part = ids[start : start + 4 * capacity]
                        out.append(
                            (row + i, start // 4, len(part) // 4, zlib.crc32(part), len(ids) // 4)
                        )
                table = np.array(out, dtype=np.int64).T
                yield pa.RecordBatch.from_arrays(
                    [batch["id"].take(pa.array(table[0])), *(pa.array(c) for c in table[1:])],
                    names=schema.names,
                )

    return rows.mapInArrow(cut, schema)


class Tournament:
    """Sequences with room, where the first that fits a piece is found from the root."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.room = [capacity] * (2 * self.leaves)

    def place(self, size: int) -> int:
        """The first sequence with room for ``size``, which takes it up."""
        room, node = self.room, 1
        while node < self.leaves:
            node *= 2
            if room[node] < size:
                node += 1
        found = node - self.leaves
        room[node] -= size
        while node > 1:
            node //= 2
            most = max(room[2 * node], room[2 * node + 1])
            if room[node] == most:
                break
            room[node] = most
        return found


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece; there are never more sequences than pieces."""
    order = np.argsort(-lengths, kind="stable")
    tree = Tournament(len(lengths), capacity)
    sequence = np.empty(len(lengths), dtype=np.int64)
    offset = np.empty(len(lengths), dtype=np.int64)
    filled: dict[int, int] = {}
    for i in order.tolist():
        size = int(lengths[i])
        found = tree.place(size)
        sequence[i] = found
        offset[i] = filled.get(found, 0)
        filled[found] = int(offset[i]) + size
    return sequence, offset


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    capacity: int = CAPACITY,
    end: int = END,
    group_pieces: int = GROUP_PIECES,
) -> DataFrame:
    """One row per piece, with its sequence and its offset there.

    ``sequence_id`` has the group in its upper 32 bits.
    """
    cut = pieces(docs, tokenizer, id_column, text_column, capacity, end)
    stored = materialise(cut.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    groups = max(1, -(-stored.count() // group_pieces))
    group = F.pmod(F.xxhash64("_row"), F.lit(groups))
    schema = T.StructType(
        [
            *(f for f in stored.schema.fields if f.name != "_row"),
            T.StructField("sequence_id", T.LongType()),
            T.StructField("offset", T.LongType()),
        ]
    )

    def pack_group(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("_row", ignore_index=True)
        sequence, offset = first_fit_decreasing(frame["length"].to_numpy(), capacity)
        frame["sequence_id"] = sequence + (int(key[0]) << 32)
        frame["offset"] = offset
        return frame[schema.names]

    return stored.groupBy(group.alias("_group")).applyInPandas(pack_group, schema)
