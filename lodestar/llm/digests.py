"""Sorted digest arrays in files that every worker maps into memory.

A set of strings becomes arrays of 64-bit xxhash keys in ascending order, of
text offsets and of the texts. Spark hashes and sorts; the driver passes the
rows through to the files one partition at a time; Spark ships the files to
the executors, where all workers of a machine share their pages. Nothing is
held in memory, so the set may be larger than a worker; a file holds at most
``FILE_BYTES`` of text and there are as many files as needed.
"""

from __future__ import annotations

import os
import struct
import tempfile
import uuid
from functools import lru_cache

import numpy as np
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, functions as F

#: The most text in one file.
FILE_BYTES = 32 << 20
#: The seed of Spark's xxhash64.
SEED = 42


def digest(text: bytes) -> int:
    """The signed 64-bit number that Spark's ``xxhash64`` gives for a string."""
    value = xxhash.xxh64_intdigest(text, SEED)
    return value - (1 << 64) if value >> 63 else value


def publish(keys: DataFrame, text: Column, payload: Column, file_bytes: int = FILE_BYTES) -> list[str]:
    """Write strings with a small payload string each to digest files; return their names."""
    spark = keys.sparkSession
    rows = (
        keys.select(text.alias("text"), payload.alias("payload"))
        .where("text IS NOT NULL")
        .groupBy("text")
        .agg(F.min("payload").alias("payload"))
        .select(F.xxhash64("text").alias("digest"), "text", "payload")
        .orderBy("digest", "text")
    )
    folder = tempfile.mkdtemp(prefix="digests-", dir=SparkFiles.getRootDirectory())
    names: list[str] = []
    part: list[tuple[int, bytes, bytes]] = []
    held = 0

    def flush() -> None:
        nonlocal part, held
        name = f"digests-{uuid.uuid4().hex}"
        _write(os.path.join(folder, name), part)
        spark.sparkContext.addFile(os.path.join(folder, name))
        names.append(name)
        part, held = [], 0

    for row in rows.toLocalIterator():
        entry = (row["digest"], row["text"].encode(), (row["payload"] or "").encode())
        part.append(entry)
        held += len(entry[1]) + len(entry[2])
        if held >= file_bytes:
            flush()
    if part or not names:
        flush()
    return names


def _write(path: str, part: list[tuple[int, bytes, bytes]]) -> None:
    texts = [x for _, text, payload in part for x in (text, payload)]
    ends = np.cumsum([0, *map(len, texts)], dtype=np.int64)
    with open(path, "wb") as out:
        out.write(struct.pack("<q", len(part)))
        out.write(np.array([d for d, _, _ in part], dtype=np.int64).tobytes())
        out.write(ends.tobytes())
        out.write(b"".join(texts))


class DigestArray:
    """One digest file, mapped into memory."""

    def __init__(self, path: str):
        data = np.memmap(path, dtype=np.uint8, mode="r")
        n = int(data[:8].view(np.int64)[0])
        self.keys = data[8 : 8 + 8 * n].view(np.int64)
        self.ends = data[8 + 8 * n : 16 + 24 * n].view(np.int64)
        self.texts = data[16 + 24 * n :]

    def _text(self, place: int) -> bytes:
        return self.texts[self.ends[place] : self.ends[place + 1]].tobytes()

    def probe(self, digests: np.ndarray, texts: list[bytes]) -> dict[int, bytes]:
        """Payloads by place in ``texts`` of those that the set holds."""
        first = np.searchsorted(self.keys, digests, side="left")
        near = np.minimum(first, len(self.keys) - 1)
        found = {}
        for i in np.flatnonzero(self.keys[near] == digests) if len(self.keys) else ():
            at = int(first[i])
            # equal digests stand together; only an equal text is a hit
            while at < len(self.keys) and self.keys[at] == digests[i]:
                if self._text(2 * at) == texts[i]:
                    found[int(i)] = self._text(2 * at + 1)
                    break
                at += 1
        return found


@lru_cache(maxsize=64)
def opened(name: str) -> DigestArray:
    return DigestArray(SparkFiles.get(name))
