"""Benchmark passages in training text.

A window is ten consecutive words of a benchmark item; a shorter item is one
window. The distinct windows of all items, normalised, are broadcast as a hash
set with a number each; documents are scanned once, every window of as many words is looked up,
and a hit counts only if the words themselves are the same. Words are those of
``tokens.ALPHANUMERIC`` after lower-casing A-Z.

Which items a window is from stays in a stored table: a window may be that of
very many. Items are joined to the distinct sets of windows that documents hold,
once for each set.

The set is broadcast only up to ``SET_BYTES``. A larger one is dealt into
blocks by the hash of the window, the documents are scanned against one block
after the other, and hits are united, which gives the same result.

Null and empty texts have no words, and items without words no windows.
Repeated items share their windows and all count. Rows of equal ids are judged
one by one. Empty tables give no hits, or no rows. Other columns of the
documents are passed through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, functions as F, types as T

from lodestar.llm.common import column, fresh_name, map_batches, prepare_workers
from lodestar.llm.tokens import (
    ALPHANUMERIC,
    Words,
    find_words,
    text_slices,
    windows,
    word_hashes,
)
from lodestar.scratch import materialise

#: Words of a window.
WINDOW = 10
#: The largest set of windows that is broadcast, in bytes.
SET_BYTES = 32 << 20

GRAMS = "hash bigint, gram string, item string, words int"
#: What windows are told apart by.
WINDOW_KEY = ["hash", "gram", "words"]


def benchmark_windows(benchmark: DataFrame, size: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """The distinct windows of all items with a number each, and the items of each window, both stored."""
    prepare_workers(benchmark.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items = batch["item"].to_pylist()
            for row, _, data, offsets in text_slices(batch["text"]):
                words = find_words(data, offsets, ALPHANUMERIC)
                hashes, bounds = word_hashes(words), words.per_text()
                out: list[tuple] = []
                for length in range(1, size + 1):
                    values, first = windows(hashes, words.text, length)
                    for value, at in zip(values.view(np.int64).tolist(), first.tolist()):
                        text = words.text[at]
                        if length == size or bounds[text + 1] - bounds[text] == length:
                            gram = words.joined(at, length).decode()
                            out.append((value, gram, items[row + text], length))
                columns = list(zip(*out)) or [[], [], [], []]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(columns[0], pa.int64()),
                        pa.array(columns[1], pa.string()),
                        pa.array(columns[2], pa.string()),
                        pa.array(columns[3], pa.int32()),
                    ],
                    names=["hash", "gram", "item", "words"],
                )

    texts = benchmark.select(
        column(benchmark, "item_id").cast("string").alias("item"),
        F.coalesce(column(benchmark, "text"), F.lit("")).alias("text"),
    )
    found = materialise(texts.mapInArrow(cut, GRAMS).distinct(), "benchmark-windows")
    grams = found.select(*WINDOW_KEY).distinct().withColumn("window", F.monotonically_increasing_id())
    grams = materialise(grams, "windows")
    # stored, so that the items of a very common window may be split
    return grams, materialise(found.join(grams, WINDOW_KEY).select("window", "item"), "window-items")


class WindowSet:
    """The windows of one block, ready for lookup."""

    def __init__(self, rows: list[Row]):
        rows = sorted(rows, key=lambda r: r["hash"])
        self.keys = np.array([r["hash"] for r in rows], dtype=np.int64)
        self.grams = [r["gram"].encode() for r in rows]
        self.numbers = [r["window"] for r in rows]
        self.lengths = sorted({r["words"] for r in rows})
        # a hash can only be in the set if this says so of its upper bits
        self.maybe = np.zeros(1 << 20, dtype=bool)
        self.maybe[self.keys.view(np.uint64) >> np.uint64(44)] = True

    def hits(self, words: Words) -> Iterator[tuple[int, int, int]]:
        """First word, number of words and number of every window found in the texts."""
        hashes = word_hashes(words)
        for length in self.lengths:
            values, first = windows(hashes, words.text, length)
            near = np.flatnonzero(self.maybe[values >> np.uint64(44)])
            signed = values[near].view(np.int64)
            place = np.searchsorted(self.keys, signed)
            equal = self.keys[np.minimum(place, len(self.keys) - 1)] == signed
            for i, at in zip(near[equal].tolist(), place[equal].tolist()):
                start = int(first[i])
                text = words.joined(start, length)
                while at < len(self.keys) and self.keys[at] == values[i].view(np.int64):
                    if self.grams[at] == text:
                        yield start, length, self.numbers[at]
                    at += 1


def _runs(mask: np.ndarray) -> np.ndarray:
    """Begin and end of every run of true values, alternating."""
    return np.flatnonzero(np.diff(mask.astype(np.int8), prepend=0, append=0))


def scan(docs: DataFrame, grams: DataFrame, text_column: str, names: dict[str, str], cut: bool) -> DataFrame:
    """``docs`` with the number of words, the runs of hit words and the windows found.

    With ``cut`` the hit words are taken out of the text, each run from its
    first to its last byte. ``grams`` fits a broadcast.
    """
    spark = docs.sparkSession
    prepare_workers(spark)
    block = spark.sparkContext.broadcast(WindowSet(grams.collect()))
    again = names["hits"] in docs.columns  # of an earlier block
    base = [c for c in docs.columns if c not in names.values()]
    added = [
        T.StructField(names["words"], T.LongType()),
        T.StructField(names["hits"], T.ArrayType(T.IntegerType())),
        T.StructField(names["windows"], T.ArrayType(T.LongType())),
    ]
    place = base.index(text_column)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        windows_of = block.value
        for batch in batches:
            texts = batch.column(place)
            counts: list[int] = []
            hits: list[list[int]] = []
            found: list[list[int]] = []
            kept: list[bytes | None] = []
            before = batch.column(len(base) + 1).to_pylist() if again else None
            known = batch.column(len(base) + 2).to_pylist() if again else None
            filled = texts.fill_null("") if texts.null_count else texts
            for row, last, data, offsets in text_slices(filled):
                words = find_words(data, offsets, ALPHANUMERIC)
                bounds = words.per_text()
                mask = np.zeros(len(words.starts), dtype=bool)
                seen: dict[int, set[int]] = {}
                for start, length, number in windows_of.hits(words):
                    mask[start : start + length] = True
                    seen.setdefault(int(words.text[start]), set()).add(number)
                for i in range(last - row):
                    part = mask[bounds[i] : bounds[i + 1]]
                    numbers = seen.get(i, set())
                    if again:
                        pairs = before[row + i]
                        for s, e in zip(pairs[::2], pairs[1::2]):
                            part[s:e] = True
                        numbers |= set(known[row + i])
                    runs = _runs(part).tolist() if part.any() else []
                    counts.append(len(part))
                    hits.append(runs)
                    found.append(sorted(numbers))
                    if cut:
                        text = data[offsets[i] : offsets[i + 1]].tobytes()
                        kept.append(_without(text, runs, words, bounds[i], offsets[i]))
            results = [
                pa.array(counts, pa.int64()),
                pa.array(hits, pa.list_(pa.int32())),
                pa.array(found, pa.list_(pa.int64())),
            ]
            columns = batch.columns[: len(base)]
            if cut:
                cleaned = pa.array([t.decode() for t in kept], pa.string())
                columns[place] = pa.compute.if_else(texts.is_valid(), cleaned, pa.scalar(None, pa.string()))
            yield [*columns, *results]

    # the three columns of an earlier block are replaced
    return map_batches(docs, look, [] if again else added)


def _without(text: bytes, runs: list[int], words: Words, first: int, offset: int) -> bytes:
    parts, at = [], 0
    for s, e in zip(runs[::2], runs[1::2]):
        parts.append(text[at : words.starts[first + s] - offset])
        at = int(words.ends[first + e - 1] - offset)
    return b"".join([*parts, text[at:]])


def find_benchmark(
    docs: DataFrame,
    benchmark: DataFrame,
    text_column: str = "text",
    size: int = WINDOW,
    set_bytes: int = SET_BYTES,
    cut: bool = False,
) -> tuple[DataFrame, dict[str, str], DataFrame]:
    """``docs`` with three more columns, whose names are returned under words, hits and windows, and the windows' items.

    ``hits`` holds begin and end of each run of hit words, in words.
    """
    names = {k: fresh_name(docs, f"_{k}") for k in ("words", "hits", "windows")}
    grams, items = benchmark_windows(benchmark, size)
    each = F.octet_length("gram").cast("long") + 72
    total = grams.agg(F.sum(each)).first()[0] or 0
    blocks = max(1, -(-total // set_bytes))
    for i in range(blocks):
        block = grams.where(F.pmod("hash", F.lit(blocks)) == i) if blocks > 1 else grams
        # the text is cut once, when all hits are known
        docs = scan(docs, block, text_column, names, cut and i == blocks - 1)
        if i < blocks - 1:
            docs = materialise(docs, "scanned")
    return docs, names, items


def remove_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without any hit, all columns as they were."""
    found, names, _ = find_benchmark(docs, benchmark, **options)
    return found.where(F.size(names["hits"]) == 0).drop(*names.values())


def remove_spans(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """All documents, without the words that are hit."""
    found, names, _ = find_benchmark(docs, benchmark, cut=True, **options)
    return found.drop(*names.values())


def contamination_report(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Words, hit words and items found, per document."""
    rows = docs.select(column(docs, id_column).alias(id_column), column(docs, "text").alias("text"))
    found, names, items = find_benchmark(rows, benchmark)
    runs = F.col(names["hits"])
    hit = F.aggregate(
        F.sequence(F.lit(1), F.size(runs)),
        F.lit(0).cast("long"),
        lambda n, i: n + F.element_at(runs, i) * F.when(i % 2 == 0, 1).otherwise(-1),
    )
    hit = F.when(F.size(runs) > 0, hit).otherwise(F.lit(0).cast("long"))
    counted = found.select(
        column(found, id_column).alias("id"),
        F.col(names["words"]).alias("n_words"),
        hit.alias("n_hit"),
        F.when(F.size(runs) > 0, F.col(names["windows"])).alias("windows"),
    )
    counted = materialise(counted, "hits")
    sets = counted.where("windows IS NOT NULL").select("windows").distinct()
    held = sets.select("windows", F.explode("windows").alias("window")).join(items, "window")
    listed = held.groupBy("windows").agg(F.array_sort(F.collect_set("item")).alias("items"))
    listed = materialise(
        listed.select(
            "windows",
            F.size("items").cast("long").alias("n_items"),
            F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        ),
        "sets-of-windows",
    )
    return counted.join(listed, "windows", "left").select(
        F.col("id").alias(id_column),
        "n_words",
        "n_hit",
        F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("items_sha256"),
        F.col("windows").isNotNull().alias("contaminated"),
    )
