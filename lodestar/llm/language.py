"""Language of a text by a string kernel.

Two texts are as similar as the n-grams (of 1 to 4 characters) that occur in
both: the blended spectrum kernel on presence, divided by the root of both
texts' n-gram counts. A bounded sample of labelled texts gives landmarks, on
which the Nyström method maps texts, and kernel ridge regression is solved for
each language against the rest. As the map and the weights are linear in the
presence of n-grams, they are multiplied out once into one matrix, and a batch
of texts is scored by one product of its presence matrix with it.

N-grams are hashed into ``BUCKETS`` places. They are taken from whole texts in
lower case, in which anything but letters counts as a single blank.

A text that is null or has no letter is ``und`` with score 0; so is every
text if there is nothing to learn from. The score of others is the regression
value of the language, cut to 0 to 1; of equally scored languages the first
in order of name wins. Rows without id or language are not learnt from.
Repeated rows are learnt from once and predicted one by one. Other columns are
passed through, whatever their names.

The scores of a text add up to 1 over all languages, so they tell languages
apart but not whether a text is in any of them. That is told by the share of a
text's n-grams of the greatest length (each occurrence counts) that the sample
of the predicted language shows; a text of several languages may have each
passage known in another one. What share to expect is learnt by leaving out
each text of the sample in turn, and does not depend on how many languages
there are. Texts of a few words are too short to be judged by it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from lodestar.llm.common import column, fresh_name, map_batches, prepare_workers
from lodestar.scratch import materialise

#: N-gram lengths and the number of places they are hashed into.
LONGEST = 4
BUCKETS = 1 << 16
#: Bounds of the sample: texts per language, languages that have so many (each of more has fewer
#: texts, in proportion), code points of a text.
SAMPLE_TEXTS, SAMPLE_LANGUAGES, SAMPLE_CHARACTERS = 300, 64, 20_000
#: Code points of the longer texts of a language that has no others; its shortest is taken in any case.
LONG_CHARACTERS = 1 << 20
#: Landmarks in all, and the ridge.
LANDMARKS, RIDGE = 192, 1e-3
#: Texts scored by one matrix product; code points of a long text that are looked at together.
ROWS, PART = 64, 1 << 20

#: Places of the n-grams that a language shows, as a power of two.
SEEN_BITS = 20
#: What a text must reach of the typical share, the part of the sample that may fall below, and
#: the fewest different texts to learn the share from.
LEAST_OF_TYPICAL, LEAST_QUANTILE, LEAST_TEXTS = 0.75, 0.05, 10
#: N-grams of a passage, of which a text of several languages has some in each.
PASSAGE = 128
#: Standard deviations allowed; one is the root of a text's n-grams at most, as each letter is in LONGEST.
DEVIATIONS = 3
#: Texts with fewer n-grams (five or six words) are not judged: a name or two may fill them.
FEWEST_NGRAMS = 32

UNDETERMINED = "und"

_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0x100000001B3)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _parts(text: str) -> Iterator[tuple[np.ndarray, bool]]:
    """The code points of each part of ``text`` between blanks, and whether the part has a letter."""
    for at in range(0, max(len(text), 1), PART):
        part = text[at : at + PART + LONGEST - 1].lower()
        points = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        letter = _letters()[points]
        points = np.where(letter, points, 32).astype(np.uint64)
        after_blank = np.concatenate([[False], ~letter[:-1]]) if len(letter) else letter
        yield (
            np.concatenate([[32], points[letter | ~after_blank], [32]]).astype(np.uint64),
            bool(letter.any()),
        )


def _ngrams(points: np.ndarray) -> Iterator[np.ndarray]:
    """Hashes of the n-grams of one part, length by length; the places are their upper bits."""
    grams = np.zeros(len(points), dtype=np.uint64)
    for n in range(1, min(LONGEST, len(points)) + 1):
        grams = grams[: len(points) - n + 1] * _STEP + points[n - 1 :] + np.uint64(n)
        yield grams * _MULTIPLY


def mark_ngrams(text: str, row: np.ndarray) -> bool:
    """Set the places of all n-grams of ``text`` to one; whether it has a letter."""
    any_letter = False
    for points, letter in _parts(text):
        any_letter |= letter
        for grams in _ngrams(points):
            row[grams >> np.uint64(48)] = 1
    return any_letter


def longest_ngrams(text: str) -> Iterator[np.ndarray]:
    """Places, of 2 to the ``SEEN_BITS``, of all n-grams of the greatest length, part by part."""
    for points, _ in _parts(text):
        if len(points) >= LONGEST:
            *_, grams = _ngrams(points)
            yield (grams >> np.uint64(64 - SEEN_BITS)).astype(np.int64)


def presence(texts: Iterable[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Presence matrices of at most ``ROWS`` texts, and which of these have a letter."""
    matrix = np.zeros((ROWS, BUCKETS), dtype=np.float32)
    has = np.zeros(ROWS, dtype=bool)
    n = 0
    for text in texts:
        has[n] = text is not None and mark_ngrams(text, matrix[n])
        n += 1
        if n == ROWS:
            yield matrix, has
            matrix.fill(0)
            n = 0
    if n:
        yield matrix[:n], has[:n]


@dataclass
class LanguageModel:
    """Weights of each n-gram place for each language, and what n-grams its texts show."""

    languages: list[str]
    weights: np.ndarray
    bias: np.ndarray
    #: A bit for each place of the longest n-grams, and the least share of a text's that must be set.
    seen: list[np.ndarray]
    least: list[float]

    def score(self, matrix: np.ndarray) -> np.ndarray:
        size = np.maximum(matrix.sum(axis=1, keepdims=True), 1)
        return matrix @ self.weights / np.sqrt(size) + self.bias

    def _shown(self, language: int, places: np.ndarray) -> np.ndarray:
        return (self.seen[language][places >> 3] >> (places & 7).astype(np.uint8)) & 1

    def familiar(self, text: str, language: int) -> bool:
        """Whether ``text`` may be in the language, or each passage of it in one of the languages."""
        least = self.least[language]
        if least <= 0:
            return True
        known = count = 0
        for places in longest_ngrams(text):
            known += int(self._shown(language, places).sum())
            count += len(places)
        needed = least * count - DEVIATIONS * np.sqrt(count)
        if known >= needed or count < FEWEST_NGRAMS:
            return True
        known = 0
        for places in longest_ngrams(text):
            begins = np.arange(0, len(places), PASSAGE)
            best = np.zeros(len(begins), dtype=np.int64)
            for l in range(len(self.languages)):
                best = np.maximum(best, np.add.reduceat(self._shown(l, places), begins, dtype=np.int64))
            known += int(best.sum())
        return known >= needed


def sample(docs: DataFrame, text: Column, label: Column, key: Column, learn: Column) -> DataFrame:
    """A bounded, repeatable sample of labelled texts of every language, in a random order."""
    rows = docs.where(
        learn & label.isNotNull() & text.isNotNull() & key.isNotNull()
    ).select(key.alias("key"), label.cast("string").alias("label"), text.alias("text"))
    rows = rows.withColumn("check", F.xxhash64("text"))
    ids = rows.select("key", "label", "check", F.char_length("text").alias("size")).distinct()
    order = F.xxhash64("key", "check")
    short = F.col("size") <= SAMPLE_CHARACTERS
    languages = materialise(ids.groupBy("label").agg(F.count_if(short).alias("count")), "languages")
    wanted = min(SAMPLE_TEXTS, max(1, SAMPLE_TEXTS * SAMPLE_LANGUAGES // max(languages.count(), 1)))
    # About four times as many as wanted of each language are drawn by their hash, so the
    # window that picks the exact number sees a bounded group of each.
    share = F.pmod(order, F.lit(1 << 31)) * F.col("count")
    drawn = ids.where(short).join(languages.where("count > 0"), "label").where(share < 4 * SAMPLE_TEXTS * (1 << 31))
    top = Window.partitionBy("label").orderBy(F.pmod(order, F.lit(1 << 31)), order, "key")
    picked = drawn.withColumn("_rank", F.row_number().over(top)).where(F.col("_rank") <= wanted)
    # of languages that have long texts only, the shortest of these
    long = ids.where(~short).join(languages.where("count = 0"), "label")
    by_size = Window.partitionBy("label").orderBy("size", order, "key")
    ranked = long.withColumn("_rank", F.row_number().over(by_size)).where(F.col("_rank") <= wanted)
    so_far = F.sum("size").over(Window.partitionBy("label").orderBy("_rank"))
    shortest = ranked.withColumn("_sum", so_far).where((F.col("_sum") <= LONG_CHARACTERS) | (F.col("_rank") == 1))
    picked = picked.select("key", "label", "check").unionByName(shortest.select("key", "label", "check"))
    # at most SAMPLE_TEXTS * SAMPLE_LANGUAGES ids, or one for each of more languages
    texts = rows.join(F.broadcast(picked), ["key", "label", "check"])
    once = texts.dropDuplicates(["key", "label", "check"])
    return once.orderBy(F.xxhash64("key", "check"), "key", "label").select("label", "text")


def learn_seen(texts: list[str]) -> tuple[np.ndarray, float]:
    """The bits of all n-grams that one language's texts show, and the least share a text needs."""
    texts = sorted(set(texts))
    shown = np.zeros(1 << SEEN_BITS, dtype=np.int32)  # in how many texts
    for text in texts:
        own = np.zeros(1 << SEEN_BITS, dtype=bool)
        for places in longest_ngrams(text):
            own[places] = True
        shown += own
    shares = []
    for text in texts:
        others = [shown[places] > 1 for places in longest_ngrams(text)]
        if others:
            shares.append(np.concatenate(others).mean())
    least = 0.0
    if len(shares) >= LEAST_TEXTS:
        least = min(LEAST_OF_TYPICAL * np.median(shares), np.quantile(shares, LEAST_QUANTILE))
    return np.packbits(shown > 0, bitorder="little"), float(least)


def fit(examples: Iterable[tuple[str, str]], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> LanguageModel | None:
    """Learn from (language, text) pairs in random order; None without any."""
    examples = list(examples)
    if not examples:
        return None
    languages = sorted({label for label, _ in examples})
    share = max(1, landmarks // len(languages))
    taken = dict.fromkeys(languages, 0)
    chosen = []
    for i, (label, _) in enumerate(examples):
        if taken[label] < share:
            taken[label] += 1
            chosen.append(i)
    marks = np.concatenate(
        [m / np.sqrt(np.maximum(m.sum(axis=1, keepdims=True), 1)) for m, _ in presence(examples[i][1] for i in chosen)]
    ).T  # places x landmarks
    kernel = []
    for matrix, _ in presence(text for _, text in examples):
        size = np.maximum(matrix.sum(axis=1, keepdims=True), 1)
        kernel.append(matrix @ marks / np.sqrt(size))
    similar = np.concatenate(kernel).astype(np.float64)
    values, vectors = np.linalg.eigh((marks.T @ marks).astype(np.float64))
    usable = values > 1e-6 * values[-1]
    root = vectors[:, usable] / np.sqrt(values[usable])
    mapped = similar @ root  # the Nyström map of the examples
    target = np.array([[label == l for l in languages] for label, _ in examples], dtype=np.float64)
    # examples weigh so that every language counts the same
    weight = (1 / target.sum(axis=0) / len(languages))[target.argmax(axis=1)][:, None]
    centre, mean = (weight * mapped).sum(axis=0), (weight * target).sum(axis=0)
    left = mapped - centre
    gram = left.T @ (weight * left) + ridge * np.eye(left.shape[1])
    solved = np.linalg.solve(gram, left.T @ (weight * (target - mean)))
    bias = mean - centre @ solved
    weights = marks @ (root @ solved).astype(np.float32)
    seen, least = zip(*(learn_seen([t for label, t in examples if label == l]) for l in languages))
    return LanguageModel(
        languages, weights.astype(np.float32), bias.astype(np.float32), list(seen), list(least)
    )


def held_out(key: Column) -> Column:
    """Whether a document is kept from learning: CRC-32 of its id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(key.cast("string")) % 5 == 0, F.lit(False))


def identify(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "lang",
    only_familiar: bool = False,
) -> tuple[DataFrame, str, str]:
    """``docs`` with two more columns, whose names are returned: the language and its score.

    Labels, ids and other columns serve learning at most, never a prediction. With
    ``only_familiar`` a text that looks like none of the languages is ``und`` with score 0 too.
    """
    spark = docs.sparkSession
    prepare_workers(spark)
    key, text = column(docs, id_column), column(docs, text_column)
    rows = sample(docs, text, column(docs, label_column), key, ~held_out(key))
    model = fit((r["label"], r["text"]) for r in rows.toLocalIterator())
    shared = spark.sparkContext.broadcast(model)
    language, score = fresh_name(docs, "lang_pred"), fresh_name(docs, "score")
    added = [T.StructField(language, T.StringType()), T.StructField(score, T.DoubleType())]
    place = docs.columns.index(text_column)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        known = shared.value
        for batch in batches:
            names: list[str] = []
            scores: list[float] = []
            texts = batch.column(place)
            for matrix, has in presence(t.as_py() for t in texts):
                if known is None:
                    names += [UNDETERMINED] * len(has)
                    scores += [0.0] * len(has)
                    continue
                values = known.score(matrix)
                best = values.argmax(axis=1)
                top = np.clip(values[np.arange(len(best)), best], 0, 1)
                if only_familiar:
                    at = len(names)
                    has = np.array(
                        [h and known.familiar(texts[at + i].as_py(), b) for i, (b, h) in enumerate(zip(best, has))]
                    )
                names += [known.languages[b] if h else UNDETERMINED for b, h in zip(best, has)]
                scores += np.where(has, top, 0.0).astype(float).tolist()
            yield [*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())]

    return map_batches(docs, predict, added), language, score


def keep_identified(docs: DataFrame, **columns) -> DataFrame:
    """The documents in one of the languages, all columns as they were."""
    found, language, score = identify(docs, only_familiar=True, **columns)
    return found.where(F.col(language) != UNDETERMINED).drop(language, score)


def language_report(docs: DataFrame) -> DataFrame:
    """Prediction and score for every document, and whether it was kept from learning."""
    rows = docs.select(*(column(docs, c).alias(c) for c in ("doc_id", "text", "lang")))
    found, language, score = identify(rows)
    return found.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col(language).alias("lang_pred"),
        F.col(score).alias("score"),
    )
