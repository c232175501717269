"""Near duplicates: documents whose word shingles have a Jaccard similarity of T per cent or more.

Exact, and without pairs of a whole group. All sets are ordered by one global
order, and of each only a prefix is looked at. If a set of n shingles shows its
first n - ceil(T n / 100) + l, two similar sets share at least l of what they
show. The join adapts l to each document:

1. Copies. Documents with the same set form a class; one of each goes on.
2. Cost. The shingles of all shortest prefixes are counted. Frequent ones are
   moved to the end of the global order, most frequent last, and what the
   prefixes show then is counted again, until no shingle that many documents
   show passes as rare. A document's estimated cost is the sum of the counts of
   the frequent shingles it shows, and its prefix grows by the logarithm of that.
3. Rare shingles shown by two documents make a candidate. Sets of x and y
   shingles that show p and q of them must share as many as
   ceil(T (x + y) / (100 + T)) - max(x - p, y - q) there, which almost only
   true pairs do. Only those are verified on the texts.
4. Frequent shingles would make a candidate of every two of thousands of near
   copies. Instead, all documents that show one are compared with its leader
   (the document with the fewest rare shingles, the base text, as it were), and
   each is described by its differences from it. The difference of two sets is
   the difference of their differences: documents linked to the leader need no
   comparison, and two others can be similar only if they share some of these,
   which is a join on prefixes as above, but on differences, which are rare.
   Where many documents differ from the leader alike, one of them becomes the
   leader of those, and so on.

Links become components by contraction.

Null and empty texts have no shingles and are linked with nothing. A text of
fewer words than a shingle is one shingle. Repeated rows are copies. Null ids
never name a component that has another id. An empty table gives an empty
result. Columns other than the id and the text are not looked at, or passed
through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from lodestar.llm.common import (
    BROADCAST_ROWS,
    FILE,
    PLACE,
    prepare_workers,
    column,
    named_in,
    with_places,
    without_rows,
)
from lodestar.llm.components import connected
from lodestar.llm.tokens import (
    BLANK_SEPARATED,
    find_words,
    mix,
    text_slices,
    windows,
    word_hashes,
)
from lodestar.scratch import discard, materialise

#: A shingle counts as frequent from this many prefixes on; doubled until ``MOST_FREQUENT`` fit.
FREQUENT = 32
#: Rare shingles are shown by fewer documents than this; otherwise all is counted again.
MANY = 128
#: Pairs of one leader and difference beyond which these documents get a leader of their own, and
#: rounds of that; what is crowded even then is joined.
CROWDED, ROUNDS = 1_000_000, 4
#: How far a count looks ahead for each shingle that was moved, and the most by which a prefix grows for its cost.
AHEAD, LONGER = 3, 32
#: The most frequent shingles that are broadcast (16 bytes each); only cost depends on it.
MOST_FREQUENT = 1_000_000

_U64 = np.uint64


@dataclass
class Sets:
    """The distinct shingles of some texts, ascending per text, and where each text's begin."""

    values: np.ndarray
    bounds: np.ndarray

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.bounds)

    def places(self) -> np.ndarray:
        """The place of every shingle in its set."""
        return np.arange(len(self.values)) - np.repeat(self.bounds[:-1], self.sizes)

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), self.sizes)

    def __getitem__(self, text: int) -> np.ndarray:
        return self.values[self.bounds[text] : self.bounds[text + 1]]


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> Sets:
    """Distinct shingles of ``size`` words; the whole text if it has fewer words, but not none."""
    words = find_words(data, offsets, BLANK_SEPARATED)
    hashes, counts = word_hashes(words), np.diff(words.per_text())
    values, first = windows(hashes, words.text, size)
    parts, owners = [values], [words.text[first]]
    for length in range(1, size):
        if (counts == length).any():
            values, first = windows(hashes, words.text, length)
            whole = counts[words.text[first]] == length
            parts.append(values[whole])
            owners.append(words.text[first][whole])
    values, owner = np.concatenate(parts), np.concatenate(owners)
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    new = np.ones(len(values), dtype=bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    values, owner = values[new], owner[new]
    return Sets(values, np.searchsorted(owner, np.arange(words.texts + 1)))


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64), pa.int64())


def shortest_prefix(sizes: np.ndarray, least: int) -> np.ndarray:
    """Shingles that a set of each size shows at least: n - ceil(T n / 100) + 1."""
    return np.where(sizes > 0, sizes + (-least * sizes) // 100 + 1, 0)


def can_link(sizes, least: int):
    """Whether a set may be similar to a different one: the closest has one shingle more."""
    return 100 * sizes >= least * (sizes + 1)


class Frequent:
    """The frequent shingles with their counts, as sorted arrays."""

    def __init__(self, values: np.ndarray, counts: np.ndarray):
        order = np.argsort(values)
        self.values, self.counts = values[order], counts[order]
        # rank in the global order, from 1: by count, then by value
        self.ranks = np.empty(len(values), dtype=np.int64)
        self.ranks[np.lexsort((self.values, self.counts))] = np.arange(1, len(values) + 1)
        self.maybe = np.zeros(1 << 20, dtype=bool)
        self.maybe[self.values >> _U64(44)] = True

    def find(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (0 if not frequent) and count of every value."""
        ranks = np.zeros(len(values), dtype=np.int64)
        counts = np.zeros(len(values), dtype=np.int64)
        near = np.flatnonzero(self.maybe[values >> _U64(44)])
        at = np.searchsorted(self.values, values[near])
        at[at == len(self.values)] = 0
        hit = self.values[at] == values[near] if len(self.values) else np.zeros(len(near), bool)
        ranks[near[hit]] = self.ranks[at[hit]]
        counts[near[hit]] = self.counts[at[hit]]
        return ranks, counts


def in_order(sets: Sets, known: Frequent) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingles of each set in the global order, frequent ones last, with their ranks and counts."""
    ranks, counts = known.find(sets.values)
    order = np.argsort((sets.owners() << 32) | ranks, kind="stable")
    return sets.values[order], ranks[order], counts[order]


def _tokens(docs: DataFrame, size: int, least: int, known: Broadcast | None) -> DataFrame:
    """Shingles with the number of documents that show them.

    Without ``known`` these are all shingles of the shortest prefixes. With it, rare ones of the
    prefixes as ``known`` orders them (``shown``), and ``count`` also has documents that would show
    them if more became frequent: ``AHEAD`` times as many places as frequent ones were moved from.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in text_slices(batch["text"]):
                sets = shingle_sets(data, offsets, size)
                prefix = shortest_prefix(sets.sizes, least)
                place = sets.places()
                if known is None:
                    chosen = shown = place < np.repeat(prefix, sets.sizes)
                    values = sets.values
                else:
                    ranks, _ = known.value.find(sets.values)
                    early = (ranks > 0) & (place < np.repeat(prefix, sets.sizes))
                    moved = np.bincount(sets.owners(), early, len(prefix)).astype(np.int64)
                    values, ranks, _ = in_order(sets, known.value)
                    slack = np.where(moved > 0, LONGER, 0)
                    shown = (ranks == 0) & (place < np.repeat(prefix + slack, sets.sizes))
                    reach = np.where(2 * moved >= prefix, sets.sizes, prefix + slack + AHEAD * moved)
                    chosen = (ranks == 0) & (place < np.repeat(reach, sets.sizes))
                found, which, counts = np.unique(values[chosen], return_inverse=True, return_counts=True)
                seen = np.bincount(which, shown[chosen], len(found)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [_signed(found), pa.array(counts, pa.int64()), pa.array(seen)], names=["token", "count", "shown"]
                )

    rows = docs.select("text").mapInArrow(count, "token bigint, count bigint, shown bigint")
    return rows.groupBy("token").agg(F.sum("count").alias("count"), F.sum("shown").alias("shown"))


def frequent_shingles(docs: DataFrame, size: int, least: int) -> Frequent:
    """Shingles worth avoiding, as many as fit.

    To move a frequent shingle away lets others move up, which may be just as frequent. So what
    the prefixes then show is counted again, until ``MANY`` documents or more show none of the rare ones.
    """
    spark = docs.sparkSession
    values, counts = np.empty(0, dtype=_U64), np.empty(0, dtype=np.int64)
    known = None
    while True:
        counted = _tokens(docs, size, least, known).where(F.col("count") >= FREQUENT)
        stored = materialise(counted, "frequent")
        worst = stored.agg(F.max("shown")).first()[0] or 0
        floor = FREQUENT
        while stored.where(F.col("count") >= floor).count() > MOST_FREQUENT // 2:
            floor *= 2
        rows = stored.where(F.col("count") >= floor).toPandas()
        discard(stored)
        fresh = ~np.isin(rows["token"].to_numpy(np.int64).view(_U64), values)
        values = np.concatenate([values, rows["token"].to_numpy(np.int64).view(_U64)[fresh]])
        counts = np.concatenate([counts, rows["count"].to_numpy(np.int64)[fresh]])
        most = np.argsort(-counts, kind="stable")[:MOST_FREQUENT]
        values, counts = values[most], counts[most]
        done = not fresh.any() or (known is not None and worst < MANY)
        if known is not None:
            known.unpersist()
        if done:
            return Frequent(values, counts)
        known = spark.sparkContext.broadcast(Frequent(values, counts))


def signatures(docs: DataFrame, size: int, least: int, frequent: Broadcast) -> DataFrame:
    """Set size, set digest and the shown shingles of every document, stored.

    ``docs`` has id, text and the places of its rows; ``node`` tells rows apart.
    """
    kind = docs.schema["id"].dataType
    schema = (
        f"id {kind.simpleString()}, {FILE} bigint, {PLACE} bigint, n int, high bigint, low bigint,"
        " rare array<bigint>, often array<bigint>"
    )

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order_of = frequent.value
        for batch in batches:
            for row, last, data, offsets in text_slices(batch["text"]):
                sets = shingle_sets(data, offsets, size)
                sizes = sets.sizes
                digests = []
                for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F):
                    sums = np.zeros(len(sets.values) + 1, dtype=_U64)
                    np.cumsum(mix(sets.values ^ _U64(salt)), out=sums[1:])
                    digests.append(sums[sets.bounds[1:]] - sums[sets.bounds[:-1]])
                owner = sets.owners()
                values, ranks, counts = in_order(sets, order_of)
                place = sets.places()
                prefix = shortest_prefix(sizes, least)
                shortest = place < np.repeat(prefix, sizes)
                cost = np.bincount(owner, counts * shortest, len(sizes))
                longer = np.floor(np.log2(1 + cost / (FREQUENT * np.maximum(prefix, 1))))
                prefix = np.minimum(prefix + np.minimum(longer, LONGER).astype(np.int64), sizes)
                prefix[~can_link(sizes, least)] = 0
                shown = place < np.repeat(prefix, sizes)
                lists = []
                for part in (shown & (ranks == 0), shown & (ranks > 0)):
                    ends = np.concatenate([[0], np.cumsum(np.bincount(owner[part], minlength=len(sizes)))])
                    lists.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), _signed(values[part])))
                columns = [batch[c].slice(row, last - row) for c in ("id", FILE, PLACE)]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(sizes, pa.int32()), *map(_signed, digests), *lists],
                    names=["id", FILE, PLACE, "n", "high", "low", "rare", "often"],
                )

    signed = docs.select("id", "text", FILE, PLACE).mapInArrow(sign, schema)
    return materialise(signed.withColumn("node", F.monotonically_increasing_id()), "signatures")


CLASS = ["high", "low", "n"]


def _classes(signed: DataFrame) -> DataFrame:
    """Classes of equal sets that have several members: smallest node and id."""
    groups = signed.where("n > 0").groupBy(*CLASS)
    found = groups.agg(F.min("node").alias("first"), F.min("id").alias("least_id"), F.count("*").alias("members"))
    return materialise(found.where("members > 1"), "classes")


def _needed(x: str, y: str, least: int) -> Column:
    """Shingles that two sets must share among those they show."""
    total = F.col(f"n_{x}") + F.col(f"n_{y}")
    overlap = F.floor((total * least + 99 + least) / (100 + least)).cast("int")
    hidden = F.greatest(
        F.col(f"n_{x}") - F.col(f"shown_{x}"), F.col(f"n_{y}") - F.col(f"shown_{y}")
    )
    return overlap - hidden


def rare_candidates(postings: DataFrame, least: int) -> DataFrame:
    """Pairs a < b that share enough shown shingles, of which one at least is rare."""
    a, b = (
        postings.select(
            "token", *(F.col(c).alias(f"{c}_{s}") for c in ("node", "n", "shown", "frequent"))
        )
        for s in ("a", "b")
    )
    close = (F.col("n_a") * 100 >= F.col("n_b") * least) & (F.col("n_b") * 100 >= F.col("n_a") * least)
    pairs = a.join(b, "token").where((F.col("node_a") < F.col("node_b")) & close)
    keys = ["node_a", "node_b", "n_a", "n_b", "shown_a", "shown_b", "frequent_a", "frequent_b"]
    shared = pairs.groupBy(*keys).agg(F.count("*").alias("shared"))
    most = F.col("shared") + F.least("frequent_a", "frequent_b")
    return shared.where(most >= _needed("a", "b", least)).select("node_a", "node_b")


def leader_pairs(signed: DataFrame) -> DataFrame:
    """Every document that shows a frequent shingle with the leaders of those it shows."""
    shown = signed.where(F.size("often") > 0).select(
        "node", F.size("rare").alias("rare"), F.explode("often").alias("token")
    )
    leaders = shown.groupBy("token").agg(
        F.min(F.struct("rare", "node")).alias("lead"), F.count("*").alias("showing")
    )
    # stored, so that the documents of a very frequent shingle may be split
    stored = materialise(
        leaders.where("showing > 1").select("token", F.col("lead.node").alias("leader")), "leaders"
    )
    return shown.join(stored, "token").where("node <> leader").select("leader", "node").distinct()


def fetch_texts(docs: DataFrame, signed: DataFrame, nodes: DataFrame) -> DataFrame:
    """The texts of some documents, stored once."""
    places = materialise(signed.select("node", FILE, PLACE).join(nodes, "node"), "places")
    few = places.count() <= BROADCAST_ROWS
    side = F.broadcast(places) if few else places.hint("shuffle_hash")
    return materialise(docs.select("text", FILE, PLACE).join(side, [FILE, PLACE]).select("node", "text"), "texts")


def _paired_texts(pairs: DataFrame, texts: DataFrame, one: str, other: str) -> DataFrame:
    left = texts.toDF(one, "text_one")
    right = texts.toDF(other, "text_other")
    return pairs.join(left, one).join(right, other)


def _pair_sets(batch: pa.RecordBatch, size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Row and both sets of every pair of texts."""
    for row, last, data, offsets in text_slices(batch["text_one"]):
        ones = shingle_sets(data, offsets, size)
        rest = batch["text_other"].slice(row, last - row)
        for at, stop, other_data, other_offsets in text_slices(rest):
            others = shingle_sets(other_data, other_offsets, size)
            for i in range(at, stop):
                yield row + i, ones[i], others[i - at]


def verified(pairs: DataFrame, texts: DataFrame, size: int, least: int) -> DataFrame:
    """The pairs ``node_a`` and ``node_b`` that are similar, as links ``a`` and ``b``."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = np.zeros(batch.num_rows, dtype=bool)
            for row, x, y in _pair_sets(batch, size):
                both = len(np.intersect1d(x, y, assume_unique=True))
                good[row] = 100 * both >= least * (len(x) + len(y) - both) > 0
            yield pa.RecordBatch.from_arrays(
                [batch["node_a"], batch["node_b"]], names=["a", "b"]
            ).filter(pa.array(good))

    joined = _paired_texts(pairs, texts, "node_a", "node_b")
    return joined.select("node_a", "node_b", "text_one", "text_other").mapInArrow(check, "a bigint, b bigint")


DIFFERENCES = "leader bigint, node bigint, n int, size int, linked boolean, shown array<bigint>"


def differences(stars: DataFrame, texts: DataFrame, size: int, least: int, frequent: Broadcast) -> DataFrame:
    """How each document differs from its leader, stored.

    Differences are ordered: shingles the leader lacks, rare ones first, then
    those the document lacks. Of s differences, b + 1 are shown, where b is the
    most by which the document may differ from any similar one.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order_of = frequent.value
        for batch in batches:
            sizes, counts, linked, shown = [], [], [], []
            for _, lead, own in _pair_sets(batch, size):
                extra = np.setdiff1d(own, lead, assume_unique=True)
                lacking = np.setdiff1d(lead, own, assume_unique=True)
                ranks, _ = order_of.find(extra)
                extra = extra[np.argsort(ranks, kind="stable")]
                every = np.concatenate([extra, lacking])
                n, largest = len(own), 100 * len(own) // least
                sizes.append(n)
                counts.append(len(every))
                linked.append(len(every) * (100 + least) <= (100 - least) * (n + len(lead)))
                shown.append(every[: (100 - least) * (n + largest) // (100 + least) + 1])
            ends = np.concatenate([[0], np.cumsum([len(s) for s in shown])])
            flat = np.concatenate(shown) if shown else np.empty(0, dtype=_U64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["leader"],
                    batch["node"],
                    pa.array(sizes, pa.int32()),
                    pa.array(counts, pa.int32()),
                    pa.array(linked, pa.bool_()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), _signed(flat)),
                ],
                names=["leader", "node", "n", "size", "linked", "shown"],
            )

    joined = _paired_texts(stars, texts, "leader", "node")
    rows = joined.select("leader", "node", "text_one", "text_other").mapInArrow(compare, DIFFERENCES)
    return materialise(rows, "differences")


def crowded_differences(differing: DataFrame) -> DataFrame:
    """Differences from a leader that many documents show, with the one of them that differs least, stored.

    Documents that are linked to the leader need no comparison with each other, so only
    pairs with one that is not are counted.
    """
    posted = differing.select("leader", "node", "size", "linked", F.explode("shown").alias("token"))
    groups = posted.groupBy("leader", "token").agg(
        F.count("*").alias("showing"),
        F.count_if(~F.col("linked")).alias("apart"),
        F.min(F.struct("size", "node")).alias("lead"),
    )
    crowded = groups.where(F.col("apart") * F.col("showing") >= CROWDED)
    return materialise(crowded.select("leader", "token", F.col("lead.node").alias("second")), "crowded")


def second_leaders(differing: DataFrame, crowded: DataFrame) -> DataFrame:
    """Documents of crowded differences with the document that they are compared with next."""
    posted = differing.select("leader", "node", F.explode("shown").alias("token"))
    joined = posted.join(crowded, ["leader", "token"]).where("node <> second")
    return joined.select(F.col("second").alias("leader"), "node").distinct()


def difference_candidates(differing: DataFrame, least: int, crowded: DataFrame) -> DataFrame:
    """Pairs a < b of one leader, not both linked to it, that may share enough differences.

    Two documents with s and t differences that are to differ by no more than d
    share o = (s + t - d) / 2 of them, so one within the first s - o + 1 and t - o + 1.
    Crowded differences are left to a second leader.
    """
    posted = differing.select(
        "leader", "node", "n", "size", "linked", F.posexplode("shown").alias("place", "token")
    ).join(crowded.select("leader", "token"), ["leader", "token"], "left_anti")
    a, b = (
        posted.select(
            "leader", "token", *(F.col(c).alias(f"{c}_{s}") for c in ("node", "n", "size", "linked", "place"))
        )
        for s in ("a", "b")
    )
    apart = F.floor((F.col("n_a") + F.col("n_b")) * (100 - least) / (100 + least)).cast("int")
    both = F.floor((F.col("size_a") + F.col("size_b") - apart + 1) / 2).cast("int")
    both = F.greatest(both, F.lit(1))
    possible = (F.col("node_a") < F.col("node_b")) & ~(F.col("linked_a") & F.col("linked_b"))
    possible &= F.col("place_a") <= F.col("size_a") - both
    possible &= F.col("place_b") <= F.col("size_b") - both
    return a.join(b, ["leader", "token"]).where(possible).select("node_a", "node_b").distinct()


def leader_links(
    stars: DataFrame, texts: DataFrame, size: int, least: int, frequent: Broadcast
) -> tuple[DataFrame, list[DataFrame]]:
    """Links found by comparison with leaders, and with second ones where many differ alike; stored tables to discard.

    The documents of a crowded difference all have it, so from one of them they do not differ by
    it. A leader that gets more documents in a later round is compared with all it ever had, as any
    two of these may be similar. The last round joins all differences, crowded or not.
    """
    found, used, compared = [], [], []
    for left in range(ROUNDS - 1, -1, -1):
        differing = differences(stars, texts, size, least, frequent)
        crowded = crowded_differences(differing)
        compared.append(stars.select("leader", "node"))
        used += [stars, differing, crowded]
        stars = None
        if left and not crowded.isEmpty():
            before = reduce(DataFrame.union, compared)
            new = materialise(second_leaders(differing, crowded).join(before, ["leader", "node"], "left_anti"), "stars")
            used.append(new)
            if not new.isEmpty():
                grown = before.join(new.select("leader").distinct(), "leader", "left_semi")
                stars = materialise(new.union(grown).distinct(), "stars")
        elsewhere = crowded if stars is not None else crowded.limit(0)
        pairs = materialise(difference_candidates(differing, least, elsewhere), "pairs")
        used.append(pairs)
        found += [differing.where("linked").select("leader", "node"), verified(pairs, texts, size, least)]
        if stars is None:
            break
    return reduce(DataFrame.union, found), used


def similar_components(docs: DataFrame, size: int, least: int) -> tuple[DataFrame, DataFrame]:
    """Signatures of all documents, and root and smallest id of those in a component.

    ``docs`` has id, text (not null) and the places of its rows. ``least`` is in
    per cent.
    """
    spark = docs.sparkSession
    prepare_workers(spark)
    frequent = spark.sparkContext.broadcast(frequent_shingles(docs, size, least))
    shown = signatures(docs, size, least, frequent)
    signed = materialise(shown.select("node", "id", FILE, PLACE, *CLASS), "signed")
    classes = _classes(signed)
    # One document of each class goes on. The others are those of a class but its first.
    others = signed.select("node", *CLASS).join(classes, CLASS).where("node <> first")
    members = materialise(others.select("node", "first"), "members")
    one_each = shown.join(members.select("node").hint("shuffle_hash"), "node", "left_anti")
    single = materialise(one_each.select("node", "n", "rare", "often").where("size(rare) + size(often) > 0"), "single")
    discard(shown, classes)
    postings = single.select(
        "node",
        "n",
        (F.size("rare") + F.size("often")).alias("shown"),
        F.size("often").alias("frequent"),
        F.explode("rare").alias("token"),
    )
    pairs = materialise(rare_candidates(postings, least), "pairs")
    stars = materialise(leader_pairs(single), "stars")
    nodes = [pairs.select(F.col(c).alias("node")) for c in ("node_a", "node_b")]
    nodes += [stars.select(F.col(c).alias("node")) for c in ("leader", "node")]
    wanted = nodes[0].union(nodes[1]).union(nodes[2]).union(nodes[3]).distinct()
    texts = fetch_texts(docs, signed, wanted)
    led, used = leader_links(stars, texts, size, least, frequent)
    links = verified(pairs, texts, size, least).union(led).union(members.select("node", "first"))
    roots = connected(links)
    discard(single, members, pairs, texts, *used)
    smallest = (
        signed.select("node", "id").join(roots, "node").groupBy("root").agg(F.min("id").alias("least_id"))
    )
    placed = roots.join(materialise(smallest, "components"), "root")
    return signed, materialise(placed, "components")


def _prepared(docs: DataFrame, placed: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return placed.select(
        column(placed, named_in(placed, docs, id_column)).alias("id"),
        F.coalesce(column(placed, named_in(placed, docs, text_column)), F.lit("")).alias("text"),
        FILE,
        PLACE,
    )


def near_duplicates(
    docs: DataFrame, size: int = 5, least: int = 80, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per document: the size of its set and the smallest id of its component."""
    signed, placed = similar_components(_prepared(docs, with_places(docs), id_column, text_column), size, least)
    rows = signed.select("node", "id", "n").join(placed, "node", "left")
    component = F.when(F.col("root").isNull(), F.col("id")).otherwise(F.col("least_id"))
    return rows.select(
        F.col("id").alias(id_column),
        F.col("n").cast("long").alias("n_shingles"),
        component.alias("component_id"),
    )


def drop_near_duplicates(
    docs: DataFrame, size: int = 5, least: int = 80, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``docs`` with one document of each component, that of the smallest id, all columns as they were."""
    rows = with_places(docs)
    signed, placed = similar_components(_prepared(docs, rows, id_column, text_column), size, least)
    inside = signed.select("node", "id", FILE, PLACE).join(placed, "node")
    stays = inside.groupBy("root").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "node")).alias("first")
    )
    keepers = materialise(stays.select(F.col("first.node").alias("node")), "keepers")
    gone = inside.select("node", FILE, PLACE).join(keepers, "node", "left_anti")
    return without_rows(rows, materialise(gone.select(FILE, PLACE), "dropped"), docs)
