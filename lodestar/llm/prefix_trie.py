"""The trie of conversation prefixes, from adaptive radix trees over turn ids.

A turn's id is 16 bytes: the first half of the SHA-256 of its role and text. A
conversation is the string of its turn ids, so every byte depth that is a
multiple of 16 is a number of turns, and only there a tree gives a node.

1. Turns are numbered per conversation; texts stay where they are, only ids and
   lengths are shuffled. A conversation that is too large for a task is split.
2. Conversations are cut into levels of ``LEVEL_TURNS`` turns, so no row holds
   more. The trie of a level hangs below the full strings of the level above.
   Equal strings become one class with its number of members and its smallest.
3. The classes of a level are sorted globally. Tasks build a radix tree for each
   run of neighbouring classes (bounded in classes and turns). Nodes have room
   for 4, 16, 48 or 256 children, growing as needed, and hold the bytes that
   all strings below them share.
4. A node's strings stand together in the sort, so a node that does not hold the
   first or the last string of its run is complete. The others are added up over
   runs, less what the two sides of a border have in common. Every sum over a
   subtree is a difference of such additive numbers: saved tokens are the
   characters of all members from a node on, less those of the distinct nodes.
5. Parents that are complete are known in the tree, others are joined.

Members that end together may be many: their ids are sorted globally and joined
to pieces of bounded size, which pass through SHA-256 one after the other (that
function has no other way), not held in memory.

Turns are ordered by turn (null first), then by id where turns are equal; a
repeated row is a turn of its own. Null role or text is empty. Rows without a
conversation id belong to no conversation and are left out. An empty table gives
no nodes. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from lodestar.llm.common import BROADCAST_ROWS, column, prepare_workers
from lodestar.operators.ranking import rank_within
from lodestar.scratch import discard, materialise

#: Bytes of a turn id.
TURN = 16
#: The most turns of a conversation that one string holds.
LEVEL_TURNS = 1 << 15
#: A tree is closed when it has so many classes or turns.
RUN_CLASSES, RUN_TURNS = 20_000, 1 << 17
#: Ids of members that are joined to one piece.
PIECE_IDS = 10_000
NO_ENDS = hashlib.sha256(b"").hexdigest()


def turn_sequences(
    conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """``conv``, ``place`` from 1, ``id`` (hexadecimal) and ``chars`` of every turn, stored.

    Each conversation also has a row of place 0, so that it is there without turns.
    """
    who, what = (F.coalesce(column(conversations, c).cast("string"), F.lit("")) for c in (role, text))
    digest = F.sha2(F.concat(F.char_length(who).cast("string"), F.lit(":"), who, what), 256)
    turns = conversations.where(column(conversations, conv).isNotNull()).select(
        column(conversations, conv).alias("conv"),
        column(conversations, turn).alias("turn"),
        F.substring(digest, 1, 2 * TURN).alias("id"),
        F.char_length(what).alias("chars"),
    )
    placed = rank_within(turns, ["conv"], "turn", ["id"], descending=False, row_number="place")
    stored = materialise(placed.select("conv", "place", "id", "chars"), "turns")
    return stored.union(stored.where("place = 1").select("conv", F.lit(0), F.lit(None), F.lit(0)))


def with_shared_heads(sequences: DataFrame) -> DataFrame:
    """Every conversation c with the first h turns of conversation c - c % 100 instead of its own.

    h is the CRC-32 of c in decimal, modulo 6. If there are fewer turns, all are taken.
    """
    head = F.crc32(F.col("conv").cast("string").cast("binary")) % 6
    own = sequences.where((F.col("place") == 0) | (F.col("place") > head))
    wanted = sequences.where("place = 0").select(
        "conv", (F.col("conv") - F.col("conv") % 100).alias("base"), head.alias("head")
    )
    heads = sequences.where("place BETWEEN 1 AND 5 AND conv % 100 = 0").withColumnRenamed("conv", "base")
    borrowed = wanted.join(heads, "base").where("place <= head").select(*sequences.columns)
    both = own.union(borrowed)
    renumbered = rank_within(both, ["conv"], "place", [], descending=False, row_number="_from_one")
    return renumbered.select("conv", (F.col("_from_one") - 1).alias("place"), "id", "chars")


# ---------------------------------------------------------------------------
# The radix tree
# ---------------------------------------------------------------------------


class Node:
    """A node for 4 or 16 children: their first bytes, and themselves in the same order."""

    __slots__ = ("path", "value", "labels", "below", "room")
    LAYOUTS = (4, 16)

    def __init__(self, path: bytes, value: int | None = None, room: int = 4):
        self.path, self.value, self.room = path, value, room
        self.labels, self.below = b"", []

    def get(self, label: int) -> Node | None:
        at = self.labels.find(label)
        return self.below[at] if at >= 0 else None

    def put(self, label: int, child: Node) -> Node:
        """Add or replace a child; the result is this node or a larger one with all it holds."""
        at = self.labels.find(label)
        if at >= 0:
            self.below[at] = child
            return self
        if len(self.below) == self.room:
            return self._grown().put(label, child)
        self.labels += bytes((label,))
        self.below.append(child)
        return self

    def children(self) -> list[tuple[int, Node]]:
        return list(zip(self.labels, self.below))

    def _grown(self) -> Node:
        larger = Node(self.path, self.value, 16) if self.room == 4 else Node48(self.path, self.value)
        for label, child in self.children():
            larger.put(label, child)
        return larger


class Node48(Node):
    """A node for 48 children: the place of each possible byte among them."""

    __slots__ = ()

    def __init__(self, path: bytes, value: int | None = None):
        super().__init__(path, value, 48)
        self.labels = bytearray(b"\xff" * 256)

    def get(self, label: int) -> Node | None:
        at = self.labels[label]
        return None if at == 255 else self.below[at]

    def put(self, label: int, child: Node) -> Node:
        at = self.labels[label]
        if at != 255:
            self.below[at] = child
            return self
        if len(self.below) == self.room:
            return self._grown().put(label, child)
        self.labels[label] = len(self.below)
        self.below.append(child)
        return self

    def children(self) -> list[tuple[int, Node]]:
        return [(label, self.below[at]) for label, at in enumerate(self.labels) if at != 255]

    def _grown(self) -> Node:
        larger = Node256(self.path, self.value)
        for label, child in self.children():
            larger.put(label, child)
        return larger


class Node256(Node):
    """A node with a place for the child of every byte."""

    __slots__ = ()

    def __init__(self, path: bytes, value: int | None = None):
        super().__init__(path, value, 256)
        self.below = [None] * 256

    def get(self, label: int) -> Node | None:
        return self.below[label]

    def put(self, label: int, child: Node) -> Node:
        self.below[label] = child
        return self

    def children(self) -> list[tuple[int, Node]]:
        return [(label, child) for label, child in enumerate(self.below) if child is not None]


class RadixTree:
    """Strings with a number each. The root shares no bytes, so it is depth 0."""

    def __init__(self):
        self.root: Node = Node(b"")

    def insert(self, key: bytes, value: int) -> None:
        above, entry, node, at = None, 0, self.root, 0
        while True:
            path = node.path
            if not key.startswith(path, at):
                shared = 0
                while at + shared < len(key) and path[shared] == key[at + shared]:
                    shared += 1
                upper = Node(path[:shared])
                upper.put(path[shared], node)
                node.path = path[shared + 1 :]
                above.put(entry, upper)
                node = upper
            at += len(node.path)
            if at == len(key):
                node.value = value
                return
            label = key[at]
            child = node.get(label)
            if child is None:
                larger = node.put(label, Node(key[at + 1 :], value))
                if larger is not node:
                    if above is None:
                        self.root = larger
                    else:
                        above.put(entry, larger)
                return
            above, entry, node, at = node, label, child, at + 1


# ---------------------------------------------------------------------------
# Nodes of a run
# ---------------------------------------------------------------------------


@dataclass
class Run:
    """Neighbouring classes of one level and prefix."""

    prefix: str
    smallest: object  # the smallest member of the prefix, if it is not of this level
    classes: list[dict] = field(default_factory=list)
    turns: int = 0

    def add(self, row: dict) -> None:
        self.classes.append(row)
        self.turns += len(row["chars"])


def names_along(prefix: str, key: bytes) -> list[str]:
    """The name of the node of each number of turns on the way to ``key``: a digest of prefix and turns."""
    running, names = hashlib.sha256(), []
    for depth in range(len(key) // TURN + 1):
        if depth:
            running.update(key[(depth - 1) * TURN : depth * TURN])
        names.append(hashlib.sha256((prefix + running.hexdigest()).encode()).hexdigest())
    return names


#: What is known of a node. Open nodes (``name``) are added up; complete ones have a parent, or its name.
NODE_FIELDS = ["depth", "conv", "parent_conv", "name", "parent_name", "n", "children", "leaves", "m", "d", "ends"]


def nodes_of(run: Run) -> dict[str, list]:
    """The nodes of a run as columns, from a radix tree of its classes.

    ``m`` is the number of characters of all members from the node on, ``d`` that of the distinct nodes.
    """
    classes = run.classes
    tree = RadixTree()
    for i, row in enumerate(classes):
        tree.insert(row["key"], i)
    out: dict[str, list] = {name: [] for name in NODE_FIELDS}
    first = names_along(run.prefix, classes[0]["key"])
    last = names_along(run.prefix, classes[-1]["key"])
    # nodes from the root on, each with its place of its parent, and bytes before and at its end
    order: list[tuple[Node, int, int, int]] = [(tree.root, -1, -1, 0)]
    for at, (node, _, _, end) in enumerate(order):
        order.extend((c, at, end, end + 1 + len(c.path)) for _, c in node.children())
    # sums from the nodes below: members, smallest, m, d, leaves, first and last class, rows without parent
    sums: list[list | None] = [None] * len(order)
    for at in range(len(order) - 1, -1, -1):
        node, above, before, end = order[at]
        held = sums[at] or [0, None, 0, 0, 0, len(classes), -1, []]
        sums[at] = None
        n, conv, m, d, leaves, low, high, pending = held
        ends, more = None, 0
        if node.value is not None:
            row = classes[node.value]
            n, m, d, more, ends = n + row["w"], m + row["after"], d + row["deep_chars"], row["deep_children"], row["ends"]
            conv = row["conv"] if conv is None else min(conv, row["conv"])
            leaves += row["deep_leaves"] if more else 0 if pending else 1
            low, high = min(low, node.value), max(high, node.value)
        if above < 0 and run.smallest is not None:  # the root ends conversations of the level above
            conv = min(conv, run.smallest)
        chars = classes[low]["chars"]
        for depth in range(end // TURN, before // TURN, -1):
            length = chars[depth - 1] if depth else 0
            m, d = m + n * length, d + length
            name = first[depth] if low == 0 else last[depth] if high == len(classes) - 1 else None
            for child in pending:
                out["parent_conv" if name is None else "parent_name"][child] = conv if name is None else name
            values = (depth, conv, None, name, None, n, len(pending) + more, leaves, m, d, ends)
            pending, ends, more = [len(out["depth"])], None, 0
            for column_values, value in zip(out.values(), values):
                column_values.append(value)
        if above >= 0:
            total = sums[above]
            if total is None:
                sums[above] = [n, conv, m, d, leaves, low, high, pending]
            else:
                total[0] += n
                total[1] = min(total[1], conv)
                total[2] += m
                total[3] += d
                total[4] += leaves
                total[5], total[6] = min(total[5], low), max(total[6], high)
                total[7] += pending
    return out


# ---------------------------------------------------------------------------
# The trie of a level
# ---------------------------------------------------------------------------


def _fields(conv: T.DataType) -> list[T.StructField]:
    long, text = T.LongType(), T.StringType()
    kinds = dict(conv=conv, parent_conv=conv, name=text, parent_name=text, ends=text)
    return [T.StructField(name, kinds.get(name, long)) for name in NODE_FIELDS]


def build_runs(classes: DataFrame, run_classes: int, run_turns: int) -> DataFrame:
    """The nodes of all runs, and a row of ends for each run, stored."""
    fields = _fields(classes.schema["conv"].dataType)
    long, binary = T.LongType(), T.BinaryType()
    schema = T.StructType(
        [
            T.StructField("prefix", T.StringType()),
            T.StructField("run", long),
            *fields,
            T.StructField("first", binary),
            T.StructField("last", binary),
            T.StructField("lengths", T.ArrayType(long)),
        ]
    )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wide: pa.Schema | None = None
        run, number = None, TaskContext.get().partitionId() << 32

        def closed(run: Run) -> Iterator[pa.RecordBatch]:
            columns = nodes_of(run)
            count = len(columns["depth"])
            # the last row holds the ends of the run
            columns = {name: [*values, None] for name, values in columns.items()}
            columns |= {"prefix": [run.prefix] * (count + 1), "run": [number] * (count + 1)}
            ends = {"first": run.classes[0]["key"], "last": run.classes[-1]["key"], "lengths": run.classes[0]["chars"]}
            columns |= {name: [None] * count + [value] for name, value in ends.items()}
            arrays = [pa.array(columns[f.name], f.type) for f in wide]
            yield pa.RecordBatch.from_arrays(arrays, schema=wide)

        for batch in batches:
            if wide is None:
                kinds = {"conv": batch.schema.field("conv").type, "prefix": pa.string(), "lengths": pa.list_(pa.int64())}
                kinds |= {"parent_conv": kinds["conv"], "first": pa.binary(), "last": pa.binary()}
                kinds |= dict.fromkeys(("name", "parent_name", "ends"), pa.string())
                wide = pa.schema([(f.name, kinds.get(f.name, pa.int64())) for f in schema])
            for row in batch.to_pylist():
                full = run and (len(run.classes) >= run_classes or run.turns >= run_turns)
                if run and (full or run.prefix != row["prefix"]):
                    yield from closed(run)
                    run, number = None, number + 1
                run = run or Run(row["prefix"], row["smallest"])
                run.add(row)
        if run:
            yield from closed(run)

    ordered = classes.repartitionByRange("prefix", "key").sortWithinPartitions("prefix", "key")
    return materialise(ordered.mapInArrow(build, schema), "runs")


def shared_at_borders(runs: DataFrame) -> DataFrame:
    """What two neighbouring runs of one prefix both count, as negative sums of the nodes they share."""
    ends = runs.where("first IS NOT NULL").select("prefix", "run", "first", "last", "lengths")
    # one row for each run
    in_order = Window.orderBy("run")
    borders = ends.select(
        "prefix", "first", "lengths", F.lag("prefix").over(in_order).alias("old"), F.lag("last").over(in_order).alias("last")
    ).where("old = prefix")

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                one, other, lengths = row["last"], row["first"], row["lengths"]
                depth = 0
                while one[depth * TURN : (depth + 1) * TURN] == other[depth * TURN : (depth + 1) * TURN] != b"":
                    depth += 1
                names = names_along(row["prefix"], one[: depth * TURN])
                # the last string of the run before ends where the next goes on: no leaf
                leaf = -1 if len(one) == depth * TURN else 0
                total, chars = 0, [0] * (depth + 1)
                for at in range(depth, -1, -1):
                    total += lengths[at - 1] if at else 0
                    chars[at] = -total
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(names),
                        pa.array([-1 if at < depth else 0 for at in range(depth + 1)], pa.int64()),
                        pa.array([leaf] * (depth + 1), pa.int64()),
                        pa.array(chars, pa.int64()),
                    ],
                    names=["name", "children", "leaves", "d"],
                )

    return borders.mapInArrow(shared, "name string, children bigint, leaves bigint, d bigint")


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df.hint("shuffle_hash")


def level_nodes(
    classes: DataFrame, first_depth: int, run_classes: int = RUN_CLASSES, run_turns: int = RUN_TURNS
) -> tuple[DataFrame, DataFrame]:
    """All nodes below the prefixes of a level, and the sums of each prefix (the level's roots)."""
    runs = build_runs(classes, run_classes, run_turns)
    nodes = runs.where("first IS NULL")
    open_parts = nodes.where("name IS NOT NULL").drop("first", "last", "lengths")
    merged = (
        open_parts.unionByName(shared_at_borders(runs), allowMissingColumns=True)
        .groupBy("name")
        .agg(
            *(F.max(c).alias(c) for c in ("prefix", "depth", "parent_name", "ends")),
            F.min("conv").alias("conv"),
            *(F.sum(c).alias(c) for c in ("n", "children", "leaves", "m", "d")),
        )
    )
    merged = materialise(merged, "open")
    parents = _small(merged.select(F.col("name").alias("parent_name"), F.col("conv").alias("parent_conv")))
    kept = ["depth", "conv", "n", "children", "leaves", "m", "d", "ends"]
    complete = nodes.where("name IS NULL")
    found = complete.where("parent_name IS NULL").select(*kept, "parent_conv")
    hanging = complete.where("parent_name IS NOT NULL").select(*kept, "parent_name")
    hanging = hanging.union(merged.select(*kept, "parent_name")).join(parents, "parent_name", "left")
    every = found.unionByName(hanging.select(*kept, "parent_conv"))
    if first_depth:
        every = every.where("depth > 0")
    roots = merged.where("depth = 0").select(
        F.col("prefix").alias("name"), *(F.col(c).alias(f"deep_{v}") for c, v in _DEEP.items())
    )
    return every.withColumn("depth", F.col("depth") + first_depth), roots


#: What a class takes from the level below.
_DEEP = {"children": "children", "leaves": "leaves", "d": "chars"}


def _strings(sequences: DataFrame, level_turns: int) -> DataFrame:
    """One row per conversation and level: its string, where it hangs, and what comes after."""
    level = F.floor((F.greatest("place", F.lit(1)) - 1) / level_turns).cast("int")
    gathered = sequences.groupBy("conv", level.alias("level")).agg(
        F.sort_array(F.collect_list(F.struct("place", "id", "chars"))).alias("turns")
    )
    turns = F.filter("turns", lambda t: t["place"] > 0)
    strings = gathered.select(
        "conv",
        "level",
        F.unhex(F.array_join(F.transform(turns, lambda t: t["id"]), "")).alias("key"),
        F.transform(turns, lambda t: t["chars"]).alias("chars"),
    )
    # a row per level of a conversation
    levels = Window.partitionBy("conv").orderBy("level")
    chars = F.aggregate("chars", F.lit(0).cast("bigint"), lambda a, x: a + x)
    after = F.sum(chars).over(levels.rowsBetween(1, Window.unboundedFollowing))
    before = F.collect_list(F.sha2("key", 256)).over(levels.rowsBetween(Window.unboundedPreceding, -1))
    prefix = F.aggregate(before, F.lit(""), lambda a, x: F.sha2(F.concat(a, x), 256))
    return strings.select(
        "conv",
        "level",
        "key",
        "chars",
        F.coalesce(after, F.lit(0)).alias("after"),
        after.isNull().alias("last"),
        prefix.alias("prefix"),
        F.sha2(F.concat(prefix, F.sha2("key", 256)), 256).alias("name"),
    )


def ends_digests(members: DataFrame, piece_ids: int = PIECE_IDS) -> DataFrame:
    """``name`` and the SHA-256 of its ids (``conv``) in ascending order, in decimal, joined by commas."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, first, ids = None, None, []

        def piece() -> pa.RecordBatch:
            arrays = [pa.array([name]), pa.array([first], kind), pa.array([",".join(map(str, ids))])]
            return pa.RecordBatch.from_arrays(arrays, names=["name", "first", "ids"])

        for batch in batches:
            kind = batch.schema.field("conv").type
            for row_name, conv in zip(batch["name"].to_pylist(), batch["conv"].to_pylist()):
                if ids and (row_name != name or len(ids) >= piece_ids):
                    yield piece()
                    ids = []
                if not ids:
                    name, first = row_name, conv
                ids.append(conv)
        if ids:
            yield piece()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, running = None, hashlib.sha256()

        def whole() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([running.hexdigest()])], names=["name", "ends"])

        for batch in batches:
            for row_name, ids in zip(batch["name"].to_pylist(), batch["ids"].to_pylist()):
                if row_name != name:
                    if name is not None:
                        yield whole()
                    name, running = row_name, hashlib.sha256()
                else:
                    running.update(b",")
                running.update(ids.encode())
        if name is not None:
            yield whole()

    conv = members.schema["conv"].dataType.simpleString()
    pieces = members.orderBy("name", "conv").mapInArrow(join, f"name string, first {conv}, ids string")
    ordered = pieces.repartition("name").sortWithinPartitions("name", "first")
    return ordered.mapInArrow(digest, "name string, ends string")


def _classes(strings: DataFrame) -> DataFrame:
    """Equal strings of a level and prefix as one row, stored: members, smallest one, ends."""
    groups = strings.groupBy("level", "prefix", "key", "chars", "name").agg(
        F.count("*").alias("w"),
        F.min("conv").alias("conv"),
        F.sum("after").alias("after"),
        F.count_if("last").alias("ending"),
        F.min(F.when(F.col("last"), F.col("conv"))).alias("end"),
    )
    stored = materialise(groups, "classes")
    several = _small(stored.where("ending > 1").select("name"))
    digests = ends_digests(strings.where("last").select("name", "conv").join(several, "name", "left_semi"))
    digests = _small(materialise(digests.withColumnRenamed("ends", "several"), "ends"))
    single = F.when(F.col("ending") == 1, F.sha2(F.col("end").cast("string").cast("binary"), 256))
    return stored.join(digests, "name", "left").withColumn("ends", F.coalesce("several", single))


def prefix_trie(
    sequences: DataFrame,
    level_turns: int = LEVEL_TURNS,
    run_classes: int = RUN_CLASSES,
    run_turns: int = RUN_TURNS,
) -> DataFrame:
    """One row per node of the trie of ``sequences`` (as of ``turn_sequences``), root included."""
    prepare_workers(sequences.sparkSession)
    strings = materialise(_strings(sequences, level_turns), "strings")
    classes = _classes(strings)
    deepest = strings.agg(F.max("level")).first()[0] or 0
    result, roots = None, None
    for level in range(deepest, -1, -1):
        here = classes.where(F.col("level") == level)
        smallest = F.lit(None).cast(strings.schema["conv"].dataType).alias("smallest")
        if level:
            above = classes.where(F.col("level") == level - 1).select(
                F.col("name").alias("prefix"), F.col("conv").alias("smallest")
            )
            here, smallest = here.join(above, "prefix"), F.col("smallest")
        deep: list[Column] = [F.lit(0).cast("bigint").alias(f"deep_{v}") for v in _DEEP.values()]
        if roots is not None:
            here = here.join(roots, "name", "left")
            deep = [F.coalesce(f"deep_{v}", F.lit(0)).alias(f"deep_{v}") for v in _DEEP.values()]
        here = here.select("prefix", "key", "chars", "conv", "w", "after", "ends", smallest, *deep)
        nodes, roots = level_nodes(here, level * level_turns, run_classes, run_turns)
        result = nodes if result is None else result.unionByName(nodes)
    discard(strings)
    return result.select(
        F.col("conv").alias("conv_id"),
        "depth",
        F.col("parent_conv").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        (F.col("m") - F.col("d")).alias("saved_tokens"),
        F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"),
    )
