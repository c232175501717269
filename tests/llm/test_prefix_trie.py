import hashlib
import random
import zlib

import pytest

from lodestar.llm import prefix_trie as trie

DDL = "conv_id bigint, turn bigint, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def sequences_of(rows):
    """Turns of each conversation in order, ties by what is hashed."""
    found = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]
            found.setdefault(conv, []).append((turn is not None, turn or 0, digest, role, text))
    return {c: [t[3:] for t in sorted(turns)] for c, turns in found.items()}


def shared_heads(sequences):
    made = {}
    for c, turns in sequences.items():
        h = zlib.crc32(str(c).encode()) % 6
        made[c] = sequences.get(c - int(c % 100 if c >= 0 else -(-c % 100)), [])[:h] + turns[h:]
    return made


def brute_force(sequences):
    """Every prefix with its numbers, subtree by subtree."""
    members = {}
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)

    def sums(p):
        own = (len(members[p]) - 1) * (len(p[-1][1]) if p else 0)
        below = [sums(q) for q in children.get(p, [])]
        out[p] = (sum(b[0] for b in below) or 1, own + sum(b[1] for b in below))
        return out[p]

    out = {}
    if members:
        sums(())
    rows = []
    for p, held in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in held if len(sequences[c]) == len(p)))
        digest = hashlib.sha256(ends.encode()).hexdigest()
        parent = min(members[p[:-1]]) if p else None
        rows.append((min(held), len(p), parent, len(held), len(children.get(p, [])), *out[p], digest))
    return sorted(rows, key=repr)


def conversations(seed, n=130, long=0):
    rnd = random.Random(seed)
    texts = ["", None, "a", "bé", "longer words \U0001F600", "x" * 300]
    rows = []
    for c in range(-5, n):
        if c % 9 == 4:
            continue
        length = rnd.choice([1, 2, 3, 4, 6, 9])
        kind = rnd.randrange(3)
        for turn in range(length):
            said = texts[turn % 6] if kind == 0 else rnd.choice(texts)
            rows.append((c * 3 if c % 2 else c, turn if rnd.random() < 0.9 else None, rnd.choice(["user", None]) if kind else "user", said))
    rows += [(1001, t, "user", str(t % 7)) for t in range(long)]
    rows += [(1002, t, "user", str(t % 7)) for t in range(long)] + [(1003, t, "user", str(t % 7)) for t in range(long // 2)]
    rows += [rows[7]] * 3 + [(None, 1, "user", "of nobody")]
    return rows


def run(spark, rows, heads=False, **limits):
    made = spark.createDataFrame(rows, DDL).repartition(3)
    sequences = trie.turn_sequences(made)
    return trie.prefix_trie(trie.with_shared_heads(sequences) if heads else sequences, **limits)


def listed(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


@pytest.mark.parametrize(
    "limits",
    [{}, dict(run_classes=1), dict(run_classes=3), dict(run_turns=10), dict(level_turns=2), dict(level_turns=3, run_classes=2)],
    ids=str,
)
def test_against_brute_force(spark, limits):
    rows = conversations(1, n=90, long=11)
    assert listed(run(spark, rows, **limits)) == brute_force(sequences_of(rows))


@pytest.mark.parametrize("limits", [{}, dict(level_turns=2, run_classes=4)], ids=str)
def test_shared_heads(spark, limits):
    rows = conversations(2) + [(700 + i, 0, "user", "alone") for i in range(30)]
    expected = brute_force(shared_heads(sequences_of(rows)))
    assert listed(run(spark, rows, heads=True, **limits)) == expected


def test_one_conversation_split(spark, monkeypatch):
    """A conversation too large for a window is numbered in slices."""
    from lodestar.operators import ranking

    rows = [(1, t, "user", str(t % 5)) for t in range(400)] + [(2, t, "user", str(t % 5)) for t in range(40)]
    monkeypatch.setattr(ranking.rank_within, "__kwdefaults__", {**ranking.rank_within.__kwdefaults__, "max_group_rows": 50})
    got = listed(run(spark, rows, level_turns=64))
    assert got == brute_force(sequences_of(rows))


def test_edges(spark):
    clashing = spark.createDataFrame([(1, 0, "u", "t"), (2, 0, "u", "t")], DDL).selectExpr(
        "*", *(f"9 AS {c}" for c in ("conv", "place", "id", "chars", "level", "key", "n", "name", "first", "`a.b`", "_rank", "_row_number", "_dense_rank"))
    )
    got = listed(trie.prefix_trie(trie.turn_sequences(clashing)))
    assert got == brute_force({1: [("u", "t")], 2: [("u", "t")]})
    assert run(spark, []).count() == 0 and run(spark, [(None, 1, "u", "t")]).count() == 0
    heads = run(spark, [(100, 0, "u", "t")], heads=True)  # h of 100 takes its only turn from itself
    assert [r[1] for r in listed(heads)] == [0, 1]


def test_ends_in_pieces(spark):
    members = spark.range(1000).selectExpr("cast(id % 3 AS string) AS name", "id * 7 - 400 AS conv").repartition(4)
    got = {r["name"]: r["ends"] for r in trie.ends_digests(members, piece_ids=13).collect()}
    for name in range(3):
        ids = ",".join(str(i * 7 - 400) for i in range(name, 1000, 3))
        assert got[str(name)] == hashlib.sha256(ids.encode()).hexdigest()


def test_radix_tree_grows_and_splits():
    rnd = random.Random(5)
    keys = {bytes(rnd.randrange(256) for _ in range(2)) * rnd.randrange(1, 4) for _ in range(3000)}
    keys |= {b"", b"abc", b"abcabd", bytes(range(256)), bytes(range(128))}
    tree = trie.RadixTree()
    for i, key in enumerate(sorted(keys, key=lambda _: rnd.random())):
        tree.insert(key, i)
    found, kinds, stack = set(), set(), [(tree.root, b"")]
    while stack:
        node, at = stack.pop()
        at += node.path
        kinds.add(node.room)
        assert len(node.children()) <= node.room and (node.value is not None or len(node.children()) > 1 or node is tree.root)
        if node.value is not None:
            found.add(at)
        for label, child in node.children():
            assert node.get(label) is child
            stack.append((child, at + bytes([label])))
    assert found == keys and kinds == {4, 16, 48, 256}
