"""The prefix trie against a brute-force version."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from tideline.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, node string, depth int, path string"


def brute(rows):
    """Nodes of all prefixes, by dictionaries of tuples."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own.setdefault(c, []).append((turn is not None, turn or 0, tie, role, text))
    own = {c: [t[3:] for t in sorted(turns)] for c, turns in own.items()}
    made = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(np.fmod(c, 100))
        made[c] = own.get(base, [])[:h] + turns[h:]
    members = {}
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children, leaves, saved = {}, dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for node in members:
        if node:
            children[node[:-1]] = children.get(node[:-1], 0) + 1
    for node, names in members.items():
        gain = (len(names) - 1) * len(node[-1][1]) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += gain
    found = []
    for node, names in members.items():
        ends = ",".join(str(c) for c in sorted(names) if len(made[c]) == len(node))
        found.append(
            (
                min(names),
                len(node),
                min(members[node[:-1]]) if node else None,
                len(names),
                children.get(node, 0),
                leaves[node],
                saved[node],
                hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return sorted(found, key=repr)


def run(spark, rows, parts=4, **how):
    table = [(*row, "n", 7, "p") for row in rows]
    df = spark.createDataFrame(table, SCHEMA).repartition(parts)
    found = prefix_trie.prefix_trie(df, **how)
    assert found.columns == [
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
    ]
    return sorted((tuple(row) for row in found.collect()), key=repr)


def sample(seed, n=300):
    draw = random.Random(seed)
    rows = []
    for c in range(n):
        for turn in range(draw.randint(1, 9)):
            text = draw.choice(["a", "bb", "ccc", "é🙂"]) if draw.random() < 0.8 else draw.choice(["", None])
            rows.append((c, turn, draw.choice(["user", "user", None]), text))
    return rows


@pytest.mark.parametrize("shards", [1, 9])
def test_against_brute_force(spark, shards):
    """One shard, several, and so many that nearly all nodes are on spines."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(shards))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = sample(shards)
        assert run(spark, rows, block=8) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_group_of_copies_over_shards(spark, monkeypatch):
    """Many equal conversations and prefixes of them, more than a shard; lists in pieces."""
    monkeypatch.setattr(prefix_trie, "PIECE", 100)
    turns = [(0, "user", "hello"), (1, "assistant", "good day"), (2, "user", "bye")]
    rows = [(c, *turn) for c in range(1000, 1900) for turn in turns[: 3 if c % 3 else 2]]
    rows += [(c, 0, "user", "hello") for c in range(5000, 5030)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert run(spark, rows) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_odd_rows(spark):
    """Nulls in every column, ties, repeated rows, missing and short bases, long conversations."""
    rows = [
        (None, 0, "user", "x"),
        (100, None, None, None),
        (100, None, "user", None),
        (100, 0, "user", "x"),
        (100, 0, "user", "x"),
        (101, 5, "user", "x" * 100_000),
        (7, 0, "user", "only"),
        (250, 0, "user", "a"),
        (-5, 0, "user", "a"),
        (0, 0, "user", "a"),
    ]
    rows += [(103, turn, "user", "same") for turn in range(250)]
    rows += [(100, turn, "user", "same") for turn in range(1, 9)]
    expected = brute(rows)
    assert run(spark, rows) == expected
    assert run(spark, rows, hot_rows=100) == expected


def test_empty_table(spark):
    assert run(spark, []) == []


def test_findclose():
    """Against a stack, with blocks of several sizes."""
    draw = np.random.default_rng(3)
    for block in (1, 2, 7, 64):
        for _ in range(30):
            opens, depth = [], 0
            for _ in range(int(draw.integers(1, 200))):
                if depth and draw.random() < 0.5:
                    opens.append(False)
                    depth -= 1
                else:
                    opens.append(True)
                    depth += 1
            opens += [False] * depth
            stack, match = [], {}
            for i, is_open in enumerate(opens):
                if is_open:
                    stack.append(i)
                else:
                    match[stack.pop()] = i
            at = np.flatnonzero(opens)
            found = prefix_trie.Parentheses(np.array(opens, bool), block).findclose(at)
            assert found.tolist() == [match[i] for i in at.tolist()]
