"""Exact and near deduplication against brute force."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tideline.llm import bagminhash, components, exact_dedup, near_dedup, shingles
from tideline.llm import common


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def exact_by_hand(pairs):
    groups = collections.defaultdict(list)
    for i, text in pairs:
        groups[normal(text)].append(i)
    found = []
    for i, text in pairs:
        ids = [x for x in groups[normal(text)] if x is not None]
        sha = hashlib.sha256(normal(text).encode()).hexdigest()
        found.append((i, min(ids, default=None), len(groups[normal(text)]), sha))
    return sorted(found, key=repr)


@pytest.mark.parametrize("bits", [64, 256, 1 << 27])
def test_exact_groups(docs, bits):
    pairs = [(row.doc_id, row.text) for row in docs.select("doc_id", "text").collect()]
    found = exact_dedup.exact_groups(docs, filter_bits=bits)
    assert rows_of(found, "doc_id", "keep_id", "group_size", "text_sha256") == exact_by_hand(pairs)
    kept = found.where("kept").groupBy("text_sha256").count().collect()
    assert len(kept) == len({normal(text) for _, text in pairs})
    assert {row["count"] for row in kept} == {1}
    assert found.where("kept and not (doc_id <=> keep_id)").count() == 0


@pytest.mark.parametrize("bits", [128, 1 << 27])
def test_exact_keep_first(docs, bits):
    kept = exact_dedup.keep_first(docs, filter_bits=bits)
    assert kept.columns == docs.columns
    found = exact_dedup.exact_groups(docs).where("kept")
    assert rows_of(kept, "doc_id") == rows_of(found, "doc_id")
    assert {row.rank for row in kept.collect()} == {"y"}


def test_exact_hot_group(texts):
    pairs = [(i, "same text" if i % 2 else f"text {i}") for i in range(3000)]
    found = exact_dedup.exact_groups(texts(pairs))
    assert rows_of(found, "doc_id", "keep_id", "group_size", "text_sha256") == exact_by_hand(pairs)


def test_exact_slices(texts):
    """A corpus beyond one filter: each slice has its own, few documents without a copy are suspects."""
    pairs = [(i, "hot" if i % 3 == 0 else f"text {i // 2 if i % 10 == 0 else i}") for i in range(3000)]
    docs, bits = texts(pairs), 1 << 14
    number = exact_dedup.slices(docs, bits)
    assert number == 5
    found = exact_dedup.exact_groups(docs, filter_bits=bits)
    assert rows_of(found, "doc_id", "keep_id", "group_size", "text_sha256") == exact_by_hand(pairs)
    prints = docs.select("doc_id", exact_dedup.normal_sha256(F.col("text")).alias("sha"))
    marked = exact_dedup.judged(prints, "sha", number, bits)
    assert marked.count() == 3000
    sizes = {row.doc_id: row.group_size for row in found.collect()}
    rows = {row.doc_id: row["_suspect"] for row in marked.collect()}
    assert all(rows[i] for i, size in sizes.items() if size > 1)
    single = [rows[i] for i, size in sizes.items() if size == 1]
    assert sum(single) < 0.03 * len(single)


def test_empty_tables(nothing):
    assert exact_dedup.exact_groups(nothing).count() == 0
    assert exact_dedup.keep_first(nothing).count() == 0
    assert near_dedup.classes(nothing).count() == 0
    assert near_dedup.keep_one(nothing).columns == nothing.columns


def bag(text):
    words = [word for word in re.split(r"[\x20\x09-\x0D]+", (text or "").lower()) if word]
    if not words:
        return None
    return collections.Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def overlap(one, other):
    return sum((one & other).values()) / sum((one | other).values())


def classes_by_hand(pairs, similarity=0.8):
    bags = [bag(text) for _, text in pairs]
    parent = list(range(len(pairs)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(pairs)):
        for j in range(i):
            if bags[i] and bags[j] and overlap(bags[i], bags[j]) >= similarity:
                parent[max(root(i), root(j))] = min(root(i), root(j))
    members = collections.defaultdict(list)
    for i in range(len(pairs)):
        members[root(i)].append(pairs[i][0])
    found = []
    for i in range(len(pairs)):
        ids = [x for x in members[root(i)] if x is not None]
        found.append((pairs[i][0], min(ids, default=None), len(members[root(i)])))
    return sorted(found, key=repr)


def family(n, words, edits, seed):
    """A text and copies of it with some words changed, and unrelated texts."""
    draw = random.Random(seed)
    base = [f"w{draw.randrange(10_000)}" for _ in range(words)]
    found = []
    for i in range(n):
        copy = list(base)
        for _ in range(draw.randrange(edits + 1)):
            copy[draw.randrange(words)] = f"e{draw.randrange(10**6)}"
        found.append((1000 * seed + i, " ".join(copy)))
    return found


def test_near_classes_of_odd_rows(docs):
    pairs = [(row.doc_id, row.text) for row in docs.select("doc_id", "text").collect()]
    found = near_dedup.classes(docs)
    assert rows_of(found, "doc_id", "class_id", "class_size") == classes_by_hand(pairs)
    kept = near_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    assert rows_of(kept, "doc_id") == rows_of(found.where("kept"), "doc_id")


@pytest.mark.parametrize("large", [64, 8])
def test_near_classes_of_families(texts, monkeypatch, large):
    """Chains and outsiders in crowded buckets, by listed pairs and by blocks."""
    monkeypatch.setattr(near_dedup, "LARGE", large)
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    pairs = [*family(120, 150, 9, 1), *family(30, 60, 3, 2), *family(40, 300, 30, 3)]
    pairs += [(9000 + i, "one two three " * (10 + i % 3)) for i in range(6)]
    found = near_dedup.classes(texts(pairs))
    assert rows_of(found, "doc_id", "class_id", "class_size") == classes_by_hand(pairs)


def test_similar_blocks():
    draw = np.random.default_rng(3)
    bags = [np.unique(draw.integers(0, 60, 45)).astype("<u4") for _ in range(40)]
    members = [{"node": i, "root": i, "items": b.tobytes()} for i, b in enumerate(bags)]
    got = {tuple(sorted(x)) for x in near_dedup._similar_blocks(members[:20], members[20:], 0.5)}
    want = set()
    for i in range(20):
        for j in range(20, 40):
            both = len(np.intersect1d(bags[i], bags[j]))
            if both >= 0.5 * (len(bags[i]) + len(bags[j]) - both):
                want.add((i, j))
    assert want and got == want


def weighted(bags):
    keys = [np.array(sorted(b), np.uint64) for b in bags]
    return shingles.Bags(
        np.cumsum([0, *map(len, keys)]),
        np.repeat(np.arange(len(bags)), [len(k) for k in keys]),
        np.concatenate(keys),
        np.concatenate([np.array([b[x] for x in sorted(b)]) for b in bags]),
    )


@pytest.mark.parametrize("top", [2, 9, 300])
def test_signatures_are_unbiased(top):
    draw = random.Random(top)
    one = {i * 77 + 5: draw.randrange(1, top) for i in range(60)}
    other = {i * 77 + 5: draw.randrange(1, top) for i in range(15, 75)}
    found = bagminhash.signatures(weighted([one, other, one]), 3, 16_384)
    want = overlap(collections.Counter(one), collections.Counter(other))
    assert abs((found[0] == found[1]).mean() - want) < 4 * (want * (1 - want) / 16_384) ** 0.5
    assert (found[0] == found[2]).all()


def test_shingles_count_copies():
    raws = [t.lower().encode() for t in ["a b c d e f a b c d e", "", "A b", "a b", " a  b c d e "]]
    found = shingles.bags(raws)
    sizes = [int(found.weights[found.bounds[i] : found.bounds[i + 1]].sum()) for i in range(5)]
    assert sizes == [7, 0, 1, 1, 1]
    assert len(found.keys) == 6 + 3
    assert found.keys[found.bounds[2]] == found.keys[found.bounds[3]]
    assert found.keys[found.bounds[4]] in found.keys[: found.bounds[1]]


def test_components(spark):
    draw = random.Random(5)
    links = [(draw.randrange(300), draw.randrange(300)) for _ in range(180)]
    links += [(i, i + 1) for i in range(1000, 1100)] + [(2000, 2000 + i) for i in range(1500)]
    parent = {x: x for link in links for x in link}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    frame = spark.createDataFrame(links, "a long, b long")
    found = components.components(frame, "a", "b")
    loops = {a for a, b in links if a == b} - {x for a, b in links if a != b for x in (a, b)}
    assert rows_of(found) == sorted(((x, root(x)) for x in parent if x not in loops), key=repr)
    assert components.components(frame.limit(0), "a", "b").count() == 0


def test_ranked(spark):
    pairs = [("hot" if i % 3 else None, i // 4) for i in range(1000)]
    frame = common.settled(spark.createDataFrame(pairs, "k string, v long").repartition(7))
    found = common.ranked(frame, ["k"], ["v"], "rank").orderBy(F.col("k"), "rank").collect()
    for key in ("hot", None):
        own = [(row["rank"], row.v) for row in found if row.k == key]
        assert [rank for rank, _ in own] == list(range(len(own)))
        assert [v for _, v in own] == sorted(v for k, v in pairs if k == key)
