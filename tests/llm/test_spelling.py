"""Spelling variants against a brute-force version."""

import random
import re
import zlib

import numpy as np
import pytest

from tideline.llm import spelling

SCHEMA = "doc_id long, text string, word int, n string, tile int"


def counted(rows):
    found = {}
    lower = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] = found.get(run, 0) + 1
    return {word: n for word, n in found.items() if len(word) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(words):
    near = {word: [other for other in words if one_edit(word, other)] for word in words}
    form = {}
    for word, others in near.items():
        best = min(others, key=lambda other: (-words[other], other), default=None)
        form[word] = best if best and words[best] >= 2 * words[word] else None
    rows = []
    for word, n in words.items():
        root = word
        while form[root]:
            root = form[root]
        rows.append((word, form[word], root, n, len(near[word]), words.get(form[word])))
    return sorted(rows)


def result(df):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect())


def sample(seed, n=400):
    draw = random.Random(seed)
    stems = ["".join(draw.choices("abé", k=draw.randint(4, 9))) for _ in range(60)]
    rows = []
    for i in range(n):
        words = [draw.choice(stems[: draw.randint(1, 60)]) for _ in range(draw.randint(0, 30))]
        words = [w.capitalize() if draw.random() < 0.2 else w for w in words]
        rows.append((i, draw.choice([" ", "-", ", "]).join(words)))
    return rows


@pytest.mark.parametrize("block", [2048, 5])
@pytest.mark.parametrize("narrow", [24, 3])
def test_against_brute_force(spark, monkeypatch, block, narrow):
    """Whole buckets and blocks, row-wise and as matrices."""
    monkeypatch.setattr(spelling, "NARROW", narrow)
    rows = sample(block + narrow)
    table = [(*row, 1, "x", 2) for row in rows]
    df = spark.createDataFrame(table, SCHEMA).repartition(5)
    expected = brute(counted(rows))
    assert any(row[1] for row in expected)
    assert result(spelling.variants(df, block=block)) == expected


def test_odd_rows(spark, docs, nothing):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert result(spelling.variants(docs)) == brute(counted(rows))
    assert result(spelling.variants(nothing)) == []
    ties = [(1, "aaaaab aaaaab aaaaab"), (2, "aaaaac " * 6 + "aaaaad " * 6), (None, None), (3, "")]
    df = spark.createDataFrame([(*row, 1, "x", 2) for row in ties], SCHEMA)
    found = result(spelling.variants(df, plant=10**12))
    assert found[0] == ("aaaaab", "aaaaac", "aaaaac", 3, 2, 6)
    assert found[1] == ("aaaaac", None, "aaaaac", 6, 2, None)


def test_chain_of_forms(spark):
    """Pointers are doubled through a chain longer than one round."""
    words = ["abcdefghijkl"[:i] for i in range(5, 12)]
    forms = spark.createDataFrame(list(zip(words[1:], words)), "word string, form string")
    assert {tuple(r) for r in spelling.roots(forms).collect()} == {(w, words[0]) for w in words[1:]}


def test_long_and_wide_words():
    """Beyond 255 places and beyond 16 bits."""
    words = ["a" * 300, "a" * 301, "😀bcde", "😀bcdf", "ÿbcde"]
    left, right, lengths = spelling.matrices(words)
    size, low = np.array([300, 300, 5, 5, 5]), np.zeros(5, int)
    tile, side = np.array([1, 1, 2, 2, 2]), np.full(5, -1)
    a, b = spelling.tile_pairs(words, size, low, tile, side)
    assert {tuple(sorted(pair)) for pair in zip(a, b)} == {(0, 1), (2, 3), (2, 4)}
