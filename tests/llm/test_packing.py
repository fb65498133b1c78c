"""Token ids, both packings, and the mix."""

import bisect
import collections
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from conftest import rows_of
from tokenizers import Tokenizer

from tideline.llm import bfd_packing, histogram_packing, mixing, tokens

EXACT = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids_of(text):
    return [*(EXACT.encode(text, add_special_tokens=False).ids if text else []), 0]


def pieces_of(text, capacity=2048):
    ids = ids_of(text)
    first = len(ids) % capacity or capacity
    cuts = [0, *range(first, len(ids), capacity), len(ids)]
    return [(a, ids[a:b]) for a, b in zip(cuts, cuts[1:])]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def best_fit_decreasing(lengths, capacity):
    rooms, n = [], 0
    for length in sorted(lengths, reverse=True):
        at = bisect.bisect_left(rooms, length)
        if at == len(rooms):
            n += 1
            room = capacity
        else:
            room = rooms.pop(at)
        if room > length:
            bisect.insort(rooms, room - length)
    return n


def test_ids_are_the_tokenizers():
    draw = random.Random(1)
    signs = " \n\t\r  aZé9'ß漢🙂́.,!-_<|>\u0000"
    odd = ["".join(draw.choices(signs, k=draw.randrange(1, 60))) for _ in range(400)]
    odd += ["a<|endoftext|>b", "don't we'll I'M", "   \n\n  x", "x" * 3000]
    for text in odd:
        assert tokens.document_ids(text).tolist() == ids_of(text), repr(text)


def check_sequences(rows, capacity):
    """Pieces lie behind each other from 0, without gaps, and fit."""
    by = collections.defaultdict(list)
    for row in rows:
        by[row.sequence_id].append((row.offset, row.length))
    for members in by.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


@pytest.mark.parametrize("capacity", [2048, 64])
def test_histogram_packing(docs, capacity):
    found = histogram_packing.pack(docs, capacity=capacity).collect()
    want = sorted(
        (
            (row.doc_id, number, start, len(ids), crc(ids))
            for row in docs.select("doc_id", "text").collect()
            for number, (start, ids) in enumerate(pieces_of(row.text, capacity))
        ),
        key=repr,
    )
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found]
    assert sorted(got, key=repr) == want
    n = check_sequences(found, capacity)
    assert n <= best_fit_decreasing([r.length for r in found], capacity)


def test_histogram_plan_is_best_fit():
    draw = random.Random(2)
    for _ in range(200):
        capacity = draw.choice([10, 37, 100])
        lengths = [draw.randrange(1, capacity + 1) for _ in range(draw.randrange(400))]
        rows = histogram_packing.plan(collections.Counter(lengths), capacity)
        sequences = collections.defaultdict(list)
        ranks = collections.defaultdict(list)
        for length, low, high, each, first, offset in rows:
            for rank in range(low, high):
                nth, step = divmod(rank - low, each)
                sequences[first + nth].append((offset + step * length, length))
                ranks[length].append(rank)
        for members in sequences.values():
            at = 0
            for offset, length in sorted(members):
                assert offset == at
                at += length
            assert at <= capacity
        assert {k: sorted(v) for k, v in ranks.items()} == {
            k: list(range(n)) for k, n in collections.Counter(lengths).items()
        }
        assert len(sequences) == best_fit_decreasing(lengths, capacity)


def test_plan_does_not_grow_with_the_corpus():
    draw = random.Random(4)
    counts = {length: draw.randrange(1, 5) for length in range(1, 2049)}
    small = len(histogram_packing.plan(counts))
    large = len(histogram_packing.plan({k: n * 10**6 + draw.randrange(10**5) for k, n in counts.items()}))
    assert large < 4 * small < 40_000


def test_pack_ids(docs):
    found = histogram_packing.pack_ids(docs).collect()
    for row in found:
        ids = np.frombuffer(row.ids, "<u4")
        assert len(ids) == row.length and zlib.crc32(row.ids) == row.ids_crc32
    check_sequences(found, 2048)


def test_room_tree_is_best_fit():
    draw = random.Random(3)
    for capacity in (1, 7, 64, 100):
        for _ in range(40):
            lengths = [draw.randrange(1, capacity + 1) for _ in range(draw.randrange(200))]
            found = bfd_packing.best_fit_decreasing(lengths, capacity)
            assert sorted(i for members in found for i in members) == list(range(len(lengths)))
            assert all(sum(lengths[i] for i in members) <= capacity for members in found)
            assert len(found) == best_fit_decreasing(lengths, capacity)


@pytest.mark.parametrize("buffer", [1 << 22, 3000])
def test_matrix_round_trip(docs, buffer):
    found = bfd_packing.pack_matrix(docs, buffer=buffer).collect()
    assert len({row.sequence_id for row in found}) == len(found)
    got = collections.defaultdict(list)
    for row in found:
        ids = np.frombuffer(row.ids, "<u2")
        assert len(ids) == 2048 and not ids[row.n_tokens :].any()
        assert row.ids_crc32 == crc(ids[: row.n_tokens])
        assert row.cumulative[0] == 0 and row.cumulative[-1] == row.n_tokens
        assert row.resets == row.cumulative[:-1]
        places = bfd_packing.positions(row.cumulative)
        assert np.flatnonzero(places == 0).tolist() == row.resets
        for i, (a, b) in enumerate(zip(row.cumulative, row.cumulative[1:])):
            got[row.doc_ids[i]].append((row.starts[i], ids[a:b].tolist()))
    want = collections.defaultdict(list)
    for row in docs.select("doc_id", "text").collect():
        want[row.doc_id] += pieces_of(row.text)
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}


def test_empty_tables(nothing):
    assert histogram_packing.pack(nothing).count() == 0
    assert bfd_packing.pack_matrix(nothing).count() == 0
    assert mixing.mix(nothing).count() == 0
    assert mixing.mixed(nothing).columns == nothing.columns


def sizes_of(rows):
    return [len(re.findall(r"[^\x20\x09-\x0D]+", row.text or "")) for row in rows]


def targets_by_hand(by_source):
    """Share by weight; what is above twice a size goes to the others, until none is above."""
    names = sorted((s for s in by_source if s is not None)) + [None] * (None in by_source)
    weight = {name: (3, 1, 2)[i % 3] for i, name in enumerate(names)}
    left, targets, active = 1.5 * sum(by_source.values()), {}, set(names)
    while active:
        shares = {s: left * weight[s] / sum(weight[x] for x in active) for s in active}
        over = [s for s in active if shares[s] > 2 * by_source[s]]
        if not over:
            return targets | shares
        for s in over:
            targets[s] = 2.0 * by_source[s]
            left -= targets[s]
            active.remove(s)
    return targets


def test_mix(docs):
    rows = docs.collect()
    by_source = collections.Counter()
    for row, size in zip(rows, sizes_of(rows)):
        by_source[row.source] += size
    targets = targets_by_hand(by_source)
    found = mixing.mix(docs).collect()
    assert sorted(r.size for r in found) == sorted(sizes_of(rows))
    for row in found:
        assert row.source_size == by_source[row.source]
        assert row.target == pytest.approx(targets[row.source])
        assert 0 <= row.taken <= 2 * row.size and row.taken == row.copies * row.size
    again = mixing.mix(docs.repartition(5)).collect()
    assert sorted(map(repr, found)) == sorted(map(repr, again))


def test_mix_comes_near_its_targets(spark):
    draw = random.Random(6)
    rows = []
    for i in range(4000):
        source = "hot" if i % 3 == 0 else f"s{draw.randrange(6)}"
        rows.append((i, "w " * int(draw.paretovariate(1.2)), source))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6)
    found = mixing.mix(docs).collect()
    taken, target, longest = collections.Counter(), {}, collections.Counter()
    for row in found:
        taken[row.source] += row.taken
        target[row.source] = row.target
        longest[row.source] = max(longest[row.source], row.size)
    for source, words in target.items():
        assert abs(taken[source] - words) <= max(2 * longest[source], 0.02 * words)
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns
    counts = collections.Counter(row.doc_id for row in mixed.collect())
    assert counts == {row.doc_id: row.copies for row in found if row.copies}


def test_mixed_rows_with_repeats(docs):
    want = collections.Counter()
    for row in mixing.mix(docs).collect():
        want[row.doc_id, row.source] += row.copies
    got = collections.Counter((row.doc_id, row.source) for row in mixing.mixed(docs).collect())
    assert got == {key: n for key, n in want.items() if n}
    assert rows_of(mixing.mixed(docs)) == rows_of(mixing.mixed(docs.repartition(2)))


def test_matrix_of_many_narrow_partitions(texts):
    pairs = [(i, f"a few words of document {i}") for i in range(300)]
    narrow = bfd_packing.pack_matrix(texts(pairs, 60)).collect()
    one = bfd_packing.pack_matrix(texts(pairs, 1)).collect()
    assert len(narrow) == len(one) < 5
    assert sorted(i for row in narrow for i in row.doc_ids) == list(range(300))
