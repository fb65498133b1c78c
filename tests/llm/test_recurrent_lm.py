"""The recurrent model: counts by brute force, gradients by differences, sums of probabilities."""

import math
import random
import re
import zlib

import numpy as np
import pytest

from tideline.llm import recurrent_lm as lm

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = {ord("A") + i: ord("a") + i for i in range(26)}


def tokens(text):
    return [*WORD.findall((text or "").translate(UPPER)), " "]


def held_out(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


def brute(rows):
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score per row."""
    counts = {}
    for doc_id, text in rows:
        if not held_out(doc_id):
            for token in tokens(text):
                counts[token] = counts.get(token, 0) + 1
    n, v = sum(counts.values()), len(counts)
    found = []
    for doc_id, text in rows:
        own = tokens(text)
        base = sum(math.log10((counts.get(token, 0) + 1) / (n + 1 * (v + 1))) for token in own)
        known = sum(counts.get(token, 0) > 0 for token in own)
        found.append((doc_id, held_out(doc_id), len(own), known, n, round(base, 6)))
    return sorted(found, key=repr)


def counted(df):
    columns = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score"]
    rows = [tuple(row) for row in df.select(*columns).collect()]
    return sorted([(*row[:-1], round(row[-1], 6)) for row in rows], key=repr)


@pytest.mark.parametrize("head", [100_000, 6, 0])
def test_counts_and_base_score(spark, docs, head):
    """With all, few and no tokens looked up in the tasks."""
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    found = lm.scored(docs, head=head, words=5, classes=2, one_in=1)
    assert counted(found) == brute(rows)
    scores = [row.score for row in found.collect()]
    assert all(math.isfinite(score) and score < 0 for score in scores)


def test_empty_table_and_nothing_to_learn_from(spark, nothing, texts):
    assert lm.scored(nothing).count() == 0
    out = next(i for i in range(100) if held_out(i))
    row = lm.scored(texts([(out, "some words")])).first()
    assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (True, 3, 0, 0, 0.0)


def small_model(seed=1, words=7, classes=3, hidden=5):
    head = {f"w{i}".encode(): 50 - 5 * i for i in range(10)}
    vocabulary = lm.Vocabulary(head, sum(head.values()) + 40, 30, words, classes)
    model = lm.new_model(vocabulary, 4, hidden)
    draw = np.random.default_rng(seed)
    for name in ("C", "O"):
        model[name] = draw.standard_normal(model[name].shape).astype(np.float32)
    return vocabulary, model


def test_probabilities_of_all_tokens_add_up():
    """Words of the model by class, tokens of the rest, and the unseen as one more."""
    vocabulary, model = small_model()
    states = np.random.default_rng(2).standard_normal((4, 5)).astype(np.float32)
    for state in states:
        every = np.arange(vocabulary.size + 1)
        logs = lm.log_probabilities(model, np.repeat(state[None], len(every), 0), every, vocabulary.width)
        inside = np.exp(logs[:-1]).sum()
        # of the rest: three frequent tokens, 20 others with 40 occurrences, and what was never seen
        counts = vocabulary.counts[vocabulary.size : -1]
        rest = (counts + 1).sum() + (40 + 20) + 1
        assert vocabulary.rest == pytest.approx(rest)
        assert inside + np.exp(logs[-1]) * rest / vocabulary.rest == pytest.approx(1, abs=1e-5)


def test_gradients_by_differences():
    vocabulary, model = small_model()
    model = {name: value.astype(np.float64) for name, value in model.items()}
    draw = np.random.default_rng(5)
    documents = [draw.integers(0, vocabulary.size + 1, n) for n in (6, 3, 4, 1)]
    window = next(lm.windows(documents, 2, 8, vocabulary.size + 1))[:4]
    state = np.zeros((2, 5))
    grad, _, loss = lm.gradients(model, window, state, vocabulary.width)
    for name, value in model.items():
        flat = value.reshape(-1)
        for at in draw.choice(len(flat), min(6, len(flat)), replace=False):
            if value[np.unravel_index(at, value.shape)] <= -29:
                continue
            kept, losses = flat[at], []
            for step in (1e-2, -1e-2):
                flat[at] = kept + step
                losses.append(lm.gradients(model, window, state, vocabulary.width)[2])
            flat[at] = kept
            slope = (losses[0] - losses[1]) / 2e-2
            assert grad[name].reshape(-1)[at] == pytest.approx(slope, abs=2e-3, rel=2e-2), name


def test_state_is_carried_across_windows_and_not_across_documents():
    vocabulary, model = small_model()
    draw = np.random.default_rng(6)
    documents = [draw.integers(0, vocabulary.size + 1, n) for n in (70, 1, 33, 8, 8, 21)]
    alone = [lm.score(model, [ids], vocabulary.width, 1, 1000)[0] for ids in documents]
    for lanes, steps in ((1, 7), (2, 5), (4, 16), (16, 3)):
        found = lm.score(model, documents, vocabulary.width, lanes, steps)
        assert np.allclose(found, alone, rtol=1e-4)


def test_held_out_text_is_likelier_than_by_counts(spark, texts):
    """Sentences of fixed order: what follows is all but given."""
    draw = random.Random(4)
    lines = ["one two three four five six", "six five four three two one", "red green blue red green blue"]
    rows = [(i, " ".join(draw.choice(lines) for _ in range(60))) for i in range(150)]
    found = lm.scored(texts(rows), words=20, classes=4, one_in=1).where("held_out").collect()
    assert len(found) > 10
    base, score = (sum(row[name] for row in found) for name in ("base_score", "score"))
    assert score > 0.75 * base


def test_models_are_averaged_by_tokens_in_two_levels(spark, monkeypatch):
    monkeypatch.setattr(lm, "PER_TASK", 40)
    monkeypatch.setattr(lm, "FAN_IN", 2)
    vocabulary, model = small_model()
    draw = np.random.default_rng(7)
    rows = [(0, i, 12, draw.integers(0, 8, 12).astype("<i4").tobytes()) for i in range(25)]
    ids = spark.createDataFrame(rows, "round int, draw long, size long, ids binary")
    found = lm.trained(ids, model, vocabulary.width, rounds=1)
    again = lm.trained(ids, model, vocabulary.width, rounds=1)
    assert all(np.array_equal(found[name], again[name]) for name in found)
    assert not np.allclose(found["C"], model["C"])
    assert found["E"].shape == model["E"].shape and np.isfinite(found["O"]).all()


def test_every_training_document_is_learned_from(texts, monkeypatch):
    """By default the model trains on all documents that are not held out, not on a sample."""
    seen = []
    train = lm.trained

    def spy(ids, *args, **kwargs):
        seen.append(sorted(row.draw for row in ids.select("draw").collect()))
        return train(ids, *args, **kwargs)

    monkeypatch.setattr(lm, "trained", spy)
    pairs = [(i, f"word{i % 5} and more words") for i in range(80)]
    lm.scored(texts(pairs), words=5, classes=2).collect()
    learned = [i for i, _ in pairs if not held_out(i)]
    draws = sorted(zlib.crc32(str(i).encode()) for i in learned)
    assert seen == [draws]
