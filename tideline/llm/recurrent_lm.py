"""A gated recurrent language model that scores whole documents.

Counts. Tokens are words, lower-cased in A-Z, and one end per document. All training documents are
counted; the counts give the base score (add-one unigram) and the model's vocabulary.

Model. The ``MODEL_WORDS`` most frequent tokens have embeddings and outputs; they are cut into
classes of neighbouring ranks. All other tokens share one input and one class, inside which a
token has its add-one share of the rest, so that probabilities of all tokens, unseen ones
included, add up to one. A gated recurrent unit reads the tokens; a token's probability is that
of its class times that of the token within the class.

Training. Truncated backpropagation through windows of ``WINDOW`` tokens, in numpy, over whole
documents; the state is carried from window to window. Every training document is learned from
(``ONE_IN`` = 1; a caller may ask for one in ``one_in`` by hash). They are dealt in ``ROUNDS`` parts;
in each, every task trains the current model on its rows, and the models are averaged by the tokens
they have seen, in two levels. The model itself has a fixed size.

Scoring. Many documents run side by side as lanes of one batch, each lane going on with the next
document when one ends; the state is carried through a document however long it is. Tokens that
are not among the ``HEAD`` most frequent are counted per document and joined with their counts
by a shuffle, all others are looked up in the task.

Defined results: a null text is empty and has one token, its end; a null doc_id counts as the empty
string in the hashes, which puts such rows by chance into training or not; repeated rows count as
often as they occur and get the same scores; without training documents every count is 0 and
the model is as it was drawn; an empty table gives an empty result. Columns beyond doc_id and text
play no part and may have any name.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import settled, ship_by_value
from .common import landed

ship_by_value(__name__)

#: The end of a document; no word can hold a blank.
END = b" "
#: Tokens with embeddings and outputs, and the classes they are cut into.
MODEL_WORDS = 2000
CLASSES = 40
#: Tokens whose counts are sent to all tasks.
HEAD = 100_000
EMBEDDING = 24
HIDDEN = 32
#: Tokens of a window of truncated backpropagation, and documents side by side.
WINDOW = 32
LANES = 256
TRAIN_LANES = 64
ROUNDS = 3
ONE_IN = 1
RATE = 0.01
#: Tokens of a round that one task trains on, about.
PER_TASK = 500_000
#: Tokens that are worked on at once in scoring.
AT_ONCE = 400_000
#: Models averaged by one task of the first level.
FAN_IN = 256
#: Tasks of the first level, at least.
GROUPS = 16
LOG10 = float(np.log(10.0))


def document_hash(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def tokens_of(text: str | None) -> list[bytes]:
    """Words, lower-cased in A-Z only, without the end. Bytes are split at exactly the six blanks
    and lower-cased in ASCII only."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def token_counts(texts: DataFrame) -> DataFrame:
    """(token, c) over all texts (a column ``text``), the ends included."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            names = pa.array(list(found), pa.binary())
            return pa.RecordBatch.from_arrays([names, pa.array(list(found.values()), pa.int64())], ["token", "n"])

        for batch in batches:
            for text in batch.column("text"):
                found.update(tokens_of(text.as_py()))
                # what a task holds is bounded; tokens may come out more than once
                if len(found) > 500_000:
                    yield out()
                    found.clear()
            found[END] += batch.num_rows
        if found:
            yield out()

    return texts.select("text").mapInArrow(count, "token binary, n long").groupBy("token").agg(F.sum("n").alias("c"))


def frequent(counts: DataFrame, most: int = HEAD) -> tuple[dict[bytes, int], int]:
    """The most frequent tokens with their counts in falling order, at most ``most`` of them, and the
    count from which on a token is one of them. Found by a histogram of at most some 1,000 sizes."""
    size = F.floor(F.log2("c") * 16)
    sizes = counts.groupBy(size.alias("size")).agg(F.count("*").alias("n"), F.min("c").alias("least"))
    least, sum_ = None, 0
    for row in sorted(sizes.collect(), key=lambda row: -row["size"]):
        sum_ += row["n"]
        if sum_ > most:
            break
        least = row["least"]
    if least is None:
        return {}, 1 << 62
    rows = counts.where(F.col("c") >= least).toArrow()
    pairs = zip(rows.column("token").to_pylist(), rows.column("c").to_pylist())
    return dict(sorted(pairs, key=lambda pair: (-pair[1], pair[0]))), least


@dataclass
class Vocabulary:
    """The frequent tokens with their counts in falling order, the sums over all tokens, and what
    follows for the first ``words`` of them, those of the model, and for the rest."""

    head: dict[bytes, int]
    total: int
    distinct: int
    words: int
    classes: int

    def __post_init__(self):
        self.number = {token: i for i, token in enumerate(self.head)}
        self.counts = np.array([*self.head.values(), 0], np.int64)
        known = list(self.head)[: self.words]
        self.size = len(known)
        # classes of equal numbers of ranks; the last is the rest
        self.width = max(1, -(-self.size // self.classes))
        self.groups = -(-self.size // self.width) if self.size else 0
        counts = np.array([self.head[token] for token in known], float)
        rest = self.total + self.distinct + 1 - float((counts + 1).sum())
        self.rest = max(rest, 1.0)
        self.base_unit = np.log10(self.total + self.distinct + 1)
        mass = np.zeros(self.groups + 1)
        np.add.at(mass, np.arange(self.size) // self.width, counts + 1)
        mass[-1] = self.rest
        self.class_bias = np.log(mass / mass.sum()).astype(np.float32)
        self.word_bias = np.full((self.groups, self.width), -30.0, np.float32)
        self.word_bias.reshape(-1)[: self.size] = np.log(counts + 1)


def new_model(vocabulary: Vocabulary, embedding: int, hidden: int, seed: int = 7) -> dict[str, np.ndarray]:
    """Weights before training: outputs start as class and word frequencies."""
    draw = np.random.default_rng(seed)

    def matrix(*shape: int) -> np.ndarray:
        return (draw.standard_normal(shape) / np.sqrt(shape[-2])).astype(np.float32)

    return {
        # one input for each word, the rest, and the start of a document
        "E": (draw.standard_normal((vocabulary.size + 2, embedding)) * 0.1).astype(np.float32),
        "W": matrix(embedding, 3 * hidden),
        "U": matrix(hidden, 2 * hidden),
        "V": matrix(hidden, hidden),
        "b": np.zeros(3 * hidden, np.float32),
        "C": np.zeros((hidden, vocabulary.groups + 1), np.float32),
        "c": vocabulary.class_bias.copy(),
        "O": np.zeros((vocabulary.groups, hidden, vocabulary.width), np.float32),
        "o": vocabulary.word_bias.copy(),
    }


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def forward(model: dict, inputs: np.ndarray, fresh: np.ndarray, state: np.ndarray) -> tuple:
    """States of a window: inputs and fresh (a document begins) are steps x lanes. Returns states
    (steps + 1 x lanes x hidden, the first being the carried one) and what the way back needs."""
    steps, lanes = inputs.shape
    hidden = state.shape[1]
    driven = (model["E"][inputs.reshape(-1)] @ model["W"] + model["b"]).reshape(steps, lanes, 3 * hidden)
    states = np.empty((steps + 1, lanes, hidden), np.float32)
    gates = np.empty((steps, lanes, 2 * hidden), np.float32)
    fresh_states = np.empty((steps, lanes, hidden), np.float32)
    states[0] = state
    keep = (~fresh).astype(np.float32)[:, :, None]
    for t in range(steps):
        before = states[t] * keep[t]
        gate = _sigmoid(driven[t, :, : 2 * hidden] + before @ model["U"])
        update, reset = gate[:, :hidden], gate[:, hidden:]
        new = np.tanh(driven[t, :, 2 * hidden :] + (reset * before) @ model["V"])
        states[t + 1] = before + update * (new - before)
        gates[t], fresh_states[t] = gate, new
    return states, gates, fresh_states, keep


def _log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(axis=1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=1, keepdims=True))


def log_probabilities(model: dict, states: np.ndarray, targets: np.ndarray, width: int) -> np.ndarray:
    """Natural log of class times word for flat states and targets; for the rest (a target past the
    last word) that of the class alone."""
    words = len(model["E"]) - 2
    groups = model["O"].shape[0]
    group = np.where(targets < words, targets // width, groups)
    classes = _log_softmax(states @ model["C"] + model["c"])
    found = classes[np.arange(len(targets)), group]
    order = np.argsort(group, kind="stable")
    edges = np.searchsorted(group[order], np.arange(groups + 1))
    for g in range(groups):
        rows = order[edges[g] : edges[g + 1]]
        if len(rows):
            within = _log_softmax(states[rows] @ model["O"][g] + model["o"][g])
            found[rows] += within[np.arange(len(rows)), targets[rows] - g * width]
    return found


def gradients(model: dict, window: tuple, state: np.ndarray, width: int) -> tuple[dict, np.ndarray, float]:
    """Gradients of a window's negative log-likelihood by truncated backpropagation, the state
    after it, and the loss. window: inputs, fresh, targets, live (lanes that still have a token)."""
    inputs, fresh, targets, live = window
    steps, lanes = inputs.shape
    hidden = state.shape[1]
    states, gates, news, keep = forward(model, inputs, fresh, state)
    grad = {name: np.zeros_like(value) for name, value in model.items()}
    after = states[1:].reshape(-1, hidden)
    rows = np.flatnonzero(live.reshape(-1))
    goal = targets.reshape(-1)[rows]
    words, groups = len(model["E"]) - 2, model["O"].shape[0]
    group = np.where(goal < words, goal // width, groups)
    h = after[rows]
    classes = _log_softmax(h @ model["C"] + model["c"])
    at = np.arange(len(rows))
    loss = -float(classes[at, group].sum())
    error = np.exp(classes)
    error[at, group] -= 1
    grad["C"], grad["c"] = h.T @ error, error.sum(axis=0)
    back = np.zeros_like(after)
    back[rows] = error @ model["C"].T
    order = np.argsort(group, kind="stable")
    edges = np.searchsorted(group[order], np.arange(groups + 1))
    for g in range(groups):
        some = order[edges[g] : edges[g + 1]]
        if len(some):
            within = _log_softmax(h[some] @ model["O"][g] + model["o"][g])
            place = goal[some] - g * width
            loss -= float(within[np.arange(len(some)), place].sum())
            error = np.exp(within)
            error[np.arange(len(some)), place] -= 1
            grad["O"][g] = h[some].T @ error
            grad["o"][g] = error.sum(axis=0)
            back[rows[some]] += error @ model["O"][g].T
    back = back.reshape(steps, lanes, hidden)
    driven = np.empty((steps, lanes, 3 * hidden), np.float32)
    later = np.zeros((lanes, hidden), np.float32)
    for t in range(steps - 1, -1, -1):
        later = later + back[t]
        before = states[t] * keep[t]
        update, reset, new = gates[t, :, :hidden], gates[t, :, hidden:], news[t]
        d_new = later * update * (1 - new * new)
        d_update = later * (new - before) * update * (1 - update)
        d_mixed = d_new @ model["V"].T
        d_reset = d_mixed * before * reset * (1 - reset)
        grad["V"] += (reset * before).T @ d_new
        d_gate = np.concatenate([d_update, d_reset], axis=1)
        grad["U"] += before.T @ d_gate
        later = (later * (1 - update) + d_mixed * reset + d_gate @ model["U"].T) * keep[t]
        driven[t, :, : 2 * hidden], driven[t, :, 2 * hidden :] = d_gate, d_new
    flat = driven.reshape(-1, 3 * hidden)
    seen = inputs.reshape(-1)
    grad["W"] = model["E"][seen].T @ flat
    grad["b"] = flat.sum(axis=0)
    order = np.argsort(seen, kind="stable")
    found, starts = np.unique(seen[order], return_index=True)
    grad["E"][found] = np.add.reduceat((flat @ model["W"].T)[order], starts)
    return grad, states[-1], loss


class Trainer:
    """Adam on gradients divided by the tokens of a full window, so that windows with few live
    lanes count less; large gradients are shortened."""

    def __init__(self, model: dict, rate: float):
        self.model = {name: value.copy() for name, value in model.items()}
        self.rate, self.step = rate, 0
        self.mean = {name: np.zeros_like(value) for name, value in model.items()}
        self.square = {name: np.zeros_like(value) for name, value in model.items()}

    def learn(self, grad: dict, tokens: int) -> None:
        self.step += 1
        rate = self.rate * np.sqrt(1 - 0.99**self.step) / (1 - 0.9**self.step)
        norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values())) / tokens
        scale = np.float32(min(1.0, 1.0 / max(norm, 1e-9)) / tokens)
        for name, value in self.model.items():
            g = grad[name] * scale
            self.mean[name] += 0.1 * (g - self.mean[name])
            self.square[name] += 0.01 * (g * g - self.square[name])
            value -= (rate * self.mean[name] / (np.sqrt(self.square[name]) + 1e-6)).astype(np.float32)

    def read(self, documents: list[np.ndarray], width: int, lanes: int, steps: int) -> float:
        """One pass over documents; the loss on the way."""
        state = np.zeros((lanes, self.model["V"].shape[0]), np.float32)
        total = 0.0
        for inputs, fresh, targets, live, _ in windows(documents, lanes, steps, len(self.model["E"]) - 1):
            window = (inputs, fresh, targets, live)
            grad, state, loss = gradients(self.model, window, state[: inputs.shape[1]], width)
            self.learn(grad, lanes * steps)
            total += loss
        return total


def lanes_of(lengths: np.ndarray, lanes: int) -> list[list[int]]:
    """Documents dealt to lanes, longest first, each to the lane that is shortest; a lane has them
    in their own order."""
    heap = [(0, lane) for lane in range(min(lanes, len(lengths)))]
    found: list[list[int]] = [[] for _ in heap]
    for i in np.argsort(-lengths, kind="stable").tolist():
        size, lane = heapq.heappop(heap)
        found[lane].append(i)
        heapq.heappush(heap, (size + int(lengths[i]), lane))
    return [sorted(lane) for lane in found]


def windows(documents: list[np.ndarray], lanes: int, steps: int, start: int) -> Iterator[tuple]:
    """Windows over lanes of documents: inputs, fresh, targets, live, and each target's document.
    ``start`` is the input before a document's first token. Lanes run out from the last on."""
    lengths = np.array([len(ids) for ids in documents])
    dealt = lanes_of(lengths, lanes)
    sizes = np.array([int(lengths[lane].sum()) for lane in dealt])
    order = np.argsort(-sizes, kind="stable")
    streams = []
    for k in order.tolist():
        ids = np.concatenate([documents[i] for i in dealt[k]])
        begins = np.cumsum([0, *lengths[dealt[k]][:-1]])
        before = np.empty_like(ids)
        before[1:] = ids[:-1]
        before[begins] = start
        new = np.zeros(len(ids), bool)
        new[begins] = True
        streams.append((before, new, ids, np.repeat(dealt[k], lengths[dealt[k]])))
    sizes = sizes[order]
    for low in range(0, int(sizes[0]) if len(sizes) else 0, steps):
        active = int(np.searchsorted(-sizes, -low, "left"))
        high = min(low + steps, int(sizes[0]))
        shape = (high - low, active)
        inputs, targets = np.full(shape, start), np.zeros(shape, np.int64)
        fresh, live = np.ones(shape, bool), np.zeros(shape, bool)
        owner = np.zeros(shape, np.int64)
        for lane in range(active):
            before, new, ids, own = (column[low:high] for column in streams[lane])
            n = len(ids)
            inputs[:n, lane], fresh[:n, lane], targets[:n, lane] = before, new, ids
            owner[:n, lane], live[:n, lane] = own, True
        yield inputs, fresh, targets, live, owner


def score(model: dict, documents: list[np.ndarray], width: int, lanes: int, steps: int) -> np.ndarray:
    """The natural log-likelihood of each document; tokens of the rest count with their class alone."""
    found = np.zeros(len(documents))
    hidden = model["V"].shape[0]
    state = np.zeros((lanes, hidden), np.float32)
    for inputs, fresh, targets, live, owner in windows(documents, lanes, steps, len(model["E"]) - 1):
        states, *_ = forward(model, inputs, fresh, state[: inputs.shape[1]])
        state = states[-1]
        rows = live.reshape(-1)
        logs = log_probabilities(model, states[1:].reshape(-1, hidden)[rows], targets.reshape(-1)[rows], width)
        found += np.bincount(owner.reshape(-1)[rows], logs, len(documents))
    return found


def _chunks(found: Iterator[np.ndarray], at_once: int) -> Iterator[list[np.ndarray]]:
    part, size = [], 0
    for ids in found:
        part.append(ids)
        size += len(ids)
        if size >= at_once:
            yield part
            part, size = [], 0
    if part:
        yield part


def _packed(model: dict) -> bytes:
    return b"".join(np.ascontiguousarray(value, np.float32).tobytes() for value in model.values())


def _unpacked(raw: bytes, shapes: dict[str, tuple]) -> dict:
    flat, found, at = np.frombuffer(raw, np.float32), {}, 0
    for name, shape in shapes.items():
        size = int(np.prod(shape))
        found[name] = flat[at : at + size].reshape(shape).copy()
        at += size
    return found


def _added(models: DataFrame, parts: int) -> DataFrame:
    """Sums of models times their tokens, one for each of ``parts`` tasks."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, total = 0, None
        for batch in batches:
            for n, raw in zip(batch.column("tokens").to_pylist(), batch.column("weights")):
                values = np.frombuffer(raw.as_py(), np.float64)
                total = values.copy() if total is None else total + values
                tokens += n
        if tokens:
            yield pa.RecordBatch.from_arrays(
                [pa.array([0]), pa.array([tokens]), pa.array([total.tobytes()])], ["slot", "tokens", "weights"]
            )

    # a shuffle also into one part: without it the tasks that train would become one as well
    dealt = models.repartition(parts, "slot") if parts > 1 else models.repartition(1)
    return dealt.mapInArrow(add, "slot long, tokens long, weights binary")


def trained(ids: DataFrame, model: dict, width: int, rounds: int = ROUNDS, rate: float = RATE) -> dict:
    """The model after all rounds over the documents in ``ids`` (round, draw, ids), a settled table."""
    sums = ids.agg(F.sum("size")).first()[0] or 0
    tasks = max(1, -(-sums // (rounds * PER_TASK)))
    lanes, steps = TRAIN_LANES, WINDOW
    for number in range(rounds):
        packed = _packed(model)
        shapes = {name: value.shape for name, value in model.items()}

        def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            trainer = Trainer(_unpacked(packed, shapes), rate)
            tokens = 0
            found = (np.frombuffer(raw.as_py(), "<i4").astype(np.int64) for b in batches for raw in b.column("ids"))
            for documents in _chunks(found, PER_TASK):
                trainer.read(documents, width, lanes, steps)
                tokens += sum(map(len, documents))
            if tokens:
                weights = np.frombuffer(_packed(trainer.model), np.float32).astype(np.float64) * tokens
                slot = TaskContext.get().partitionId()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([slot]), pa.array([tokens]), pa.array([weights.tobytes()])],
                    ["slot", "tokens", "weights"],
                )

        some = ids.where(F.col("round") == number).select("draw", "ids")
        some = some.repartition(tasks, "draw").sortWithinPartitions("draw")
        models = some.mapInArrow(learn, "slot long, tokens long, weights binary")
        groups = max(GROUPS, -(-tasks // FAN_IN))
        models = _added(models.withColumn("slot", F.col("slot") % groups), groups)
        whole = _added(models, 1).collect()
        if whole:
            mean = np.frombuffer(whole[0]["weights"], np.float64) / whole[0]["tokens"]
            model = _unpacked(mean.astype(np.float32).tobytes(), shapes)
    return model


def scored(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    words: int = MODEL_WORDS,
    classes: int = CLASSES,
    head: int = HEAD,
    embedding: int = EMBEDDING,
    hidden: int = HIDDEN,
    rounds: int = ROUNDS,
    one_in: int = ONE_IN,
    rate: float = RATE,
) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score
    (log10 probabilities)."""
    draw = document_hash(F.col(doc_id))
    narrow = docs.select(
        F.col(doc_id).alias("doc_id"), draw.alias("draw"), F.col(text).cast("string").alias("text")
    ).withColumn("held_out", F.col("draw") % 7 == 2)
    learned = narrow.where("not held_out")
    counts = settled(token_counts(learned))
    sums = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    top, least = frequent(counts, head)
    vocabulary = Vocabulary(top, sums["n"] or 0, sums["v"], words, classes)
    model = new_model(vocabulary, embedding, hidden)
    number, size = vocabulary.number, vocabulary.size

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for value in batch.column("text"):
                tokens = [*tokens_of(value.as_py()), END]
                ids = np.fromiter(map(number.get, tokens, repeat(size)), np.int64, len(tokens))
                found.append(np.minimum(ids, size).astype("<i4").tobytes())
            lengths = [len(raw) // 4 for raw in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("round"), batch.column("draw"), pa.array(lengths, pa.int64()), pa.array(found)],
                ["round", "draw", "size", "ids"],
            )

    chosen = F.floor(F.col("draw") / 7)
    sample = learned.where(chosen % one_in == 0).select(
        (F.floor(chosen / one_in) % rounds).cast("int").alias("round"), "draw", "text"
    )
    ids = landed(sample.mapInArrow(numbered, "round int, draw long, size long, ids binary"), "tokens")
    model = trained(ids, model, vocabulary.width, rounds, rate)
    parts = landed(_document_parts(narrow, vocabulary, model), "scores")
    # tokens that are not frequent meet their counts by a shuffle; unseen ones add nothing more
    rare = parts.select("row", F.explode("rare").alias("r")).select("row", "r.token", "r.n")
    rare = rare.join(counts.where(F.col("c") < least), "token").groupBy("row")
    rare = rare.agg(F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("weight"), F.sum("n").alias("known"))
    weight = F.coalesce("weight", F.lit(0.0))
    return parts.drop("rare").join(rare, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(vocabulary.total).cast("long").alias("train_tokens"),
        (F.col("base_part") + weight).alias("base_score"),
        (F.col("score_part") + weight).alias("score"),
    )


def _document_parts(docs: DataFrame, vocabulary: Vocabulary, model: dict) -> DataFrame:
    """A row per document with its sums over frequent tokens, and its other tokens with their
    numbers; for those ``c + 1`` counts as 1 in the sums."""
    packed = _packed(model)
    shapes = {name: value.shape for name, value in model.items()}
    size, width = vocabulary.size, vocabulary.width
    number, counts = vocabulary.number, vocabulary.counts
    logs = np.log10(counts + 1.0)
    unit, rest_unit = float(vocabulary.base_unit), float(np.log10(vocabulary.rest))
    lanes, steps = LANES, WINDOW
    rows = docs.withColumn("row", F.monotonically_increasing_id()).select("row", "doc_id", "held_out", "text")
    schema = T.StructType(
        [
            rows.schema["row"],
            rows.schema["doc_id"],
            rows.schema["held_out"],
            T.StructField("n_tokens", T.LongType()),
            T.StructField("n_known", T.LongType()),
            T.StructField("base_part", T.DoubleType()),
            T.StructField("score_part", T.DoubleType()),
            T.StructField("rare", T.ArrayType(T.StructType.fromDDL("token binary, n long"))),
        ]
    )
    kinds = pa.list_(pa.struct([("token", pa.binary()), ("n", pa.int64())]))

    def work(batch: pa.RecordBatch, own: dict, texts: list[list[bytes]]) -> pa.RecordBatch:
        documents, known, base, share, rare = [], [], [], [], []
        for tokens in texts:
            tokens.append(END)
            at = np.fromiter(map(number.get, tokens, repeat(len(counts) - 1)), np.int64, len(tokens))
            documents.append(np.minimum(at, size))
            weights = logs[at]
            known.append(int((counts[at] > 0).sum()))
            base.append(float(weights.sum()) - unit * len(tokens))
            outside = at >= size
            share.append(float(weights[outside].sum()) - rest_unit * int(outside.sum()))
            missing = np.flatnonzero(at == len(counts) - 1)
            some = Counter(tokens[i] for i in missing.tolist())
            rare.append([{"token": token, "n": n} for token, n in some.items()])
        likely = score(own, documents, width, lanes, steps) / LOG10
        return pa.RecordBatch.from_arrays(
            [
                batch.column("row"),
                batch.column("doc_id"),
                batch.column("held_out"),
                pa.array([len(ids) for ids in documents], pa.int64()),
                pa.array(known, pa.int64()),
                pa.array(base, pa.float64()),
                pa.array(likely + np.array(share)),
                pa.array(rare, kinds),
            ],
            schema.names,
        )

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _unpacked(packed, shapes)
        for batch in batches:
            first, texts, size_ = 0, [], 0
            for i, value in enumerate(batch.column("text")):
                texts.append(tokens_of(value.as_py()))
                size_ += len(texts[-1])
                if size_ >= AT_ONCE:
                    yield work(batch.slice(first, len(texts)), own, texts)
                    first, texts, size_ = i + 1, [], 0
            if texts:
                yield work(batch.slice(first, len(texts)), own, texts)

    return rows.mapInArrow(describe, schema)
