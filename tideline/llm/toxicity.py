"""Toxicity by weak supervision.

Many voters look at a text: one for each word of a lexicon, one for each beginning of words that
the labelled sample shows to go with toxic texts (so insults are found with any ending), and
patterns. A generative model takes each document's true
class as hidden (known where a training label exists) and estimates by expectation-maximisation
how often each voter fires in either class; voters that still correlate within a class share their
weight. A linear classifier is then trained on the model's posterior labels; it also sees how many
words fire, so that an insult which the sample never had still counts.

Both models are fitted on a bounded sample, ``LABELLED`` labelled and ``UNLABELLED`` other training
documents or few more, chosen by hashes. A score depends on the text alone.

Defined results: a null text counts as empty, and empty texts get a score too; without any label
the classes rest on the lexicon; a null doc_id counts as not held out and as unlabelled; repeated
rows get the same score; of repeated labels the greater counts; an empty table gives an empty
result. Other columns play no part and may have any name.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship_by_value
from .common import if_small, settled
from .language import is_held_out

ship_by_value(__name__)

#: Insults, by language.
LEXICON = (
    # English
    "idiot idiots idiotic moron morons moronic stupid dumb imbecile cretin loser losers scum trash "
    "garbage clown clowns pathetic worthless disgusting filthy vermin ugly fool fools jerk creep "
    "coward liar freak freaks lowlife degenerate retard retarded bastard bastards bitch bitches "
    "asshole assholes dickhead fuck fucking fucker shit shitty bullshit crap whore slut hate hateful "
    # German
    "idioten dummkopf trottel arschloch scheisse scheiße verlierer abschaum widerlich abartig "
    # French
    "imbécile crétin connard connasse salope ordure abruti débile dégueulasse minable "
    # Spanish
    "idiota imbécil estúpido estúpida basura asqueroso asquerosa cabrón mierda puta payaso escoria "
).split()
#: Labelled training documents, and others (the expected numbers).
LABELLED = 20_000
UNLABELLED = 10_000
#: Beginnings of words that the labelled sample may add: at most so many, of these lengths, each in
#: so many toxic texts at least, which are such a share of all texts that have it.
MINED = 200
BEGINNINGS = (4, 5, 6)
MINED_TEXTS = 6
MINED_SHARE = 0.8
PARTS, HELD_OUT = 5, 0
RESULT = "double"


def patterns() -> list[re.Pattern]:
    """Voters beside the words; they look at the text as it is."""
    return [
        re.compile(r"[A-ZÄÖÜÉÈÊÀÇÑÓÍ]{4,}[^a-z]{0,3}[A-ZÄÖÜÉÈÊÀÇÑÓÍ]{4,}"),  # shouting
        re.compile(r"[!?]{3,}"),
        re.compile(r"\b(?:you|your|you're|ur)\b", re.IGNORECASE),
        re.compile(r"\b(?:shut up|go away|kill yourself|get lost|drop dead)\b", re.IGNORECASE),
    ]


@dataclass
class Voters:
    """The voters: whole words, beginnings of words (after those), and patterns."""

    words: list[str]
    whole: int

    def __getstate__(self) -> dict:
        return {"words": self.words, "whole": self.whole}

    @cached_property
    def _automaton(self):
        import ahocorasick

        places: dict[str, list[int]] = {}
        for i, word in enumerate(self.words):
            places.setdefault(word, []).append(i)
        found = ahocorasick.Automaton()
        for word, numbers in places.items():
            found.add_word(word, (numbers, len(word)))
        found.make_automaton()
        return found

    @cached_property
    def _patterns(self) -> list[re.Pattern]:
        return patterns()

    @property
    def size(self) -> int:
        return len(self.words) + len(patterns())

    def votes(self, text: str | None) -> np.ndarray:
        """How often each voter fires, then the number of words."""
        counts = np.zeros(self.size + 1, np.float32)
        if not isinstance(text, str) or not text:
            return counts
        folded = text.lower()
        last = len(folded)
        for end, (numbers, length) in self._automaton.iter(folded):
            before = end - length
            if before >= 0 and folded[before].isalnum():
                continue
            ends = end + 1 >= last or not folded[end + 1].isalnum()
            for i in numbers:
                counts[i] += ends or i >= self.whole
        for i, pattern in enumerate(self._patterns, len(self.words)):
            counts[i] = bool(pattern.search(text))
        counts[-1] = text.count(" ") + 1
        return counts


def features(counts: np.ndarray, words: int) -> np.ndarray:
    """What the linear classifier sees: each voter, and how many words fire in all."""
    fired = (counts[:, :-1] > 0).astype(np.float64)
    hits = counts[:, :words].sum(axis=1)
    kinds = fired[:, :words].sum(axis=1)
    extra = [np.log1p(hits), np.log1p(kinds), (hits > 0), np.minimum(1, 20 * hits / (counts[:, -1] + 20))]
    return np.column_stack([fired, *extra, np.ones(len(counts))])


def label_model(
    fired: np.ndarray, known: np.ndarray, seeds: np.ndarray, rounds: int = 30
) -> np.ndarray:
    """Posterior P(toxic) of each document from its voters.

    ``known`` is 0, 1 or NaN; ``seeds`` marks voters that are taken to point at toxic texts before
    anything is estimated.
    """
    labelled = ~np.isnan(known)
    posterior = np.where(labelled, known, np.where(fired[:, seeds].any(axis=1), 0.9, 0.05))
    weight = np.ones(fired.shape[1])
    for step in range(rounds):
        # how often each voter fires in either class, with one document of each kind added
        toxic, clean = posterior.sum(), (1 - posterior).sum()
        rate_toxic = (posterior @ fired + 0.05) / (toxic + 1)
        rate_clean = ((1 - posterior) @ fired + 0.05) / (clean + 1)
        # a voter for toxic texts may be useless, but not speak against them
        rate_toxic[seeds] = np.maximum(rate_toxic[seeds], rate_clean[seeds])
        prior = np.clip(toxic / len(posterior), 1e-4, 0.5) if len(posterior) else 0.1
        if step == rounds // 2:
            # what voters still have in common within the classes
            left = fired - np.outer(posterior, rate_toxic) - np.outer(1 - posterior, rate_clean)
            spread = np.sqrt((left**2).sum(axis=0)) + 1e-9
            shared = np.abs((left.T @ left) / np.outer(spread, spread))
            weight = 1 / (1 + np.where(shared > 0.2, shared, 0).sum(axis=0) - np.diag(shared))
        present = np.log(rate_toxic / rate_clean)
        absent = np.log((1 - rate_toxic) / (1 - rate_clean))
        odds = fired @ (weight * (present - absent)) + (weight * absent).sum()
        odds += math.log(prior / (1 - prior))
        posterior = np.where(labelled, known, 1 / (1 + np.exp(-np.clip(odds, -30, 30))))
    return posterior


def linear_classifier(x: np.ndarray, target: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights of a logistic regression on soft labels, by Newton steps."""
    weights = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3
    for _ in range(30):
        chance = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (chance - target) + penalty * weights
        curve = (x * (chance * (1 - chance))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curve, slope)
        weights -= step
        if np.abs(step).max() < 1e-6:
            break
    return weights


def _drawn(df: DataFrame, key: Column, size: int, of: int) -> DataFrame:
    share = min(1.0, size / max(1, of))
    return df.where(F.pmod(F.xxhash64(key, F.lit(7)), F.lit(1 << 20)) < share * (1 << 20))


def _sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic) of the training sample; toxic is null for unlabelled documents."""
    training = docs.where(~is_held_out(F.col("doc_id"), PARTS, HELD_OUT))
    known = settled(
        labels.where("toxic is not null and doc_id is not null")
        .where(~is_held_out(F.col("doc_id"), PARTS, HELD_OUT))
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    some = settled(_drawn(known, F.col("doc_id"), LABELLED, known.count()))
    of_labels = training.join(if_small(some), "doc_id")
    others = _drawn(training, F.col("doc_id"), UNLABELLED, training.count())
    unlabelled = others.join(if_small(some.select("doc_id")), "doc_id", "left_anti")
    both = of_labels.select("doc_id", "text", "toxic").unionByName(
        unlabelled.select("doc_id", "text", F.lit(None).cast("int").alias("toxic"))
    )
    # a document that is repeated is sampled once
    return settled(
        both.groupBy("doc_id").agg(F.first("text").alias("text"), F.first("toxic").alias("toxic"))
    )


def _mined(sample: DataFrame) -> list[str]:
    """Beginnings of words of the labelled sample that go with toxic texts, strongest first; none
    that begins with another."""
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}{3,}"), F.lit(0)))
    cut = F.transform(words, lambda w: F.array(*[F.substring(w, 1, n) for n in BEGINNINGS]))
    counted = (
        sample.where("toxic is not null")
        .select("toxic", F.explode(F.array_distinct(F.flatten(cut))).alias("start"))
        .groupBy("start")
        .agg(F.sum("toxic").alias("toxic"), F.count("*").alias("n"))
        .where(f"toxic >= {MINED_TEXTS} and toxic >= {MINED_SHARE} * n")
        .withColumn("use", F.expr("toxic - 5 * (n - toxic)"))
    )
    found: list[str] = []
    for row in counted.orderBy(F.desc("use"), F.length("start"), "start").limit(20 * MINED).collect():
        if len(found) < MINED and not any(row["start"].startswith(other) for other in found):
            found.append(row["start"])
    return found


@dataclass
class Model:
    voters: Voters
    weights: np.ndarray

    def scores(self, texts: list[str | None]) -> np.ndarray:
        counts = np.array([self.voters.votes(text) for text in texts])
        if not len(counts):
            return np.zeros(0)
        odds = features(counts, len(self.voters.words)) @ self.weights
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from documents (doc_id, text) and labels (doc_id, toxic) outside the held-out part."""
    sample = _sample(docs, labels)
    lexicon = list(dict.fromkeys(LEXICON))
    words = [*lexicon, *_mined(sample)]
    voters = Voters(words, len(lexicon))

    @F.pandas_udf("binary")
    def votes(texts: pd.Series) -> pd.Series:
        return pd.Series([voters.votes(text).tobytes() for text in texts])

    # the bounded sample: four bytes per voter and document
    rows = [
        (row["toxic"], np.frombuffer(row["votes"], np.float32))
        for row in sample.select("toxic", votes("text").alias("votes")).toArrow().to_pylist()
    ]
    rows.sort(key=lambda row: (row[0] is None, row[0], row[1].tolist()))
    counts = np.array([row[1] for row in rows], np.float32).reshape(len(rows), voters.size + 1)
    known = np.array([np.nan if row[0] is None else row[0] for row in rows], float)
    seeds = np.arange(voters.size) < len(words)
    fired = (counts[:, :-1] > 0).astype(np.float64)
    posterior = label_model(fired, known, seeds)
    x = features(counts, len(words))
    return Model(voters, linear_classifier(x, posterior))


def scored(text: Column, model: Model) -> Column:
    @F.pandas_udf(RESULT)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(model.scores(list(texts)))

    return run(text)


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    known = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).alias("toxic"))
    model = fit(rows, known)
    return rows.select(
        "doc_id",
        is_held_out(F.col("doc_id"), PARTS, HELD_OUT).alias("held_out"),
        scored(F.col("text"), model).alias("score"),
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
