"""Language identification by the nearest of several centroids per language.

A text becomes counts of its letter bigrams and trigrams (case folded, anything but letters is a
boundary), hashed into a fixed number of buckets, damped by a logarithm, weighted by inverse
document frequency and scaled to length one. Document frequencies come from all training
documents. Each language's training vectors are clustered (spherical k-means) into a few
centroids; a text gets the language of the centroid with the greatest cosine. A text that is
farther from it than nearly all training texts of that language and of its length, with a margin, is
rejected: centroids of one half of its documents (by hash) are compared with beginnings of the other
half's texts, cut at several lengths, and a low quantile of the cosines at each length is the language's
floor there. A language with fewer than ``LEAST`` texts of a length takes its floor at shorter ones, and
one without any rejects what has no n-gram in common with it.

Centroids and floors are fitted on every training document, as Spark jobs: k-means sums vectors per
centroid in the tasks and adds them up by key, medians and quantiles are Spark's exact percentiles.
Training reads text and language alone, and no held-out document.

Defined results: a null text and one without a letter get ``und``, score 0, rejected; so does
every text if nothing could be learned. Documents without language are not learned from. A null
doc_id counts as not held out. Equal cosines go to the language first in code point order.
Repeated rows get the same result; an empty table gives an empty result. Other columns play no
part and may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship_by_value
from .common import landed, whole
from .kept import once

ship_by_value(__name__)

UNKNOWN = "und"
#: Buckets of the hashed n-grams.
BUCKETS = 4096
#: Centroids per language.
CENTROIDS = 4
#: Training documents per language for the centroids (the expected number).
SAMPLE = 1500
#: Rounds of k-means.
ROUNDS = 8
#: A text is rejected below this share of a low quantile of its language's cosines at its length.
MARGIN = 0.8
QUANTILE = 0.01
#: Characters at which training texts are cut, and the texts that a length needs.
CUTS = tuple(2**i for i in range(3, 13))
LEAST = 10
#: Texts that are counted at once.
AT_ONCE = 64
RESULT = "lang_pred string, score double, rejected boolean"


def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    every = range(0x110000)
    return once("letters", lambda: np.fromiter((chr(i).isalpha() for i in every), bool, len(every)))


def counts(texts: list[str | None], buckets: int = BUCKETS) -> np.ndarray:
    """N-gram counts, a row per text; a row of zeros for texts without a letter."""
    # a boundary between and after the texts
    folded = [text.lower() if isinstance(text, str) else "" for text in texts]
    joined = "\n".join([*folded, ""])
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
    rows = np.repeat(np.arange(len(texts)), [len(text) + 1 for text in folded])
    marks = np.where(_letters()[points], points, 0).astype(np.uint64)
    before = np.concatenate([[np.uint64(0)], marks[:-1]])
    earlier = np.concatenate([[np.uint64(0)], before[:-1]])
    mix = np.uint64(0x9E3779B97F4A7C15)
    two = (before * np.uint64(0x110001) + marks + np.uint64(1)) * mix
    three = (two ^ (earlier + np.uint64(7)) * np.uint64(0xC2B2AE3D27D4EB4F)) * mix
    shift = np.uint64(64 - int(buckets).bit_length() + 1)
    total = np.zeros(len(texts) * buckets)
    is_two = (marks + before) > 0
    # a trigram needs a letter in its middle, so that runs of other signs count once
    is_three = (before > 0) & ((marks > 0) | (earlier > 0))
    for grams, valid in ((two, is_two), (three, is_three)):
        cells = rows[valid] * buckets + (grams[valid] >> shift).astype(np.int64)
        total += np.bincount(cells, minlength=len(total))
    return total.reshape(len(texts), buckets)


def weighed(raw: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Normalised TF-IDF rows."""
    vectors = np.log1p(raw) * idf
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / np.where(norms > 0, norms, 1)


def cluster(vectors: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Spherical k-means from far-apart first centroids; the same for the same rows."""
    centroids = vectors.mean(axis=0, keepdims=True)
    while len(centroids) < min(k, len(vectors)):
        nearest = (vectors @ centroids.T).max(axis=1)
        centroids = np.vstack([centroids, vectors[nearest.argmin()]])
    for _ in range(rounds):
        norms = np.linalg.norm(centroids, axis=1, keepdims=True)
        centroids = centroids / np.where(norms > 0, norms, 1)
        owner = (vectors @ centroids.T).argmax(axis=1)
        for i in range(len(centroids)):
            if (owner == i).any():
                centroids[i] = vectors[owner == i].mean(axis=0)
    return centroids / np.maximum(np.linalg.norm(centroids, axis=1, keepdims=True), 1e-12)


def measured(texts: list[str], buckets: int) -> np.ndarray:
    """N-gram counts of the texts that have a letter."""
    parts = [
        counts(texts[low : low + AT_ONCE], buckets).astype(np.float32)
        for low in range(0, len(texts), AT_ONCE)
    ]
    raw = np.concatenate(parts) if parts else np.zeros((0, buckets), np.float32)
    return raw[raw.any(axis=1)]


def floors(texts: list[str], idf: np.ndarray, k: int) -> np.ndarray:
    """Two rows: numbers of n-grams, rising from 0, and the least cosine of a text of that size."""
    halves = [texts[0::2], texts[1::2]]
    centroids = []
    for half in halves:
        raw = measured(half, len(idf))
        centroids.append(cluster(weighed(raw, idf), k) if len(raw) else None)
    points = [(0.0, 0.0)]
    for cut in CUTS:
        sizes, cosines = [], []
        for half, other in zip(halves, reversed(centroids)):
            long = [text[:cut] for text in half if len(text) >= cut]
            for low in range(0, len(long) if other is not None else 0, AT_ONCE):
                raw = measured(long[low : low + AT_ONCE], len(idf))
                sizes.append(raw.sum(axis=1))
                cosines.append((weighed(raw, idf) @ other.T).max(axis=1))
        if sum(map(len, sizes)) < LEAST:
            continue
        size = float(np.median(np.concatenate(sizes)))
        if size > points[-1][0]:
            points.append((size, MARGIN * float(np.quantile(np.concatenate(cosines), QUANTILE))))
    return np.array(points).T


@dataclass
class Model:
    """What a fit leaves: a few centroids per language, of fixed size each."""

    languages: list[str]
    centroids: np.ndarray
    idf: np.ndarray
    floors: list[np.ndarray]

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        raw = counts(texts, len(self.idf))
        known = raw.any(axis=1) & bool(self.languages)
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), ~known
        cosines = np.clip(weighed(raw, self.idf) @ self.centroids.T, 0, 1)
        best = cosines.argmax(axis=1)
        score = np.where(known, cosines[np.arange(len(texts)), best], 0.0)
        names = [self.languages[i] if ok else UNKNOWN for i, ok in zip(best, known)]
        sizes = np.log1p(raw.sum(axis=1))
        least = np.zeros(len(texts))
        for i in np.unique(best):
            at, floor = self.floors[i]
            least[best == i] = np.interp(sizes[best == i], np.log1p(at), floor)
        return names, score, ~known | (score <= least)


def is_held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Whether crc32(doc_id as text) leaves ``part``."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")), F.lit(0)) % parts == part


def _document_frequencies(training: DataFrame, buckets: int) -> tuple[np.ndarray, dict[str, int]]:
    """In how many training texts each bucket occurs, and how many texts each language has."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(buckets, np.int64)
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for low in range(0, len(texts), AT_ONCE):
                seen += (counts(texts[low : low + AT_ONCE], buckets) > 0).sum(axis=0)
        hit = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(seen[hit])], ["bucket", "n"])

    found = training.select("text").mapInArrow(count, "bucket long, n long")
    # at most `buckets` rows, and one per language
    rows = found.groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    frequencies = np.zeros(buckets)
    for row in rows:
        frequencies[row["bucket"]] = row["n"]
    languages = training.groupBy("lang").count().orderBy("lang").collect()
    return frequencies, {row["lang"]: row["count"] for row in languages}


def _weighed_texts(texts: list, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Normalised TF-IDF rows of the texts that have a letter, and which texts have one."""
    found, has = [], []
    for low in range(0, len(texts), AT_ONCE):
        raw = counts(texts[low : low + AT_ONCE], len(idf)).astype(np.float32)
        some = raw.any(axis=1)
        found.append(raw[some])
        has.append(some)
    raw = np.concatenate(found) if found else np.zeros((0, len(idf)), np.float32)
    return weighed(raw, idf), np.concatenate(has) if has else np.zeros(0, bool)


_SUMS = pa.schema([("lang", pa.string()), ("part", pa.int32()), ("i", pa.int32()), ("n", pa.int64()), ("sum", pa.binary())])
_LEAST = pa.schema([("lang", pa.string()), ("part", pa.int32()), ("value", pa.float64()), ("text", pa.string())])
_CUTS = pa.schema([("lang", pa.string()), ("cut", pa.int32()), ("size", pa.float64()), ("cosine", pa.float64())])
#: Texts of a language that are turned into vectors at once.
CHUNK = 1024


def _by_key(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[str]]]:
    """Texts of each (lang, part) in each batch."""
    for batch in batches:
        frame = batch.to_pandas()
        for key, rows in frame.groupby(["lang", "part"], sort=False):
            yield key, list(rows["text"])


def _vectors_by_key(batches: Iterator[pa.RecordBatch], idf: np.ndarray) -> Iterator[tuple[tuple, np.ndarray, list]]:
    """Vectors and texts of each (lang, part) in each batch of rows (lang, part, text), a chunk at a
    time: each text is counted once, for its language as a whole (part -1) and for its half."""
    for batch in batches:
        frame = batch.to_pandas()
        for lang, rows in frame.groupby("lang", sort=False):
            texts, halves = list(rows["text"]), rows["part"].to_numpy()
            for low in range(0, len(texts), CHUNK):
                vectors, has = _weighed_texts(texts[low : low + CHUNK], idf)
                kept = [text for text, ok in zip(texts[low : low + CHUNK], has) if ok]
                half = halves[low : low + CHUNK][has]
                yield (lang, -1), vectors, kept
                for part in (0, 1):
                    chosen = half == part
                    yield (lang, part), vectors[chosen], [text for text, ok in zip(kept, chosen) if ok]


def _summed(rows: DataFrame, step, buckets: int) -> dict[tuple, tuple[int, np.ndarray]]:
    """Sums that tasks give per (lang, part, centroid), added up by key."""

    def add(key: tuple, found: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(buckets)
        for raw in found["sum"]:
            total += np.frombuffer(raw, "<f8")
        return pd.DataFrame({"lang": [key[0]], "part": [key[1]], "i": [key[2]], "n": [int(found["n"].sum())],
                             "sum": [total.tobytes()]})

    schema = "lang string, part int, i int, n long, sum binary"
    partial = rows.mapInArrow(step, schema)
    done = partial.groupBy("lang", "part", "i").applyInPandas(add, schema).collect()
    return {(row["lang"], row["part"], row["i"]): (row["n"], np.frombuffer(row["sum"], "<f8")) for row in done}


def _task_sums(totals: dict[tuple, list]) -> Iterator[pa.RecordBatch]:
    """A task's sums per (lang, part, centroid), one row each."""
    found = [{"lang": lang, "part": part, "i": i, "n": n, "sum": total.tobytes()}
             for (lang, part, i), (n, total) in totals.items()]
    if found:
        yield pa.RecordBatch.from_pylist(found, _SUMS)


def _clustered(rows: DataFrame, idf: np.ndarray, k: int, rounds: int = ROUNDS) -> dict[tuple, np.ndarray]:
    """``cluster`` per (lang, part) over all rows (lang, part, text), part being a text's half, as
    Spark jobs: sums of vectors per centroid are added up over the tasks, the farthest vector is the
    least of the tasks' least. Each language as a whole is part -1."""
    buckets = len(idf)

    def means(batches):
        totals = {}
        for key, vectors, _ in _vectors_by_key(batches, idf):
            if len(vectors):
                n, total = totals.setdefault((*key, 0), [0, np.zeros(buckets)])
                totals[(*key, 0)] = [n + len(vectors), total + vectors.sum(axis=0, dtype=np.float64)]
        yield from _task_sums(totals)

    sums = _summed(rows, means, buckets)
    sizes = {key[:2]: n for key, (n, _) in sums.items()}
    centroids = {key[:2]: (total / n)[None, :] for key, (n, total) in sums.items()}
    for _ in range(1, k):
        growing = {key: value for key, value in centroids.items() if len(value) < min(k, sizes[key])}
        if not growing:
            break

        def farthest(batches, growing=growing):
            least = {}
            for key, vectors, kept in _vectors_by_key(batches, idf):
                if key in growing and len(vectors):
                    nearest = (vectors @ growing[key].T).max(axis=1)
                    value = nearest.min()
                    text = min(t for t, v in zip(kept, nearest) if v == value)
                    least[key] = min(least.get(key, (np.inf, "")), (float(value), text))
            found = [{"lang": lang, "part": part, "value": value, "text": text}
                     for (lang, part), (value, text) in least.items()]
            if found:
                yield pa.RecordBatch.from_pylist(found, _LEAST)

        least = rows.mapInArrow(farthest, "lang string, part int, value double, text string")
        least = least.groupBy("lang", "part").agg(F.min(F.struct("value", "text")).alias("m")).collect()
        for row in least:
            vector, _ = _weighed_texts([row["m"]["text"]], idf)
            key = (row["lang"], row["part"])
            centroids[key] = np.vstack([centroids[key], vector])
    for _ in range(rounds):
        centroids = {
            key: value / np.where((norm := np.linalg.norm(value, axis=1, keepdims=True)) > 0, norm, 1)
            for key, value in centroids.items()
        }

        def assigned(batches, current=centroids):
            totals = {}
            for key, vectors, _ in _vectors_by_key(batches, idf):
                if not len(vectors) or key not in current:
                    continue
                owner = (vectors @ current[key].T).argmax(axis=1)
                for i in np.unique(owner):
                    chosen = vectors[owner == i]
                    n, total = totals.get((*key, int(i)), (0, 0.0))
                    totals[(*key, int(i))] = (n + len(chosen), total + chosen.sum(axis=0, dtype=np.float64))
            yield from _task_sums(totals)

        sums = _summed(rows, assigned, buckets)
        for (lang, part, i), (n, total) in sums.items():
            centroids[(lang, part)][i] = total / n
    return {
        key: value / np.maximum(np.linalg.norm(value, axis=1, keepdims=True), 1e-12)
        for key, value in centroids.items()
    }


def _floors(rows: DataFrame, idf: np.ndarray, centroids: dict[tuple, np.ndarray]) -> dict[str, np.ndarray]:
    """``floors`` per language over all its rows: beginnings of each half's texts against the other
    half's centroids; medians and quantiles exact, by Spark's percentile per language and cut."""

    def measured_cuts(batches):
        for key, texts in _by_key(batches):
            lang, part = key[0], int(key[1])
            other = centroids.get((lang, 1 - part))
            if part < 0 or other is None:
                continue
            found = []
            for cut in CUTS:
                long = [text[:cut] for text in texts if len(text) >= cut]
                for low in range(0, len(long), AT_ONCE):
                    raw = measured(long[low : low + AT_ONCE], len(idf))
                    cosines = (weighed(raw, idf) @ other.T).max(axis=1)
                    found += [
                        {"lang": lang, "cut": cut, "size": float(a), "cosine": float(b)}
                        for a, b in zip(raw.sum(axis=1), cosines)
                    ]
            if found:
                yield pa.RecordBatch.from_pylist(found, _CUTS)

    found = rows.mapInArrow(measured_cuts, "lang string, cut int, size double, cosine double")
    found = found.groupBy("lang", "cut").agg(
        F.count("*").alias("n"),
        F.percentile("size", F.lit(0.5)).alias("size"),
        F.percentile("cosine", F.lit(QUANTILE)).alias("cosine"),
    )
    # a row per language and cut
    at = {}
    for row in found.collect():
        at.setdefault(row["lang"], {})[row["cut"]] = row
    least = {}
    for lang in {key[0] for key in centroids}:
        points = [(0.0, 0.0)]
        for cut in CUTS:
            row = at.get(lang, {}).get(cut)
            if row is None or row["n"] < LEAST:
                continue
            if row["size"] > points[-1][0]:
                points.append((row["size"], MARGIN * row["cosine"]))
        least[lang] = np.array(points).T
    return least


def fit(labelled: DataFrame, buckets: int = BUCKETS, sample: int = SAMPLE, k: int = CENTROIDS) -> Model:
    """Learn from rows (doc_id, text, lang); rows without language are left out. Centroids and
    floors come from every training row; ``sample`` is kept for callers and plays no part."""
    training = labelled.where(F.col("lang").isNotNull()).select(
        F.col("doc_id").cast("string").alias("doc_id"), "text", "lang"
    )
    frequencies, sizes = _document_frequencies(training, buckets)
    idf = np.log((1 + sum(sizes.values())) / (1 + frequencies)) + 1
    weights = idf.astype(np.float32)
    # each text once, with its half by hash; the steps take it for its language as a whole too
    half = F.pmod(F.xxhash64("doc_id", "text"), F.lit(2)).cast("int")
    rows = training.where(F.col("text").isNotNull()).select("lang", half.alias("part"), "text")
    rows = landed(rows, "language_fit")
    centroids = _clustered(rows, weights, k)
    least = _floors(rows, weights, centroids)
    found = sorted(
        (lang, row.tobytes(), row) for (lang, part), value in centroids.items() if part < 0 for row in value
    )
    return Model(
        [lang for lang, _, _ in found],
        np.array([row for _, _, row in found]).reshape(len(found), buckets),
        idf,
        [least[lang] for lang, _, _ in found],
    )


def predicted(text: Column, model: Model) -> Column:
    """A struct (lang_pred, score, rejected) for each text."""

    @F.pandas_udf(RESULT)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            values = list(texts)
            names, scores, rejects = [], [], []
            for low in range(0, len(values), AT_ONCE):
                some = model.predict(values[low : low + AT_ONCE])
                names += some[0]
                scores.append(some[1])
                rejects.append(some[2])
            yield pd.DataFrame(
                {
                    "lang_pred": names,
                    "score": np.concatenate(scores) if scores else np.zeros(0),
                    "rejected": np.concatenate(rejects) if rejects else np.zeros(0, bool),
                }
            )

    return run(text)


def _model(docs: DataFrame, doc_id: str, text: str, lang: str) -> Model:
    columns = [(doc_id, "doc_id"), (text, "text"), (lang, "lang")]
    rows = docs.select(*[F.col(name).alias(alias) for name, alias in columns])
    return fit(rows.where(~is_held_out(F.col("doc_id"), 3, 1)))


def identify(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang"
) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, rejected."""
    model = _model(docs, doc_id, text, lang)
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        is_held_out(F.col(doc_id), 3, 1).alias("held_out"),
        predicted(F.col(text), model).alias("_found"),
    ).select("doc_id", "held_out", "_found.*")


def accepted(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang"
) -> DataFrame:
    """The documents that are not rejected, with all their columns."""
    model = _model(docs, doc_id, text, lang)
    found = whole(docs).withColumn("_found", predicted(F.col(f"doc.`{text}`"), model))
    return found.where(~F.col("_found.rejected")).select("doc.*")
