"""Secrets in texts: fixed patterns, and strings that look drawn at random (DataFrame functions only).

The patterns give the base spans. Beside them, each token of 16 characters or more is scored by two
Markov models of its characters, one of random strings and one of ordinary identifiers: the sum of
the log-likelihood ratios of its transitions over the stretch where that sum is largest, so that
ordinary text joined to a key does not dilute it, and a path around a key is not taken for one. The
ends of the stretch are moved to separators beside them. UUIDs, stretches without a letter and
stretches below 16 characters are never random.

The models are counted from labelled samples. Random strings: the values of base spans, and digests
of the sampled documents in the usual alphabets of keys. Ordinary ones, two models of equal weight:
of words outside any base span that occur in two documents, and of identifiers, constants, paths and
dated names made of a document's words; and, as a corpus may hold no code, of names in Python's
standard library, by themselves and joined likewise. A fifth of the sampled texts is held out; on their tokens the threshold is set as the least
sum that no more than ``FALSE`` of the ordinary ones reach. The sample is bounded, ``SAMPLE``
documents or few more, chosen by a hash; the models are tables of fixed size. All else covers every
whole text. Of two random stretches in one token the likelier is listed.

Spans are counted in code points, the end is exclusive. The places of matches come from the
lengths of the stretches between them, which splitting by the same pattern gives.

Defined results: a null text counts as empty and has no span; without ordinary tokens held out the
threshold is ``EVIDENCE``; repeated rows get the same result; an empty table gives an empty
result. Columns beyond doc_id and text play no part and may have any name.
"""

from __future__ import annotations

import builtins
import errno
import http
import importlib
import keyword
import math
import re
import sys
from collections import Counter, defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settled


@dataclass(frozen=True)
class Kind:
    """A kind of span: its pattern, and the group that must have so many characters."""

    name: str
    pattern: str
    group: int
    least: int


# fixed values
ASSIGN = Kind(
    "assign",
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    2,
    6,
)
ACCESS = Kind("access", r"AKIA[A-Z0-9]+", 0, 20)
HEX = Kind("hex", r"[0-9a-f]+", 0, 24)
#: In the order in which spans with the same start are listed.
BASE = (ASSIGN, ACCESS, HEX)
#: Runs too short to pass are not worth a match: same result, since these runs are maximal.
QUICK = {"access": r"AKIA[A-Z0-9]{16,}", "hex": r"[0-9a-f]{24,}"}

#: Characters of the models, and the tokens that are scored.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
TOKEN = Kind("markov", r"[A-Za-z0-9+/_-]{16,}={0,2}", 0, 16)
#: Ordinary identifiers of the sample, and prose words of which others are made.
WORD = r"[A-Za-z][A-Za-z0-9_-]{4,}"
PROSE = r"(?<![A-Za-z0-9+/_=-])[A-Z]?[a-z]{2,15}(?![A-Za-z0-9+/_=-])"
UUID = r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}"
#: Documents of the sample (the expected number); one in ``HELD`` texts is held out.
SAMPLE = 4_000
HELD = 5
#: Share of held-out ordinary tokens that may count as random.
FALSE = 0.0001
#: Least sum of log-likelihood ratios of a random stretch, whatever the sample.
EVIDENCE = 10.0
#: Added to each count, so that a few strings in the wrong class do not decide.
PRIOR = 4.0

EMPTY = "array<struct<start:bigint,kind:int,end:bigint>>"


def spans(text: Column, kind: Kind, number: int) -> Column:
    """The matches of a kind that pass, as structs (start, kind, end)."""
    pattern = QUICK.get(kind.name, kind.pattern)
    between = F.transform(F.split(text, pattern, -1), lambda x: F.length(x).cast("long"))
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    checked = F.regexp_extract_all(text, F.lit(pattern), F.lit(kind.group))
    matches = F.arrays_zip(
        between.alias("gap"),
        F.transform(whole, lambda x: F.length(x).cast("long")).alias("size"),
        F.transform(checked, F.length).alias("tested"),
    )
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(EMPTY).alias("found"))

    def step(seen: Column, match: Column) -> Column:
        begin = seen["at"] + match["gap"]
        end = begin + F.coalesce(match["size"], F.lit(0))
        span = F.struct(begin.alias("start"), F.lit(number).alias("kind"), end.alias("end"))
        passed = F.coalesce(match["tested"] >= kind.least, F.lit(False))
        found = F.when(passed, F.concat(seen["found"], F.array(span))).otherwise(seen["found"])
        return F.struct(end.alias("at"), found.alias("found"))

    walked = F.aggregate(matches, start, step, lambda seen: seen["found"])
    return F.when(F.regexp_like(text, F.lit(pattern)), walked).otherwise(F.array().cast(EMPTY))


def with_base(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, text, assign, access, hex (arrays of spans)."""
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    return rows.select("*", *[spans(F.col("text"), k, i).alias(k.name) for i, k in enumerate(BASE)])


@dataclass(frozen=True)
class Model:
    """Log-likelihood ratio of each transition, by place of first and second character; the sum from
    which a stretch is random; shares of held-out random tokens missed and ordinary ones found."""

    ratios: list[float]
    threshold: float
    missed: float
    false: float


def drawn(seed: Column) -> Column:
    """Digests of a string in the usual alphabets of keys."""
    sha = F.sha2(seed, 256)
    key = F.translate(F.base64(F.unhex(sha)), "=", "")
    plain = F.translate(key, "+/", "")
    return F.array(key, F.translate(key, "+/", "-_"), plain, F.upper(plain), F.lower(plain), sha)


def composed(words: Column) -> Column:
    """Each three words in a row as an identifier, constant, path or dated name, in turn."""

    def named(i: Column) -> Column:
        a, b, c = (F.element_at(words, 3 * i + k) for k in (1, 2, 3))
        number = F.crc32(F.concat(a, b).cast("binary"))
        low, high = F.lower(b), F.initcap(b)
        day = F.concat_ws(
            "-",
            (number % 100 + 1970).cast("string"),
            F.lpad((number % 12 + 1).cast("string"), 2, "0"),
            F.lpad((number % 28 + 1).cast("string"), 2, "0"),
        )
        forms = [
            F.concat_ws("_", F.lower(a), low, F.lower(c)),
            F.concat_ws("_", F.upper(a), F.upper(b), F.upper(c)),
            F.concat(F.lower(a), high, F.initcap(c)),
            F.concat_ws("/", F.lower(a), low, F.lower(c)),
            F.concat_ws("-", F.lower(a), low, (number % 1000).cast("string")),
            F.concat_ws("/", a, day, F.concat_ws("_", low, F.lower(c))),
            F.concat(F.initcap(a), high, (number % 100).cast("string")),
            F.concat_ws("-", day, day, low),
        ]
        return F.element_at(F.array(*forms), (i % len(forms) + 1).cast("int"))

    triples = F.floor(F.size(words) / 3).cast("int")
    some = F.transform(F.sequence(F.lit(0), triples - 1), named)
    return F.when(triples > 0, some).otherwise(F.array().cast("array<string>"))


def labelled(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE
) -> DataFrame:
    """The labelled tokens of the sample, each once: random, token, held (in held-out texts only)."""
    share = min(1.0, sample / max(1, docs.count()))
    draw = F.pmod(F.xxhash64(F.col(doc_id), F.col(text)), F.lit(1 << 20)) / (1 << 20)
    chosen = with_base(docs.where(draw < share), doc_id, text)

    def values(kind: Kind) -> Column:
        found = F.regexp_extract_all("text", F.lit(kind.pattern), F.lit(kind.group))
        some = F.filter(found, lambda x: F.length(x) >= kind.least)
        return F.when(F.size(kind.name) > 0, some).otherwise(F.array().cast("array<string>"))

    rest = F.col("text")
    for kind in BASE:
        gone = F.regexp_replace(rest, QUICK.get(kind.name, kind.pattern), " ")
        rest = F.when(F.size(kind.name) > 0, gone).otherwise(rest)
    found = chosen.select("*", rest.alias("rest")).select(
        (F.crc32(F.col("text").cast("binary")) % HELD == 0).alias("held"),
        F.concat(*[values(k) for k in BASE]).alias("values"),
        drawn(F.col("text")).alias("drawn"),
        F.array_distinct(F.regexp_extract_all("rest", F.lit(WORD), F.lit(0))).alias("words"),
        F.regexp_extract_all("rest", F.lit(PROSE), F.lit(0)).alias("prose"),
    )
    # a word counts as ordinary from two documents on, what has been made of words at once
    sides = [
        (True, "values", 1),
        (True, "drawn", 1),
        (False, "words", 2),
        (False, composed(F.col("prose")), 1),
    ]
    side = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(random).alias("random"),
                    F.lit(least).alias("least"),
                    (F.col(tokens) if isinstance(tokens, str) else tokens).alias("tokens"),
                )
                for random, tokens, least in sides
            ]
        )
    )
    return (
        found.select("held", side.alias("side"))
        .select("held", "side.random", "side.least", F.explode("side.tokens").alias("token"))
        .groupBy("random", "token")
        .agg(F.min("held").alias("held"), F.count("*").alias("n"), F.min("least").alias("least"))
        .where("n >= least")
        .select("random", "token", "held")
    )


def train(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE
) -> Model:
    """The two models, as ratios of their transitions, and the threshold that goes with them."""
    tokens = settled(labelled(docs, doc_id, text, sample))
    letters = F.split("token", "")
    pairs = F.zip_with(
        letters, F.slice(letters, 2, F.size(letters)), lambda a, b: F.concat(a, b)
    )
    # at most two rows per pair of characters
    rows = (
        tokens.where("not held")
        .select("random", F.explode(pairs).alias("pair"))
        .where("pair is not null")
        .groupBy("random", "pair")
        .count()
        .collect()
    )
    table = ratios({(row["random"], row["pair"]): row["count"] for row in rows})
    # sums beyond 100 are one row
    long = tokens.where(F.col("held") & (F.length("token") >= TOKEN.least))
    score = F.least(F.floor(stretch(F.col("token"), table)["score"]), F.lit(100))
    sums = long.groupBy("random", score.alias("score")).count().collect()
    reached = {
        side: [sum(r["count"] for r in sums if r["random"] == side and r["score"] >= t) for t in range(101)]
        for side in (True, False)
    }
    plain, secret = reached[False], reached[True]
    bound = next((t for t in range(101) if plain[t] <= FALSE * plain[0]), 100)
    bound = max(int(EVIDENCE), bound)
    return Model(
        table, float(bound), 1 - secret[bound] / max(1, secret[0]), plain[bound] / max(1, plain[0])
    )


def names() -> list[str]:
    """Ordinary names: those of Python's modules, built-in objects and a few common modules, by
    themselves, and their words joined as constants, paths and identifiers."""
    modules = ("os", "socket", "logging", "subprocess", "threading", "inspect", "json", "string", "tarfile")
    found = {*sys.stdlib_module_names, *keyword.kwlist, *dir(builtins), *errno.errorcode.values()}
    found |= {status.name for status in http.HTTPStatus}
    for name in modules:
        module = importlib.import_module(name)
        found.update(dir(module))
        for value in vars(module).values():
            if isinstance(value, type):
                found.update(dir(value))
    alone = sorted(found)
    words = sorted({w for name in alone for w in re.findall("[A-Z]?[a-z]{2,}|[A-Z]{3,}", name)}, key=str.lower)
    joined = []
    for i, word in enumerate(words):
        other, third = (words[(i * step + 1) % len(words)] for step in (7, 31))
        for sign in "_/-":
            joined.append(sign.join((word, other, third)).lower())
        joined.append("_".join((word, other, third)).upper())
        joined.append(word.lower() + other.capitalize() + third.capitalize())
    return alone + joined


def named_counts() -> Counter[str]:
    """How often each pair of characters comes in ``names``."""
    return Counter(a + b for name in names() for a, b in zip(name, name[1:]))


def ratios(counts: dict[tuple[bool, str], int]) -> list[float]:
    """Log-likelihood ratios from the counts of (random, pair of characters) in the sample, and
    those of the names."""
    random = _chances({pair: n for (side, pair), n in counts.items() if side})
    found = _chances({pair: n for (side, pair), n in counts.items() if not side})
    known = _chances(named_counts())
    pairs = [a + b for a in ALPHABET for b in ALPHABET]
    return [math.log(random[ab]) - math.log((found[ab] + known[ab]) / 2) for ab in pairs]


def _chances(counts: dict[str, int]) -> dict[str, float]:
    """The chance of each pair's second character after its first."""
    first: dict[str, float] = defaultdict(float)
    second: dict[str, float] = defaultdict(float)
    for pair, n in counts.items():
        if pair[0] in ALPHABET and pair[1] in ALPHABET:
            first[pair[0]] += n
            second[pair[1]] += n
    total, size = sum(second.values()), len(ALPHABET)

    def chance(a: str, b: str) -> float:
        # transitions seldom seen lean on how often their second character comes at all
        alone = (second[b] + PRIOR) / (total + PRIOR * size)
        return (counts.get(a + b, 0) + PRIOR * size * alone) / (first[a] + PRIOR * size)

    return {a + b: chance(a, b) for a in ALPHABET for b in ALPHABET}


def stretch(token: Column, table: list[float]) -> Column:
    """The stretch of a token over which the ratios of its transitions have the largest sum, as a
    struct (score, first, last): that sum, and the places of its characters from 0, the last
    exclusive. Nothing runs through a UUID."""
    # one constant: an array of fixed length
    values = F.split(F.lit(",".join(repr(value) for value in table)), ",").cast("array<double>")
    plain = F.regexp_replace(token, UUID, " " * 36)
    places = F.transform(F.split(plain, ""), lambda x: F.instr(F.lit(ALPHABET), x))
    steps = F.zip_with(
        places,
        F.slice(places, 2, F.size(places)),
        lambda a, b: F.when(
            (a > 0) & (b > 0), F.element_at(values, (a - 1) * len(ALPHABET) + b)
        ),
    )

    def state(at, total, begin, score, first, last) -> Column:
        names = ("at", "total", "begin", "score", "first", "last")
        return F.struct(*[x.alias(n) for x, n in zip((at, total, begin, score, first, last), names)])

    def step(seen: Column, ratio: Column) -> Column:
        at = seen["at"]
        fresh = seen["total"] <= 0
        # a transition outside the alphabet ends the stretch; the last place has none
        total = F.coalesce(F.when(fresh, ratio).otherwise(seen["total"] + ratio), F.lit(0.0))
        begin = F.when(fresh, at).otherwise(seen["begin"])
        better = total > seen["score"]
        return state(
            at + 1,
            total,
            begin,
            F.when(better, total).otherwise(seen["score"]),
            F.when(better, begin).otherwise(seen["first"]),
            F.when(better, at + 2).otherwise(seen["last"]),
        )

    nil = F.lit(0).cast("int")
    return F.aggregate(
        steps,
        state(nil, F.lit(0.0), nil, F.lit(0.0), nil, nil),
        step,
        lambda seen: F.struct(seen["score"].alias("score"), seen["first"].alias("first"), seen["last"].alias("last")),
    )


def random_spans(text: Column, tokens: Column, model: Model, number: int) -> Column:
    """Of each token (a span of the text) the stretch that is random, its ends moved to the nearer
    separators, as spans of the given kind."""

    def scored(token: Column) -> Column:
        size = (token["end"] - token["start"]).cast("int")
        word = F.substring(text, (token["start"] + 1).cast("int"), size)
        return F.struct(
            token["start"].alias("start"), word.alias("word"), stretch(word, model.ratios).alias("best")
        )

    def random(found: Column) -> Column:
        best = found["best"]
        inside = F.substring(found["word"], best["first"] + 1, best["last"] - best["first"])
        return (best["score"] >= model.threshold) & F.regexp_like(inside, F.lit("[A-Za-z]"))

    def placed(found: Column) -> Column:
        best, word = found["best"], found["word"]
        inside = F.substring(word, best["first"] + 1, best["last"] - best["first"])
        rest = F.substring(word, best["last"] + 1, F.length(word))

        def run(part: Column, pattern: str) -> Column:
            return F.length(F.regexp_extract(part, pattern, 0))

        # a part between separators is the stretch's if no more of it lies outside than inside
        before = run(F.substring(word, F.lit(1), best["first"]), "[A-Za-z0-9]*$")
        head = run(inside, "^[A-Za-z0-9]*")
        after = run(rest, "^[A-Za-z0-9]*")
        tail = run(inside, "[A-Za-z0-9]*$")
        padding = run(rest, "^[A-Za-z0-9]*={0,2}$") - run(rest, "^[A-Za-z0-9]*(?==*$)")
        first = F.when(before > head, best["first"] + head + 1).otherwise(best["first"] - before)
        last = F.when(after > tail, best["last"] - tail - 1).otherwise(best["last"] + after + padding)
        return F.struct(
            (found["start"] + first).alias("start"),
            F.lit(number).alias("kind"),
            (found["start"] + last).alias("end"),
        )

    spans = F.transform(F.filter(F.transform(tokens, scored), random), placed)
    return F.filter(spans, lambda x: x["end"] - x["start"] >= TOKEN.least)


def scan(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    model: Model | None = None,
    sample: int = SAMPLE,
) -> DataFrame:
    """One row per document: doc_id and ``found``, its spans (start, kind, end) by start and kind,
    kind being the place in ``KINDS``; and ``base``, those of the fixed patterns. ``model`` is one
    that ``train`` gave; without it one is trained on these documents."""
    model = model or train(docs, doc_id, text, sample)
    rows = with_base(docs, doc_id, text)
    rows = rows.withColumn("base", F.array_sort(F.concat(*[kind.name for kind in BASE])))
    tokens = rows.withColumn("tokens", spans(F.col("text"), TOKEN, len(BASE)))

    def apart(token: Column) -> Column:
        return ~F.exists("base", lambda x: (x["start"] < token["end"]) & (token["start"] < x["end"]))

    found = random_spans(F.col("text"), F.col("tokens"), model, len(BASE))
    added = F.filter(found, apart)
    return tokens.select(
        "doc_id",
        *[kind.name for kind in BASE],
        "base",
        F.array_sort(F.concat("base", added)).alias("found"),
    )


KINDS = tuple(kind.name for kind in (*BASE, TOKEN))


def listed(found: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    names = F.array(*[F.lit(name) for name in KINDS])
    return F.array_join(
        F.transform(
            found,
            lambda x: F.concat_ws(
                ":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string")
            ),
        ),
        ",",
    )


def digest(docs: DataFrame, **how) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    return scan(docs, **how).select(
        "doc_id",
        *[F.size(kind.name).cast("long").alias(f"n_{kind.name}") for kind in BASE],
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.col("found")).alias("spans"),
    )
