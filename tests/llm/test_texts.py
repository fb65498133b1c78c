"""Language, toxicity, licences and secrets."""

import base64
import collections
import hashlib
import math
import random
import re
import zlib
from pathlib import Path

import numpy as np
import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tideline.llm import language, licences, secrets, toxicity

SYLLABLES = {
    "en": ["the", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha"],
    "de": ["der", "ein", "sch", "ich", "ung", "keit", "ver", "zu", "ü", "ß"],
    "fr": ["le", "que", "eux", "ou", "ai", "é", "è", "tion", "ç", "aux"],
}


TABLES = Path("/root/testdata/sf0.01")


def prose(draw, lang, words):
    return " ".join(
        "".join(draw.choices(SYLLABLES[lang], k=draw.randrange(1, 4))) for _ in range(words)
    )


def crc(doc_id):
    return zlib.crc32(str(doc_id).encode())


@pytest.fixture(scope="module")
def tongues(spark):
    draw = random.Random(1)
    rows = [
        (i, prose(draw, lang, draw.randrange(3, 80)), lang)
        for i in range(600)
        for lang in [draw.choice(list(SYLLABLES))]
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)


def test_language_on_held_out_documents(tongues):
    found = language.identify(tongues).join(tongues, "doc_id").collect()
    assert len(found) == 600
    for row in found:
        assert row.held_out == (crc(row.doc_id) % 3 == 1)
        assert 0 <= row.score <= 1 and not row.rejected
    held = [row for row in found if row.held_out]
    assert np.mean([row.lang_pred == row.lang for row in held]) > 0.97


def test_language_sees_neither_labels_nor_ids(tongues):
    """Held-out labels may be anything."""
    held = language.is_held_out(F.col("doc_id"), 3, 1)
    wrong = tongues.withColumn("lang", F.when(held, F.lit("zz")).otherwise(F.col("lang")))
    assert rows_of(language.identify(tongues)) == rows_of(language.identify(wrong))


def test_language_of_odd_rows(docs, nothing):
    found = language.identify(docs).join(docs.select("doc_id", "text"), "doc_id").collect()
    for row in found:
        if not any(sign.isalpha() for sign in row.text or ""):
            assert (row.lang_pred, row.score, row.rejected) == ("und", 0.0, True)
        else:
            assert row.lang_pred in ("en", "de", "fr")
    kept = language.accepted(docs)
    assert kept.columns == docs.columns
    letters = [r for r in docs.collect() if any(sign.isalpha() for sign in r.text or "")]
    assert kept.count() == len(letters)
    assert language.identify(nothing).count() == 0
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {row.lang_pred for row in language.identify(unlabelled).collect()} == {"und"}


def test_language_rejects_what_is_far(tongues):
    model = language.fit(tongues)
    names, scores, rejected = model.predict(["漢字 仮名 文字", "the oner and", "", None, "123"])
    assert rejected.tolist() == [True, False, True, True, True]
    assert names[2:] == ["und"] * 3 and scores[2:].tolist() == [0, 0, 0]


FOREIGN = [
    "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu "
    "järki ja omatunto, ja heidän on toimittava toisiaan kohtaan veljeyden hengessä.",
    "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana sahiptirler ve "
    "birbirlerine karşı kardeşlik zihniyeti ile hareket etmelidirler.",
    "Minden emberi lény szabadon születik és egyenlő méltósága és joga van. Az emberek, ésszel és "
    "lelkiismerettel bírván, egymással szemben testvéri szellemben kell hogy viseltessenek.",
]


def far_texts(draw):
    binary = [base64.b64encode(draw.randbytes(n)).decode() for n in (300, 1500, 6000)]
    return [*FOREIGN, *(text * 4 for text in FOREIGN), *binary]


def test_language_rejects_foreign_latin_script_and_base64(tongues):
    """Texts of any length in a known language stay."""
    draw = random.Random(5)
    model = language.fit(tongues)
    assert model.predict(far_texts(draw))[2].all()
    lengths = (1, 2, 3, 5, 10, 40, 200, 2000)
    clean = [prose(draw, lang, n) for lang in SYLLABLES for n in lengths for _ in range(20)]
    assert model.predict(clean)[2].mean() < 0.01


@pytest.mark.skipif(not TABLES.exists(), reason="no test tables here")
def test_language_floors_on_the_test_tables(spark):
    """Odd training texts, which these tables have, do not let others through."""
    docs = spark.read.parquet(str(TABLES / "documents.parquet"))
    held = language.is_held_out(F.col("doc_id"), 3, 1)
    model = language.fit(docs.where(~held))
    _, scores, rejected = model.predict(far_texts(random.Random(5)))
    assert rejected.all(), scores
    clean = [row.text for row in docs.where(held & F.col("lang").isNotNull()).collect()]
    clean = [text for text in clean if any(sign.isalpha() for sign in text or "")]
    assert len(clean) > 250 and model.predict(clean)[2].mean() < 0.02


def test_language_fit_counts_each_text_once():
    """A text is read once per pass, for its language as a whole (part -1) and for its half."""
    import pyarrow as pa

    texts = ["the one", "der ein", "", "le que", "then he", "1 2"]
    batch = pa.RecordBatch.from_pydict(
        {"lang": ["en", "de", "en", "fr", "en", "en"], "part": [0, 1, 1, 0, 1, 0], "text": texts}
    )
    idf = np.ones(language.BUCKETS, np.float32)
    found = {key: kept for key, _, kept in language._vectors_by_key(iter([batch]), idf)}
    assert found[("en", -1)] == ["the one", "then he"]
    assert found[("en", 0)] == ["the one"] and found[("en", 1)] == ["then he"]
    assert found[("de", -1)] == found[("de", 1)] == ["der ein"] and found[("de", 0)] == []


def test_counts_by_hand():
    texts = ["Ab c", "", None, "a1", "ÉTÉ"]
    raw = language.counts(texts)
    # bigrams with a boundary on either side, and trigrams around each letter of two or more
    assert raw.sum(axis=1).tolist() == [5 + 2, 0, 0, 2, 4 + 3]
    assert (language.counts(["xx", "Ab c"])[1] == raw[0]).all()


@pytest.fixture(scope="module")
def insults(spark):
    draw = random.Random(2)
    docs, labels = [], []
    for i in range(900):
        words = prose(draw, "en", draw.randrange(5, 60)).split()
        toxic = draw.random() < 0.15
        if toxic:
            for _ in range(draw.randrange(1, 4)):
                words.insert(draw.randrange(len(words)), draw.choice(["moron", "scum", "zorgface"]))
        docs.append((i, " ".join(words)))
        if draw.random() < 0.5:
            labels.append((i, int(toxic) if draw.random() < 0.97 else 1 - int(toxic)))
    return (
        spark.createDataFrame(docs, "doc_id long, text string").repartition(4),
        spark.createDataFrame(labels, "doc_id long, toxic int"),
        {i for i, text in docs if re.search("moron|scum|zorgface", text)},
    )


def test_toxicity_on_held_out_documents(insults):
    docs, labels, toxic = insults
    found = toxicity.toxicity(docs, labels).collect()
    assert len(found) == 900
    wrong = 0
    for row in found:
        assert row.held_out == (crc(row.doc_id) % 5 == 0)
        assert 0 <= row.score <= 1 and row.predicted == int(row.score >= 0.5)
        wrong += row.held_out and row.predicted != int(row.doc_id in toxic)
    assert wrong <= 2


def test_toxicity_never_sees_held_out_labels(insults):
    docs, labels, _ = insults
    held = toxicity.is_held_out(F.col("doc_id"), 5, 0)
    wrong = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert rows_of(toxicity.toxicity(docs, labels)) == rows_of(toxicity.toxicity(docs, wrong))


def test_insults_that_the_sample_never_had(insults, spark):
    docs, labels, _ = insults
    model = toxicity.fit(docs, labels)
    scores = model.scores(["you are a worthless bastard", "the heron and the inn", "", None])
    assert scores[0] > 0.5 and (scores[1:] < 0.5).all()


def test_toxicity_of_odd_rows(docs, nothing):
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    found = toxicity.toxicity(docs, labels).collect()
    assert len(found) == docs.count() and all(0 <= row.score <= 1 for row in found)
    assert len({row.score for row in found if row.doc_id == 11}) == 1
    assert toxicity.toxicity(nothing, labels.limit(0)).count() == 0
    assert toxicity.toxicity(docs, labels.limit(0)).count() == len(found)


def test_label_model_finds_accuracies_and_copies():
    """Ten voters of different use, three of which are copies, and no label at all."""
    draw = np.random.default_rng(3)
    truth = draw.random(4000) < 0.3
    hit = np.array([0.9, 0.8, 0.7, 0.8, 0.6, 0.7, 0.3])
    false = np.array([0.02, 0.05, 0.1, 0.05, 0.02, 0.05, 0.3])
    fired = draw.random((4000, 7)) < np.where(truth[:, None], hit, false)
    fired = np.column_stack([fired, fired[:, [6]], fired[:, [6]]]).astype(float)
    seeds = np.array([True] * 6 + [False] * 3)
    posterior = toxicity.label_model(fired, np.full(4000, np.nan), seeds)
    assert ((posterior > 0.5) == truth).mean() > 0.97


def test_every_known_sentence_is_looked_up():
    for sentence in licences.SENTENCES:
        assert re.search(licences.HINT, sentence), sentence
    names = set(licences.SENTENCES.values())
    assert all(set(needed.split()) <= names for needed, _ in licences.RULES)


GPL3 = """
 # This program is free software: you can redistribute it and/or modify
 # it under the terms of the GNU General Public License as published by
 # the Free Software Foundation, either version 3 of the License, or
 # (at your option) any later version.
"""


def test_licences(texts, docs, nothing):
    pairs = [
        (1, "Prose.\nReleased under the MIT License.\nMore prose."),
        (2, GPL3),
        (3, "Licensed under CC BY-NC 4.0. Licensed under the Apache License, Version 2.0."),
        (4, "A licence of my own making.\nNothing else"),
        (5, "the permission to walk, and a copyrighted song"),
        (6, "Released under the MIT License. Released under the MIT License."),
        (7, "Redistribution and use in source and binary forms, with or without modification, are "
            "permitted provided that the following conditions are met:\n"
            "Redistributions of source code must retain the above copyright notice, this list of "
            "conditions and the following disclaimer.\nUnrelated."),
        (8, None),
    ]
    found = {row.doc_id: row for row in licences.scan(texts(pairs)).collect()}
    assert [found[i].licences for i in range(1, 9)] == [
        "MIT", "GPL-3.0-or-later", "Apache-2.0,CC-BY-NC-4.0", "", "", "MIT", "", "",
    ]
    assert found[4].n_unknown == 1 and found[4].identifiers == "unknown"
    assert found[5].n_sentences == 0 and found[6].n_sentences == 2
    assert found[7].identifiers == "bsd-redistribute bsd-source"
    assert licences.scan(docs).count() == docs.count()
    assert licences.scan(nothing).count() == 0


def test_wrapped_and_unwrapped_licences_in_one_text(texts):
    """Whether a sentence is wrapped is seen where it stands, not once per text."""
    line = "Licensed under the MIT License"
    mpl = " * This work is licensed under the GNU General\n * Public License, version 2.\n"
    pairs = [(1, f"{line}\n{GPL3}"), (2, f"{GPL3}\n{mpl}\n{line}\nand prose"), (3, f"Released under the ISC License\n{mpl}")]
    found = {row.doc_id: row for row in licences.scan(texts(pairs)).collect()}
    assert found[1].licences == "GPL-3.0-or-later,MIT"
    assert found[1].identifiers == "mit-grant free-software gpl3-redistribute"
    assert found[2].licences == "GPL-3.0-or-later,GPL-2.0,MIT"
    assert found[3].licences == "GPL-2.0,ISC"


GNU = """/* This library is free software; you can redistribute it and/or
 * modify it under the terms of the GNU {} General Public
 * License as published by the Free Software Foundation; either
 * version {} of the License, or (at your option) any later version.
 */"""

GRANTS = [
    ("// SPDX-License-Identifier: MIT\nint x;", "MIT"),
    ("# SPDX-License-Identifier: Apache-2.0", "Apache-2.0"),
    ("/* SPDX-License-Identifier: GPL-2.0-only */", "GPL-2.0"),
    ("; SPDX-License-Identifier: GPL-2.0+\n", "GPL-2.0-or-later"),
    ("<!-- SPDX-License-Identifier: LGPL-2.1-or-later -->", "LGPL-2.1-or-later"),
    ("// SPDX-License-Identifier: (MIT OR Apache-2.0)", "Apache-2.0,MIT"),
    ("// SPDX-License-Identifier: GPL-2.0-or-later WITH Classpath-exception-2.0", "GPL-2.0-or-later"),
    ("// SPDX-License-Identifier: LicenseRef-Mine", ""),
    ("This project is licensed under the MIT License - see the LICENSE file for details.", "MIT"),
    ("This project is not licensed under the MIT License.", ""),
    ("Licensed under either of Apache License, Version 2.0 or MIT license.", "Apache-2.0,MIT"),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0\nInternational License.",
     "CC-BY-SA-4.0"),
    (GNU.format("Lesser", "2.1"), "LGPL-2.1-or-later"),
    (GNU.format("Affero", "3"), "AGPL-3.0-or-later"),
    (GNU.format("Lesser", "3").replace("Foundation;", "Foundation,"), "LGPL-3.0-or-later"),
    ("This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy", "MPL-2.0"),
    ("Released under the GNU GPL v3 or later.", "GPL-3.0-or-later"),
]


def test_licence_marks_in_their_usual_form(texts):
    pairs = [(i, text) for i, (text, _) in enumerate(GRANTS)]
    found = {row.doc_id: row for row in licences.scan(texts(pairs)).collect()}
    got = [(text, ",".join(sorted(found[i].licences.split(",")))) for i, (text, _) in enumerate(GRANTS)]
    assert got == GRANTS
    assert found[7].n_unknown == found[9].n_unknown == 1
    for sentence in [*licences.MORE, *licences.NAMES]:
        assert re.search(licences.HINT, sentence), sentence
    names = set(licences._table().values())
    assert all(set(needed.split()) <= names for needed, _ in licences.MORE_RULES)


BSD3 = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this
list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this
list of conditions and the following disclaimer in the documentation and/or other
materials provided with the distribution.
3. Neither the name of Example Inc nor the names of its contributors may be used to
endorse or promote products derived from this software without specific prior
written permission.
"""


def test_a_notice_that_occurs_twice_in_a_row(texts):
    found = {row.doc_id: row for row in licences.scan(texts([(1, BSD3), (2, BSD3 * 3)])).collect()}
    assert found[1].licences == found[2].licences == "BSD-3-Clause"
    assert found[2].n_sentences == 3 * found[1].n_sentences == 12


PATTERNS = [
    ("assign", r"""((?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
]


def base_by_hand(text):
    found = []
    for number, (kind, pattern, group, least) in enumerate(PATTERNS):
        flags = re.IGNORECASE | re.ASCII if kind == "assign" else 0
        for match in re.finditer(pattern, text or "", flags):
            if len(match[group]) >= least:
                found.append((match.start(), number, match.end()))
    return sorted(found)


def test_base_spans(texts, docs, nothing):
    draw = random.Random(4)
    parts = [
        "token", "Secret", "API_KEY", "apikey", "passwd", "password", "=", ":", " ", '"', "'", "AKIA",
        "ABCDEFGH12345678", "deadbeef" * 3, "0123456789abcdef01234567", "abc", "é", "🙂", "x_y.z", "\n", "tok",
    ]
    pairs = [(i, "".join(draw.choices(parts, k=draw.randrange(0, 25)))) for i in range(600)]
    pairs += [(1000, "token=token: abcdefg"), (1001, "token=secret=abcdefgh token: abcde"), (1002, None)]
    pairs += [(1003, "AKIA" * 9 + " " + "f" * 23 + " " + "f" * 24), (1004, "ſecret = longenough ToKeN:longenough")]
    pairs += [(1005, "secret=" + "a1" * 30_000 + " " + "key " * 30_000)]
    want = dict(pairs)
    for row in secrets.digest(texts(pairs)).collect():
        spans = base_by_hand(want[row.doc_id])
        listed = ",".join(f"{PATTERNS[k][0]}:{a}:{b}" for a, k, b in spans)
        assert row.base_sha256 == hashlib.sha256(listed.encode()).hexdigest(), want[row.doc_id]
        assert [row.n_assign, row.n_access, row.n_hex] == [
            sum(k == number for _, k, _ in spans) for number in range(3)
        ]
        assert set(filter(None, listed.split(","))) <= set(row.spans.split(","))
    assert secrets.digest(docs).count() == docs.count()
    assert secrets.digest(nothing).count() == 0


SIGNS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
FORMS = [
    lambda a, b, c, n, day: f"{a}_{b}_{c}".lower(),
    lambda a, b, c, n, day: f"{a}_{b}_{c}".upper(),
    lambda a, b, c, n, day: a.lower() + b.capitalize() + c.capitalize(),
    lambda a, b, c, n, day: f"{a}/{b}/{c}".lower(),
    lambda a, b, c, n, day: f"{a}-{b}-{n % 1000}".lower(),
    lambda a, b, c, n, day: f"{a}/{day}/{b.lower()}_{c.lower()}",
    lambda a, b, c, n, day: a.capitalize() + b.capitalize() + str(n % 100),
    lambda a, b, c, n, day: f"{day}-{day}-{b.lower()}",
]


def secret_texts(draw):
    pairs = []
    for i in range(300):
        key = "".join(draw.choices(SIGNS, k=32))
        pairs.append((i, prose(draw, "en", 30) + f" token = {key} " + prose(draw, "en", 30)))
    return pairs


def labelled_by_hand(pairs):
    """(random, token) -> whether only held-out texts have it."""
    seen = collections.defaultdict(list)
    for _, text in pairs:
        held = zlib.crc32(text.encode()) % secrets.HELD == 0
        for match in re.finditer(PATTERNS[0][1], text, re.IGNORECASE):
            seen[True, match[2], 1].append(held)
        sha = hashlib.sha256(text.encode())
        key = base64.b64encode(sha.digest()).decode().rstrip("=")
        plain = re.sub("[+/]", "", key)
        safe = key.replace("+", "-").replace("/", "_")
        for token in (key, safe, plain, plain.upper(), plain.lower(), sha.hexdigest()):
            seen[True, token, 1].append(held)
        rest = re.sub(PATTERNS[0][1], " ", text, flags=re.IGNORECASE)
        for word in set(re.findall(secrets.WORD, rest)):
            seen[False, word, 2].append(held)
        words = re.findall(secrets.PROSE, rest)
        for i in range(len(words) // 3):
            a, b, c = words[3 * i : 3 * i + 3]
            n = zlib.crc32((a + b).encode())
            day = f"{n % 100 + 1970}-{n % 12 + 1:02}-{n % 28 + 1:02}"
            seen[False, FORMS[i % len(FORMS)](a, b, c, n, day), 1].append(held)
    return {(side, token): all(held) for (side, token, least), held in seen.items() if len(held) >= least}


def stretch_by_hand(token, table):
    """The best sum over all stretches of a token."""
    place = {sign: i for i, sign in enumerate(secrets.ALPHABET)}
    size = len(place)
    steps = [table[place[a] * size + place[b]] for a, b in zip(token, token[1:])]
    return max(math.fsum(steps[i:j]) for i in range(len(steps)) for j in range(i + 1, len(steps) + 1))


def test_markov_models(texts):
    """Samples, models, threshold and stretches are those made by hand."""
    draw = random.Random(5)
    pairs = secret_texts(draw)
    frame = texts(pairs)
    found = {(row.random, row.token): row.held for row in secrets.labelled(frame).collect()}
    want = labelled_by_hand(pairs)
    assert found == want
    counts = collections.Counter(
        (side, a + b) for (side, token), held in want.items() if not held for a, b in zip(token, token[1:])
    )
    model = secrets.train(frame)
    assert len(model.ratios) == len(secrets.ALPHABET) ** 2
    assert np.allclose(model.ratios, secrets.ratios(counts))
    long = {side: [] for side in (True, False)}
    for (side, token), held in want.items():
        if held and len(token) >= secrets.TOKEN.least:
            long[side].append(math.floor(max(0.0, stretch_by_hand(token, model.ratios))))
    plain = sum(score >= model.threshold for score in long[False]) / len(long[False])
    assert math.isclose(model.false, plain) and plain <= secrets.FALSE
    missed = sum(score < model.threshold for score in long[True]) / len(long[True])
    assert math.isclose(model.missed, missed, abs_tol=1e-12) and missed < 0.02
    tokens = ["understandinghereandthere", "".join(draw.choices(SIGNS, k=40)), "usr/local/X9fk2Lq8Zt41Vb7w"]
    rows = texts(list(enumerate(tokens))).select("text", secrets.stretch(F.col("text"), model.ratios).alias("s"))
    for row in rows.collect():
        assert math.isclose(row.s.score, max(0.0, stretch_by_hand(row.text, model.ratios)), rel_tol=1e-9)


ORDINARY = [
    "usr/local/lib/python/site-packages/numpy/core",
    "HTTP_STATUS_INTERNAL_SERVER_ERROR",
    "2024-10-11-12-33-44-55-66-77",
    "123e4567-e89b-42d3-a456-426614174000",
    "prefix/123e4567-e89b-42d3-a456-426614174000/here",
    "4111111111111111111111",
    "getConnectionFactoryFromRegistry",
    "understandinghereandthere",
    "================================",
    "--------------------------------",
]


def test_ordinary_and_random_tokens(texts):
    draw = random.Random(6)
    pairs = secret_texts(draw)
    model = secrets.train(texts(pairs))
    keys = ["".join(draw.choices(SIGNS, k=k)) for k in (18, 20, 24, 40, 64)]
    keys += ["".join(draw.choices("0123456789abcdef", k=23)), "".join(draw.choices(SIGNS[:26] + SIGNS[52:], k=24))]
    padded = base64.b64encode(draw.randbytes(32)).decode()
    key = keys[2]
    cases = [(f"see {token} there", []) for token in ORDINARY]
    cases += [(f"it is {token}.", [(6, 6 + len(token))]) for token in [*keys, padded]]
    address = f"https://example.org/callback/of/the/service/{key}/done"
    cases += [(address, [(address.index(key), address.index(key) + len(key))])]
    cases += [(f"long_name={key}", [(10, 10 + len(key))]), (f"é🙂 {key}", [(3, 3 + len(key))])]
    rows = secrets.digest(texts(list(enumerate(text for text, _ in cases))), model=model).collect()
    for row in rows:
        text, want = cases[row.doc_id]
        assert row.spans == ",".join(f"markov:{a}:{b}" for a, b in want), text
    assert all("markov" not in row.spans for row in secrets.digest(texts(pairs), model=model).collect())


def test_licence_of_python(texts):
    found = licences.scan(texts([(1, "# SPDX-License-Identifier: Python-2.0")])).collect()
    assert [row.licences for row in found] == ["Python-2.0"]


def test_language_learns_from_every_training_row(tongues):
    """Centroids and floors come from all rows of a language, whatever sample size is asked for."""
    whole, few = language.fit(tongues), language.fit(tongues, sample=1)
    assert whole.languages == few.languages
    assert np.allclose(whole.centroids, few.centroids)
    assert all(np.allclose(a, b) for a, b in zip(whole.floors, few.floors))
