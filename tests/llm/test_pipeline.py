"""The whole pipeline against brute force, and its registration."""

import collections
import random

import pytest
from conftest import rows_of

import __spark_entry__ as entry
import corpus_pipeline
from tideline.llm import common, mixing

from .conftest import DOCS, rows
from .test_dedup import classes_by_hand, family, normal
from .test_packing import check_sequences, crc, pieces_of
from .test_texts import prose


def documents(spark, folder):
    """Odd rows, families of near copies, exact copies, and prose in three languages."""
    draw = random.Random(7)
    found = [row[:4] for row in rows()]
    found += [(2000 + i, text, "en", "b") for i, text in family(40, 80, 6, 4)]
    for i in range(300):
        lang = draw.choice(["en", "de", "fr"])
        found.append((5000 + i, prose(draw, lang, draw.randrange(5, 60)), lang, draw.choice("abc")))
    found += [(9000 + i, found[20][1].replace(" ", "  "), "en", "c") for i in range(30)]
    found = [(*row, None if row[1] is None else len(row[1])) for row in found]
    schema = ", ".join(DOCS.split(", ")[:4]) + ", n_chars long"
    spark.createDataFrame(found, schema).repartition(4).write.parquet(f"{folder}/documents.parquet")
    return found


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("corpus"))
    documents(spark, folder)
    docs = common.table(spark, folder, "documents")
    found = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = common.landed(stage(spark, docs, folder), name)
        found.append(docs)
    return folder, found


def texts_of(df):
    return [(row.doc_id, row.text) for row in df.collect()]


def test_stages(stages):
    _, (raw, known, exact, near, mixed, packed) = stages
    for df in (known, exact, near, mixed):
        assert df.columns == raw.columns
    letters = [pair for pair in texts_of(raw) if any(sign.isalpha() for sign in pair[1] or "")]
    assert sorted(texts_of(known), key=repr) == sorted(letters, key=repr)
    groups = collections.defaultdict(list)
    for doc_id, text in letters:
        groups[normal(text)].append((doc_id is None, doc_id))
    firsts = sorted((min(ids)[1], text) for text, ids in groups.items())
    assert sorted((i, normal(text)) for i, text in texts_of(exact)) == firsts
    classes = classes_by_hand(texts_of(exact))
    assert sorted(i for i, _ in texts_of(near)) == sorted({least for _, least, _ in classes})
    copies = {row.doc_id: row.copies for row in mixing.mix(near).collect() if row.copies}
    assert collections.Counter(i for i, _ in texts_of(mixed)) == copies
    want = collections.Counter(
        (doc_id, number, start, len(ids), crc(ids))
        for doc_id, text in texts_of(mixed)
        for number, (start, ids) in enumerate(pieces_of(text))
    )
    pieces = packed.collect()
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in pieces) == want
    check_sequences(pieces, 2048)


def test_run_gives_the_last_stage(spark, stages):
    folder, found = stages
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert rows_of(corpus_pipeline.run(spark, folder), *columns) == rows_of(found[-1], *columns)


def test_empty_documents(spark, tmp_path):
    schema = ", ".join(DOCS.split(", ")[:4]) + ", n_chars long"
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_every_operator_is_registered():
    names = [name for name in entry.queries() if name.startswith("op")]
    assert sorted(int(name[2:].split("_")[0]) for name in names) == list(range(1, 14))
    assert "pipeline" in entry.queries()
    assert set(entry.oracle_sql()) <= set(entry.queries())
