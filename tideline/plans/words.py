"""Words of the documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from tideline.operators import control, words
from tideline.plans.registry import load, query

# Words per text, in plain SQL: trailing blanks go, a text of blanks only has no words.
_WORDS = (
    "CASE WHEN length(text) > 0 AND trim(text, ' ') = '' THEN CAST([] AS VARCHAR[]) "
    "ELSE string_split(rtrim(lower(text), ' '), ' ') END"
)
_TOKENS = f"(SELECT doc_id, unnest({_WORDS}) AS word FROM documents)"
_PLACED = f"""(SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) - 1 AS pos
    FROM (SELECT doc_id, {_WORDS} AS ws FROM documents))"""
_BLOCKED = f"(SELECT item_id, unnest({_WORDS}) AS word FROM benchmark)"


@query(f"SELECT doc_id, word, 1 AS one FROM {_TOKENS}")
def tokenize(spark, sf_dir):
    return words.tokenize(load(spark, sf_dir, "documents"), "text", keep=["doc_id"])


@query(f"SELECT word, count(*) AS n FROM {_TOKENS} GROUP BY word")
def word_count(spark, sf_dir):
    return words.word_count(words.tokenize(load(spark, sf_dir, "documents"), "text"))


@query(
    f"""SELECT doc_id, pos, word, count(*) OVER (PARTITION BY word ORDER BY doc_id, pos
        ROWS UNBOUNDED PRECEDING) AS n FROM {_PLACED}"""
)
def word_count_running(spark, sf_dir):
    tokens = words.tokens_at(load(spark, sf_dir, "documents"), "text", "doc_id")
    return words.word_count_running(tokens, "doc_id")


@query(f"SELECT doc_id, word, 1 AS one, 'shoreline' AS tag FROM {_TOKENS}")
def parametrized_tokenize(spark, sf_dir):
    documents = load(spark, sf_dir, "documents")
    return words.parametrized_tokenize(documents, "doc_id", "text", {"tag": "shoreline"})


@query(f"SELECT doc_id, word, 1 AS one, 'shoreline' AS tag FROM {_TOKENS}")
def tokenize_table_function(spark, sf_dir):
    """The same through a table function that is set up once per partition."""
    documents = load(spark, sf_dir, "documents").select("doc_id", "text")
    kind = documents.schema["doc_id"].dataType.simpleString()
    tokens = words.tokenizer("doc_id", "text", kind, {"tag": "shoreline"})
    return tokens(documents.asTable())


@query(f"SELECT doc_id, pos, word FROM {_PLACED} WHERE word NOT IN (SELECT word FROM {_BLOCKED})")
def blocklist_anti(spark, sf_dir):
    tokens = words.tokens_at(load(spark, sf_dir, "documents"), "text", "doc_id")
    blocked = words.tokenize(load(spark, sf_dir, "benchmark"), "text")
    return control.blocklist_anti(tokens, blocked, ["word"]).select("doc_id", "pos", "word")


@query(
    f"""SELECT t.doc_id, t.pos, t.word FROM {_PLACED} t WHERE NOT EXISTS
        (SELECT 1 FROM {_BLOCKED} b WHERE b.word = t.word AND 20 * b.item_id <= t.doc_id)"""
)
def blocklist_ordered(spark, sf_dir):
    """Control item i arrives just before document 20 * i."""
    tokens = words.tokens_at(load(spark, sf_dir, "documents"), "text", "doc_id")
    tokens = tokens.withColumn("seq", F.col("doc_id"))
    blocked = words.tokenize(load(spark, sf_dir, "benchmark"), "text", keep=["item_id"])
    blocked = blocked.withColumn("seq", F.col("item_id") * 20)
    return control.blocklist_ordered(tokens, blocked, "word", "seq").select("doc_id", "pos", "word")
