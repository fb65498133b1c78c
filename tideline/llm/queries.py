"""The registered queries of the corpus operators and their SQL forms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import (
    bfd_packing,
    exact_dedup,
    grid_join,
    histogram_packing,
    language,
    licences,
    mixing,
    near_dedup,
    prefix_trie,
    recurrent_lm,
    secrets,
    spelling,
    toxicity,
)
from .common import table


def op1_bfd_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bfd_packing.pack_matrix(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op4_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.classes(table(spark, sf_dir, "documents")).drop("print")


def op6_grid_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid_join.linked(table(spark, sf_dir, "embeddings"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(table(spark, sf_dir, "documents"))


def op9_histogram_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return histogram_packing.pack(table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op11_recurrent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recurrent_lm.scored(table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_bfd_packing": op1_bfd_packing,
    "op2_toxicity": op2_toxicity,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_licences": op4_licences,
    "op5_near_dedup": op5_near_dedup,
    "op6_grid_join": op6_grid_join,
    "op7_language": op7_language,
    "op8_secrets": op8_secrets,
    "op9_histogram_packing": op9_histogram_packing,
    "op10_mixing": op10_mixing,
    "op11_recurrent_lm": op11_recurrent_lm,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_spelling": op13_spelling,
}

#: One row with the table of CRC-32, for ``crc32_sql``.
CRC_STEPS = """crc_steps AS (
  SELECT list(c ORDER BY i) AS steps FROM (
    SELECT i, list_reduce(range(8), lambda c, k:
      xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END), i) AS c FROM range(256) r(i)))"""


def crc32_sql(text: str) -> str:
    """The unsigned CRC-32 of a text's UTF-8 bytes in DuckDB, beside the row of ``crc_steps``."""
    digits = f"regexp_replace(hex(encode({text})), '(..)', '\\1 ', 'g')"
    codes = f"list_transform(string_split({digits}, ' ')[:-2], lambda b: ('0x' || b)::BIGINT)"
    step = "lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce({codes}, {step}, 4294967295), 4294967295)"


SQL = {
    "op3_exact_dedup": """
WITH prints AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS sha
  FROM documents),
groups AS (SELECT sha, min(doc_id) AS keep_id, count(*) AS group_size FROM prints GROUP BY sha)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha AS text_sha256
FROM prints JOIN groups USING (sha)""",
    "op10_mixing": """
WITH sizes AS (
  SELECT doc_id, source, md5(doc_id::VARCHAR) AS key,
    coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size
  FROM documents),
named AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [3.0::DOUBLE, 1.0, 2.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM sizes GROUP BY source),
full_at AS (SELECT *, source_size * 2 / weight AS full_at FROM named),
walked AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(source_size * 2) OVER
      (ORDER BY full_at, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER
      (ORDER BY full_at, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM full_at),
goals AS (
  SELECT source, source_size, least(source_size * 2::DOUBLE, coalesce(weight * (
    SELECT max(level) FROM walked WHERE level <= full_at), source_size * 2::DOUBLE)) AS target
  FROM walked),
steps AS (
  SELECT *, coalesce(round(target / nullif(source_size, 0) * 16777216), 0)::BIGINT AS each,
    ('0x' || substr(md5('tideline:' || coalesce(source, '')), 1, 8))::BIGINT % 16777216 AS place
  FROM goals),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY size, key) AS rank FROM sizes),
taken AS (
  SELECT n.doc_id, n.size, s.source_size, s.target, n.source,
    (n.rank * s.each + s.place) // 16777216 - ((n.rank - 1) * s.each + s.place) // 16777216 AS copies
  FROM numbered n JOIN steps s ON n.source IS NOT DISTINCT FROM s.source)
SELECT doc_id, size, source_size, target, copies * size AS taken, source, copies FROM taken""",
    "op4_licences": licences.oracle_sql(),
    "op6_grid_join": """
WITH RECURSIVE usable AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reached(node, other) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION SELECT node, b FROM reached JOIN links ON other = a),
roots AS (SELECT node, min(other) AS component_id FROM reached GROUP BY node),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN roots ON vec_id = node LEFT JOIN counts ON vec_id = a""",
    "op12_prefix_trie": f"""
WITH {CRC_STEPS},
own AS (
  SELECT conv_id, list((coalesce(role, ''), coalesce(text, '')) ORDER BY turn NULLS FIRST,
    md5(len(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
heads AS (SELECT conv_id, turns, {crc32_sql("conv_id::VARCHAR")} % 6 AS h FROM own, crc_steps),
rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.turns, [])[:h], c.turns[h + 1:]) AS path
  FROM heads c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 100),
steps AS (
  SELECT conv_id, len(path) AS total, d AS depth, path[:d] AS node
  FROM (SELECT *, unnest(range(len(path) + 1)) AS d FROM rebuilt)),
nodes AS (
  SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    CASE WHEN depth > 0 THEN (count(*) - 1) * len(node[-1][2]) ELSE 0 END AS gain,
    coalesce(string_agg(conv_id, ',' ORDER BY conv_id) FILTER (total = depth), '') AS ends
  FROM steps GROUP BY node, depth),
families AS (
  SELECT node[:depth - 1] AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
linked AS (SELECT *, coalesce(n_children, 0) AS kids FROM nodes LEFT JOIN families USING (node)),
spread AS (SELECT node, gain, kids, unnest(range(depth + 1)) AS d FROM linked),
subtrees AS (
  SELECT node[:d] AS node, count(*) FILTER (kids = 0) AS n_leaves, sum(gain) AS saved
  FROM spread GROUP BY 1)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.kids AS n_children, n_leaves,
  saved::BIGINT AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM linked n JOIN subtrees USING (node)
LEFT JOIN nodes p ON n.depth > 0 AND p.node = n.node[:n.depth - 1]""",
    "op13_spelling": f"""
WITH RECURSIVE {CRC_STEPS},
runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id, count(*) AS n,
    unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run
  FROM documents GROUP BY doc_id, text),
hashed AS (
  SELECT run, n, {crc32_sql("id || ':' || run")} AS h
  FROM (SELECT id, run, sum(n) AS n FROM runs GROUP BY id, run), crc_steps),
words AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT n, CASE WHEN h % 97 = 0 THEN run[:h % len(run)] || run[h % len(run) + 2:] ELSE run END AS word
    FROM hashed)
  GROUP BY word HAVING len(word) >= 5 AND sum(n) >= 3),
holes AS (
  SELECT word, n, i, word[:i] || word[i + 2:] AS rest
  FROM (SELECT word, n, unnest(range(len(word))) AS i FROM words)),
pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM holes a JOIN holes b USING (rest, i)
  WHERE a.word <> b.word
  UNION SELECT h.word, h.rest, w.n FROM holes h JOIN words w ON w.word = h.rest
  UNION SELECT w.word, h.word, h.n FROM holes h JOIN words w ON w.word = h.rest),
best AS (
  SELECT word, count(*) AS n_near, min((-near_n, encode(near))) AS best FROM pairs GROUP BY word),
named AS (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near,
    CASE WHEN -best[1] >= 2 * w.n THEN decode(best[2]) END AS form,
    CASE WHEN -best[1] >= 2 * w.n THEN -best[1] END AS form_n
  FROM words w LEFT JOIN best USING (word)),
walk AS (
  SELECT word, word AS at, form AS next FROM named
  UNION ALL
  SELECT walk.word, named.word, named.form FROM walk JOIN named ON named.word = walk.next)
SELECT named.word, named.form, walk.at AS root, n, n_near, form_n
FROM named JOIN walk ON walk.word = named.word AND walk.next IS NULL""",
}
