"""Registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlens.functions.columns import qcol
from fundlens.llm import (
    jaccard_join,
    langid,
    lexical,
    line_dedup,
    lm_ppm,
    merkle,
    mixing,
    nn_descent,
    pii,
    quality,
    token_counts,
    tokenize_bpe,
    toxicity,
)
from fundlens.llm.common import held_out, read_table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def vocabulary() -> tuple[str, str]:
    """Path and pattern of the vocabulary that op2 encodes with."""
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN


def _with_fold(result: DataFrame, modulus: int, remainder: int) -> DataFrame:
    out = held_out(F.col("doc_id"), modulus, remainder).alias("held_out")
    return result.select("doc_id", out, *[c for c in result.columns if c != "doc_id"])


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"), ~held_out(F.col("doc_id"), 5, 0))
    return _with_fold(toxicity.score_documents(docs, model), 5, 0)


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenize_bpe.encode_digest(read_table(spark, sf_dir, "documents"), *vocabulary())


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    net = langid.fit(docs, ~held_out(F.col("doc_id"), 5, 0))
    return _with_fold(langid.predict(docs, net), 5, 0)


def op4_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(read_table(spark, sf_dir, "documents"))


# The key of the registered query only; a real run passes its own secret.
PII_KEY = "registered query"


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(read_table(spark, sf_dir, "documents"), PII_KEY)


def op6_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs, count_col="lines_deleted")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return quality.assess(docs, quality.fit(docs, read_table(spark, sf_dir, "labels")))


def op9_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return _with_fold(lm_ppm.score_documents(docs, ~held_out(F.col("doc_id"), 7, 2)), 7, 2)


MIX = {"temperature": 0.5, "epochs": 1.0, "seed": 17}


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return mixing.mix_sources(docs, copy_col="copy", **MIX).select("doc_id", "source", "copy", "text")


OP10_SQL = """
WITH counts AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
rates AS (
  SELECT source, sqrt(n) / (SELECT sum(sqrt(n)) FROM counts) * (SELECT sum(n) FROM counts) / n AS rate FROM counts
), means AS (SELECT *, greatest(ceil(rate / 16), 1) AS draws FROM rates
), steps AS (
  SELECT source, k, sum(exp(-rate / draws + k * ln(rate / draws) - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS cdf
  FROM means, generate_series(0, 95) AS s(k)
), seeds AS (
  SELECT d.doc_id, d.source, d.text, d.r, unnest(range(CAST(m.draws AS BIGINT))) AS j
  FROM (SELECT *, row_number() OVER () AS r FROM documents) d JOIN means m ON m.source IS NOT DISTINCT FROM d.source
), drawn AS (
  SELECT *, ('0x' || substr(md5('17:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || CASE WHEN j > 0 THEN ':' || j ELSE '' END), 1, 13))::BIGINT / 4503599627370496.0 AS u
  FROM seeds
), copies AS (
  SELECT d.r, any_value(d.doc_id) AS doc_id, any_value(d.source) AS source, any_value(d.text) AS text, count(s.k) AS n
  FROM drawn d LEFT JOIN steps s ON s.source IS NOT DISTINCT FROM d.source AND d.u >= s.cdf GROUP BY d.r
)
SELECT doc_id, source, unnest(range(n)) AS copy, text FROM copies
"""

def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts.count_tokens(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    changed = {c: qcol(c) for c in merkle.LEAF_COLUMNS} | {"n_chars": F.try_add(F.col("n_chars"), F.lit(1))}
    altered = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, merkle.leaf(changed))
    tree = merkle.manifest(docs, carry={"altered": altered})
    folded = merkle.fold(F.coalesce("altered", "leaf"), F.col("path"))
    proof = merkle.path_digest(F.col("path"))
    out = tree.select("doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


# The level loop of the tree, the path of every leaf and the crc32 of an id, in SQL.
OP12_SQL = """
WITH RECURSIVE fields AS (
  SELECT doc_id, lang, CAST(doc_id AS VARCHAR) AS id_text,
         coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
           || coalesce(strlen(lang) || ':' || lang, '-') AS head,
         coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS chars,
         coalesce(strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1), '-') AS more_chars,
         coalesce(strlen(text) || ':' || text, '-') AS body
  FROM documents
), digests AS (
  SELECT doc_id, lang, sha256(head || chars || body) AS leaf, sha256(head || more_chars || body) AS altered,
         xor(4294967295, list_reduce(
           list_concat([4294967295::BIGINT], list_transform(range(1, strlen(id_text) + 1), lambda i: ascii(substr(id_text, i, 1))::BIGINT)),
           lambda crc, b: list_reduce(list_concat([xor(crc, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
             lambda c, z: xor(c >> 1, 3988292384 * (c & 1))))) AS crc
  FROM fields
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS grp
  FROM digests
), up(grp, lvl, pos, node) AS (
  SELECT grp, 0, pos, leaf FROM leaves
  UNION ALL
  SELECT grp, lvl + 1, pos // 2, sha256(string_agg(node, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER (PARTITION BY grp) AS nodes FROM up) WHERE nodes > 1 GROUP BY grp, lvl, pos // 2
), heights AS (SELECT grp, max(lvl) AS height FROM up GROUP BY grp
), subroots AS (SELECT u.grp, u.node FROM up u JOIN heights h ON u.grp = h.grp AND u.lvl = h.height
), over_up(lvl, pos, node) AS (
  SELECT 0, grp, node FROM subroots
  UNION ALL
  SELECT lvl + 1, pos // 2, sha256(string_agg(node, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER () AS nodes FROM over_up) WHERE nodes > 1 GROUP BY lvl, pos // 2
), top AS (SELECT max(lvl) AS height FROM over_up
), low AS (
  SELECT l.grp, l.pos, list(CASE WHEN (l.pos >> s.lvl) & 1 = 1 THEN 'L' ELSE 'R' END || coalesce(u.node, '') ORDER BY s.lvl) AS steps
  FROM leaves l JOIN heights h ON l.grp = h.grp JOIN (SELECT unnest(range(0, 64)) AS lvl) s ON s.lvl < h.height
  LEFT JOIN up u ON u.grp = l.grp AND u.lvl = s.lvl AND u.pos = xor(l.pos >> s.lvl, 1)
  GROUP BY l.grp, l.pos
), high AS (
  SELECT g.grp, list(CASE WHEN (g.grp >> s.lvl) & 1 = 1 THEN 'L' ELSE 'R' END || coalesce(u.node, '') ORDER BY s.lvl) AS steps
  FROM subroots g, top t JOIN (SELECT unnest(range(0, 64)) AS lvl) s ON s.lvl < t.height
  LEFT JOIN over_up u ON u.lvl = s.lvl AND u.pos = xor(g.grp >> s.lvl, 1)
  GROUP BY g.grp
), paths AS (
  SELECT l.doc_id, l.leaf, r.node AS subroot, (SELECT o.node FROM over_up o, top t WHERE o.lvl = t.height) AS root,
         CASE WHEN l.crc % 7 = 0 THEN l.altered ELSE l.leaf END AS start,
         list_concat(coalesce(low.steps, []::VARCHAR[]), coalesce(high.steps, []::VARCHAR[])) AS steps
  FROM leaves l JOIN subroots r ON l.grp = r.grp LEFT JOIN low ON low.grp = l.grp AND low.pos = l.pos LEFT JOIN high ON high.grp = l.grp
), folded AS (
  SELECT *, list_reduce(list_concat([start], steps), lambda node, s:
           sha256(CASE WHEN s[1] = 'L' THEN s[2:] || node ELSE node || s[2:] END)) AS folded_root
  FROM paths
)
SELECT doc_id, leaf, subroot, root, sha256(coalesce(array_to_string(list_transform(steps, lambda s: s[2:]), ''), '')) AS proof_sha256,
       folded_root, folded_root = root AS verified
FROM folded
"""


def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.top_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


_TERMS = "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

OP13_SQL = f"""
WITH doc_terms AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS words FROM documents),
stats AS (SELECT count(*) AS n_docs, sum(len(words))::BIGINT AS n_terms FROM doc_terms WHERE len(words) > 0),
postings AS (
  SELECT r, doc_id, len(words)::BIGINT AS n, word, count(*)::BIGINT AS tf
  FROM (SELECT r, doc_id, words, unnest(words) AS word FROM doc_terms) GROUP BY r, doc_id, words, word
), dfs AS (SELECT word, count(*)::BIGINT AS df FROM postings GROUP BY word),
items AS (
  SELECT item_id, word, count(*)::BIGINT AS times
  FROM (SELECT item_id, unnest({_TERMS}) AS word FROM (SELECT DISTINCT item_id, text FROM benchmark)) GROUP BY item_id, word
), scored AS (
  SELECT i.item_id, p.r, p.doc_id, sum(
    i.times * CAST(floor(1000 * ln(CAST(2 * s.n_docs + 2 AS DOUBLE) / CAST(2 * d.df + 1 AS DOUBLE))) AS BIGINT)
    * ((1000000000 * p.tf) // (1000 * p.tf + 8 * (25 + (75 * p.n * s.n_docs) // s.n_terms))))::BIGINT AS score
  FROM items i JOIN postings p ON p.word = i.word JOIN dfs d ON d.word = i.word, stats s
  GROUP BY i.item_id, p.r, p.doc_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM scored WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""

QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_bpe": op2_bpe,
    "op3_langid": op3_langid,
    "op4_jaccard": op4_jaccard,
    "op5_pii": op5_pii,
    "op6_nn_descent": op6_nn_descent,
    "op7_line_dedup": op7_line_dedup,
    "op8_quality": op8_quality,
    "op9_ppm": op9_ppm,
    "op10_mixing": op10_mixing,
    "op11_token_counts": op11_token_counts,
    "op12_merkle": op12_merkle,
    "op13_lexical": op13_lexical,
}

ORACLE_SQL = {"op10_mixing": OP10_SQL, "op12_merkle": OP12_SQL, "op13_lexical": OP13_SQL}
