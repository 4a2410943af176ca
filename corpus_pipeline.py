"""The corpus pipeline: quality, line dedup, near-duplicate removal, mixing, encoding.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
one's docs.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlens.llm import jaccard_join, line_dedup, mixing, quality, tokenize_bpe
from fundlens.llm.common import read_table, written
from fundlens.llm.queries import MIX, vocabulary


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or score below the fitted threshold go."""
    return quality.keep_good(docs, quality.fit(docs, read_table(spark, sf_dir, "labels")))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs go; documents that consist of nothing else go with them."""
    out = line_dedup.dedup_lines(docs, drop_emptied=True)
    if "n_chars" not in out.columns:
        return out
    kind = docs.schema["n_chars"].dataType
    return out.withColumn("n_chars", F.char_length("text").cast(kind)).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies stays."""
    return jaccard_join.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated to their source's target share and shuffled."""
    return mixing.mix_sources(docs, **MIX)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids) of every remaining document."""
    encoded = tokenize_bpe.encode_documents(docs, *vocabulary())
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", dedup_lines),
    ("jaccard_join", drop_near_copies),
    ("mixing", mix),
    ("byte_bpe", encode),
]

# The fitted rules and the tokenizer have no SQL form; tests/llm holds the brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
