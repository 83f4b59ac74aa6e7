"""The corpus pipeline: filter, de-duplicate, mix and tokenise the table ``documents``.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept and
returns the rows that go on, with the columns of ``documents``; the last returns token
digests. ``run`` writes every stage's rows as Parquet and reads them back for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlens.llm import bpe, entropy_mix, line_dedup, ngram_join, quality_rules
from demandlens.llm.tables import table
from demandlens.session import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules (operator 10)."""
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that an earlier one holds (operator 7); ``n_chars``
    follows the text."""
    out = line_dedup.drop_shared_lines(docs)
    if "n_chars" in out.columns:
        kind = out.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word n-grams, similarity 0.8 or
    more; the smallest doc_id stays (operator 8)."""
    return ngram_join.keep_one(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them (operator 2)."""
    return entropy_mix.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every row (operator 9)."""
    return bpe.encode_digests(docs)


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("ngram_join", near_duplicates),
    ("entropy_mix", mixture),
    ("byte_bpe", tokens),
]

#: The learned stage and the mix have no SQL form; tests/llm holds the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
