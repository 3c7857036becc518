"""The corpus pipeline: language, line dedup, near-dedup, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next stage's ``docs``. All but the last return the columns of ``documents``.
Empty tables pass through all stages; null texts end at the first (no language).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repolens.llm import langid, lines, minhash, mixing
from repolens.llm.common import ship
from repolens.llm.queries import _tokenizer, bpe_digests
from repolens.session import cut_lineage

#: Language ID is fitted on the input; this SQL-less operator leaves the rows to brute-force tests.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; those without letters go, and those whose score shows none.
    If there are no labels to learn from, all with letters stay."""
    ship(spark)
    model = langid.fit(docs)
    found = langid.predict(docs, model)
    return found.filter(langid.shown(langid.thresholds(docs, model))).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that a smaller document holds as well go; every document stays."""
    ship(spark)
    left = lines.dedup(docs)
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return left.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five words, similarity 0.8 or more."""
    ship(spark)
    return minhash.kept(docs, words=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the target of its source takes it, in training order."""
    ship(spark)
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row."""
    ship(spark)
    return bpe_digests(docs.select("doc_id", "text"), _tokenizer("byte_bpe_50k.tiktoken"))


STAGES = [
    ("language", language),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mix", mix),
    ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
