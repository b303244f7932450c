"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``documents``.  ``run`` writes what a stage returns
to the shared folder before the next one reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm import jaccard, packing, registry, secrets, suffix_dedup, toxicity
from tallyspark.llm.shared import discard, scratch, stored, table
from tallyspark.llm.suffix_dedup import PASSAGE_BYTES, PASSAGE_WORDS


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go.

    A null text is judged like an empty one; repeated rows are judged each, and
    no row of an accepted document is lost or doubled by its labels.
    """
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the row of smallest doc_id stays, null last.

    Rows have a key of their own, written once, so repeated rows and rows
    without a doc_id are documents like others.  Documents without words are in
    no group and stay.
    """
    key = "__row"
    keyed = stored(docs.withColumn(key, F.monotonically_increasing_id()), "pipeline-keyed")
    groups = jaccard.near_duplicates(keyed.select(F.col(key).alias("doc_id"), "text")).select(F.col("doc_id").alias(key), F.col("component_id").alias("component"))
    rows = groups.join(keyed.select(key, "doc_id"), key)
    first = rows.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", key)).alias("first"))
    return keyed.join(first.select(F.col(f"first.{key}").alias(key)), key, "left_semi").select(docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of over 50 words that occur twice leave the texts.

    They are found as strings of 200 bytes, fewer than 51 words of three letters
    have.  A null text stays null, an empty one empty; a row without a doc_id is
    a document like others; repeated rows repeat each other.
    """
    return suffix_dedup.without_repeats(docs, PASSAGE_BYTES, PASSAGE_WORDS)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are masked.  A null text stays null, an empty one empty; repeated rows are masked each."""
    return secrets.masked(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in sequences of at most 4096 tokens.

    A null or empty text is its closing id alone; repeated rows are packed each.
    """
    return packing.pack(docs, registry.tokenizer_path(registry.TOKENIZER))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("repeats", cut_repeats),
    ("secrets", mask_secrets),
    ("packing", pack_sequences),
]

#: SQL expresses none of a trained network, suffix sorting and tokenizing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with scratch():
            after = stored(stage(spark, docs, sf_dir), f"pipeline-{name}", keep=True)
        if name != STAGES[0][0]:
            discard(docs)
        docs = after
    return STAGES[-1][1](spark, docs, sf_dir)
