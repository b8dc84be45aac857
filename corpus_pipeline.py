"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, folder of the given tables) and returns a frame that is
written as Parquet and read again as the next stage's ``docs``. All but the last return
the columns of ``documents``; the last returns the pieces of the packed sequences.

Columns beyond those of ``documents`` are carried along, whatever their names. Rows with a null
id are rows like others. An empty table goes through every stage and gives no piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tunesmith.llm import chains, host_rules, minhash, secret_scan
from tunesmith.llm.queries import packed
from tunesmith.sources.scratch import stored
from tunesmith.sources.tables import table

# Similarity in percent from which documents are near-duplicates.
SIMILAR = 80


def toxicity(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the classifier chain, fitted on ``labels``, does not reject.

    A null text is scored as an empty one; rows that repeat are scored each. Texts of any
    length are scored whole. Without labels nothing is rejected.
    """
    return chains.kept_rows(docs, table(spark, folder, "labels"))


def quality_rules(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that pass the base rules and whose host is not rejected.

    A null or empty text has no word and fails. Rows that repeat count each in their host's
    rates; rows without a source go by the base rules alone.
    """
    return host_rules.kept_rows(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near-duplicates: the one of the smallest id, a null id being the largest.

    Of rows that repeat with one id and text one stays. Texts without words (null, empty) are
    no one's duplicates and all stay.
    """
    return minhash.one_of_each(docs, SIMILAR)


def secrets(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents, with secrets replaced by a mask and ``n_chars`` counted anew.

    A null text stays null, with 0 characters; rows that repeat all stay.
    """
    masked = docs.withColumn("text", secret_scan.masked(F.col("text")))
    return masked.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("long"))


def packing(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 1024 tokens.

    A null or empty text is its end mark alone; rows that repeat are packed each, and each
    token of a long text is in exactly one piece.
    """
    return packed(docs)


STAGES = [
    ("toxicity", toxicity),
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("packing", packing),
]

# SQL cannot express the classifier, the tokenizer or the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
