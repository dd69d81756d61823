"""Documents to packed sequences: quality, language, line dedup, near-duplicate removal, packing.

All stages: an empty table gives no rows; rows are judged by their own text, so repeated rows and ties have the same
fate; whole texts are read, however long; extra columns come through all stages but the last as they are, whatever their
names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxframe.llm import langid, linededup, neardup, packing, quality
from voxframe.llm._common import materialise, read
from voxframe.llm.entries import tokenizer_path
from voxframe.scratch import discard


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go.

    Null and empty texts have no evidence and get the score that goes with their shortness; a null doc_id counts as not
    labelled. Without labels nothing goes.
    """
    return quality.keep_good(docs, read(spark, sf_dir, "labels"))


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter (null and empty texts too), and those whose language is told with a score under one half, go.

    Rows with a null lang aren't learned from; where no row has one, no language is known and all documents go.
    """
    return langid.keep_known(docs)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Long lines of five documents or more stay in one of them; text and n_chars follow.

    A null text becomes an empty one. Rows with the same doc_id are one document, and so are rows with a null one.
    """
    out = linededup.dedup_lines(docs, names=("__kept_text", "__n_lines", "__n_dropped"))
    return out.withColumn("text", F.col("__kept_text")).withColumn("n_chars", F.length("__kept_text").cast("long")).select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (similarity 0.8 or more) the smallest doc_id stays.

    Texts without words, and rows with a null doc_id, are in no group and stay; of a doc_id that stays, all its rows.
    """
    found = neardup.near_duplicates(docs, percent=80)
    gone = found.where("not kept").select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, F.col("doc_id") == F.col("__gone"), "left_anti")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 tokens; a null or empty text is a piece of its end mark alone."""
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [
    ("quality", good_documents),
    ("language", known_languages),
    ("line_dedup", without_repeated_lines),
    ("near_duplicates", one_of_each_group),
    ("packing", packed),
]

#: Trained classifiers and hashing aren't expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of what all stages keep. A stage's table is removed once the next one's is written; the last one's stays."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before, docs = docs, materialise(stage(spark, docs, sf_dir), name)
        discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
