"""The corpus pipeline: stages over documents, each written as Parquet and read again by the next.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import packing, quality_classifier, secrets, suffix_dedup, weighted_minhash
from tessera.llm.common import materialize, read


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the labels of the documents it is given.

    A null text is scored as an empty one, a null doc_id has no label; long texts are scored whole, repeated rows alike; where labels of one class
    are missing every row gets the share of the other; columns stay as they are; no documents give none.
    """
    return quality_classifier.keep_good(docs, read(spark, sf_dir, "labels"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The least document of each class of near-duplicates.

    Rows without a doc_id, with a null text or without a word all stay; rows that repeat a kept doc_id stay together; texts are compared whole;
    columns stay as they are; no documents give none.
    """
    return weighted_minhash.keep_one(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 50-byte strings that start in an earlier document, whole characters only; n_chars is counted anew.

    A null text stays null; rows without a doc_id count as one document before all others, rows of one doc_id as one document; no row
    goes, also if nothing of its text is left; other columns stay as they are; no documents give none.
    """
    return suffix_dedup.strip_repeats(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with confirmed secrets masked.

    Null and empty texts and null ids stay as they are; long texts are scanned whole, repeated rows each; other columns stay; no
    documents give none.
    """
    return secrets.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token sequences: one row for each piece of a document.

    A null or empty text is the end mark alone; a null doc_id stays null; repeated rows are packed each, ties in any order of equal rows;
    documents over a window are cut into full ones first; other columns are dropped; no documents give no rows.
    """
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", good_quality),
    ("weighted_minhash", one_of_each),
    ("suffix_dedup", without_repeats),
    ("secrets", without_secrets),
    ("packing", packed),
]

#: The classifier, the sampling and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
