"""A corpus from ``documents``: drop toxic texts, exact copies and near copies, mix sources, encode.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and returns rows with
the columns of ``documents``; the last returns token ids. ``run`` writes every stage as Parquet to the
shared folder and reads it again, so a lost executor costs one stage's tasks at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casemill.llm import byte_bpe, exact_dedup, mixing, near_dedup, toxicity
from casemill.llm.common import stage, table
from casemill.llm.queries import vocabulary


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows scored under the threshold by a model of the labelled documents among ``docs``.

    Null and empty texts have the score of the constant, repeated rows stay or go together; without
    labels, or with one kind only, every row has the share of label 1. An empty table stays empty.
    """
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest id; null counts as empty, a null id as smallest.

    Of repeated rows one stays, and of an empty table nothing.
    """
    return exact_dedup.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents, the one with the smallest id.

    Null, empty and blank texts are linked with nothing and stay; null ids are never the smallest.
    Repeated rows stay together, and of an empty table nothing is left.
    """
    return near_dedup.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the target of their source takes them: never, once or twice.

    Texts without words have size 0 and go with the hash of their id like all others; rows of one id
    are taken together. A null source is a source. Columns of any name stay as they are.
    """
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded_sha256`` per row; ids are little-endian unsigned 32-bit numbers.

    The digest is that of the bytes the ids decode to. Null and empty texts have no ids and the digest of
    no bytes; repeated rows are encoded each.
    """
    trip = byte_bpe.round_trip(docs, *vocabulary())
    return trip.withColumn("decoded_sha256", F.sha2("decoded", 256)).drop("decoded")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mix_sources", mix_sources),
    ("byte_bpe", encode),
]

#: SQL can express neither the model nor the encoding; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = stage(spark)
    docs = table(spark, sf_dir, "documents")
    for _, step in STAGES:
        docs = written.write(step(spark, docs, sf_dir))
    return docs
