"""Toxicity score: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are its distinct single words, pairs of neighbours and pairs with one word
between them, hashed to ``DIMENSIONS`` coordinates. Each coordinate has its own learning rate, and
the L1 term keeps a coordinate at exactly zero until its evidence is strong, so the model is a short
list of (coordinate, weight): never more than ``DIMENSIONS`` entries, which bounds the broadcast.

Training reads about ``TRAIN_ROWS`` labelled rows at most, whatever the table's size: those whose id
hashes below a threshold set from the number of labelled rows. Their features are made in parallel;
the learner, which must see rows one after another, gets this bounded sample in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casemill.llm.common import stage, text_of, trimmed
from casemill.llm.words import mix, odd_constants, word_numbers

#: Bound of the labelled rows that training reads (as an expected number), and passes over them.
TRAIN_ROWS, EPOCHS = 12_000, 6
DIMENSIONS = 1 << 20
#: FTRL: learning rate, its offset, L2, and L1 as a multiple of the root of the rows with label 1.
ALPHA, BETA, L2, L1_SHARE = 2.0, 1.0, 0.01, 1.5
#: How much more a row of label 1 counts; they are few.
ONES_WEIGHT = 8.0
#: The constant feature keeps no L1, and its weight is the last entry.
THRESHOLD = 0.7

_SHIFT = np.uint64(44)


def features(numbers: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates of all texts, distinct within each text, and the text each belongs to."""
    c = odd_constants(3, 41)
    of = np.repeat(np.arange(len(begins) - 1, dtype=np.uint64), np.diff(begins))
    parts, owners = [mix(numbers * c[0]) >> _SHIFT], [of]
    for gap in (1, 2):
        if len(numbers) > gap:
            same = of[:-gap] == of[gap:]
            parts.append((mix(numbers[:-gap] * c[gap] + numbers[gap:]) >> _SHIFT)[same])
            owners.append(of[:-gap][same])
    key = np.unique(np.concatenate(owners) << np.uint64(20) | np.concatenate(parts))
    return (key & np.uint64(DIMENSIONS - 1)).astype(np.int64), (key >> np.uint64(20)).astype(np.int64)


def _labelled_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at, of = features(*word_numbers(batch.column("text")))
        ends = np.searchsorted(of, np.arange(batch.num_rows + 1))
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(at, pa.int32()))
        yield pa.RecordBatch.from_arrays([batch.column("ord"), batch.column("label"), lists], ["ord", "label", "at"])


def _weights(z: np.ndarray, n: np.ndarray, l1: np.ndarray) -> np.ndarray:
    return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def _learn(rows: pd.DataFrame) -> pd.DataFrame:
    """Weights of the coordinates that are not zero, from all rows of the sample in hash order."""
    rows = rows.sort_values(["ord", "label"], kind="stable")
    z, n = np.zeros(DIMENSIONS + 1), np.zeros(DIMENSIONS + 1)
    l1 = np.full(DIMENSIONS + 1, L1_SHARE * np.sqrt(rows["label"].sum()))
    l1[-1] = 0.0
    texts = [np.append(np.asarray(a, dtype=np.int64), DIMENSIONS) for a in rows["at"]]
    for _ in range(EPOCHS):
        for at, y in zip(texts, rows["label"].tolist(), strict=True):
            zi, ni = z[at], n[at]
            w = _weights(zi, ni, l1[at])
            p = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -30, 30)))
            g = (p - y) * (ONES_WEIGHT if y else 1.0)
            z[at] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA * w
            n[at] = ni + g * g
    w = _weights(z, n, l1)
    at = np.flatnonzero(w)
    return pd.DataFrame({"at": at, "w": w[at]})


def train(labelled: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Weights from ``labelled`` (doc_id, text, label 0/1): coordinates and values, the last is the constant.

    Rows without a label are left out. With no rows, or labels of one kind only, every text gets the
    share of label 1 among them (none: 0).
    """
    spark = labelled.sparkSession
    written = stage(spark)
    order = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    share = F.pmod(order, F.lit(1 << 30)) / F.lit(float(1 << 30))
    known = labelled.filter("label is not null")
    counts = known.agg(F.count(F.lit(1)), F.sum("label")).first()
    total, ones = counts[0], counts[1] or 0
    if not ones or ones == total:
        return np.zeros(0, np.int64), np.array([np.log((ones + 0.5) / (total - ones + 0.5)) if total else -30.0])
    sample = known.filter(share < F.lit(min(1.0, TRAIN_ROWS / total))).select(
        order.alias("ord"), F.col("label").cast("int").alias("label"), text_of().alias("text")
    )
    rows = written.write(sample.mapInArrow(trimmed(_labelled_features), "ord long, label int, at array<int>"))
    # At most DIMENSIONS + 1 numbers reach the driver.
    learned = rows.withColumn("model", F.lit(0)).groupBy("model").applyInPandas(_learn, "at long, w double").toPandas()
    weights = np.zeros(DIMENSIONS + 1)
    weights[learned["at"].to_numpy()] = learned["w"].to_numpy()
    at = np.flatnonzero(weights[:-1])
    return at, np.append(weights[at], weights[-1])


def scorer(spark: SparkSession, model: tuple[np.ndarray, np.ndarray]):
    """A column function from text to score; a text without words gets the score of the constant."""
    shared = spark.sparkContext.broadcast((model[0].astype(np.int32), model[1].astype(np.float32)))

    def scores(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        at, w = shared.value
        dense = np.zeros(DIMENSIONS, np.float32)
        dense[at] = w[:-1]
        for batch in texts:
            where, of = features(*word_numbers(batch))
            total = np.bincount(of, weights=dense[where], minlength=len(batch)) + float(w[-1])
            yield pa.array(np.round(1.0 / (1.0 + np.exp(-np.clip(total, -30, 30))), 9))

    @F.arrow_udf("double")
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from trimmed(scores)(texts)

    return run


def held_out(id_name: str = "doc_id"):
    """Whether crc32 of the id as text leaves 1 when divided by 3; null id: as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_name).cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1


def model_of(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The model of the labelled documents that are not held out.

    Only the text and the label are used. Of labelled ids, those under the sampling threshold are
    picked before the join, so the join moves few texts. Of the rows of a picked id, one text (by its
    hash) is trained on, so that the bound holds for rows and a repeated id displaces no other.
    """
    written = stage(docs.sparkSession)
    narrow = labels.select(F.col("doc_id").alias("_id"), F.col("toxic").alias("label")).filter(~held_out("_id") & F.col("label").isNotNull())
    narrow = written.write(narrow.distinct())
    total = narrow.count()
    order = F.xxhash64(F.coalesce(F.col("_id").cast("string"), F.lit("")))
    share = F.pmod(order, F.lit(1 << 30)) / F.lit(float(1 << 30))
    picked = narrow.filter(share < F.lit(min(1.0, TRAIN_ROWS / max(total, 1))))
    # TRAIN_ROWS narrow rows at most, so they can go to every task, and no text moves but theirs.
    joined = docs.select("doc_id", "text").join(F.broadcast(written.write(picked)), F.col("doc_id") == F.col("_id"))
    one_each = joined.groupBy("doc_id", "label").agg(F.min_by("text", F.struct(F.xxhash64("text"), F.col("text"))).alias("text"))
    return train(written.write(one_each))


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: ``doc_id, held_out, score, predicted``.

    Null and empty texts are scored by the constant alone, repeated rows alike; an empty table gives
    no rows. Labels, language, source and id never enter a score.
    """
    run = scorer(docs.sparkSession, model_of(docs, labels))
    result = docs.select("doc_id", held_out().alias("held_out"), run(text_of()).alias("score"))
    return result.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` scored under the threshold, with their columns as they were."""
    run = scorer(docs.sparkSession, model_of(docs, labels))
    return docs.filter(run(text_of()) < THRESHOLD)
