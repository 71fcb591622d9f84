"""Language identification: sparse multinomial logistic regression on TF-IDF of character n-grams.

Texts are lower-cased, every run of other signs than letters is one space, and the runs of one to
``LONGEST`` characters are hashed to ``DIMENSIONS`` coordinates. A feature is the share of a
coordinate among the text's n-grams times its inverse document frequency, which comes from all
training documents. Weights are learned by follow-the-regularised-leader with an elastic net: the L1
term keeps most coordinates at exactly zero, the L2 term shrinks the rest. The probabilities are then
calibrated by one temperature, fitted on rows that the weights have not seen.

Weights are fitted on a bounded sample, ``TRAIN_ROWS`` distinct texts in equal parts of the
``LANGUAGES`` most frequent labels at most; they and the document frequencies are as long as the
coordinates, whatever the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casemill.llm.common import stage, text_of, trimmed
from casemill.llm.words import odd_constants

#: Bounds of the fit: distinct texts and labels, and passes over them.
TRAIN_ROWS, LANGUAGES, EPOCHS = 4_000, 256, 4
LONGEST, BITS = 4, 17
DIMENSIONS = 1 << BITS
#: FTRL: learning rate and its offset, L1 and L2; features are multiplied by SCALE.
ALPHA, BETA, L1, L2, SCALE = 0.5, 0.1, 0.5, 0.05, 20.0
#: One row in so many of the sample sets the temperature.
CALIBRATE = 5
#: Characters of a text worked on at a time.
PIECE = 1 << 20
UNKNOWN = "und"

_FACTORS = odd_constants(LONGEST, 53)
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Grams:
    """Coordinates of the character n-grams of a text."""

    def __init__(self):
        self._letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
        self._ascii = bytes(ord(chr(c).lower()) if c < 128 and chr(c).isalpha() else 32 for c in range(256))

    def _codes(self, text: str) -> np.ndarray:
        """Lower-case code points, 32 for what is no letter."""
        if text.isascii():
            return np.frombuffer(text.encode().translate(self._ascii), np.uint8).astype(np.uint64)
        codes = np.frombuffer(text.lower().encode("utf-32-le"), "<u4")
        return np.where(self._letter[codes], codes, 32).astype(np.uint64)

    def of(self, text: str | None) -> Iterator[np.ndarray]:
        """In several arrays; none for a text without letters."""
        before = np.zeros(0, np.uint64)  # the last characters of the piece before
        for start in range(0, len(text or ""), PIECE):
            codes = self._codes(text[start : start + PIECE])
            codes = np.concatenate([before if start else [np.uint64(32)], codes, [np.uint64(32)] if start + PIECE >= len(text) else before[:0]])
            space = codes == 32
            keep = ~space
            keep[1:] |= ~space[:-1]
            keep[0] = True
            codes = codes[keep]
            if len(codes) < 3 and (codes == 32).all():
                before = codes[-1:]
                continue
            total, old = codes * _FACTORS[0], len(before) if start else 0
            for n in range(1, LONGEST + 1):
                if n > 1:
                    if len(codes) < n:
                        break
                    total = total[:-1] + codes[n - 1 :] * _FACTORS[n - 1]
                # Those that end in this piece.
                fresh = total[max(0, old - n + 1) :]
                if n == 1:
                    fresh = fresh[codes[old:] != 32]
                if len(fresh):
                    yield (((fresh ^ (fresh >> np.uint64(29))) * _MIX) >> np.uint64(64 - BITS)).astype(np.int64)
            before = codes[-(LONGEST - 1) :]


def _count_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many documents of a task hold each coordinate, and as the last entry, how many there are."""
    grams, counts, seen = Grams(), np.zeros(DIMENSIONS + 1, np.int64), np.zeros(DIMENSIONS, bool)
    for batch in batches:
        for text in batch.column("text"):
            parts = list(grams.of(text.as_py()))
            for part in parts:
                seen[part] = True
            here = np.flatnonzero(seen)
            counts[here] += 1
            seen[here] = False
            counts[-1] += bool(parts)
    at = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(counts[at])], ["at", "n"])


def document_frequencies(docs: DataFrame) -> np.ndarray:
    """Documents of ``docs`` (text) that hold each coordinate; the last entry is the number with letters."""
    counted = docs.select(text_of().alias("text")).mapInArrow(trimmed(_count_documents), "at int, n long")
    # DIMENSIONS + 1 numbers at most reach the driver.
    rows = counted.groupBy("at").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(DIMENSIONS + 1, np.int64)
    out[rows["at"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return out


def inverse_frequencies(frequencies: np.ndarray) -> np.ndarray:
    return np.log((1.0 + frequencies[-1]) / (1.0 + frequencies[:-1])) + 1.0


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    grams = Grams()
    for batch in batches:
        at, n = [], []
        for text in batch.column("text"):
            parts = list(grams.of(text.as_py())) or [np.zeros(0, np.int64)]
            where, count = np.unique(np.concatenate(parts), return_counts=True)
            at.append(where.astype(np.int32))
            n.append(count.astype(np.int32))
        columns = [batch.column("label"), batch.column("ord"), pa.array(at, pa.list_(pa.int32())), pa.array(n, pa.list_(pa.int32()))]
        yield pa.RecordBatch.from_arrays(columns, ["label", "ord", "at", "n"])


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def ftrl_weights(z: np.ndarray, n: np.ndarray, l1: float) -> np.ndarray:
    return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def fit(rows: list[tuple[int, np.ndarray, np.ndarray]], classes: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights (size, classes) and constants (classes) from rows (class, coordinates, values), in their order."""
    z, n = np.zeros((size, classes)), np.zeros((size, classes))
    zc, nc = np.zeros(classes), np.zeros(classes)
    for _ in range(EPOCHS):
        for y, at, x in rows:
            w = ftrl_weights(z[at], n[at], L1)
            wc = ftrl_weights(zc, nc, 0.0)
            off = _softmax(x @ w + wc)
            off[y] -= 1.0
            g = x[:, None] * off
            old = n[at]
            new = old + g * g
            z[at] += g - (np.sqrt(new) - np.sqrt(old)) / ALPHA * w
            n[at] = new
            zc += off - (np.sqrt(nc + off * off) - np.sqrt(nc)) / ALPHA * wc
            nc += off * off
    return ftrl_weights(z, n, L1), ftrl_weights(zc, nc, 0.0)


def temperature(logits: np.ndarray, classes: np.ndarray) -> float:
    """The divisor of the logits that makes ``classes`` likeliest, by golden-section search."""
    if not len(classes):
        return 1.0

    def loss(log_t: float) -> float:
        p = _softmax(logits / np.exp(log_t))[np.arange(len(classes)), classes]
        return -np.log(np.maximum(p, 1e-300)).mean()

    lo, hi, cut = -3.0, 3.0, (np.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = hi - cut * (hi - lo), lo + cut * (hi - lo)
        if loss(a) <= loss(b):
            hi = b
        else:
            lo = a
    return float(np.exp((lo + hi) / 2))


def _learn(idf: np.ndarray, classes: int):
    def run(table: pa.Table) -> pa.Table:
        order = np.lexsort((table.column("label").to_numpy(), table.column("ord").to_numpy()))
        table = table.combine_chunks().take(pa.array(order))
        labels = table.column("label").to_numpy()
        at, n = (table.column(c).combine_chunks() for c in ("at", "n"))
        ends = np.cumsum([0, *at.value_lengths().fill_null(0).to_pylist()])
        used, local = np.unique(at.flatten().to_numpy(), return_inverse=True)
        counts = n.flatten().to_numpy().astype(float)
        values = SCALE * counts * idf[used[local]]
        rows = []
        for k in range(len(labels)):
            span = slice(ends[k], ends[k + 1])
            rows.append((int(labels[k]), local[span], values[span] / max(1.0, counts[span].sum())))
        test = [r for k, r in enumerate(rows) if k % CALIBRATE == CALIBRATE - 1]
        weights, constants = fit([r for k, r in enumerate(rows) if k % CALIBRATE != CALIBRATE - 1], classes, len(used))
        logits = np.array([x @ weights[i] + constants for _, i, x in test]).reshape(-1, classes)
        heat = temperature(logits, np.array([r[0] for r in test], np.int64))
        some, cls = np.nonzero(weights)
        # Constants stand at -1, the temperature at -2.
        where = np.concatenate([used[some], np.full(classes, -1), [-2]])
        of = np.concatenate([cls, np.arange(classes), [0]])
        w = np.concatenate([weights[some, cls], constants, [heat]])
        return pa.table({"at": pa.array(where, pa.int32()), "class": pa.array(of, pa.int32()), "w": pa.array(w)})

    return run


class Model:
    """``languages`` (code-point order), weights by coordinate, constants and temperature."""

    def __init__(self, languages: list[str], at: np.ndarray, weights: np.ndarray, constants: np.ndarray, heat: float):
        self.languages, self.at, self.weights, self.constants, self.heat = languages, at, weights, constants, heat


def train(docs: DataFrame) -> Model:
    """A model from ``docs`` (text, lang); rows without lang are left out.

    Sampling goes by the hash of the text, so copies of a text are one row of the sample.
    """
    spark = docs.sparkSession
    written = stage(spark)
    known = docs.filter("lang is not null").select(text_of().alias("text"), F.col("lang").cast("string").alias("lang"))
    known = known.withColumn("ord", F.xxhash64("text"))
    sizes = known.groupBy("lang").agg(F.count(F.lit(1)).alias("rows"), F.approx_count_distinct("ord").alias("texts"))
    top = sizes.orderBy(F.desc("rows"), "lang").limit(LANGUAGES).collect()
    languages = sorted(r["lang"] for r in top)
    if not languages:
        return Model([], np.zeros(0, np.int64), np.zeros((0, 0), np.float32), np.zeros(0), 1.0)
    part = TRAIN_ROWS / len(languages)
    shares = [(r["lang"], languages.index(r["lang"]), min(1.0, part / max(1, r["texts"]))) for r in top]
    share = spark.createDataFrame(shares, "lang string, label int, share double")
    drawn = F.pmod(F.col("ord"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    # LANGUAGES rows at most.
    picked = known.join(F.broadcast(share), "lang").filter(drawn < F.col("share"))
    sample = written.write(picked.groupBy("label", "ord").agg(F.min("text").alias("text")))
    rows = written.write(sample.mapInArrow(trimmed(_counted), "label int, ord long, at array<int>, n array<int>"))
    idf = inverse_frequencies(document_frequencies(known))
    learned = rows.groupBy(F.lit(0).alias("model")).applyInArrow(_learn(idf, len(languages)), "at int, class int, w double").toPandas()
    at, cls, w = (learned[c].to_numpy() for c in ("at", "class", "w"))
    where, slot = np.unique(at[at >= 0].astype(np.int64), return_inverse=True)
    weights = np.zeros((len(where), len(languages)), np.float32)
    weights[slot, cls[at >= 0]] = w[at >= 0] * SCALE * idf[at[at >= 0]]
    constants = np.zeros(len(languages))
    constants[cls[at == -1]] = w[at == -1]
    return Model(languages, where, weights, constants, float(w[at == -2][0]) if (at == -2).any() else 1.0)


def predictor(spark, model: Model):
    """A column function from text to ``lang`` and ``score``."""
    # Plain arrays: the workers need no class of this package to read them.
    shared = spark.sparkContext.broadcast((model.languages, model.at, model.weights, model.constants, model.heat))

    def predict(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        (languages, at, weights, constants, heat), grams = shared.value, Grams()
        # Coordinates without weight share the last, empty row.
        slot = np.full(DIMENSIONS, len(at), np.int64)
        slot[at] = np.arange(len(at))
        table = [np.append(weights[:, k], np.float32(0)) for k in range(len(languages))]
        for column in columns:
            names, scores = [], []
            for text in column:
                total, n = np.zeros(len(languages)), 0
                for part in grams.of(text.as_py()):
                    rows = slot[part]
                    n += len(rows)
                    total += [w[rows].sum(dtype=np.float64) for w in table]
                if not n or not languages:
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                p = _softmax((total / n + constants) / heat)
                best = int(p.argmax())
                names.append(languages[best])
                scores.append(round(float(p[best]), 9))
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang", "score"])

    @F.arrow_udf("lang string, score double")
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from trimmed(predict)(columns)

    return run


def held_out(id_name: str = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves 2 when divided by 4; null id: as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_name).cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2


def identified(docs: DataFrame) -> DataFrame:
    """Per row: ``doc_id, held_out, lang_pred, score``.

    Learned from text and lang of the rows that are not held out. Texts that are null or have no
    letter are ``und`` with score 0; so are all if there is nothing to learn from. With one label,
    that label has score 1. Repeated rows are alike, an empty table gives no rows, other columns play no part.
    """
    model = train(docs.filter(~held_out()).select("text", "lang"))
    run = predictor(docs.sparkSession, model)
    found = docs.select("doc_id", held_out().alias("held_out"), run(text_of()).alias("found"))
    return found.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"))
