"""Document fingerprints by one-permutation MinHash.

Every run of five words is hashed once; the top bits choose one of ``BINS`` bins, and each bin keeps
its smallest hash. An empty bin takes the value of a bin chosen by its own fixed random order of all
bins: the first in it that is not empty (optimal densification; the order depends on the bin alone,
so two sets borrow alike). The fingerprint packs the low ``BITS`` bits of each bin. Two bins of
different sets agree by chance in 2^-BITS of cases; the likeness corrects for that.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemill.llm.common import stage, text_of
from casemill.llm.words import mix, shingle_numbers, word_numbers

BINS, BITS = 256, 8
#: Slices of the id range per shuffle partition, so that partitions come out even.
SLICES = 4


@lru_cache
def _orders() -> np.ndarray:
    """For each bin, all bins in a random order that never changes."""
    cells = np.arange(BINS * BINS, dtype=np.uint64)
    return np.argsort(mix(cells + np.uint64(977)).reshape(BINS, BINS), axis=1)


def signatures(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A row of ``BINS`` bytes for each text, and whether it has any word (rows without are zero)."""
    sets = shingle_numbers(*word_numbers(pa.array(texts, pa.large_string())))
    sizes = np.array([len(s) for s in sets], np.int64)
    low = np.full((len(texts), BINS), np.iinfo(np.uint64).max, np.uint64)
    if sizes.any():
        hashes = mix(np.concatenate(sets) + np.uint64(53))
        owner = np.repeat(np.arange(len(texts)), sizes)
        np.minimum.at(low.reshape(-1), owner * BINS + (hashes >> np.uint64(56)).astype(np.int64), hashes & np.uint64((1 << 56) - 1))
    empty = low == np.iinfo(np.uint64).max
    some = sizes > 0
    at, bins = np.nonzero(empty & some[:, None])
    orders = _orders()
    for k in range(BINS):
        if not len(at):
            break
        donor = orders[bins, k]
        fits = ~empty[at, donor]
        low[at[fits], bins[fits]] = low[at[fits], donor[fits]]
        at, bins = at[~fits], bins[~fits]
    out = (mix(low) & np.uint64((1 << BITS) - 1)).astype(np.uint8)
    out[~some] = 0
    return out, some


def likeness(a: np.ndarray, b: np.ndarray, a_some: np.ndarray, b_some: np.ndarray) -> np.ndarray:
    """Estimated similarity, 0 to 1; two texts without words are alike, one without is unlike."""
    chance = 2.0**-BITS
    share = (a == b).mean(axis=1)
    near = np.clip((share - chance) / (1 - chance), 0.0, 1.0)
    return np.where(a_some & b_some, near, (a_some == b_some).astype(float))


def _hex(rows: np.ndarray, some: np.ndarray) -> list[str]:
    return [r.tobytes().hex() if s else "" for r, s in zip(rows, some, strict=True)]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by slice and in order; every slice ends with the first row of the next one."""
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    held: list[tuple] = []
    for batch in batches:
        rows = held + list(zip(*(batch.column(c).to_pylist() for c in ("part", "ahead", "doc_id", "text")), strict=True))
        held = rows[-1:]
        at = [i for i, (a, b) in enumerate(pairwise(rows)) if not a[1] and a[0] == b[0]]
        if not at:
            continue
        edited = [rows[i][3][: len(rows[i][3]) - len(rows[i][3]) // 2] + rows[i + 1][3][: len(rows[i][3]) // 2] for i in at]
        own, own_some = signatures([r[3] for r in rows])
        new, new_some = signatures(edited)
        here, there = np.array(at), np.array(at) + 1
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([rows[i][2] for i in at], batch.column("doc_id").type),
                pa.array([len(rows[i][3]) for i in at], pa.int64()),
                pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited]),
                pa.array(_hex(own[here], own_some[here])), pa.array(_hex(new, new_some)),
                pa.array(likeness(own[here], new, own_some[here], new_some)),
                pa.array(likeness(own[here], own[there], own_some[here], own_some[there])),
            ],
            names,
        )


def edited_likeness(docs: DataFrame) -> DataFrame:
    """Per row: ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.

    Documents stand in order of id (null last), rows of one id in order of a hash of their text. The
    id range is cut into slices by approximate quantiles; the first row of each slice also goes to
    the slice before it, so every row meets its successor, and no slice sees more than its share.
    Texts move once. Null counts as empty; texts without words have an empty fingerprint. A single
    row follows itself; an empty table gives no rows.
    """
    spark = docs.sparkSession
    written = stage(spark)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    parts = SLICES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [k / parts for k in range(1, parts)]
    cuts = docs.agg(F.percentile_approx("doc_id", shares, 100 * parts)).first()[0] or []
    part = F.when(F.col("doc_id").isNull(), F.lit(parts)).otherwise(
        F.size(F.filter(F.array(*map(F.lit, sorted(set(cuts)))).cast("array<bigint>"), lambda c: c <= F.col("doc_id")))
    )
    rows = docs.select("doc_id", text_of().alias("text")).select("doc_id", "text", F.xxhash64("text").alias("digest"), part.alias("part"))
    # One row per slice: its first, and which slice comes before it, round the end.
    firsts = rows.groupBy("part").agg(F.min(F.struct(F.coalesce("doc_id", F.lit(0)).alias("i"), "digest")).alias("f"))
    firsts = sorted(firsts.collect(), key=lambda r: r["part"])
    if not firsts:
        return docs.sparkSession.createDataFrame([], _schema(id_type))
    before = {r["part"]: firsts[k - 1]["part"] for k, r in enumerate(firsts)}
    heads = F.inline(F.array(*(F.struct(
        F.lit(r["part"]).alias("part"), F.lit(r["f"]["i"]).cast("long").alias("first_id"),
        F.lit(r["f"]["digest"]).cast("long").alias("first_digest"), F.lit(before[r["part"]]).alias("before"),
    ) for r in firsts)))
    heads = F.broadcast(spark.range(1).select(heads))
    leads = (F.coalesce("doc_id", F.lit(0)) == F.col("first_id")) & (F.col("digest") == F.col("first_digest"))
    goes = F.when(leads, F.array(F.struct("part", F.lit(False).alias("ahead")), F.struct(F.col("before").alias("part"), F.lit(True).alias("ahead"))))
    goes = goes.otherwise(F.array(F.struct("part", F.lit(False).alias("ahead"))))
    dealt = rows.join(heads, "part").select("doc_id", "text", "digest", F.inline(goes))
    dealt = dealt.repartition(parts // SLICES, "part").sortWithinPartitions("part", "ahead", F.asc_nulls_last("doc_id"), "digest")
    return dealt.select("part", "ahead", "doc_id", "text").mapInArrow(_compare, _schema(id_type))


def _schema(id_type: str) -> str:
    return (
        f"doc_id {id_type}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
