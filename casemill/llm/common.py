"""Small helpers of the operators: inputs, written stages, batch size."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casemill.session import Stage

#: Rows in an Arrow batch. Rows are whole texts, so the default of 10,000 would hold far too much at once.
BATCH_ROWS = 128


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(spark: SparkSession) -> Stage:
    """A place for written tables in the shared folder; also keeps the batches sent to Python small."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return Stage(spark)


def text_of(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def trimmed(run: Callable) -> Callable:
    """``run`` for Arrow batches, after which the worker hands freed memory back.

    Worker processes outlive their tasks, and several wait beside the executor; what the allocators
    keep for later would add up over the stages of a job.
    """

    def and_trim(batches: Iterator) -> Iterator:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)

    return and_trim


def wrapped(docs: DataFrame) -> DataFrame:
    """All columns as one, ``_row``, so that no name of theirs meets a helper's name in a join."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"))


#: Bits of the map in ``reduced``: for each key so many, within these bounds (1 to 64 MB), in pieces of 4 KB.
BITS_PER_KEY, LEAST_BITS, MOST_BITS, _PIECE = 16, 1 << 23, 1 << 29, 32768


def reduced(rows: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """``rows`` without most of those whose ``key`` is not in ``wanted``, a written table: a step before a join.

    The hashes of the wanted keys set bits of a map, which goes to every task; rows whose bit is not set
    cannot join, so they need not be shuffled. The map grows with the number of keys up to 64 MB; beyond
    some 30 million keys it spares fewer rows. The join after it decides.
    """
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_PER_KEY * wanted.count()).bit_length()))

    def bit(column: Column) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(bits))

    marks = wanted.select(bit(F.col(key)).alias("_bit"))
    pieces = marks.groupBy(F.floor(F.col("_bit") / _PIECE).alias("_piece")).agg(
        F.bitmap_construct_agg(F.col("_bit") % _PIECE).alias("_map")
    )
    at = bit(F.col(key))
    byte = F.conv(F.hex(F.substring(F.col("_map"), (F.floor((at % _PIECE) / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    is_set = F.call_function("getbit", byte, (at % 8).cast("int")) == 1
    return rows.join(F.broadcast(pieces), (F.floor(at / _PIECE) == F.col("_piece")) & is_set).select(*rows.columns)
