"""Incremental folder intake with the same row transforms as the batch run."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casemill.functions import text as T
from casemill.operators import assemble
from casemill.params import Params, RunMeta
from casemill.plans import batch
from casemill.sources import caserun, sinks
from casemill.sources.manifest import discover, size_error, with_name_parts
from casemill.sources.readers import apply_readers

BINARY_FILE_TYPE = "path string, modificationTime timestamp, length bigint, content binary"


def arriving_files(spark: SparkSession, folder: str, max_files_per_batch: int = 1000) -> DataFrame:
    """Stream of the files that appear in ``folder``, whatever their type."""
    files = (
        spark.readStream.format("binaryFile").schema(BINARY_FILE_TYPE)
        .option("maxFilesPerTrigger", max_files_per_batch).load(folder)
    )
    return files.withColumn("file_name", F.element_at(F.split("path", "/"), -1))


def stream_results(files: DataFrame, params: Params | None = None, read_with: dict | None = None) -> DataFrame:
    """Result rows of a stream of files. Every step is a row transform, so no state is kept.

    Whether a stem is shared is not known yet, so ids are the file names' stems.
    """
    params = params or Params()
    named = with_name_parts(files).withColumn("doc_id", T.stem(F.col("file_name")))
    loaded = named.filter("supported").withColumn("load_error", size_error(params))
    documents = assemble.prepare_text(apply_readers(loaded, read_with), "raw_text", params.max_document_chars).select(
        "doc_id", "file_name", "file_type", "text", "truncated", "load_error"
    )
    return assemble.with_skipped(batch.process(documents, params), assemble.skipped_rows(named))


def unseen_inputs(spark: SparkSession, folder: str, results: DataFrame) -> DataFrame:
    """Files of ``folder`` without a result row: new ones, and those a file stream never lists (empty, or named with ``_``)."""
    return discover(spark, folder).join(results.select("file_name"), "file_name", "left_anti")


def publish_batch(rows: DataFrame, batch_id: int, out_dir: str, meta: RunMeta) -> None:
    """Publish one batch of a stream under the key (run, batch).

    The result rows replace those of an earlier attempt at the batch, and the documents are published
    once, so a batch that is replayed after a failure writes nothing twice.
    """
    spark, key = rows.sparkSession, f"{meta.run_id}-{batch_id}"
    path = f"{out_dir}/{batch.RESULTS_DIR}/run_id={key}"
    if caserun.is_published(spark, out_dir, key):
        return
    rows.write.mode("overwrite").parquet(path)
    written = spark.read.schema(rows.schema).parquet(path)
    sinks.write_documents(written, replace(meta, run_id=key), out_dir, clean=False)


def run_available(
    spark: SparkSession, folder: str, out_dir: str, checkpoint: str, params: Params | None = None, meta: RunMeta | None = None
) -> DataFrame:
    """Process what has arrived since the last call and stop; returns the result rows of all batches so far.

    ``meta.run_id`` names the stream: give the same one with the same checkpoint.
    """
    meta = meta or RunMeta("stream")
    rows = stream_results(arriving_files(spark, folder), params)
    query = (
        rows.writeStream.foreachBatch(lambda found, batch_id: publish_batch(found, batch_id, out_dir, meta))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema(rows.schema).option("recursiveFileLookup", True).parquet(f"{out_dir}/{batch.RESULTS_DIR}")
