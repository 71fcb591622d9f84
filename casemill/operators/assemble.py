"""From inputs to one result row per input: ids, statuses, warnings, errors, outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casemill import fixed_values as V
from casemill.functions import text as T
from casemill.functions.once import apart
from casemill.operators.keys import attach_group_size

_TEXTS = "array<string>"


def _no_texts() -> Column:
    return F.array().cast(_TEXTS)


def assign_doc_ids(manifest: DataFrame) -> DataFrame:
    """Add ``doc_id``: the stem, or stem and extension where supported files share a stem.

    Unsupported files always keep the bare stem. ``path`` identifies a row.
    """
    supported = attach_group_size(manifest.filter("supported"), "stem", "path", "_same")
    named = supported.withColumn(
        "doc_id",
        F.when(F.col("_same") > 1, F.concat_ws("_", "stem", "file_type")).otherwise(F.col("stem")),
    ).drop("_same")
    return named.unionByName(manifest.filter("NOT supported").withColumn("doc_id", F.col("stem")))


def duplicate_ids(manifest: DataFrame) -> DataFrame:
    """Ids still shared by several supported files (names that differ only in letter case)."""
    return (
        manifest.filter("supported").groupBy("doc_id").agg(F.count(F.lit(1)).alias("files")).filter("files > 1")
    )


def unsupported(ext: Column) -> Column:
    """Code of an input of a type that no reader takes."""
    return F.concat(F.lit("unsupported_type: "), ext)


def skipped_rows(manifest: DataFrame) -> DataFrame:
    """Result rows for the inputs of unsupported type."""
    return manifest.filter("NOT supported").select(
        "doc_id",
        "file_name",
        F.coalesce(F.nullif("file_type", F.lit("")), F.lit("unknown")).alias("file_type"),
        F.lit("SKIPPED").alias("status"),
        F.array(unsupported(F.col("ext"))).alias("errors"),
    )


def prepare_text(df: DataFrame, raw: str, max_chars: int | None = None) -> DataFrame:
    """Add ``text``, ``truncated`` and ``load_error`` from raw text.

    A row with an earlier ``load_error`` keeps it; a row with any error has no text.
    """
    known = F.col("load_error") if "load_error" in df.columns else F.lit(None).cast("string")
    hint = F.when(F.col("file_type") == "pdf", F.lit(": pictures only, perhaps")).otherwise(F.lit(""))
    full = df.withColumn("_known", known).withColumns(apart({"_full": T.normalise(F.col(raw))}))
    judged = full.withColumn(
        "load_error",
        F.coalesce(
            F.col("_known"), F.when(T.too_short(F.col("_full")), F.concat(F.lit("no_text"), hint))
        ),
    )
    return judged.withColumns(
        {
            "text": F.when(F.col("load_error").isNull(), T.truncate(F.col("_full"), max_chars)),
            "truncated": F.col("load_error").isNull() & T.is_truncated(F.col("_full"), max_chars),
        }
    ).drop("_known", "_full")


def processing_status(
    load_error: Column, extraction: Column, email: Column, summary: Column, sink_error: Column | None = None
) -> Column:
    complete = email.isNotNull() & summary.isNotNull()
    if sink_error is not None:
        complete = complete & sink_error.isNull()
    return (
        F.when(load_error.isNotNull() | extraction.isNull(), "FAILED").when(complete, "SUCCESS").otherwise("PARTIAL")
    )


def record_warnings(warnings: Column) -> Column:
    """Warnings kept with the record: everything that is not about grounding."""
    return F.filter(warnings, lambda w: ~F.contains(w, F.lit("grounding")))


def output_name(folder: str, doc_id: Column) -> Column:
    return F.concat(F.lit(f"{folder}:"), doc_id)


def output_files(doc_id: Column, extraction: Column, email: Column, summary: Column) -> Column:
    """The outputs a row has, as data set and key in it, by report column."""

    def entry(present: Column, column: str, folder: str) -> Column:
        name = output_name(folder, doc_id)
        return F.when(present, F.struct(F.lit(column).alias("key"), name.alias("value")))

    return F.map_from_entries(
        F.array_compact(
            F.array(
                entry(extraction.isNotNull(), "structured_data_file", V.STRUCTURED_DIR),
                entry(email.isNotNull(), "customer_email_file", V.EMAILS_DIR),
                entry(summary.isNotNull() & extraction.isNotNull(), "case_summary_file", V.SUMMARIES_DIR),
            )
        )
    )


def _prefixed(prefix: str, error: str) -> Column:
    return F.when(F.col(error).isNotNull(), F.concat(F.lit(f"{prefix}: "), F.col(error)))


def results(df: DataFrame, max_chars: int | None = None) -> DataFrame:
    """One result row per processed document from the columns the stages have added."""
    cut = F.when(F.col("truncated"), F.array(F.lit(f"text_cut: {max_chars}")))

    def summed(part: str) -> Column:
        stages = ["extraction", "customer_email", "case_summary"]
        total = F.lit(0).cast("bigint")
        for name in stages:
            total = total + F.coalesce(F.col(f"{name}_{part}"), F.lit(0))
        return total

    merged = df.withColumns(
        {
            "warnings": F.concat(
                *[
                    F.coalesce(w, _no_texts())
                    for w in (
                        cut,
                        F.col("verify_warnings"),
                        F.col("customer_email_warnings"),
                        F.col("case_summary_warnings"),
                    )
                ]
            ),
            "errors": F.array_compact(
                F.array(
                    _prefixed("load", "load_error"),
                    _prefixed("record", "extraction_error"),
                    _prefixed("customer_email", "customer_email_error"),
                    _prefixed("case_summary", "case_summary_error"),
                )
            ),
            "input_tokens": summed("input_tokens"),
            "output_tokens": summed("output_tokens"),
            "llm_calls": summed("calls"),
            "status": processing_status(
                F.col("load_error"), F.col("extraction"), F.col("customer_email"), F.col("case_summary")
            ),
            "output_files": output_files(
                F.col("doc_id"), F.col("extraction"), F.col("customer_email"), F.col("case_summary")
            ),
        }
    )
    timed = [s for s in ("extraction", "customer_email", "case_summary") if f"{s}_seconds" in df.columns]
    seconds = F.create_map(
        *[x for s in timed for x in (F.lit(s), F.coalesce(F.col(f"{s}_seconds"), F.lit(0.0)))]
    ).cast("map<string,double>")
    return merged.select(
        "doc_id", "file_name", "file_type", "status", "extraction",
        F.col("customer_email").alias("email"), F.col("case_summary").alias("summary"),
        "warnings", "errors", seconds.alias("stage_seconds"),
        "input_tokens", "output_tokens", "llm_calls", "output_files",
        F.aggregate(F.map_values(seconds), F.lit(0.0), lambda a, b: a + b).alias("processing_seconds"),
    )


def with_sink_errors(results: DataFrame, failed: DataFrame) -> DataFrame:
    """Result rows with the failures of a sink that takes documents one by one.

    ``failed`` has ``doc_id`` and ``sink_error``. A document that was complete becomes partial and
    names the failure; the others keep their status and name it too.
    """
    joined = results.join(failed.select("doc_id", "sink_error"), "doc_id", "left")
    hit = F.col("sink_error").isNotNull()
    return joined.withColumns(
        {
            "status": F.when(hit & (F.col("status") == "SUCCESS"), "PARTIAL").otherwise(F.col("status")),
            "errors": F.when(hit, F.array_append("errors", F.concat(F.lit("outputs: "), "sink_error"))).otherwise(F.col("errors")),
        }
    ).select(results.columns)


def with_skipped(processed: DataFrame, skipped: DataFrame) -> DataFrame:
    """Processed and skipped inputs together: one row per input file."""
    both = processed.unionByName(skipped, allowMissingColumns=True)
    zero = F.lit(0).cast("bigint")
    return both.withColumns(
        {
            "warnings": F.coalesce("warnings", _no_texts()),
            "input_tokens": F.coalesce("input_tokens", zero),
            "output_tokens": F.coalesce("output_tokens", zero),
            "llm_calls": F.coalesce("llm_calls", zero),
            "processing_seconds": F.coalesce("processing_seconds", F.lit(0.0)),
        }
    )


def in_report_order(df: DataFrame) -> DataFrame:
    return df.orderBy(F.lower("file_name"), "file_name", "doc_id")
