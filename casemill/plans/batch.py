"""The whole run: inputs in, one result row per input out."""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass, replace
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casemill.functions import classify, patterns, prompts
from casemill.functions.once import once
from casemill.operators import assemble, drafting, grounding, report, run_state, verify
from casemill.operators.asking import Answers, Model
from casemill.params import Params, RunMeta
from casemill.session import Stage
from casemill.sources import manifest as M
from casemill.sources import readers, sinks

RESULTS_DIR = "results"


def extract(
    documents: DataFrame, params: Params, model: Model | None = None, stage: Stage | None = None, answers: Answers | None = None
) -> DataFrame:
    """Add the record of every document with text, by rules or by a model."""
    if model is not None:
        return drafting.extract_with_model(documents, model, params, stage, answers)
    ready = F.col("text").isNotNull()
    chars = drafting.SIZES[1]
    counted = documents.withColumn(chars, once(F.length("text")))
    told = counted.withColumn(patterns.ASCII, once(patterns.is_ascii(F.col("text"), F.col(chars))))
    ruled = classify.extract_record(told)
    spent = prompts.tokens_of(
        F.lit(len(prompts.RECORD_SYSTEM)), prompts.record_user_chars(F.col("file_name"), F.col(drafting.SIZES[1]))
    )
    zero = F.lit(0).cast("bigint")
    return ruled.withColumn("extraction", F.when(ready, F.col("extraction"))).withColumns(
        {
            "extraction_error": F.lit(None).cast("string"),
            "extraction_input_tokens": F.when(ready, spent).otherwise(zero),
            "extraction_output_tokens": F.when(
                ready, prompts.estimate_tokens(F.to_json("extraction"))
            ).otherwise(zero),
            "extraction_calls": F.when(ready, F.lit(1)).otherwise(F.lit(0)).cast("bigint"),
        }
    )


def process(
    documents: DataFrame,
    params: Params,
    extraction_model: Model | None = None,
    generation_model: Model | None = None,
    stage: Stage | None = None,
    answers: Answers | None = None,
) -> DataFrame:
    """Result rows for prepared documents (doc_id, file_name, file_type, text, truncated, load_error).

    Without models every step is a column expression on the row: the plan has no shuffle. With a
    model, ``answers`` keeps what it said, so that a run started again asks only what is open.
    """
    rows = extract(documents, params, extraction_model, stage, answers)
    if generation_model is None:  # the tables between the waves of a model need not hold the views
        rows = grounding.source_views(rows, F.col("text"))
    rows = verify.verify_record(rows).drop(patterns.ASCII)
    if generation_model is None:
        rows = drafting.with_sizes(rows)
        for task in drafting.TASKS:
            rows = drafting.draft_with_templates(rows, task, params)
    else:
        # Once, with the keys of the drafts; the tables of the waves hold no texts.
        rows = stage.write(drafting.with_keys(rows, drafting.TASKS, params))
        outcomes = {task: drafting.draft_outcomes(rows, task, generation_model, params, stage, answers=answers) for task in drafting.TASKS}
        rows = drafting.with_outcomes(rows, outcomes, params)
    return assemble.results(rows, params.max_document_chars)


def process_table(
    table: DataFrame,
    doc_id: str,
    text: str,
    params: Params | None = None,
    file_type: str = "txt",
    where: Column | str | None = None,
    **models,
) -> DataFrame:
    """Result rows for documents that already are rows of a table.

    ``where`` picks rows of the table before any text is looked at, so it reaches the scan; a filter
    on the result rows stays above the text rules.
    """
    params = params or Params()
    table = table if where is None else table.filter(where)
    documents = table.select(
        F.col(doc_id).cast("string").alias("doc_id"),
        F.concat(F.col(doc_id).cast("string"), F.lit(f".{file_type}")).alias("file_name"),
        F.lit(file_type).alias("file_type"),
        F.col(text).alias("raw_text"),
    )
    return process(assemble.prepare_text(documents, "raw_text", params.max_document_chars).drop("raw_text"), params, **models)


def process_folder(
    spark: SparkSession,
    folder: str,
    params: Params | None = None,
    read_with: dict[str, readers.Reader] | None = None,
    **models,
) -> DataFrame:
    """Result rows for every file of a folder, unreadable and unsupported ones included."""
    params = params or Params()
    named = M.with_doc_ids(M.discover(spark, folder))
    raw = readers.read_documents(named, params, read_with)
    documents = assemble.prepare_text(raw, "raw_text", params.max_document_chars).select(
        "doc_id", "file_name", "file_type", "text", "truncated", "load_error"
    )
    return assemble.with_skipped(process(documents, params, **models), assemble.skipped_rows(named))


def new_run(provider: str = "template", model: str = "rules-v1", prompt_version: str = "1.0") -> RunMeta:
    now = datetime.now(timezone.utc).isoformat(timespec="seconds")
    return RunMeta(uuid.uuid4().hex[:12], provider, model, prompt_version, started_at=now, processed_at=now)


@dataclass(frozen=True)
class Run:
    results: DataFrame
    meta: RunMeta
    elapsed: float
    counters: dict[str, int]


def run(
    spark: SparkSession,
    folder: str,
    out_dir: str,
    params: Params | None = None,
    clean: bool = True,
    meta: RunMeta | None = None,
    answers_dir: str | None = None,
    **options,
) -> Run:
    """Process a folder and write every output.

    The result rows are written once, as an output of their own, and every other output is
    derived from them, so no document is processed, and no model asked, a second time.
    Tables written between the steps of a model are deleted when the run ends; answers in
    ``answers_dir`` stay, and a run with the same folder does not ask for them again.
    """
    started = time.perf_counter()
    meta = meta or new_run()
    stage = Stage(spark)
    model_stage = {"stage": stage} if {"extraction_model", "generation_model"} & options.keys() else {}
    if answers_dir is not None:
        model_stage["answers"] = Answers(spark, answers_dir)
    path = f"{out_dir}/{RESULTS_DIR}/run_id={meta.run_id}"
    try:
        rows, seen = report.counted(process_folder(spark, folder, params, **options, **model_stage))
        rows.write.mode("overwrite").parquet(path)
        counters = seen.get
    finally:
        stage.release()
    results = spark.read.schema(rows.schema).parquet(path)
    meta = replace(meta, processed_at=meta.processed_at or meta.started_at)
    sinks.write_documents(results, meta, out_dir, clean)
    sinks.write_report(results, out_dir)
    run_state.write_partials(results, meta, out_dir)
    elapsed = time.perf_counter() - started
    finished = datetime.now(timezone.utc).isoformat(timespec="seconds")
    sinks.write_run_summary(results, meta, elapsed, finished, out_dir)
    return Run(results, meta, elapsed, counters)
