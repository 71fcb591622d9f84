"""Totals over many runs from the partial aggregates that each run has stored.

A run stores one row of totals and one row for each category, case status and priority, with a sketch
of the senders in the totals. All of it can be merged: counts add up, the place of the first document is
a minimum, sketches unite. Results are read once, by the run itself; what merges runs reads partials only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from casemill import fixed_values as V
from casemill.operators import report
from casemill.params import RunMeta

PARTIALS_DIR = "run_partials"
#: Attribute of a run's row of totals.
TOTAL = "total"


def partials(results: DataFrame, run_id: Column | str) -> DataFrame:
    """``run_id, attribute, value, documents, first_place``, and in the rows of totals the scalars and ``senders``.

    ``run_id`` may be a column of ``results``; then all of its runs come from one pass.
    """
    names = list(report.COUNTED)
    run = F.lit(run_id) if isinstance(run_id, str) else run_id
    sender = F.nullif(F.coalesce("extraction.email", F.lit(V.NOT_PROVIDED)), F.lit(V.NOT_PROVIDED))
    narrow = report.narrow(results, run.alias("run_id"), sender.alias("sender"))
    # Rows are aggregated once, by all values together; what is grouped again for each attribute are the few rows left of that.
    whole = narrow.groupBy("run_id", *names).agg(
        F.count_if("has_record").alias("documents"), F.min("place").alias("first_place"),
        F.hll_sketch_agg("sender").alias("senders"), *report.scalars(),
    )
    counts = [c for c in whole.columns if c not in ("run_id", "first_place", "senders", *names)]
    sets = [[F.col("run_id"), F.col(a)] for a in names] + [[F.col("run_id")]]
    grouped = whole.groupingSets(sets, "run_id", *names).agg(
        F.grouping_id().alias("gid"), F.min("first_place").alias("first_place"),
        F.hll_union_agg("senders").alias("senders"), *[F.sum(c).alias(c) for c in counts],
    )
    every = grouped.withColumns({"attribute": F.coalesce(report.attribute(), F.lit(TOTAL)), "value": F.coalesce(*names)})
    # Documents without a record have no value.
    kept = every.filter(f"attribute = '{TOTAL}' OR value IS NOT NULL")
    totals = [F.when(F.col("attribute") == TOTAL, F.col(c)).alias(c) for c in ("senders", *counts) if c != "documents"]
    return kept.select("run_id", "attribute", "value", "documents", "first_place", *totals)


def write_partials(results: DataFrame, meta: RunMeta, out_dir: str) -> None:
    """Store the partials of a run; storing them again replaces them."""
    path = f"{out_dir}/{PARTIALS_DIR}/run_id={meta.run_id}"
    partials(results, meta.run_id).drop("run_id").write.mode("overwrite").parquet(path)


def read_partials(spark: SparkSession, out_dir: str) -> DataFrame:
    return spark.read.parquet(f"{out_dir}/{PARTIALS_DIR}")


def merged_totals(stored: DataFrame) -> DataFrame:
    """The scalars of all runs together, the number of runs, and about how many senders there are."""
    scalars = [c for c in stored.columns if c not in ("run_id", "attribute", "value", "documents", "first_place", "senders")]
    totals = stored.filter(F.col("attribute") == TOTAL)
    return totals.agg(
        *[F.coalesce(F.sum(c), F.lit(0).cast("bigint")).alias(c) for c in scalars],
        F.count(F.lit(1)).alias("runs"), F.hll_sketch_estimate(F.hll_union_agg("senders")).alias("senders"),
    )


def merged_value_counts(stored: DataFrame) -> DataFrame:
    """``attribute, value, documents, rank`` over all runs, as ``report.value_counts`` gives them for one."""
    counted = stored.filter(F.col("attribute") != TOTAL).groupBy("attribute", "value")
    counted = counted.agg(F.sum("documents").alias("documents"), F.min("first_place").alias("first_place"))
    # At most ten values per attribute.
    order = Window.partitionBy("attribute").orderBy(F.desc("documents"), "first_place")
    return counted.select("attribute", "value", "documents", F.row_number().over(order).cast("bigint").alias("rank"))
