"""Prompts are counted without being put together."""

from pyspark.sql import functions as F

from casemill.functions import prompts
from casemill.params import Params
from casemill.plans import batch


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_prompts_are_counted_as_they_are_put_together(spark):
    rows = spark.createDataFrame(
        [("a.txt", "plain text", "x", ["one", "two é"]), ("ü.txt", "café 😀  ", "\"quoted\"\n", []), ("c.txt", "", "", None), ("d.txt", None, "x", None)],
        "file_name string, text string, name string, issues array<string>",
    ).withColumn("record", F.struct("name"))
    chars = F.length(F.to_json("record"))
    counted = rows.select(
        prompts.record_user_chars(F.col("file_name"), F.length("text")).alias("a"),
        F.length(prompts.record_user(F.col("file_name"), F.col("text"))).alias("b"),
        prompts.draft_user_chars(chars, F.length("text"), F.col("issues")).alias("c"),
        F.length(prompts.draft_user(F.col("record"), F.col("text"), F.col("issues"))).alias("d"),
    ).collect()
    assert all(r["a"] == r["b"] and r["c"] == r["d"] for r in counted)
    assert [r["a"] is None for r in counted] == [False, False, False, True]


def test_a_run_puts_no_prompt_together_to_count_it(spark):
    table = spark.createDataFrame([("1", "My name is Ann Lee. The parcel is late.")], "id string, text string")
    assert prompts.RECORD_OPEN not in plan(batch.process_table(table, "id", "text", Params()))
