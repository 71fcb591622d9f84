"""Facts of drafts are looked up in the source and in the allowed text as they are, without a copy of both."""

import re

from pyspark.sql import functions as F

from casemill.operators import grounding
from casemill.params import Params
from casemill.plans import batch


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_drafts_are_checked_without_copies_of_the_source(spark):
    table = spark.createDataFrame([("1", "My name is Ann Lee. The parcel is late.")], "id string, text string")
    assert not re.search("_ref_lower|_ref_closed", plan(batch.process_table(table, "id", "text", Params())))


def test_facts_stand_in_the_source_or_in_the_allowed_text(spark):
    rows = spark.createDataFrame(
        [(1, "paid $5, call 613-555", "write to INFO@shop.example, ab-123, 613-555-0199, $5.00 or $7"), (2, None, "a@b.example AB-123"), (3, "x", None),
         (4, "é ab-123 a@b.example", "AB-123 or a@b.example or AB-1239 é")],
        "i int, s string, d string",
    )
    allowed = F.lit("0199 Info@Shop.example\nAB-123 $7")
    issues = {r["i"]: r["issues"] for r in grounding.check_grounding(rows, F.col("d"), F.col("s"), allowed).collect()}
    assert issues == {
        1: ["ungrounded_phone: 613-555-0199"], 2: ["ungrounded_email: a@b.example"], 3: None, 4: ["ungrounded_reference: AB-1239"],
    }
    assert grounding.check_grounding(rows, F.col("d"), F.col("s"), allowed).columns == ["i", "s", "d", "issues"]
