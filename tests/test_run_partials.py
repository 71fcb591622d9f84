"""Partials of runs: every result row is aggregated once, and their merge gives what the rows give."""

from collections import Counter

from casemill.operators import run_state

TYPE = (
    "run string, doc_id string, file_name string, status string, warnings array<string>, llm_calls long, input_tokens long, output_tokens long, "
    "extraction struct<email: string, complaint_category: string, overall_case_status: string, priority: string, escalation_required: string, is_complaint: string>"
)


def results(spark):
    rows = []
    for i in range(400):
        record = None if i % 11 == 0 else (f"a{i % 50}@b.example", f"category {i % 9}", None if i % 13 == 0 else f"state {i % 5}", f"priority {i % 4}", "Yes", "No")
        status = "FAILED" if record is None else "SUCCESS"
        rows.append((f"run{i % 7}", f"d{i}", None if i % 17 == 0 else f"F{i % 100}.txt", status, ["w"] * (i % 2), i % 3, None, i, record))
    return spark.createDataFrame([*rows, *rows[:20]], TYPE), [*rows, *rows[:20]]


def test_partials_aggregate_the_rows_before_they_are_laid_out_for_each_attribute(spark):
    plan = run_state.partials(results(spark)[0], "run1")._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" in plan.split("Expand", 1)[1]


def test_merged_partials_give_what_the_rows_give(spark):
    df, rows = results(spark)
    stored = run_state.partials(df, df["run"])
    totals = run_state.merged_totals(stored).first().asDict()
    assert (totals["files_total"], totals["runs"], totals["senders"]) == (len(rows), 7, 50)
    assert totals["status_failed"] == sum(r[8] is None for r in rows) and totals["output_tokens"] == sum(r[7] for r in rows)
    assert (totals["llm_calls"], totals["input_tokens"], totals["documents_with_warnings"]) == (sum(r[5] for r in rows), 0, sum(map(bool, (r[4] for r in rows))))
    counted = {(r.attribute, r.value): r.documents for r in run_state.merged_value_counts(stored).collect()}
    fields = {"category": 1, "case_status": 2, "priority": 3}
    expected = Counter((a, r[8][k]) for r in rows if r[8] for a, k in fields.items() if r[8][k] is not None)
    assert counted == dict(expected)
