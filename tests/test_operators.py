import json

import pytest
from pyspark.sql import functions as F

from casemill import fixed_values as V
from casemill.operators.asking import Answers
from casemill.operators import drafting, grounding, quality, score, validate, verify
from casemill.operators.keys import attach_group_size
from casemill.params import ParamError, Params
from casemill.session import Stage

BASE = {
    "customer_name": "Ilse Vargas", "email": "Ilse.Vargas@Mail.Example", "phone_number": "204-555-0167",
    "reference_number": "TKT-7781", "product_or_service": "Router", "complaint_category": "Delivery & Shipping",
    "issue_description": "The parcel came late.", "resolution_provided": "A voucher was sent.", "is_complaint": "Yes",
    "escalation_required": "No", "supporting_document_available": "Yes", "overall_case_status": "Resolved",
    "priority": "Low",
}
SOURCE = "From Tariq Omondi (tariq@post.example), tel. 204.555.0191, about ticket TKT-8833-07: €75.20 paid for nothing."
GOOD = {**BASE, "customer_name": "Tariq Omondi", "email": "tariq@post.example", "phone_number": "(204) 555 0191",
        "reference_number": "tkt-8833 -07"}


def parsed(spark, *answers):
    rows = [(i, a if isinstance(a, str) else json.dumps(a)) for i, a in enumerate(answers)]
    df = validate.parse_record(spark.createDataFrame(rows, "i int, raw string"), "raw")
    return sorted(df.collect())


def test_record_parsing(spark):
    no_email = {k: v for k, v in BASE.items() if k != "email"}
    rows = parsed(
        spark, BASE, {**BASE, "escalation_required": True, "extra": 1}, {**BASE, "phone_number": None},
        {**BASE, "overall_case_status": "Maybe"}, {**BASE, "is_complaint": "perhaps"}, no_email, "{broken", "[1]",
        {**BASE, "complaint_category": "Weird", "priority": "critical"},
    )
    assert rows[0].extraction.email == "ilse.vargas@mail.example"
    assert rows[1].extraction.escalation_required == "Yes"
    assert rows[2].extraction.phone_number == "Not Provided"
    assert rows[3].extraction is None and rows[3].validation_errors == ["invalid:overall_case_status"]
    assert rows[4].validation_errors == ["invalid:is_complaint"]
    assert rows[5].validation_errors == ["missing:email"]
    assert rows[6].validation_errors == rows[7].validation_errors == ["unparseable"]
    assert rows[8].extraction.complaint_category == "Other" and rows[8].extraction.priority == "Critical"


def test_draft_parsing(spark):
    df = spark.createDataFrame(
        [(0, json.dumps({"subject": "Hi", "body": "Too short"})), (1, json.dumps({"subject": " a \n b ", "body": "x" * 40}))],
        "i int, raw string",
    )
    rows = sorted(validate.parse_email(df, "raw").collect())
    assert rows[0].draft is None and rows[0].validation_errors == ["invalid:body"]
    assert rows[1].draft.subject == "a b"
    empty = {f: "x" for f in V.SUMMARY_FIELDS} | {"case_overview": ""}
    df = spark.createDataFrame([(json.dumps(empty),)], "raw string")
    assert validate.parse_summary(df, "raw").first().validation_errors == ["invalid:case_overview"]


def verified(spark, record, source=SOURCE):
    df = spark.createDataFrame([(source, tuple(record[f] for f in V.RECORD_FIELDS))], f"text string, extraction {validate.RECORD_TYPE}")
    return verify.verify_record(df).first()


def test_supported_record_passes(spark):
    row = verified(spark, GOOD)
    assert row.verify_warnings == [] and row.extraction.phone_number == "(204) 555 0191"


def test_invented_contacts_are_blanked(spark):
    row = verified(spark, {**GOOD, "email": "other@post.example", "phone_number": "310-555-0000", "reference_number": "TKT-1y"})
    assert row.extraction.email == row.extraction.phone_number == row.extraction.reference_number == "Not Provided"
    assert [w.split(":")[0] for w in row.verify_warnings] == [
        "email_not_in_source", "phone_not_in_source", "reference_not_in_source", "no contact details"]


def test_consistency_and_names(spark):
    row = verified(spark, {**GOOD, "escalation_required": "Yes", "is_complaint": "No", "resolution_provided": "Not Provided", "customer_name": "Xaver Zed"})
    assert [w.split(":")[0] for w in row.verify_warnings] == ["name_not_in_source", "consistency", "consistency", "consistency"]
    assert verified(spark, {**GOOD, "customer_name": "Q, x"}).verify_warnings == []
    assert verified(spark, {**GOOD, "email": "not an email"}).verify_warnings == ["email_bad_format: not an email"]


def findings(spark, text, allowed=""):
    df = spark.createDataFrame([(text, SOURCE)], "d string, s string")
    return grounding.check_grounding(df, F.col("d"), F.col("s"), F.lit(allowed)).first().issues


def test_grounding(spark):
    assert findings(spark, "Dear Tariq Omondi, €75.20 on ticket tkt-8833-07 or TKT-8833-07. Call 204 555 0191.") == []
    text = "Expect £31.40 soon, see ORD-4711, ask info@shop.example or 310-555-0000. Yours, [Clerk Name]"
    assert findings(spark, text) == [
        "blank_placeholder: [Clerk Name]", "ungrounded_amount: £31.40", "ungrounded_email: info@shop.example",
        "ungrounded_phone: 310-555-0000", "ungrounded_reference: ORD-4711"]
    assert findings(spark, "Ask info@shop.example", "info@shop.example") == []
    assert findings(spark, "£31 or £31.00 or £31") == ["ungrounded_amount: £31", "ungrounded_amount: £31.00"]


def cases(spark, n=4):
    rows = [(i, f"doc{i}", f"doc{i}.txt", SOURCE, tuple(GOOD[f] for f in V.RECORD_FIELDS)) for i in range(n)]
    return spark.createDataFrame(rows, f"i int, doc_id string, file_name string, text string, extraction {validate.RECORD_TYPE}")


BODY = "We have read your letter with care and will come back to you soon."


def test_correction_loop_with_model(spark):
    def model(system, user):
        invented = "" if "grounding check" in user else " We return $999.00."
        return {"raw": json.dumps({"subject": "s", "body": BODY + invented}), "input_tokens": 10, "output_tokens": 2}

    stage = Stage(spark)
    rows = drafting.draft_with_model(cases(spark), drafting.EMAIL_TASK, model, Params(), stage).collect()
    assert len(rows) == 4
    assert {(r.customer_email_calls, r.customer_email_input_tokens, tuple(r.customer_email_warnings)) for r in rows} == {(2, 20, ())}
    rows = drafting.draft_with_model(cases(spark), drafting.EMAIL_TASK, model, Params(grounding_max_corrections=0), stage).collect()
    assert {tuple(r.customer_email_warnings) for r in rows} == {("Customer email grounding: ungrounded_amount: $999.00",)}
    stage.release()


def test_failed_second_draft_reports_only_its_error(spark):
    def model(system, user):
        if "grounding check" in user:
            raise TimeoutError("gone")
        return {"raw": json.dumps({"subject": "s", "body": BODY + " $999.00"}), "input_tokens": 10, "output_tokens": 2}

    row = drafting.draft_with_model(cases(spark, 1), drafting.EMAIL_TASK, model, Params(max_attempts=2), Stage(spark)).first()
    assert row.customer_email is None and row.customer_email_error == "TimeoutError: gone"
    assert row.customer_email_warnings is None and row.customer_email_calls == 0 and row.customer_email_input_tokens == 0


def logger():
    """A function that tasks can carry with them."""

    def log(folder, name):
        import uuid

        open(f"{folder}/{name}-{uuid.uuid4().hex}", "w").close()

    return log


def test_a_run_started_again_asks_only_what_is_open(spark, tmp_path):
    import os

    _log, log, kept = logger(), tmp_path / "log", str(tmp_path / "answers")
    log.mkdir()

    def model(system, user):
        if user == "p3" and not any(f.startswith("lost") for f in os.listdir(log)):
            _log(log, "lost")
            os._exit(1)  # the worker goes as with its executor
        _log(log, user)
        if user == "p1" and sum(f.startswith("p1-") for f in os.listdir(log)) == 1:
            raise ConnectionError("blip")
        return {"raw": json.dumps({f: user for f in V.SUMMARY_FIELDS}), "input_tokens": 3, "output_tokens": 4}

    df = spark.createDataFrame([("s", f"p{k}") for k in range(6)], "_system string, _user string").coalesce(1)

    def run():
        answers = Answers(spark, kept, file_answers=1)
        return drafting.call_model(df, model, validate.parse_summary, Params(calls_in_flight=1), Stage(spark), answers).collect()

    with pytest.raises(Exception, match="worker exited"):
        run()
    assert sorted(f.split("-")[0] for f in os.listdir(log)) == ["lost", "p0", "p1", "p2"]
    rows = {r._user: r for r in run()}
    assert {u: r.call_attempts for u, r in rows.items()} == {"p0": 1, "p1": 2, "p2": 1, "p3": 1, "p4": 1, "p5": 1}
    assert all(r.call_error is None and r.draft.key_issue == u for u, r in rows.items())
    want = ["lost", "p0", "p1", "p1", "p2", "p3", "p4", "p5"]
    assert sorted(f.split("-")[0] for f in os.listdir(log)) == want
    run()
    assert sorted(f.split("-")[0] for f in os.listdir(log)) == want


def test_calls_of_a_task_overlap_within_the_window(spark, tmp_path):
    import os

    _log, log = logger(), tmp_path / "log"
    log.mkdir()

    def model(system, user):
        import time

        open(f"{log}/{user}", "w").close()
        time.sleep(0.3)
        _log(log, f"with{len([f for f in os.listdir(log) if not f.startswith('with')])}")
        os.remove(f"{log}/{user}")
        return {"raw": json.dumps({f: user for f in V.SUMMARY_FIELDS})}

    df = spark.createDataFrame([("s", f"p{k}") for k in range(9)], "_system string, _user string").coalesce(1)
    rows = drafting.call_model(df, model, validate.parse_summary, Params(calls_in_flight=3), Stage(spark)).collect()
    assert all(r.draft.key_issue == r._user for r in rows)
    seen = [int(f.split("-")[0][4:]) for f in os.listdir(log)]
    assert len(seen) == 9 and max(seen) == 3


def test_waves_write_no_texts_and_only_rejected_rows_again(spark):
    body = BODY

    def model(system, user):
        invented = "" if "grounding check" in user or "doc1" in user else " We return $999.00."
        return {"raw": json.dumps({"subject": "s", "body": body + invented}), "input_tokens": 10, "output_tokens": 2}

    stage = Stage(spark)
    rows = cases(spark, 6).withColumn("text", F.concat(F.lit(SOURCE), F.lit(" doc"), F.col("i").cast("string")))
    done = drafting.draft_with_model(rows, drafting.EMAIL_TASK, model, Params(), stage).collect()
    assert {(r.i, r.customer_email_calls) for r in done} == {(i, 1 if i == 1 else 2) for i in range(6)}
    first, second = (spark.read.parquet(f"{stage.root}/{n:04d}") for n in (2, 3))
    assert (first.count(), second.count()) == (6, 5)
    assert not {"text", "_record", "_user"} & set(first.columns) and SOURCE[:20] not in str(first.collect())
    stage.release()


def test_retry_waves(spark, tmp_path):
    """Transient failures are repeated, refused keys are not, bad output is."""
    log = str(tmp_path)

    def model(system, user):
        import os
        import uuid

        class AuthenticationError(Exception):
            pass

        class RefusedKey(AuthenticationError):
            pass

        seen = len([f for f in os.listdir(log) if f.startswith(user)])
        open(f"{log}/{user}-{uuid.uuid4().hex}", "w").close()
        if user == "refused":
            raise RefusedKey("no")
        if user == "flaky" and seen == 0:
            raise ConnectionError("blip")
        if user == "flaky" and seen == 1 or user == "bad":
            return {"raw": "{}"}
        return {"raw": json.dumps({f: "x" for f in V.SUMMARY_FIELDS}), "input_tokens": 3, "output_tokens": 4}

    # One row per task, so that the waves can be counted.
    df = spark.createDataFrame([("s", u) for u in ("ok", "flaky", "bad", "refused")], "_system string, _user string")
    out = drafting.call_model(df, model, validate.parse_summary, Params(max_attempts=3), Stage(spark))
    rows = {r._user: r for r in out.collect()}
    assert {u: r.call_attempts for u, r in rows.items()} == {"ok": 1, "flaky": 3, "bad": 3, "refused": 1}
    assert rows["refused"].call_error.startswith("RefusedKey") and rows["bad"].call_error.startswith("InvalidOutput")
    assert rows["flaky"].call_error is None and rows["flaky"].call_input_tokens == 3
    import os

    assert sorted(f.split("-")[0] for f in os.listdir(log)) == ["bad"] * 3 + ["flaky"] * 3 + ["ok"] + ["refused"]


SPEC = {
    "hard": {"customer_name": "Lena Brandt", "email": "Not Provided", "phone_number": "4315550123",
             "overall_case_status": ["Pending Customer Response", "Open"]},
    "soft": {"priority": ["Low", "Critical"]},
    "forbidden": {"overall_case_status": ["Closed"]},
}
RIGHT = {**{f: "" for f in V.RECORD_FIELDS}, "customer_name": "Dr Lena Brandt", "email": "Not Provided",
         "phone_number": "+49 431 555-0123", "overall_case_status": "Pending Customer Response", "priority": "Critical"}


@pytest.mark.parametrize(
    "change, status, overall",
    [({}, "PASS", 100.0), ({"email": "l@post.example"}, "FAIL", 80.0), ({"overall_case_status": "Closed"}, "FAIL", 80.0),
     ({"priority": "High"}, "WARN", 80.0), ({"phone_number": "555-0123"}, "FAIL", 80.0), (None, "FAIL", 0.0)],
)
def test_scoring(spark, change, status, overall):
    truth = score.parse_truth(spark.createDataFrame([("d", json.dumps(SPEC))], "doc_id string, j string"), "j")
    rows = [] if change is None else [("d", tuple({**RIGHT, **change}[f] for f in V.RECORD_FIELDS))]
    evaluated = score.evaluate(truth, spark.createDataFrame(rows, f"doc_id string, extraction {validate.RECORD_TYPE}"))
    assert score.verdicts(evaluated).first().status == status
    assert score.accuracy(evaluated).first().overall_accuracy_pct == overall


def test_group_sizes_with_a_hot_key(spark):
    """More hot keys than the broadcast list holds is impossible; sizes agree with a plain count."""
    rows = [(f"p{i}", "hot" if i % 3 == 0 else f"k{i % 700}" if i % 2 else f"one{i}") for i in range(6000)]
    rows += [("k1", "lonely")]  # a row id that looks like a key
    df = spark.createDataFrame(rows, "path string, stem string")
    want = {}
    for _, stem in rows:
        want[stem] = want.get(stem, 0) + 1
    got = attach_group_size(df, "stem", "path", "n").collect()
    assert len(got) == len(rows) and all(r.n == want[r.stem] for r in got)


def test_known_values(spark):
    rows = [(i, "x" * (i % 9) + f"aa secret-value-{i:04d}-end bb secret-value-{i + 1:04d}-end") for i in range(50)] + [(50, None), (51, "é𝄞 12 long ünits𝄞!"), (52, "short")]
    texts = spark.createDataFrame(rows, "i int, t string")
    values = [(f"v{i}", f"secret-value-{i:04d}-end") for i in range(40)] + [("short", "aa"), ("u", "𝄞 12 long ünits𝄞"), ("u", "𝄞 12 long ünits𝄞"), ("n", None)]
    got = quality.known_value_leaks(texts, "i", "t", spark.createDataFrame(values, "k string, v string"), "k", "v")
    want = {(i, f"v{j}") for i in range(50) for j in (i, i + 1) if j < 40} | {(51, "u")}
    assert "Python" not in got._jdf.queryExecution().executedPlan().toString().replace("PythonRDD", "")
    found = got.collect()
    assert len(found) == len(want) and {(r.i, r.key) for r in found} == want


def test_params_are_checked():
    for bad in ({"max_document_chars": 499}, {"grounding_max_corrections": -1}, {"max_attempts": 0}, {"max_file_size_mb": 0}):
        with pytest.raises(ParamError):
            Params(**bad)


def test_leaks_of_values_with_a_common_beginning(spark):
    """Ten thousand values and all texts share a beginning; only the rest of a value tells."""
    values = spark.range(10_000).select(F.col("id").cast("string").alias("k"), F.format_string("COMMON-PREFIX-%06d", "id").alias("v"))
    held = F.when(F.col("id") % 4 == 0, F.format_string("COMMON-PREFIX-%06d", F.col("id") * 3)).otherwise(F.lit("COMMON-PREFIX-"))
    texts = spark.range(400).select("id", F.concat(F.repeat(F.lit("x"), (F.col("id") % 7).cast("int")), held, F.lit(" COMMON-PREFIX-none")).alias("t"))
    got = quality.known_value_leaks(texts, "id", "t", values, "k", "v")
    assert sorted((r.id, int(r.key)) for r in got.collect()) == [(i, 3 * i) for i in range(0, 400, 4)]
    marks = texts.selectExpr("explode(transform(sequence(1, length(t) - 7), i -> xxhash64(substring(t, i, 8)))) m")
    counts = marks.groupBy(F.pmod("m", F.lit(quality.MARK_BUCKETS)).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    wanted = values.selectExpr("k as key", "v as value")
    chosen = quality.rarest_marks(wanted, counts).filter("mark = xxhash64('COMMON-P')")
    assert chosen.isEmpty() and quality.rarest_marks(wanted, counts).count() == 50_000


def test_old_stages_are_dropped(spark):
    import os
    from casemill.session import drop_old_stages, shared_dir

    old, new = Stage(spark), Stage(spark)
    for stage in (old, new):
        stage.write(spark.range(1))
    place = shared_dir(spark).removeprefix("file:")
    name = old.root.rsplit("/", 1)[1]
    os.utime(f"{place}/{name}", (0, 0))
    assert drop_old_stages(spark, hours=10_000) >= 1
    assert not os.path.exists(f"{place}/{name}") and os.path.exists(f"{place}/{new.root.rsplit('/', 1)[1]}")
    new.release()
