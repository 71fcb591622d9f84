import json

import pytest
from pyspark.sql import functions as F

from casemill.operators import assemble, quality, report, run_state
from casemill.params import Params, RunMeta
from casemill.plans import batch
from casemill.plans.fixtures import docx_bytes
from casemill.sources import casedocs, caserun, manifest, readback, readers
from casemill.streaming import intake

LETTER = """Customer name: Nora Quist
Email: nora.quist@example.org
Phone: 416-555-0173

Details: My order ORD-448120 arrived damaged. I want a new one. I have attached photos.
A replacement is scheduled for Monday."""


@pytest.fixture
def folder(tmp_path):
    data = tmp_path / "data"
    (data / "sub").mkdir(parents=True)
    (data / "a.txt").write_text(LETTER)
    (data / "a.docx").write_bytes(docx_bytes(["Form", " "], [["Name", "Bo Li", "Bo Li"], ["Message", "My parcel did not arrive at all. Please help me."]]))
    (data / "legacy file.TXT").write_bytes("Complaint about the caf\xe9 \x93service\x94 quality.".encode("latin-1"))
    (data / "_under.txt").write_text("﻿" + LETTER, encoding="utf-8")
    (data / "empty.txt").write_bytes(b"")
    (data / "tiny.txt").write_bytes(b"  hi ")
    (data / "broken.docx").write_bytes(b"no archive")
    (data / "scan.pdf").write_bytes(b"%PDF")
    (data / "big.txt").write_bytes(b"x" * 1_100_000)
    (data / "long.txt").write_text("word " * 2000)
    (data / "list.csv").write_text("a,b")
    (data / "noext").write_text("x")
    (data / ".hidden.txt").write_text(LETTER)
    (data / "~$lock.docx").write_text("x")
    (data / "sub" / "deep.txt").write_text(LETTER)
    return data


PARAMS = Params(max_file_size_mb=1, max_document_chars=1000)


def test_manifest(spark, folder):
    rows = {r.file_name: r for r in manifest.discover(spark, str(folder)).collect()}
    assert sorted(rows) == sorted(
        ["a.txt", "a.docx", "legacy file.TXT", "_under.txt", "empty.txt", "tiny.txt", "broken.docx", "scan.pdf", "big.txt",
         "long.txt", "list.csv", "noext"])
    assert rows["empty.txt"].length == 0 and not rows["noext"].supported
    assert casedocs.listing(spark, str(folder), shards=3).count() == 14
    assert {n: r.same_stem for n, r in rows.items() if n[0] in "aels"} == {
        "a.txt": 2, "a.docx": 2, "empty.txt": 1, "legacy file.TXT": 1, "scan.pdf": 1, "list.csv": 0, "long.txt": 1}
    with pytest.raises(FileNotFoundError):
        manifest.discover(spark, str(folder / "nowhere"))
    with pytest.raises(NotADirectoryError):
        manifest.discover(spark, str(folder / "a.txt"))


def test_run_over_a_folder(spark, folder, tmp_path):
    out = str(tmp_path / "out")
    run = batch.run(spark, str(folder), out, PARAMS)
    rows = {r.file_name: r for r in run.results.collect()}
    assert len(rows) == 12
    assert {n: r.status for n, r in rows.items()} == {
        "a.txt": "SUCCESS", "a.docx": "SUCCESS", "legacy file.TXT": "SUCCESS", "_under.txt": "SUCCESS", "long.txt": "SUCCESS",
        "empty.txt": "FAILED", "tiny.txt": "FAILED", "broken.docx": "FAILED", "scan.pdf": "FAILED", "big.txt": "FAILED",
        "list.csv": "SKIPPED", "noext": "SKIPPED"}
    assert rows["a.txt"].doc_id == "a_txt" and rows["a.docx"].doc_id == "a_docx" and rows["_under.txt"].doc_id == "_under"
    assert rows["empty.txt"].errors == ["load: empty_file"]
    assert rows["big.txt"].errors == ["load: too_large: 1.0 MB"]
    assert rows["broken.docx"].errors[0].startswith("load: unreadable: .docx (BadZipFile")
    assert rows["scan.pdf"].errors[0].startswith("load: unreadable: .pdf (NoReader")
    assert rows["noext"].file_type == "unknown"
    assert "text_cut: 1000" in rows["long.txt"].warnings
    e = rows["a.txt"].extraction
    assert (e.customer_name, e.email, e.reference_number, e.overall_case_status) == (
        "Nora Quist", "nora.quist@example.org", "ORD-448120", "In Progress")
    assert rows["a.docx"].extraction.customer_name == "Bo Li"
    assert rows["a.txt"].email.body.startswith("Dear Nora Quist,") and rows["a.txt"].llm_calls == 3

    back = readback.read_report(spark, f"{out}/final_report").collect()
    assert [r.file_name for r in back] == sorted(rows, key=str.lower)
    structured = readback.read_structured(spark, f"{out}/structured_data")
    assert structured.count() == 5 and structured.first().run_id == run.meta.run_id
    summary = spark.read.json(f"{out}/run_summary").first()
    assert summary.files_total == 12 and summary.status_counts.FAILED == 5 and summary.status_counts.PARTIAL == 0
    assert summary.escalations_required == 0 and sum(c.documents for c in summary.by_category) == 5

    listing = readback.listing_of_outputs(spark, out, run.meta.run_id)
    report_rows = report.report_rows(run.results)
    assert quality.missing_outputs(report_rows, listing).count() == 0
    assert quality.unreported_inputs(manifest.discover(spark, str(folder)), report_rows).count() == 0
    totals = report.run_totals(run.results).first().asDict()
    assert run.counters == totals
    again = batch.run(spark, str(folder), out, PARAMS, clean=False)
    assert readback.listing_of_outputs(spark, out, again.meta.run_id).count() == 15
    stored = run_state.read_partials(spark, out)
    both = run_state.merged_totals(stored).first().asDict()
    assert both.pop("runs") == 2 and both.pop("senders") == 1 and both == {k: 2 * v for k, v in totals.items()}
    assert sum(r.documents for r in run_state.merged_value_counts(stored).collect()) == 30
    assert readback.read_structured(spark, f"{out}/structured_data").count() == 10 and again.meta.run_id != run.meta.run_id


def test_no_limits_unless_named_and_bytes_in_no_join(spark, folder):
    rows = batch.process_folder(spark, str(folder))
    found = {r.file_name: r for r in rows.select("file_name", "status", "warnings").collect()}
    assert found["big.txt"].status == "SUCCESS" and not any("text_cut" in w for w in found["long.txt"].warnings)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    # Bytes appear behind the last exchange: nothing that holds them is joined or shuffled.
    assert "Join" not in plan and plan.count("MapInArrow") == 1
    assert all("content#" not in line for line in plan.split("MapInArrow", 1)[1].splitlines()[1:])


def test_many_files_are_listed_by_several_tasks(spark, tmp_path):
    data = tmp_path / "many"
    data.mkdir()
    for k in range(20_000):
        (data / f"{'_' * (k % 3 == 0)}case {k // 2}#%{'.txt' if k % 2 else '.docx'}").touch()
    spark.dataSource.register(casedocs.CaseDocs)
    found = spark.read.format("casedocs").option("shards", 5).load(f"file:{data}").withColumn("shard", F.spark_partition_id())
    per_task = [r["count"] for r in found.groupBy("shard").count().collect()]
    assert len(per_task) == 5 and sum(per_task) == 20_000 and max(per_task) < 6_000
    named = manifest.with_doc_ids(manifest.discover(spark, str(data)))
    assert named.count() == named.select("doc_id").distinct().count() == 20_000
    want = assemble.assign_doc_ids(named.drop("doc_id", "same_stem"))
    assert want.select("path", "doc_id").exceptAll(named.select("path", "doc_id")).isEmpty()


def test_names_and_files_that_are_hard_to_open(spark, tmp_path):
    for name in ("a b#c%20?.txt", "_é ü.txt", "gone.txt"):
        (tmp_path / name).write_text(f"text of {name}")
    rows = manifest.discover(spark, str(tmp_path))
    (tmp_path / "gone.txt").unlink()
    (tmp_path / "gone.txt").mkdir()
    got = {r.file_name: r for r in readers.load_contents(rows, PARAMS).collect()}
    assert got["a b#c%20?.txt"].content == b"text of a b#c%20?.txt" and got["_é ü.txt"].content == "text of _é ü.txt".encode()
    assert got["gone.txt"].content is None and got["gone.txt"].load_error.startswith(("unreadable: ", "missing_file: "))


def test_reader_for_another_type(spark, folder):
    read = readers.reader_from_callable(lambda content: "Text of a file that starts with " + content.decode())
    rows = batch.process_folder(spark, str(folder), PARAMS, read_with={".pdf": read}).filter("file_name = 'scan.pdf'").collect()
    assert rows[0].status == "SUCCESS"


def test_failing_task_is_isolated(spark, folder):
    from casemill.session import Stage

    def model(system, user):
        if "subject" in system:
            raise TimeoutError("simulated")
        fields = ["case_overview", "key_issue", "action_taken", "current_status", "recommended_next_action"]
        return {"raw": json.dumps({f: "x" for f in fields}), "input_tokens": 5, "output_tokens": 1}

    rows = batch.process_folder(spark, str(folder), PARAMS, generation_model=model, stage=Stage(spark)).filter("file_name = 'a.txt'").collect()
    assert rows[0].status == "PARTIAL" and rows[0].email is None and rows[0].summary is not None
    assert rows[0].errors == ["customer_email: TimeoutError: simulated"]


def test_decode_cascade(spark):
    samples = [
        "plain é".encode(), b"\xef\xbb\xbfmarked", b"caf\xe9 \x93q\x94 \x80", b"caf\xe9 \x93 \x81", bytes(range(0x80, 0x100)), b"",
    ]

    def model(b):
        for encoding in ("utf-8-sig", "utf-8", "cp1252", "latin-1"):
            try:
                return b.decode(encoding)
            except UnicodeDecodeError:
                continue

    every = bytes(b for b in range(0x80, 0x100) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D))
    samples.append(every)
    df = spark.createDataFrame([(i, bytearray(b)) for i, b in enumerate(samples)], "i int, c binary")
    got = [r.x for r in sorted(df.select("i", readers.decode_text(F.col("c")).alias("x")).collect())]
    assert got == [model(b) for b in samples]


def test_truth_file(spark, tmp_path):
    path = tmp_path / "truth.json"
    path.write_text(json.dumps({"documents": {"d1": {"hard": {"email": "x", "overall_case_status": ["Open"]}, "soft": {}}},
                                "expected_error_files": {"e.txt": "FAILED"}}))
    truth, errors = readback.read_truth(spark, str(path))
    row = truth.first()
    assert row.hard["email"].one == "x" and row.hard["overall_case_status"].many == ["Open"] and row.forbidden == {}
    lines = tmp_path / "truth.jsonl"
    lines.write_text("".join(json.dumps({"doc_id": f"d{k}", "hard": {"email": "x", "overall_case_status": ["Open"]}, "soft": {}}) + "\n" for k in (1, 2)))
    rows = readback.read_truth_lines(spark, str(lines)).orderBy("doc_id").collect()
    assert [r.doc_id for r in rows] == ["d1", "d2"] and rows[0].hard == row.hard and rows[0].forbidden == {}
    assert [tuple(r) for r in errors.collect()] == [("e.txt", "FAILED")]


def test_stream_intake(spark, tmp_path):
    data, out, mark = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "mark")
    data.mkdir()
    (data / "a.txt").write_text(LETTER)
    assert intake.run_available(spark, str(data), out, mark).count() == 1
    (data / "b.txt").write_text("hi")
    rows = {r.file_name: r.status for r in intake.run_available(spark, str(data), out, mark).collect()}
    assert rows == {"a.txt": "SUCCESS", "b.txt": "FAILED"}
    (data / "C.TXT").write_text(LETTER)
    (data / "d.docx").write_bytes(docx_bytes(["A letter about a parcel that never arrived."], []))
    (data / "e.csv").write_text("a")
    (data / "f.txt").write_text("")
    done = intake.run_available(spark, str(data), out, mark)
    assert {r.file_name: r.status for r in done.collect()} == {**rows, "C.TXT": "SUCCESS", "d.docx": "SUCCESS", "e.csv": "SKIPPED"}
    assert [r.file_name for r in intake.unseen_inputs(spark, str(data), done).collect()] == ["f.txt"]


def _outputs(spark, n=40, fail_at=None):
    @F.udf("string")
    def content(k):
        if k == fail_at:
            raise RuntimeError("task lost")
        return json.dumps({"doc_id": f"d{k}"})

    sets = F.element_at(F.array(*map(F.lit, caserun.DATA_SETS)), (F.col("id") % 3 + 1).cast("int"))
    return spark.range(0, n, 1, 4).select(sets.alias("data_set"), F.concat(F.lit("d"), "id").alias("doc_id"), content("id").alias("content"))


def _visible(root):
    return sorted(str(p.relative_to(root)) for p in root.rglob("*") if p.is_file() and not p.name.endswith(".crc") and caserun.STAGING_DIR not in p.parts)


def test_a_failed_task_publishes_nothing(spark, tmp_path):
    out = tmp_path / "out"
    with pytest.raises(Exception, match="task lost"):
        caserun.publish(_outputs(spark, fail_at=39), str(out), "r1")
    assert _visible(out) == [] and not caserun.is_published(spark, str(out), "r1")
    assert readback.listing_of_outputs(spark, str(out), "r1").count() == 0
    caserun.publish(_outputs(spark), str(out), "r1")
    assert not list((out / caserun.STAGING_DIR).iterdir())
    assert readback.listing_of_outputs(spark, str(out), "r1").count() == 40
    rows = {r.data_set: r.rows for r in caserun.published_runs(spark, str(out)).collect()}
    assert rows == dict(zip(caserun.DATA_SETS, (14, 13, 13)))


def test_runs_are_published_once_kept_or_replaced(spark, tmp_path):
    out = tmp_path / "out"
    caserun.publish(_outputs(spark), str(out), "r1")
    before = _visible(out)
    caserun.publish(_outputs(spark, n=99), str(out), "r1")
    assert _visible(out) == before
    caserun.publish(_outputs(spark, n=9), str(out), "r2")
    assert {r.run_id for r in caserun.published_runs(spark, str(out)).collect()} == {"r1", "r2"}
    # Files of an attempt whose task was never reported do not become visible.
    writer = caserun.CaseRun({"path": f"file:{out}", "run_id": "r4"}).writer(None, False)
    import pyarrow as pa

    batch_ = pa.RecordBatch.from_pydict({"data_set": ["customer_emails"], "doc_id": ["x"], "content": ["y"]})
    lost, kept = writer.write(iter([batch_])), writer.write(iter([batch_]))
    writer.commit([kept, None])
    assert lost.files != kept.files and [r.output for r in readback.listing_of_outputs(spark, str(out), "r4").collect()] == ["customer_emails:x"]
    caserun.publish(_outputs(spark, n=0), str(out), "r3", clean=True)
    assert _visible(out) == ["_runs/r3.json"] and readback.listing_of_outputs(spark, str(out), "r3").count() == 0


def test_a_replayed_batch_writes_nothing_twice(spark, folder, tmp_path):
    out, meta = str(tmp_path / "out"), RunMeta("s1", processed_at="2026-01-01T00:00:00+00:00")
    rows = batch.process_folder(spark, str(folder), PARAMS)
    intake.publish_batch(rows, 0, out, meta)
    before = _visible(tmp_path / "out")
    intake.publish_batch(rows, 0, out, meta)
    assert _visible(tmp_path / "out") == before
    intake.publish_batch(rows.filter("file_name = 'a.txt'"), 1, out, meta)
    counts = {(r.run_id, r.rows) for r in caserun.published_runs(spark, out).collect()}
    assert counts == {("s1-0", 5), ("s1-1", 1)}


def test_filter_reaches_the_scan(spark, tmp_path):
    spark.range(50).selectExpr("cast(id as string) id", "repeat('word ', 20) text").write.parquet(str(tmp_path / "t"))
    rows = batch.process_table(spark.read.parquet(str(tmp_path / "t")), "id", "text", where="id = '5'")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(id,5)" in plan and [r.doc_id for r in rows.collect()] == ["5"]
