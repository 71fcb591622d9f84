"""Threads that ask a model take rows one after another."""

import threading
from concurrent.futures import ThreadPoolExecutor

import pytest

from casemill.operators import asking


def rows(n):
    return [(f"d{k}", "s", f"p{k}") for k in range(n)]


def answers(model, asked, in_flight):
    with ThreadPoolExecutor(in_flight) as pool:
        return asking._all_answers(pool, in_flight, model, asked)


def test_calls_cost_no_tasks_of_the_pool():
    submitted = []

    class Pool(ThreadPoolExecutor):
        def submit(self, *args):
            submitted.append(args)
            return super().submit(*args)

    with Pool(4) as pool:
        out = asking._all_answers(pool, 4, lambda system, user: {"raw": user, "input_tokens": 1}, [*rows(500), ("d", "s", None)])
    assert [a[0] for a in out] == [*[f"p{k}" for k in range(500)], None]
    assert out[-1] == (None,) * len(asking._NAMES) and len(submitted) == 4


def test_a_slow_call_holds_up_no_others():
    others = threading.Semaphore(0)

    def model(system, user):
        if user == "p0":
            return {"raw": str(all(others.acquire(timeout=5) for _ in range(9)))}
        others.release()
        return {"raw": user}

    assert [a[0] for a in answers(model, rows(10), 2)] == ["True", *[f"p{k}" for k in range(1, 10)]]


def test_a_failure_that_is_no_answer_ends_the_asking():
    asked = []

    def model(system, user):
        asked.append(user)
        raise KeyboardInterrupt if user == "p2" else ConnectionError("blip")

    with pytest.raises(KeyboardInterrupt):
        answers(model, rows(100), 1)
    assert asked == ["p0", "p1", "p2"]


def test_no_rows():
    assert answers(None, [], 3) == []


def test_prompts_are_digested_where_the_rows_are_written_and_nowhere_else(spark):
    from pyspark.sql import functions as F

    from casemill.operators import drafting
    from casemill.plans import batch
    from casemill.session import Stage

    def model(system, user):
        import json

        return {"raw": json.dumps({"subject": "s", "body": "We have read your letter with care and will come back to you."})}

    odd = [("a", "Name: Lena Brandt\nMy order never came."), ("a", "Name: Lena Brandt\nMy order never came."), ("b", "short"), (None, None)]
    stage = Stage(spark)
    rows = batch.process_table(spark.createDataFrame(odd, "doc_id string, t string"), "doc_id", "t", generation_model=model, stage=stage)
    assert "sha2" not in rows._jdf.queryExecution().optimizedPlan().toString()
    assert {f"_{task.name}_key" for task in drafting.TASKS} <= set(spark.read.parquet(f"{stage.root}/0001").columns)
    found = sorted((str(r.doc_id), r.status, r.email is not None) for r in rows.collect())
    assert found == [("None", "FAILED", False), ("a", "PARTIAL", True), ("a", "PARTIAL", True), ("b", "FAILED", False)]
    assert not [c for c in rows.columns if c.startswith("_")]
    stage.release()
    some = spark.createDataFrame([("s", "u")], "_system string, _user string")
    plan = asking.asked(some, model, F.lit(1), None)._jdf.queryExecution().optimizedPlan().toString()
    assert "sha2" not in plan
