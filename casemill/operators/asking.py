"""Model calls whose answers are kept, so that a second run asks only what has no answer yet.

An answer is a row keyed by the digest of its prompt and attempt. Tasks put answers into a folder in
small files as they arrive, each with one rename, beside whatever the job does with them; the folder is
the table of answers. A wave first looks up its digests there, and only prompts without an answer
reach the model. A task that is repeated within a job also finds what its earlier attempt has put there.
"""

from __future__ import annotations

import time
import uuid
from collections import deque
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor, wait
from threading import Lock

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casemill.functions.once import once
from casemill.sources.casedocs import file_system

ANSWER_TYPE = "raw string, input_tokens bigint, output_tokens bigint, error string, error_classes array<string>, seconds double"
_NAMES = ["raw", "input_tokens", "output_tokens", "error", "error_classes", "seconds"]
_KEPT = pa.schema(
    [("digest", pa.string()), ("raw", pa.string()), ("input_tokens", pa.int64()), ("output_tokens", pa.int64()),
     ("error", pa.string()), ("error_classes", pa.list_(pa.string())), ("seconds", pa.float64())]
)
#: Answers in a kept file; calls of one task under way at a time.
FILE_ANSWERS, IN_FLIGHT = 64, 4

Model = Callable[[str, str], dict]


def prompt_digest(*parts: Column) -> Column:
    """Digest of the parts of a prompt; a part that is absent is not an empty one."""
    marked = [F.coalesce(F.concat(F.lit("+"), p.cast("string")), F.lit("-")) for p in parts]
    return F.sha2(F.concat_ws("\x1f", *marked), 256)


class Answers:
    """The kept answers below a folder that every executor reaches."""

    def __init__(self, spark: SparkSession, folder: str, file_answers: int = FILE_ANSWERS):
        """``file_answers``: so many answers of a task at most are lost with its executor."""
        self._spark, self.file_answers = spark, file_answers
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        self._system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._system.mkdirs(path)
        self._path = path
        self.folder = self._system.makeQualified(path).toString()

    def is_empty(self) -> bool:
        return not self._system.listStatusIterator(self._path).hasNext()

    def table(self) -> DataFrame:
        """``digest, known``: one answer for each digest."""
        rows = self._spark.read.schema(f"digest string, {ANSWER_TYPE}").parquet(self.folder)
        return rows.groupBy("digest").agg(F.first(F.struct(*_NAMES)).alias("known"))


class _Keeper:
    """Writes the answers of a task to the folder, and finds those of earlier attempts at it."""

    def __init__(self, folder: str, file_answers: int):
        self._file_answers = file_answers
        context = TaskContext.get()
        self._folder, self._task = folder, f"{context.stageId()}-{context.partitionId()}-"
        self._waiting: list[tuple] = []
        self.known: dict[str, tuple] = {}
        if context.attemptNumber():
            from pyarrow import fs

            system, inner = file_system(folder)
            for info in system.get_file_info(fs.FileSelector(inner)):
                if info.base_name.startswith(self._task):
                    for row in pq.read_table(system.open_input_file(info.path)).to_pylist():
                        self.known[row["digest"]] = tuple(row[n] for n in _NAMES)

    def keep(self, digest: str, answer: tuple) -> None:
        self._waiting.append((digest, *answer))
        if len(self._waiting) >= self._file_answers:
            self.flush()

    def flush(self) -> None:
        if not self._waiting:
            return
        table = pa.table([pa.array(c, t) for c, t in zip(zip(*self._waiting), _KEPT.types)], schema=_KEPT)
        name = f"{self._task}{uuid.uuid4().hex}.parquet"
        system, inner = file_system(self._folder)
        # Spark does not see names that begin with an underscore.
        with system.open_output_stream(f"{inner}/_{name}", compression=None) as out:
            pq.write_table(table, out)
        system.move(f"{inner}/_{name}", f"{inner}/{name}")
        self._waiting.clear()


def _one(call: Model, system: str, user: str) -> tuple:
    """An answer; an exception becomes a value: its message and the names of its class and base classes."""
    began = time.perf_counter()
    try:
        answer = call(system, user)
        got = answer["raw"], answer.get("input_tokens", 0), answer.get("output_tokens", 0), None, None
    except Exception as exc:  # noqa: BLE001 - errors are data here
        got = None, 0, 0, f"{type(exc).__name__}: {exc}", [c.__name__ for c in type(exc).__mro__]
    return *got, time.perf_counter() - began


def _all_answers(
    pool: ThreadPoolExecutor, in_flight: int, call: Model, rows: list[tuple], keeper: _Keeper | None = None
) -> list[tuple]:
    """The answers to rows of (digest, system, user) in their order; an answer without values where there is no user.

    Each thread takes the next open row when it has done one, so a call costs no task of the pool, and a
    slow one holds up no others. After a failure that is no answer, no further row is begun.
    """
    out: list[tuple] = [(None,) * len(_NAMES)] * len(rows)
    open_rows, keeping = iter(range(len(rows))), Lock()

    def work() -> None:
        try:
            for k in open_rows:
                digest, system, user = rows[k]
                if user is None:
                    continue
                answer = keeper.known.get(digest) if keeper else None
                if answer is None:
                    answer = _one(call, system, user)
                    if keeper:
                        with keeping:
                            keeper.keep(digest, answer)
                out[k] = answer
        except BaseException:
            deque(open_rows, maxlen=0)
            raise

    working = [pool.submit(work) for _ in range(min(in_flight, len(rows)))]
    wait(working)
    for each in working:
        each.result()
    return out


def asker(call: Model, answers: Answers | None = None, in_flight: int = IN_FLIGHT):
    """A column function (digest, system, user) -> answer; null where ``user`` is null.

    Only these three columns travel to Python. At most ``in_flight`` calls of a task are under way,
    from as many threads, so ``call`` must allow that; answers come back in the order of the rows.
    """

    place = (answers.folder, answers.file_answers) if answers else None

    @F.pandas_udf(ANSWER_TYPE)
    def ask(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        keeper = _Keeper(*place) if place else None
        with ThreadPoolExecutor(in_flight) as pool:
            for batch in batches:
                try:
                    out = _all_answers(pool, in_flight, call, list(zip(*batch)), keeper)
                finally:
                    if keeper:
                        keeper.flush()
                yield pd.DataFrame(out, columns=_NAMES)

    return ask.asNondeterministic()


def asked(rows: DataFrame, call: Model, attempt: Column, answers: Answers | None, in_flight: int = IN_FLIGHT) -> DataFrame:
    """Add ``_call``, the answer to ``_system`` and ``_user``, from the kept answers or else the model.

    On a first run the folder is empty and nothing is joined; prompts move only when a run goes on
    where another one has ended.
    """
    # Only kept answers are looked up by digest.
    digest = F.lit(None).cast("string") if answers is None else prompt_digest(attempt, F.col("_system"), F.col("_user"))
    rows = rows.withColumn("_digest", once(digest))
    ask = asker(call, answers, in_flight)
    if answers is None or answers.is_empty():
        return rows.withColumn("_call", ask("_digest", "_system", "_user")).drop("_digest")
    looked_up = rows.join(answers.table(), F.col("_digest") == F.col("digest"), "left")
    open_ = F.when(F.col("known").isNull(), F.col("_user"))
    done = looked_up.withColumn("_asked", ask("_digest", "_system", open_))
    return done.withColumn("_call", F.coalesce("known", "_asked")).drop("_digest", "digest", "known", "_asked")
