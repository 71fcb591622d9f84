"""Reply and summary drafts: templates, model calls with retries, grounded correction."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casemill import fixed_values as V
from casemill.functions import patterns as P
from casemill.functions import prompts
from casemill.functions import text as T
from casemill.functions.once import once
from casemill.operators import grounding as G
from casemill.operators import validate
from casemill.operators.asking import Answers, Model, asked, prompt_digest
from casemill.params import Params
from casemill.session import Stage


# --------------------------------------------------------------------------- templates
def _lookup(table: dict[str, str], key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), key)


def template_email(record: Column, params: Params) -> Column:
    """Offline reply: greeting, reference, issue, status sentence, resolution, sign-off."""

    def given(field: str, prefix: str, postfix: str = "") -> Column:
        value = record[field]
        return F.when(
            value != V.NOT_PROVIDED, F.concat(F.lit(prefix), value, F.lit(postfix))
        ).otherwise(F.lit(""))

    name = record["customer_name"]
    who = F.when(name == V.NOT_PROVIDED, F.lit("Customer")).otherwise(name)
    ref = given("reference_number", ", number ")
    closing = f"\n\n{V.REPLY_CLOSING}\n\n{V.REPLY_SIGN_OFF}\n{params.email_signature or 'Customer Care Team'}"
    body = F.concat(
        F.lit("Dear "), who, F.lit(f",\n\n{V.REPLY_OPENING}"), ref, F.lit(V.REPLY_CONCERN),
        record["issue_description"], F.lit("\n\n"),
        _lookup(V.REPLY_STATUS_LINES, record["overall_case_status"]),
        given("resolution_provided", V.REPLY_RESOLUTION), F.lit(closing),
    )
    return F.struct(
        T.collapse(F.concat(F.lit(V.REPLY_SUBJECT), ref)).alias("subject"), T.strip(body).alias("body")
    )


def template_summary(record: Column, params: Params | None = None) -> Column:
    """Offline five-field summary."""
    done = record["resolution_provided"]
    status = record["overall_case_status"]
    values = {
        "case_overview": F.concat(
            record["customer_name"], F.lit(V.OVERVIEW_CATEGORY), record["complaint_category"],
            F.lit(V.OVERVIEW_PRIORITY), record["priority"], F.lit("."),
        ),
        "key_issue": record["issue_description"],
        "action_taken": F.when(done == V.NOT_PROVIDED, F.lit(V.NO_ACTION)).otherwise(done),
        "current_status": status,
        "recommended_next_action": F.coalesce(_lookup(V.NEXT_ACTIONS, status), F.lit(V.NEXT_ACTION_DEFAULT)),
    }
    return F.struct(*[T.collapse(values[f]).alias(f) for f in V.SUMMARY_FIELDS])


# --------------------------------------------------------------------------- tasks
@dataclass(frozen=True)
class Task:
    """One kind of draft: how it is asked for, parsed, read and what it may mention."""

    name: str
    label: str
    system: Callable[[Params], str]
    template: Callable[[Column, Params], Column]
    parse: Callable[..., DataFrame]
    as_text: Callable[[Column], Column]
    allowed: Callable[[Params], Column]
    draft_type: str


EMAIL_TASK = Task(
    name="customer_email",
    label="Customer email",
    system=prompts.email_system,
    template=template_email,
    parse=validate.parse_email,
    as_text=G.email_text,
    allowed=G.email_allowed_text,
    draft_type=validate.EMAIL_TYPE,
)
SUMMARY_TASK = Task(
    name="case_summary",
    label="Case summary",
    system=lambda params: prompts.SUMMARY_SYSTEM,
    template=template_summary,
    parse=validate.parse_summary,
    as_text=lambda draft: G.summary_text(draft, V.SUMMARY_FIELDS),
    allowed=G.summary_allowed_text,
    draft_type=validate.SUMMARY_TYPE,
)
TASKS = [EMAIL_TASK, SUMMARY_TASK]


def _outcome_columns(task: Task) -> list[str]:
    parts = ["warnings", "error", "input_tokens", "output_tokens", "calls", "seconds"]
    return [task.name, *[f"{task.name}_{p}" for p in parts]]


def _grounding_warnings(task: Task, issues: Column) -> Column:
    return F.transform(issues, lambda i: F.concat(F.lit(f"{task.label} grounding: "), i))


# --------------------------------------------------------------------------- in-row loop
SIZES = ["_record_chars", "_source_chars"]


def with_sizes(df: DataFrame, record: str = "extraction", source: str = "text") -> DataFrame:
    """Add the lengths of the record as JSON and of the source, unless they are there: every prompt's length follows from them."""
    texts = [F.to_json(F.col(record)), F.col(source)]
    return df.withColumns({name: once(F.length(text)) for name, text in zip(SIZES, texts) if name not in df.columns})


def draft_with_columns(
    df: DataFrame,
    task: Task,
    drafts: Callable[[int, Column], Column],
    params: Params,
    record: str = "extraction",
    source: str = "text",
) -> DataFrame:
    """Grounded drafting when a draft is a column expression.

    ``drafts(attempt, feedback)`` gives the draft struct of one attempt. All attempts are
    laid out side by side on the row and a later one is evaluated only where the earlier
    one had findings, so the loop costs one pass: no wave, no union, nothing written.
    """
    ready = F.col(record).isNotNull()
    none = F.lit(None).cast("array<string>")
    own = [name for name in (*SIZES, *G.SOURCE_VIEWS) if name not in df.columns]
    allowed = task.allowed(params)
    out = with_sizes(G.prepare_reference(df, F.col(source), allowed), record, source)
    tried = []
    for attempt in range(params.grounding_max_corrections + 1):
        redo = ready if attempt == 0 else F.size(F.col(f"_issues{attempt - 1}")) > 0
        feedback = none if attempt == 0 else F.col(f"_issues{attempt - 1}")
        d, i = f"_draft{attempt}", f"_issues{attempt}"
        out = out.withColumn(d, once(F.when(redo, drafts(attempt, feedback))))
        out = out.withColumn(f"_text{attempt}", once(task.as_text(F.col(d))))
        written = F.col(f"_text{attempt}")
        out = out.withColumn(f"_ascii{attempt}", once(P.is_ascii(written)))
        out = out.withColumn(i, once(F.when(redo, G.issue_list(written, allowed, F.col(f"_ascii{attempt}")))))
        spent_in = prompts.tokens_of(
            F.lit(len(task.system(params))), prompts.draft_user_chars(*map(F.col, SIZES), feedback)
        )
        out = out.withColumns(
            {
                f"_in{attempt}": F.when(redo, spent_in).otherwise(F.lit(0)),
                f"_out{attempt}": F.when(redo, prompts.estimate_tokens(F.to_json(F.col(d)))).otherwise(F.lit(0)),
                f"_call{attempt}": F.when(redo, F.lit(1)).otherwise(F.lit(0)),
            }
        )
        tried.append(attempt)

    def total(prefix: str) -> Column:
        result = F.lit(0).cast("bigint")
        for a in tried:
            result = result + F.col(f"{prefix}{a}")
        return result

    latest = list(reversed(tried))
    result = out.withColumns(
        {
            task.name: F.coalesce(*[F.col(f"_draft{a}") for a in latest]),
            f"{task.name}_warnings": _grounding_warnings(
                task, F.coalesce(*[F.col(f"_issues{a}") for a in latest])
            ),
            f"{task.name}_error": F.lit(None).cast("string"),
            f"{task.name}_input_tokens": total("_in"),
            f"{task.name}_output_tokens": total("_out"),
            f"{task.name}_calls": total("_call"),
        }
    )
    scratch = [f"{p}{a}" for a in tried for p in ("_draft", "_text", "_ascii", "_issues", "_in", "_out", "_call")]
    return result.drop(*scratch, *G.REFERENCE_COLUMNS, *own)


def draft_with_templates(df: DataFrame, task: Task, params: Params, record: str = "extraction") -> DataFrame:
    """Grounded drafting with the offline templates."""
    return draft_with_columns(
        df, task, lambda attempt, feedback: task.template(F.col(record), params), params, record
    )


# --------------------------------------------------------------------------- model calls
def is_retryable(error_classes: Column) -> Column:
    """Anything may be retried unless one of its classes is on the fixed list."""
    listed = F.array(*[F.lit(n) for n in V.NON_RETRYABLE_ERRORS])
    return ~F.coalesce(F.arrays_overlap(error_classes, listed), F.lit(False))


def _judged(rows: DataFrame, parse: Callable[..., DataFrame]) -> DataFrame:
    """Add ``draft``, ``_error`` and ``_retry`` to rows with an answer in ``_call``."""
    parsed = parse(rows.withColumn("_raw", F.col("_call.raw")), "_raw", out="draft", problems="_problems")
    failed = F.col("_call.error").isNotNull()
    bad = ~failed & F.col("draft").isNull()
    return parsed.withColumns(
        {
            "_error": F.when(failed, F.col("_call.error")).when(
                bad, F.concat(F.lit("InvalidOutput: "), F.array_join("_problems", ", "))
            ),
            "_retry": (failed & is_retryable(F.col("_call.error_classes"))) | bad,
        }
    )


def _waves(rows: DataFrame, first: dict[str, Column], step: Callable[[DataFrame], DataFrame], most: int, stage: Stage) -> DataFrame:
    """The last state of each ``_key`` of ``rows`` after at most ``most`` waves.

    ``first`` gives the columns of the state before the first wave; ``step`` takes rows with their
    state and returns ``_key``, the columns of the next state and more, ``_more`` among them. Only
    that is written. A later wave joins it to the rows whose state asks for more, so what a wave
    writes and reads grows with the rows that still need work, and texts are never written.
    """
    done: list[DataFrame] = []
    pending = rows.withColumns(first)
    for wave in range(most):
        written = stage.write(step(pending).withColumn("_wave", F.lit(wave)))
        done.append(written)
        again = written.filter("_more")
        if wave == most - 1 or again.isEmpty():
            break
        # Rows of equal prompts have one key; one state serves them all.
        state = again.groupBy("_key").agg(*[F.max_by(c, F.col("_spent_seconds")).alias(c) for c in first])
        pending = rows.join(state, "_key")
    every = done[0]
    for more in done[1:]:
        every = every.unionByName(more)
    columns = [c for c in every.columns if c not in ("_key", "_wave", "_more")]
    last = every.groupBy("_key").agg(F.max_by(F.struct(*columns), F.struct("_wave", "_spent_seconds")).alias("_last"))
    return last.select("_key", "_last.*")


def call_model(
    df: DataFrame, call: Model, parse: Callable[..., DataFrame], params: Params, stage: Stage, answers: Answers | None = None
) -> DataFrame:
    """Ask for every row holding ``_system`` and ``_user``; repeat the failed rows in waves.

    Adds draft, error, tokens, attempts and seconds. The outcome of each wave is written before it is looked
    at, so no answer is asked for twice when a later step is recomputed, and with ``answers`` not even
    when the whole run is started again. Run this stage with ``spark.speculation`` off, or
    speculative tasks repeat calls. ``df`` is written once: the waves join states to it, and a join on
    top of long chains of text rules is more than the optimizer can plan.
    """
    return _called(stage.write(df), call, parse, params, stage, answers)


def _called(
    df: DataFrame, call: Model, parse: Callable[..., DataFrame], params: Params, stage: Stage, answers: Answers | None
) -> DataFrame:
    prompted = df.withColumn("_user", once(F.col("_user")))
    keyed = prompted.withColumn("_key", once(prompt_digest(F.col("_system"), F.col("_user"))))

    def step(rows: DataFrame) -> DataFrame:
        judged = _judged(asked(rows, call, F.col("_try"), answers, params.calls_in_flight), parse)

        def spent(tokens: str) -> Column:
            return F.when(F.col("_error").isNull(), F.col(f"_call.{tokens}")).otherwise(0).cast("bigint")

        return judged.select(
            "_key", "draft", F.col("_error").alias("call_error"), spent("input_tokens").alias("call_input_tokens"),
            spent("output_tokens").alias("call_output_tokens"), F.col("_try").alias("call_attempts"), (F.col("_try") + 1).alias("_try"),
            (F.col("_spent_seconds") + F.col("_call.seconds")).alias("_spent_seconds"), F.col("_retry").alias("_more"),
        )

    first = {"_try": F.lit(1).cast("bigint"), "_spent_seconds": F.lit(0.0)}
    last = _waves(keyed.select("_key", "_system", "_user"), first, step, params.max_attempts, stage)
    return keyed.join(last.drop("_try").withColumnRenamed("_spent_seconds", "call_seconds"), "_key").drop("_key")


def extract_with_model(df: DataFrame, call: Model, params: Params, stage: Stage, answers: Answers | None = None) -> DataFrame:
    """Add record, error and cost columns from a model; rows without text pass through."""
    df = stage.write(df)
    ready = df.filter(F.col("text").isNotNull()).withColumns(
        {"_system": F.lit(prompts.RECORD_SYSTEM), "_user": prompts.record_user(F.col("file_name"), F.col("text"))}
    )
    rows = _called(ready, call, validate.parse_record, params, stage, answers)
    named = rows.select(
        *df.columns,
        F.col("draft").alias("extraction"),
        F.col("call_error").alias("extraction_error"),
        F.when(F.col("call_error").isNull(), F.col("call_input_tokens")).otherwise(F.lit(0)).cast("bigint").alias("extraction_input_tokens"),
        F.when(F.col("call_error").isNull(), F.col("call_output_tokens")).otherwise(F.lit(0)).cast("bigint").alias("extraction_output_tokens"),
        F.when(F.col("call_error").isNull(), F.col("call_attempts")).otherwise(F.lit(0)).cast("bigint").alias("extraction_calls"),
        F.col("call_seconds").alias("extraction_seconds"),
    )
    return named.unionByName(df.filter(F.col("text").isNull()), allowMissingColumns=True)


def _draft_key(task: Task, params: Params, record: str) -> Column:
    """Digest of all that a draft is made from; null for rows without a record."""
    user = prompts.draft_user(F.col(record), F.col("text"), F.lit(None).cast("array<string>"))
    return once(F.when(F.col(record).isNotNull(), prompt_digest(F.lit(task.system(params)), user)))


def with_keys(df: DataFrame, tasks: Iterable[Task], params: Params, record: str = "extraction") -> DataFrame:
    """``df`` with the key of each task's drafts, unless it is there; written with the rows, a prompt is digested once."""
    keys = {f"_{task.name}_key": task for task in tasks}
    return df.withColumns({name: _draft_key(task, params, record) for name, task in keys.items() if name not in df.columns})


def draft_outcomes(
    df: DataFrame, task: Task, call: Model, params: Params, stage: Stage, record: str = "extraction", answers: Answers | None = None
) -> DataFrame:
    """The outcome columns of a task by ``_key``, from waves over the rows whose call failed or whose draft was rejected.

    ``df`` is a written table, since every wave reads it again: all of it first, then what is rejected.
    A wave is one call for each of its rows: a failed call is repeated up to ``max_attempts`` times, a
    draft with findings is asked for again with them, up to ``grounding_max_corrections`` times.
    """
    keyed = with_keys(df.filter(F.col(record).isNotNull()), [task], params, record)
    base = keyed.select(F.col(f"_{task.name}_key").alias("_key"), F.col(record).alias("_record"), "text")
    texts = F.lit(None).cast("array<string>")
    zero = F.lit(0).cast("bigint")
    first = {
        "_turn": F.lit(0), "_try": F.lit(1), "_feedback": texts,
        "_spent_in": zero, "_spent_out": zero, "_spent_calls": zero, "_spent_seconds": F.lit(0.0),
    }

    def step(rows: DataFrame) -> DataFrame:
        asking = rows.withColumns(
            {
                "_system": F.lit(task.system(params)),
                "_user": once(prompts.draft_user(F.col("_record"), F.col("text"), F.col("_feedback"))),
            }
        )
        judged = _judged(asked(asking, call, F.col("_try"), answers, params.calls_in_flight), task.parse)
        checked = G.check_grounding(judged, task.as_text(F.col("draft")), F.col("text"), task.allowed(params), out="_issues")
        good = F.col("_error").isNull()
        redo = good & (F.size("_issues") > 0) & (F.col("_turn") < params.grounding_max_corrections)
        retry = F.col("_retry") & (F.col("_try") < params.max_attempts)

        def spent(tokens: str) -> Column:
            return F.when(good, F.col(f"_call.{tokens}")).otherwise(0).cast("bigint")

        return checked.select(
            "_key", F.when(good, F.col("draft")).alias("draft"), F.when(good, F.col("_issues")).alias("_issues"), "_error",
            F.when(redo, F.col("_turn") + 1).otherwise(F.col("_turn")).alias("_turn"),
            F.when(redo, F.lit(1)).otherwise(F.col("_try") + 1).alias("_try"),
            F.when(redo, F.col("_issues")).otherwise(F.col("_feedback")).alias("_feedback"),
            (F.col("_spent_in") + spent("input_tokens")).alias("_spent_in"),
            (F.col("_spent_out") + spent("output_tokens")).alias("_spent_out"),
            (F.col("_spent_calls") + 1).alias("_spent_calls"),
            (F.col("_spent_seconds") + F.col("_call.seconds")).alias("_spent_seconds"),
            (redo | retry).alias("_more"),
        )

    most = (params.grounding_max_corrections + 1) * params.max_attempts
    last = _waves(base, first, step, most, stage)
    names = _outcome_columns(task)
    failed = F.col("_error").isNotNull()
    # A failed task reports its error and nothing else, whatever earlier drafts cost.
    return last.select(
        F.col("_key").alias(f"_{task.name}_key"),
        F.col("draft").alias(names[0]),
        F.when(~failed, _grounding_warnings(task, F.col("_issues"))).alias(names[1]),
        F.col("_error").alias(names[2]),
        F.when(failed, zero).otherwise(F.col("_spent_in")).alias(names[3]),
        F.when(failed, zero).otherwise(F.col("_spent_out")).alias(names[4]),
        F.when(failed, zero).otherwise(F.col("_spent_calls")).alias(names[5]),
        F.col("_spent_seconds").alias(names[6]),
    )


def with_outcomes(df: DataFrame, outcomes: dict[Task, DataFrame], params: Params, record: str = "extraction") -> DataFrame:
    """``df`` with the outcome columns of the tasks; rows without a record have none.

    Columns that no later step reads, texts above all, are not moved by the joins.
    """
    ready = with_keys(df.filter(F.col(record).isNotNull()), outcomes, params, record)
    for task, rows in outcomes.items():
        ready = ready.join(rows, f"_{task.name}_key").drop(f"_{task.name}_key")
    rest = df.filter(F.col(record).isNull()).drop(*[f"_{task.name}_key" for task in outcomes])
    return ready.unionByName(rest, allowMissingColumns=True)


def draft_with_model(
    df: DataFrame, task: Task, call: Model, params: Params, stage: Stage, record: str = "extraction", answers: Answers | None = None
) -> DataFrame:
    """Grounded drafting with a model: ``df`` and the outcome columns of one task."""
    df = stage.write(with_keys(df, [task], params, record))
    return with_outcomes(df, {task: draft_outcomes(df, task, call, params, stage, record, answers)}, params, record)
