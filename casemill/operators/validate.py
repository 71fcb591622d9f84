"""Turn model answers (JSON text) into typed records, or into rejects with reasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casemill import fixed_values as V
from casemill.functions import text as T
from casemill.functions.once import once

RECORD_TYPE = "struct<" + ",".join(f"{f}:string" for f in V.RECORD_FIELDS) + ">"
EMAIL_TYPE = "struct<" + ",".join(f"{f}:string" for f in V.EMAIL_FIELDS) + ">"
SUMMARY_TYPE = "struct<" + ",".join(f"{f}:string" for f in V.SUMMARY_FIELDS) + ">"


def reasons(*checks: tuple[Column, str]) -> Column:
    """Reason codes whose condition holds, in the order given."""
    return F.array_compact(F.array(*[F.when(bad, F.lit(code)) for bad, code in checks]))


def _parse(df: DataFrame, raw: str, fields: list[str], type_: str) -> DataFrame:
    """Add ``_keys`` and ``_in``: a NULL value is not the same as an absent key."""
    return df.withColumns(
        {"_keys": once(F.json_object_keys(F.col(raw))), "_in": once(F.from_json(F.col(raw), type_))}
    )


def _absent(field: str) -> Column:
    return ~F.array_contains(F.col("_keys"), field)


def _record_value(field: str) -> Column:
    raw = F.col(f"_in.{field}")
    if field == "email":
        return T.lower_email(T.clean(raw))
    if field in V.TEXT_FIELDS:
        return T.clean(raw)
    if field in V.YES_NO_FIELDS:
        return T.yes_no(raw)
    return {"complaint_category": T.category, "overall_case_status": T.case_status, "priority": T.priority}[field](raw)


def _finish(df: DataFrame, fields: list[str], problems: str, out: str) -> DataFrame:
    value = F.struct(*[F.col(f"_v_{f}").alias(f) for f in fields])
    return df.withColumn(out, once(F.when(F.size(problems) == 0, value))).drop(
        "_keys", "_in", *[f"_v_{f}" for f in fields]
    )


def parse_record(df: DataFrame, raw: str, out: str = "extraction", problems: str = "validation_errors") -> DataFrame:
    """Add the coerced record, NULL when rejected, and the reject reasons."""
    fields = V.RECORD_FIELDS
    coerced = _parse(df, raw, fields, RECORD_TYPE).withColumns({f"_v_{f}": once(_record_value(f)) for f in fields})
    found = reasons(
        *[(_absent(f), f"missing:{f}") for f in fields],
        *[(~_absent(f) & F.col(f"_v_{f}").isNull(), f"invalid:{f}") for f in fields],
    )
    checked = coerced.withColumn(
        problems, once(F.when(F.col("_keys").isNull(), F.array(F.lit("unparseable"))).otherwise(found))
    )
    return _finish(checked, fields, problems, out)


def _draft_text(value: Column) -> Column:
    """A JSON null is a value like any other here and reads as its name."""
    return F.coalesce(value, F.lit("None"))


def parse_email(df: DataFrame, raw: str, out: str = "draft", problems: str = "validation_errors") -> DataFrame:
    """Add the reply draft, NULL when its subject is empty or its body too short."""
    coerced = _parse(df, raw, V.EMAIL_FIELDS, EMAIL_TYPE).withColumns(
        {
            "_v_subject": once(T.collapse(_draft_text(F.col("_in.subject")))),
            "_v_body": once(T.strip(_draft_text(F.col("_in.body")))),
        }
    )
    found = reasons(
        (_absent("subject"), "missing:subject"),
        (_absent("body"), "missing:body"),
        (~_absent("subject") & (F.col("_v_subject") == ""), "invalid:subject"),
        (~_absent("body") & (F.length("_v_body") < V.MIN_BODY_CHARS), "invalid:body"),
    )
    checked = coerced.withColumn(
        problems, once(F.when(F.col("_keys").isNull(), F.array(F.lit("unparseable"))).otherwise(found))
    )
    return _finish(checked, V.EMAIL_FIELDS, problems, out)


def parse_summary(df: DataFrame, raw: str, out: str = "draft", problems: str = "validation_errors") -> DataFrame:
    """Add the five-field summary draft, NULL when a field is absent or empty."""
    fields = V.SUMMARY_FIELDS
    coerced = _parse(df, raw, fields, SUMMARY_TYPE).withColumns(
        {f"_v_{f}": once(T.collapse(_draft_text(F.col(f"_in.{f}")))) for f in fields}
    )
    found = reasons(
        *[(_absent(f), f"missing:{f}") for f in fields],
        *[(~_absent(f) & (F.col(f"_v_{f}") == ""), f"invalid:{f}") for f in fields],
    )
    checked = coerced.withColumn(
        problems, once(F.when(F.col("_keys").isNull(), F.array(F.lit("unparseable"))).otherwise(found))
    )
    return _finish(checked, fields, problems, out)


def split_rejects(df: DataFrame, problems: str = "validation_errors") -> tuple[DataFrame, DataFrame]:
    """Accepted rows and rejected rows."""
    return df.filter(F.size(problems) == 0), df.filter(F.size(problems) > 0)
