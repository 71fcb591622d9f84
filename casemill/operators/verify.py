"""Check extracted records against their source text (first guardrail)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casemill import fixed_values as V
from casemill.functions import patterns as P
from casemill.functions import text as T
from casemill.functions.once import once
from casemill.operators.grounding import SOURCE_VIEWS, source_views


def _given(value: Column) -> Column:
    return value != V.NOT_PROVIDED


def _squeeze(text: Column) -> Column:
    return P.replaced(text, rf"[{P.WS}]+", "")


def bad_email_format(email: Column) -> Column:
    return _given(email) & ~P.is_email(email)


def email_absent(email: Column, source_lower: Column) -> Column:
    return _given(email) & P.is_email(email) & ~F.contains(source_lower, F.lower(email))


def phone_absent(phone: Column, closed_source: Column) -> Column:
    number = P.digits(phone)
    return _given(phone) & ~(
        (F.length(number) >= V.MIN_PHONE_DIGITS) & P.digits_present(number, closed_source)
    )


def reference_absent(reference: Column, source_lower: Column) -> Column:
    """Not in the source, white space aside; where it stands there as it is, the source is not squeezed."""
    wanted = _squeeze(F.lower(reference))
    return _given(reference) & ~(F.contains(source_lower, wanted) | F.contains(_squeeze(source_lower), wanted))


def name_absent(name: Column, source_lower: Column) -> Column:
    """No part of the name (two letters or more) occurs in the source."""
    # Found, not split: a pattern is compiled for each text that is split.
    parts = F.filter(F.regexp_extract_all(F.lower(name), F.lit(rf"[^{P.WS},]++"), F.lit(0)), lambda t: F.length(t) > 1)
    return _given(name) & (F.size(parts) > 0) & ~F.exists(parts, lambda t: F.contains(source_lower, t))


def consistency_codes(record: Column) -> list[Column]:
    """Warnings about values that contradict each other, on the corrected record."""
    escalated = record["escalation_required"] == "Yes"
    status = record["overall_case_status"]
    return [
        F.when(escalated & status.isin("Resolved", "Closed"), "consistency: escalation on a finished case"),
        F.when(
            (status == "Resolved") & ~_given(record["resolution_provided"]),
            "consistency: resolved without a resolution",
        ),
        F.when((record["is_complaint"] == "No") & escalated, "consistency: escalation of a non-complaint"),
        F.when(
            ~_given(record["email"]) & ~_given(record["phone_number"]),
            "no contact details: reply cannot be delivered",
        ),
    ]


def verify_record(
    df: DataFrame, record: str = "extraction", source: str = "text", warnings: str = "verify_warnings"
) -> DataFrame:
    """Blank contact details the source does not support and list the findings in order.

    Rows whose record is NULL pass through with NULL warnings.
    """
    r = F.col(record)
    own = SOURCE_VIEWS if SOURCE_VIEWS[0] not in df.columns else []
    prepared = source_views(df, F.col(source))
    tested = prepared.withColumns(
        {
            "_email_format": once(bad_email_format(r["email"])),
            "_email": once(email_absent(r["email"], F.col("_src_lower"))),
            "_phone": once(phone_absent(r["phone_number"], F.col("_src_closed"))),
            "_reference": once(reference_absent(r["reference_number"], F.col("_src_lower"))),
            "_name": once(name_absent(r["customer_name"], F.col("_src_lower"))),
        }
    ).drop(*own)

    def quoted(flag: str, code: str, field: str) -> Column:
        return F.when(F.col(flag), F.concat(F.lit(f"{code}: "), r[field]))

    found = tested.withColumn(
        "_found",
        F.array(
            quoted("_email_format", "email_bad_format", "email"),
            quoted("_email", "email_not_in_source", "email"),
            quoted("_phone", "phone_not_in_source", "phone_number"),
            quoted("_reference", "reference_not_in_source", "reference_number"),
            quoted("_name", "name_not_in_source", "customer_name"),
        ),
    )
    blank = {
        "email": F.col("_email_format") | F.col("_email"),
        "phone_number": F.col("_phone"),
        "reference_number": F.col("_reference"),
    }
    corrected = F.struct(
        *[
            (F.when(blank[f], T.sentinel()).otherwise(r[f]) if f in blank else r[f]).alias(f)
            for f in V.RECORD_FIELDS
        ]
    )
    fixed = found.withColumn(record, once(F.when(r.isNotNull(), corrected)))
    return fixed.withColumn(
        warnings,
        once(
            F.when(
                F.col(record).isNotNull(),
                F.array_compact(F.concat(F.col("_found"), F.array(*consistency_codes(F.col(record))))),
            )
        ),
    ).drop("_email_format", "_email", "_phone", "_reference", "_name", "_found")
