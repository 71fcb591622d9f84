"""Find items in generated text that the source does not support (second guardrail)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casemill.functions import patterns as P
from casemill.functions import text as T
from casemill.functions.once import once
from casemill.params import Params


def email_allowed_text(params: Params) -> Column:
    return F.lit(f"{params.company_name}\n{params.email_signature}")


def summary_allowed_text(params: Params) -> Column:
    return F.lit(params.company_name)


def email_text(draft: Column) -> Column:
    return F.concat_ws("\n", draft["subject"], draft["body"])


def summary_text(draft: Column, fields: list[str]) -> Column:
    return F.concat_ws(" ", *[draft[f] for f in fields])


SOURCE_VIEWS = ["_src_lower", "_src_closed", "_src_amounts"]


def source_views(df: DataFrame, source: Column) -> DataFrame:
    """Add the three views of the source text that facts are looked up in, unless they are there.

    They are computed once per row and serve the check of the record and every draft of that row.
    """
    if SOURCE_VIEWS[0] in df.columns:
        return df
    own = [] if P.ASCII in df.columns else [P.ASCII]
    known = F.col(P.ASCII)
    told = df.withColumns({name: once(P.is_ascii(source)) for name in own})
    return told.withColumns(
        {
            "_src_lower": once(F.lower(source)),
            "_src_closed": once(P.close_digit_gaps(source, known)),
            "_src_amounts": once(F.array_distinct(F.transform(P.all_amounts(source, known), P.amount_key))),
        }
    ).drop(*own)


def prepare_reference(df: DataFrame, source: Column, allowed: Column) -> DataFrame:
    """Add the views of the source, and the amounts of source and allowed text together.

    Other items are looked up in the source and in the allowed text one after the other, so that no text is copied.
    """
    none = F.array().cast("array<string>")
    allowed_amounts = F.transform(P.all_amounts(allowed), P.amount_key)
    both = F.array_union(F.coalesce("_src_amounts", none), allowed_amounts)
    return source_views(df, source).withColumn("_ref_amounts", once(both))


REFERENCE_COLUMNS = ["_ref_amounts"]


def _stands_in(value: Column, *texts: Column) -> Column:
    """In one of the texts; a text that is NULL holds nothing."""
    found = F.lit(False)
    for text in texts:
        found = found | F.coalesce(F.contains(text, value), F.lit(False))
    return found


def ungrounded_emails(text: Column, allowed: Column, ascii_: Column) -> Column:
    return F.filter(
        F.array_distinct(P.all_emails(text, ascii_)),
        lambda v: ~_stands_in(F.lower(v), F.col("_src_lower"), F.lower(allowed)),
    )


def ungrounded_phones(text: Column, allowed: Column, ascii_: Column) -> Column:
    return F.filter(
        F.array_distinct(P.all_phones(text, ascii_)),
        lambda v: ~((F.length(P.digits(v)) > 0) & _stands_in(P.digits(v), F.col("_src_closed"), P.close_digit_gaps(allowed))),
    )


def ungrounded_amounts(text: Column, ascii_: Column) -> Column:
    return F.filter(
        F.array_distinct(P.all_amounts(text, ascii_)),
        lambda v: ~F.array_contains(F.col("_ref_amounts"), P.amount_key(v)),
    )


def ungrounded_references(text: Column, allowed: Column, ascii_: Column) -> Column:
    return F.filter(
        F.array_distinct(P.all_references(text, ascii_)),
        lambda v: ~_stands_in(F.lower(v), F.col("_src_lower"), F.lower(allowed)),
    )


def unfilled_placeholders(text: Column) -> Column:
    return F.array_distinct(P.all_placeholders(text))


def issue_list(text: Column, allowed: Column, ascii_: Column) -> Column:
    """Every finding as one sorted list; needs the columns of ``prepare_reference``.

    ``ascii_`` is a column that says whether ``text`` is of ASCII characters alone.
    """

    def named(code: str, values: Column) -> Column:
        return F.transform(values, lambda v: F.concat(F.lit(f"{code}: "), v))

    return F.sort_array(
        F.concat(
            named("blank_placeholder", unfilled_placeholders(text)),
            named("ungrounded_amount", F.transform(ungrounded_amounts(text, ascii_), T.strip)),
            named("ungrounded_email", ungrounded_emails(text, allowed, ascii_)),
            named("ungrounded_phone", F.transform(ungrounded_phones(text, allowed, ascii_), T.strip)),
            named("ungrounded_reference", ungrounded_references(text, allowed, ascii_)),
        )
    )


def check_grounding(
    df: DataFrame, text: Column, source: Column, allowed: Column, out: str = "issues"
) -> DataFrame:
    """Add the sorted findings for ``text`` against ``source`` and ``allowed``."""
    own = SOURCE_VIEWS if SOURCE_VIEWS[0] not in df.columns else []
    draft = F.col("_draft_text")
    return (
        prepare_reference(df, source, allowed)
        .withColumn("_draft_text", once(text))
        .withColumn("_draft_ascii", once(P.is_ascii(draft)))
        .withColumn(out, once(issue_list(draft, allowed, F.col("_draft_ascii"))))
        .drop("_draft_text", "_draft_ascii", *REFERENCE_COLUMNS, *own)
    )
