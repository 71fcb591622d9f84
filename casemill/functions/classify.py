"""Rule-based classification and the full offline record extraction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casemill import fixed_values as V
from casemill.functions import patterns as P
from casemill.functions import text as T
from casemill.functions.once import apart, once


def category_rank(lowered: Column) -> Column:
    """Position of the first keyword group that hits; one past the last when none does."""
    chain = F
    for rank, (_, words) in enumerate(V.CATEGORY_KEYWORDS):
        chain = chain.when(T.has_any(lowered, words), F.lit(rank))
    return chain.otherwise(F.lit(len(V.CATEGORY_KEYWORDS)))


def category_of_rank(rank: Column) -> Column:
    names = [name for name, _ in V.CATEGORY_KEYWORDS] + ["Other"]
    return F.element_at(F.array(*[F.lit(n) for n in names]), rank + 1)


def is_complaint(lowered: Column) -> Column:
    return ~T.has_any(lowered, V.NON_COMPLAINT_PHRASES)


def is_escalated(text: Column, lowered: Column, ascii_: Column | None = None) -> Column:
    """One of the words in any letter case.

    Lower-casing settles it except for three letters that fold to ``s`` or ``i`` only when
    compared without case; texts holding one of them are put to the pattern.
    """
    odd = ~(P.is_ascii(text) if ascii_ is None else ascii_) & F.rlike(text, F.lit(P.ODD_FOLDS)) & F.rlike(text, F.lit(P.ESCALATION))
    return T.has_any(lowered, V.ESCALATION_WORDS) | odd


def has_document(lowered: Column) -> Column:
    return T.has_any(lowered, V.ATTACHMENT_WORDS)


def status_of(escalated: Column, resolved: Column, waiting: Column, in_progress: Column) -> Column:
    return (
        F.when(escalated, "Escalated")
        .when(resolved, "Resolved")
        .when(waiting, "Pending Customer Response")
        .when(in_progress, "In Progress")
        .otherwise("Open")
    )


def priority_of(complaint: Column, category: Column, critical: Column, escalated: Column, high: Column) -> Column:
    return (
        F.when(~complaint, "Low")
        .when((category == "Fraud & Security") | critical, "Critical")
        .when(escalated | high, "High")
        .otherwise("Medium")
    )


def signals(text: Column, lowered: Column, ascii_: Column | None = None) -> dict[str, Column]:
    """The facts the classification rules rest on.

    Each is "the text contains ...", so it can be evaluated on the parts of a text
    and merged with ``min`` / ``bool_or`` when no phrase spans two parts.
    """
    return {
        "category_rank": category_rank(lowered),
        "complaint": is_complaint(lowered),
        "escalated": is_escalated(text, lowered, ascii_),
        "resolved": T.has_any(lowered, V.RESOLVED_PHRASES),
        "waiting": T.has_any(lowered, V.WAITING_PHRASES),
        "in_progress": T.has_any(lowered, V.IN_PROGRESS_PHRASES),
        "critical": T.has_any(lowered, V.CRITICAL_PHRASES),
        "high": T.has_any(lowered, V.HIGH_PHRASES),
        "document": has_document(lowered),
    }


def classify(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the six classified fields to rows holding ``text``."""
    facts = df.withColumn("_lower", once(F.lower(F.col(text))))
    known = F.col(P.ASCII) if P.ASCII in df.columns else None
    facts = facts.withColumns(
        {f"_{name}": once(value) for name, value in signals(F.col(text), F.col("_lower"), known).items()}
    )
    return with_labels(facts).drop("_lower", *[f"_{n}" for n in signals(F.lit(""), F.lit(""))])


def with_labels(facts: DataFrame) -> DataFrame:
    """Turn signal columns into the six record fields."""
    c = F.col
    yes_no = lambda flag: F.when(flag, "Yes").otherwise("No")
    return facts.withColumn("complaint_category", category_of_rank(c("_category_rank"))).withColumns(
        {
            "is_complaint": yes_no(c("_complaint")),
            "escalation_required": yes_no(c("_escalated")),
            "supporting_document_available": yes_no(c("_document")),
            "overall_case_status": status_of(c("_escalated"), c("_resolved"), c("_waiting"), c("_in_progress")),
            "priority": priority_of(
                c("_complaint"), c("complaint_category"), c("_critical"), c("_escalated"), c("_high")
            ),
        }
    )


def extract_record(df: DataFrame, text: str = "text", out: str = "extraction") -> DataFrame:
    """Add the thirteen-field record derived from ``text`` by rules alone."""
    t, known = F.col(text), F.col(P.ASCII)
    own = [] if P.ASCII in df.columns else [P.ASCII]
    told = df.withColumns({name: once(P.is_ascii(t)) for name in own})
    raw = {
        "customer_name": P.person_name(t, known),
        "email": P.first_email(t),
        "phone_number": P.first_phone(t, known),
        "reference_number": P.first_reference(t, known),
        "product_or_service": F.lit(None).cast("string"),
        "issue_description": T.leading_sentences(t, ascii_=known),
        "resolution_provided": P.resolution_line(t, known),
    }
    found = classify(told, text).withColumns(apart(raw))
    cleaned = found.withColumns({f: T.clean(F.col(f), known) for f in raw}).withColumn(
        "email", T.lower_email(F.col("email"))
    )
    return cleaned.withColumn(out, once(F.struct(*V.RECORD_FIELDS))).drop(*V.RECORD_FIELDS, *own)
