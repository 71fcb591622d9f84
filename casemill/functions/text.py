"""Text preparation and scalar normalisers as column functions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from casemill import fixed_values as V
from casemill.functions import patterns as P


def sentinel() -> Column:
    return F.lit(V.NOT_PROVIDED)


def strip(text: Column) -> Column:
    """White space removed from both ends (SQL ``trim`` alone only knows the space)."""
    return F.btrim(text, F.lit(P.WS_CHARS))


def collapse(text: Column, ascii_: Column | None = None) -> Column:
    """Runs of white space become one space; none at the ends.

    Only a run that is not a single space is matched, so ordinary text is left alone.
    """
    return P.by_alphabet(text, lambda p: _collapsed(text, p), ascii_)


def _collapsed(text: Column, p: Callable[[str], str]) -> Column:
    return F.trim(F.regexp_replace(text, p(rf"{P.ANY_WS}(?:(?<! ){P.ANY_WS}*+|{P.ANY_WS}++)"), " "))


def normalise(text: Column) -> Column:
    """NULs dropped, one newline style, lines right-trimmed, blank runs squeezed, ends stripped."""
    steps = [("\x00", ""), ("\r\n", "\n"), ("\r", "\n")]
    lf = text
    for old, new in steps:
        lf = F.replace(lf, F.lit(old), F.lit(new))
    ws = P.ANY_WS_NOT_NL
    # What follows a blank within a line settles most of them before the test for the start of its run.
    ends = rf"{ws}(?![!-~])(?<!{ws}{ws}){ws}*+(?=\n|\z)"
    trimmed = P.by_alphabet(text, lambda p: F.regexp_replace(lf, p(ends), ""))
    # Lines end without blanks by now, so line breaks alone are left to be taken from the end.
    squeezed = F.regexp_replace(trimmed, r"\n(?:\n*+\z|\n\n++(?<=(\n\n)))", "$1")
    return F.ltrim(squeezed, F.lit(P.WS_CHARS))


def too_short(text: Column) -> Column:
    return F.length(text) < V.MIN_TEXT_CHARS


def truncate(text: Column, max_chars: int | None) -> Column:
    """The whole text, or its beginning when a limit is named."""
    return text if max_chars is None else F.left(text, F.lit(max_chars))


def is_truncated(text: Column, max_chars: int | None) -> Column:
    return F.lit(False) if max_chars is None else F.length(text) > max_chars


def clean(value: Column, ascii_: Column | None = None) -> Column:
    """Collapsed text, or the sentinel when it is NULL or spells "missing"."""
    flat = collapse(value, ascii_)
    return F.when(flat.isNull() | F.lower(flat).isin(V.MISSING_TOKENS), sentinel()).otherwise(flat)


def yes_no(value: Column) -> Column:
    """Yes, No, or NULL when the value is neither."""
    key = F.lower(strip(value))
    return F.when(key.isin(V.YES_TOKENS), F.lit("Yes")).when(key.isin(V.NO_TOKENS), F.lit("No"))


def match_option(value: Column, options: Sequence[str]) -> Column:
    """Canonical spelling of ``value`` among ``options``, or NULL."""
    pairs = [F.lit(x) for option in options for x in (option.lower(), option)]
    return F.try_element_at(F.create_map(*pairs), F.lower(strip(value)))


def case_status(value: Column) -> Column:
    return match_option(value, V.CASE_STATUSES)


def priority(value: Column) -> Column:
    return match_option(value, V.PRIORITIES)


def category(value: Column) -> Column:
    return F.coalesce(match_option(value, V.CATEGORIES), F.lit("Other"))


def lower_email(value: Column) -> Column:
    return F.when(value == V.NOT_PROVIDED, value).otherwise(F.lower(value))


def has_any(lowered: Column, phrases: Sequence[str]) -> Column:
    """True if text that is already lower case contains one of the phrases."""
    hits = [F.contains(lowered, F.lit(p)) for p in phrases]
    result = hits[0]
    for hit in hits[1:]:
        result = result | hit
    return result


def leading_sentences(
    text: Column, n: int = V.ISSUE_SENTENCES, max_chars: int | None = None, ascii_: Column | None = None
) -> Column:
    """First ``n`` sentences after the description heading, in full unless a limit is named."""
    # Cut behind the n-th end, where white space follows a mark, before white space is collapsed: the rest of a long text is not looked at.
    ends = rf".*?[.!?]{P.ANY_WS}" * n
    beginning = rf"(?s)\A(?:{P.THROUGH_DESCRIPTION})?+({ends}|.*+)"
    body = P.by_alphabet(text, lambda p: _collapsed(F.regexp_extract(text, p(beginning), 1), p), ascii_)
    lead = truncate(body, max_chars)
    return F.when(lead == "", sentinel()).otherwise(lead)


def between(text: Column, start: str, end: str) -> Column:
    """Stripped text between the first ``start`` and the next ``end``; empty if either is absent."""
    opened = F.instr(text, start)
    rest = F.substr(text, opened + len(start))
    closed = F.instr(rest, end)
    inner = strip(F.left(rest, closed - 1))
    return F.when((opened > 0) & (closed > 0), inner).otherwise(F.lit(""))


def suffix(file_name: Column) -> Column:
    """Extension with its dot, as written; empty for dot-files and names ending in a dot."""
    return F.regexp_extract(file_name, r"(?s)\A.+(\.[^.]+)\z", 1)


def stem(file_name: Column) -> Column:
    return F.left(file_name, F.length(file_name) - F.length(suffix(file_name)))


def file_type(file_name: Column) -> Column:
    """Extension in lower case without its dot; empty if there is none."""
    return F.lower(F.substr(suffix(file_name), F.lit(2)))


def is_hidden(file_name: Column) -> Column:
    first, *others = [F.startswith(file_name, F.lit(p)) for p in V.HIDDEN_PREFIXES]
    for other in others:
        first = first | other
    return first


def is_supported(file_name: Column) -> Column:
    return F.lower(suffix(file_name)).isin(V.SUPPORTED_EXTENSIONS)
