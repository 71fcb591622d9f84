"""Texts of ASCII characters alone are read by cheaper patterns, which must find the same."""

import re

import pytest
from pyspark.sql import functions as F

from casemill.functions import patterns as P
from casemill.functions import text as T
from casemill.operators import verify

PATTERNS = [
    P.MONEY, P.PHONE, P.PHONE_LOOSE, P.REFERENCE, P.NAME_AFTER_LABEL, P.NAME_AFTER_SIGN_OFF, P.RESOLUTION_LINE,
    P.THROUGH_DESCRIPTION, P.SHORT_DIGIT_GAP, P.DIGIT_AND_GAP, P.ANY_WS, P.ANY_WS_NOT_NL, P.ANY_WS_NOT_SPACE,
]
TEXT = (
    "Customer name:  Ann  Lee \t\nDetails : paid $1,000.50, usd 5 and Rs. 7 . It broke!\r\n\r\n\r\nCall +1 (613) 555-1234 or 613.555.9999 \n"
    "myusd 5 CMP-2026-001 Action taken:\x1cnone\nThanks,\n Bo Berg [Agent Name] {{date}} <Customer Name>"
)


@pytest.mark.parametrize("pattern", PATTERNS)
def test_plain_patterns_name_no_wide_classes(pattern):
    assert not re.search(r"\\p\{|\\P\{|\\x\{|&&|\(\?iu|[^\x00-\x7f]", P.plain(pattern))


@pytest.mark.parametrize("pattern", PATTERNS)
def test_plain_patterns_find_the_same(spark, pattern):
    rows = spark.createDataFrame([(TEXT,), ("",), (" . 12 - 3  $ 4",)], "t string")
    every = [F.regexp_extract_all("t", F.lit(p), F.lit(0)) for p in (pattern, P.plain(pattern))]
    assert all(a == b for a, b in rows.select(*every).collect())


def test_rules_are_equal_on_ascii_and_wide_texts(column):
    """The same text with one wide letter behind it goes the other way and gives the same."""
    for rule in (P.all_amounts, P.all_phones, P.all_references, P.all_placeholders, P.first_phone, P.close_digit_gaps, T.collapse, T.normalise):
        plain, wide = column(lambda t: F.to_json(F.struct(rule(t).alias("x"))), [TEXT, TEXT + " é"])
        assert plain == wide.replace(" é", "")


def test_sentences_end_where_white_space_is_not_yet_collapsed(column):
    texts = ["  . a.  b?\n\n c", "one", "Message:  One.\tTwo!  Three.", "a. b. ", ""]
    assert column(T.leading_sentences, texts) == [". a.", "one", "One. Two!", "a. b.", "Not Provided"]


def test_references_are_found_as_they_stand_or_squeezed(column):
    """``AB-123`` stands in the first text, and in the second with white space in it."""
    absent = column(lambda t: verify.reference_absent(F.lit("AB - 123"), F.lower(t)), ["x AB-123 y", "x AB\u2003- 12 3", "AB-12", None], "string")
    assert absent == [False, False, True, None]
