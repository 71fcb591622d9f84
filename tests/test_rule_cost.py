"""Rules that all case queries share look at a text as seldom as they can, and find the same."""

import re

from pyspark.sql import functions as F

from casemill.functions import patterns as P
from casemill.functions import text as T


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_words_are_tried_only_where_three_letters_fit():
    assert P._any_case(["abc", "xbd"]).startswith("(?=[aAxX][bB][cCdD])")
    assert P._any_case(["ab", "c"]).startswith("(?=[aAcC])")


def test_words_are_found_in_any_letter_case(column):
    texts = ["x MY NAME IS Ann Lee", "Kat: PoLİCYHOLDER: Bo Berg", "thankſ,\n Cy Diaz", "fro Al Be", "fro", "na", None]
    assert column(P.person_name, texts) == ["Ann Lee", "Bo Berg", "Cy Diaz", "", "", "", None]


def test_normalised_texts_end_and_begin_without_blanks(column):
    texts = [
        "", "\n\n\n", " \t\n \n", "\n\n a", "a\n", "a \n\n \n", "a\n\n\n\nb\n\n\n", "a\n\nb\nc", "　\n a \n\x85\n\n b \xa0", "\r\r\r\nx\x00\r\n\r\r", None,
    ]

    def model(text):
        lf = text.replace("\x00", "").replace("\r\n", "\n").replace("\r", "\n")
        trimmed = "\n".join(line.rstrip(P.WS_CHARS) for line in lf.split("\n"))
        return re.sub(r"\n{3,}", "\n\n", trimmed).strip(P.WS_CHARS)

    assert column(T.normalise, texts) == [None if t is None else model(t) for t in texts]


def test_leading_sentences_are_not_split(spark, column):
    texts = ["One. Two! Three. Four.", "Details: a? b", "Details: a?b. . c. d", "one. ", " ! ? .", "", "é. ü! x. y", None]
    found = ["One. Two!", "a? b", "a?b. .", "one.", "! ?", "Not Provided", "é. ü!", None]
    assert column(T.leading_sentences, texts) == found
    assert "split(" not in plan(spark.range(1).select(T.leading_sentences(F.col("id").cast("string"))))
