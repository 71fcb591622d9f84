"""Column functions against small Python models, on hand-made and random texts."""

import random
import re

import pytest
from pyspark.sql import functions as F

from casemill import fixed_values as V
from casemill.functions import patterns as P
from casemill.functions import text as T

# The item shapes in the regex dialect of the standard library.
EMAIL = re.compile(r"[A-Za-z0-9._%+'-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}")
PHONE = re.compile(r"(?<![\w-])(?:\+?\d{1,3}[\s.-]?)?\(?\d{3}\)?[\s.-]?\d{3}[\s.-]?\d{4}(?![\w-])")
MONEY = re.compile(r"(?:[$€£₹]\s?|\b(?:USD|CAD|INR|EUR|GBP|Rs\.?)\s?)\d[\d,]*(?:\.\d{1,2})?", re.I)
REFERENCE = re.compile(r"\b[A-Z]{2,6}-\d{3,}(?:-\d+)*\b")
PLACEHOLDER = re.compile(
    r"\[(?:[A-Z][A-Za-z ]{1,30}|insert[^\]]*|your [^\]]*)\]|\{\{?\s*[a-z_ ]+\s*\}?\}|<[A-Z][A-Za-z ]{2,30}>"
)

PIECES = [
    "a@b.co", "x.y+z'q@mail.example.org", "@", "b.com", "_", "-", ".", ",", " ", "  ", "\n", "\n\n\n", "\r\n", "\r", "\t",
    "\x0b", "\x1c", "\x1f", "\x85", " ", " ", " ", "　", "\x00", "613", "555", "0142", "6135550142", "+1 ", "(613) ",
    "٣", "٦١٣", "é", "ß", "ſ", "İ", "K", "$", "€ ", "₹", "USD ", "usd", "Rs. ", "rſ", "eur", "1,200", "12.5", ".99", "CMP-", "ORD-1234",
    "-77", "AB-123-45x", "X-999", "[Agent Name]", "[insert this]", "[your name", "]", "{", "}", "{{ foo }}", "{ \n }", "{a  b}", "<Customer Name>",
    "<", ">", "Name: ", "my name is", "From", "Regards,", "thanks", "Anna", "Bo Li", "O'Neil-Smith", "word", "Sentence one. ", "Really? ", "No! ",
    "Details: ", "message |", "Action taken", ":", "|", "complaint",
]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(7)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 14))) for _ in range(3000)]


def test_normalise(column, texts):
    pairs = {
        "a \t\r\nb\r\rc": "a\nb\n\nc", "\x00 x\x00y \n\n\n\n z \n": "x y".replace(" ", "") + "\n\n z", "\n\n": "", "p\u3000\nq\x85": "p\nq",
        "one\n \n \n \ntwo": "one\n\ntwo",
    }
    assert column(T.normalise, list(pairs)) == list(pairs.values())
    for got in column(T.normalise, texts):
        assert not {"\x00", "\r"} & set(got) and "\n\n\n" not in got and got == got.strip()
        assert all(line == line.rstrip() for line in got.split("\n"))


def test_strip_and_collapse(column, texts):
    assert column(T.strip, texts) == [s.strip() for s in texts]
    assert column(T.collapse, texts) == [" ".join(s.split()) for s in texts]


@pytest.mark.parametrize(
    "fn, pattern",
    [(P.all_emails, EMAIL), (P.all_phones, PHONE), (P.all_amounts, MONEY), (P.all_references, REFERENCE),
     (P.all_placeholders, PLACEHOLDER)],
)
def test_items(column, texts, fn, pattern):
    assert column(fn, texts) == [pattern.findall(s) for s in texts]


def test_digit_lookup(column, texts):
    rng = random.Random(3)
    number = "".join(rng.choice("0123456789") for _ in range(40))
    near = [rng.choice(["", "-", " ", ") ", " - "]).join(["", *number, ""]) for _ in range(20)]
    far = [f"{number[:9]}    {number[9:]}", number[:-1], "no digits", ""]
    got = column(lambda t: P.digits_present(F.lit(number), P.close_digit_gaps(t)), near + far)
    assert got == [True] * 20 + [False] * 4
    assert column(lambda t: P.digits_present(F.lit(""), P.close_digit_gaps(t)), ["1", ""]) == [False, False]
    wide = column(lambda t: P.digits_present(F.lit("\u0663\u0664"), P.close_digit_gaps(t)), ["x\u0663/\u0664", "34"])
    assert wide == [True, False]


def test_amount_key(column):
    amounts = ["$1,200.5", "Rs. 1,200,", "€ 7", "USD 0.99", "£12,"]
    assert column(P.amount_key, amounts) == ["1200.50", "1200.00", "7.00", "0.99", "12.00"]


def test_first_items(column, texts):
    names = {
        "Customer name: Eva Lund\nx": "Eva Lund", "hello, MY NAME IS Jo-Ann O'Hara": "Jo-Ann O'Hara", "name |  Max": "Max", "From:\nIda B. Wu": "Ida B. Wu",
        "nothing here": "", "Best regards,\n\n  Otto Kern": "Otto Kern", "thanks Otto": "", "Cheers!\nPia\nname: Rolf": "Rolf", "name: lower case": "",
        "account holder: A B C D E F": "",
    }
    assert column(P.person_name, list(names)) == list(names.values())
    assert column(P.first_email, texts) == [next(iter(EMAIL.findall(s)), "") for s in texts]
    assert column(P.first_reference, texts) == [next(iter(REFERENCE.findall(s)), "") for s in texts]
    phones = {"a 204-555-0167 b 204-555-0168": "204-555-0167", "+49 (431) 555 0123": "+49 (431) 555 0123", "x2045550167y": "2045550167", "555-0167": ""}
    assert column(P.first_phone, list(phones)) == list(phones.values())


def test_leading_sentences(column):
    long = "word " * 200 + "end."
    pairs = {
        "Details: One here. Two there! Three.": "One here. Two there!", "no heading. Second? Third.": "no heading. Second?", "MESSAGE |  only one": "only one",
        "intro\nComplaint :\n a\n b. c": "a b. c", "details:": V.NOT_PROVIDED, "": V.NOT_PROVIDED, f"{long} {long} x.": f"{long} {long}", "A.B.C d": "A.B.C d",
    }
    assert column(T.leading_sentences, list(pairs)) == list(pairs.values())
    assert column(lambda t: T.leading_sentences(t, max_chars=4), ["abcdef. x"]) == ["abcd"]


def test_resolution_line(column):
    pairs = {
        "Action taken: voucher sent\nmore": "voucher sent", "RESOLUTION PROVIDED by phone | money back ": "money back ", "branch response\n\n called her": "called her",
        "action taken": "", "nothing": "", "Action taken:\n": "",
    }
    assert column(P.resolution_line, list(pairs)) == list(pairs.values())


def test_clean_values(column):
    missing = ["", "N/A", None, "unknown", "  not provided ", "--", " NULL\t"]
    assert column(T.clean, missing) == ["Not Provided"] * len(missing)
    assert column(T.clean, ["  a \n b "]) == ["a b"]
    assert column(T.yes_no, ["true", "yes", "N", "false", "perhaps", " 1 ", None]) == ["Yes", "Yes", "No", "No", None, "Yes", None]
    assert column(T.case_status, ["in progress", "Maybe"]) == ["In Progress", None]
    assert column(T.priority, [" critical "]) == ["Critical"]
    assert column(T.category, ["Weird stuff", "other", "fraud & security", None]) == ["Other", "Other", "Fraud & Security", "Other"]
    assert column(T.lower_email, ["A@B.Co", "Not Provided"]) == ["a@b.co", "Not Provided"]


def test_between(column):
    got = column(lambda t: T.between(t, "<a>", "</a>"), ["x<a> y\n</a>z</a>", "<a>open", "none", "</a><a>q</a>"])
    assert got == ["y", "", "", "q"]


def test_file_names(column):
    names = ["a.b.TXT", ".txt", "x", "x.", "..a", "a.tar.gz", "~$x.docx", "sp ace.PDF"]
    assert column(T.suffix, names) == [".TXT", "", "", "", ".a", ".gz", ".docx", ".PDF"]
    assert column(T.stem, names) == ["a.b", ".txt", "x", "x.", ".", "a.tar", "~$x", "sp ace"]
    assert column(T.is_supported, names) == [True, False, False, False, False, False, True, True]
    assert column(T.is_hidden, names) == [False, True, False, False, True, False, True, False]


UNITS = [" ", "a", "1", "-1", "\n", "{ ", "A-", "from ", "1.", "@", "a@", "\t\u3000", "[your ", "thanks\n", "message "]


def _long(n):
    return ["AB-123" + unit * (n // len(unit)) + "z" for unit in UNITS]


@pytest.mark.parametrize(
    "fn", [T.normalise, T.collapse, T.strip, P.all_emails, P.all_phones, P.all_amounts, P.all_references,
           P.all_placeholders, P.close_digit_gaps, P.person_name, P.resolution_line, T.leading_sentences, P.first_email, P.first_phone],
)
def test_long_runs_stay_linear(column, fn):
    """A long run of one piece must neither hang nor overflow the matcher's stack."""
    column(fn, _long(300_000))
