"""Text patterns in the Java regex dialect, and their column functions.

These rules hold for every pattern here:

* character classes are spelled out (``\\p{Nd}``, ``\\p{L}\\p{N}_``, the white-space
  list) instead of relying on ``\\d \\w \\s \\b``, whose reach differs between engines;
* repeats that could be cut in more than one way are made possessive, or anchored
  at the start of their run, so matching stays linear in the text even on a
  megabyte of one repeated character;
* texts of ASCII characters alone are put to ``plain`` patterns, which give the same there and whose
  classes are table lookups throughout;
* what is tested at every position is cheap: word lists are guarded by the set of their
  first letters, classes used everywhere name their characters one by one (a table
  lookup for the regex engine), printable ASCII is turned down before the list of wide
  spaces is looked at.
"""

from __future__ import annotations

import re
import string
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from casemill import fixed_values as V

# White space, as members of a character class.
_WIDE_WS = r"\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
WS = rf"\t\n\x0b\f\r\x1c\x1d\x1e\x1f\x20{_WIDE_WS}"
WS_NOT_NL = rf"\t\x0b\f\r\x1c\x1d\x1e\x1f\x20{_WIDE_WS}"
WS_NOT_SPACE = rf"\t\n\x0b\f\r\x1c\x1d\x1e\x1f{_WIDE_WS}"
# The same as whole classes that turn printable ASCII down first.
ANY_WS = rf"[[^!-~]&&[{WS}]]"
ANY_WS_NOT_NL = rf"[[^!-~]&&[{WS_NOT_NL}]]"
ANY_WS_NOT_SPACE = rf"[[^ -~]&&[{WS_NOT_SPACE}]]"
# The same as plain characters, for trimming.
WS_CHARS = (
    "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)
WORD = r"\p{L}\p{N}_"
NOT_AFTER_WORD = rf"(?<![{WORD}])"
NOT_BEFORE_WORD = rf"(?![{WORD}])"

# Letters outside ASCII that equal an ASCII letter when compared without case.
_ODD_FOLDS = {"i": r"\x{130}\x{131}", "k": r"\x{212A}", "s": r"\x{17F}"}


def _letters(words: list[str], place: int = 0) -> str:
    """The letters of the words at a place, in any letter case, as members of a character class."""
    return "".join(c + c.upper() + _ODD_FOLDS.get(c, "") for c in sorted({w[place].lower() for w in words}))


def _any_case(words: list[str]) -> str:
    """One of the words in any letter case, tried only where their first three letters may stand."""
    places = range(min(3, *map(len, words)))
    return rf"(?={''.join(f'[{_letters(words, k)}]' for k in places)})(?iu:{'|'.join(words)})"


# The shapes of the five scanned item kinds.
_LOCAL = string.ascii_letters + string.digits + "._%+'-"
_DOMAIN = r"@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
_PHONE_CORE = (
    rf"(?:\+?\p{{Nd}}{{1,3}}[{WS}.-]?)?\(?\p{{Nd}}{{3}}\)?[{WS}.-]?\p{{Nd}}{{3}}[{WS}.-]?\p{{Nd}}{{4}}"
)
EMAIL = rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++{_DOMAIN}"
EMAIL_FULL = rf"\A[{_LOCAL}]++{_DOMAIN}\z"
PHONE = rf"(?=[+(\p{{Nd}}])(?<![{WORD}-]){_PHONE_CORE}(?![{WORD}-])"
PHONE_LOOSE = rf"(?=[+(\p{{Nd}}]){_PHONE_CORE}"
_CODE_LETTERS = _letters(V.CURRENCY_CODES)
_CODES = "|".join(rf"(?<=(?iu:{code[0]}))(?iu:{code[1:]})" for code in V.CURRENCY_CODES)
# A sign, or a code that does not continue a word: both are found by their first character.
MONEY = (
    rf"[{V.CURRENCY_SIGNS}{_CODE_LETTERS}](?:(?<=[{V.CURRENCY_SIGNS}])|(?<![{WORD}][{_CODE_LETTERS}])(?:{_CODES}))[{WS}]?"
    r"\p{Nd}[\p{Nd},]*+(?:\.\p{Nd}{1,2})?"
)
REFERENCE = (
    rf"(?=[{string.ascii_uppercase}]){NOT_AFTER_WORD}[A-Z]{{2,6}}-\p{{Nd}}{{3,}}+{NOT_BEFORE_WORD}(?:-\p{{Nd}}++{NOT_BEFORE_WORD})*+"
)
_CLOSED_PLACEHOLDER = r"\[(?:[A-Z][A-Za-z ]{1,30}|insert[^\]]*+|your [^\]]*+)\]"
_OTHER_PLACEHOLDER = (
    rf"\{{\{{?(?:[{WS}]*+[a-z_][a-z_ ]*+[{WS}]*+|[{WS_NOT_SPACE}]*+ [{WS}]*+)\}}?\}}"
    r"|<[A-Z][A-Za-z ]{2,30}>"
)
PLACEHOLDER = f"{_CLOSED_PLACEHOLDER}|{_OTHER_PLACEHOLDER}"
_PERSON = r"([A-Z][A-Za-z'.-]+(?:[ \t]+[A-Z][A-Za-z'.-]+){0,3})"
NAME_AFTER_LABEL = rf"{_any_case(V.NAME_LABELS)}[{WS}]*+(?:[:|][{WS}]*+)?{_PERSON}"
NAME_AFTER_SIGN_OFF = rf"{_any_case(V.SIGN_OFFS)}[,!]?[{WS_NOT_NL}]*+\n[{WS}]*+{_PERSON}"
THROUGH_DESCRIPTION = rf"(?s)\A.*?{_any_case(V.DESCRIPTION_HEADINGS)}[{WS}]*+[:|][{WS}]*+"
RESOLUTION_LINE = rf"{_any_case(V.RESOLUTION_HEADINGS)}[^:\n]*[:|\n][{WS}]*([^\n]+)"
ESCALATION = _any_case(V.ESCALATION_WORDS)
ODD_FOLDS = rf"[{''.join(_ODD_FOLDS.values())}]"
NON_DIGITS = r"\P{Nd}+"
SHORT_DIGIT_GAP = rf"(?<=\p{{Nd}})\P{{Nd}}{{1,{V.MAX_DIGIT_GAP}}}(?=\p{{Nd}})"
DIGIT_AND_GAP = SHORT_DIGIT_GAP.replace("(?<=", "(")

_NO_STRINGS = "array<string>"


def plain(pattern: str) -> str:
    """The pattern for texts of ASCII characters alone, where it finds the same."""
    for negated in ("!-~", " -~"):
        pattern = re.sub(rf"\[\[\^{negated}\]&&(\[[^\]]*\])\]", lambda m: m[1], pattern)
    wide = [_WIDE_WS, *_ODD_FOLDS.values(), *(sign for sign in V.CURRENCY_SIGNS if not sign.isascii())]
    for piece in wide:
        pattern = pattern.replace(piece, "")
    pattern = pattern.replace(WORD, string.ascii_letters + string.digits + "_").replace("(?iu:", "(?i:")
    pattern = re.sub(r"(\[[^\[\]]*)\\p\{Nd\}", rf"\g<1>{string.digits}", pattern)
    return pattern.replace(r"\p{Nd}", f"[{string.digits}]").replace(r"\P{Nd}", f"[^{string.digits}]")


#: Column that says whether the text of a row is of ASCII characters alone, so that its characters are counted once for all rules.
ASCII = "_ascii"


def by_alphabet(text: Column, rule: Callable[[Callable[[str], str]], Column], ascii_: Column | None = None) -> Column:
    """``rule`` with its patterns as they are, or, for a text of ASCII characters alone, ``plain``.

    ``ascii_`` says whether it is, here and below; it may be that of a longer text that the text is a part of.
    """
    known = is_ascii(text) if ascii_ is None else ascii_
    return F.when(known, rule(plain)).otherwise(rule(lambda pattern: pattern))


def is_ascii(text: Column, chars: Column | None = None) -> Column:
    """``chars`` is the number of characters of ``text``, if it is known."""
    return F.octet_length(text) == (F.length(text) if chars is None else chars)


def replaced(text: Column, pattern: str, new: str) -> Column:
    return by_alphabet(text, lambda p: F.regexp_replace(text, p(pattern), new))


def _first(text: Column, pattern: str, group: int = 0, ascii_: Column | None = None) -> Column:
    return by_alphabet(text, lambda p: F.regexp_extract(text, p(pattern), group), ascii_)


def _all(text: Column, pattern: str, ascii_: Column | None = None) -> Column:
    return by_alphabet(text, lambda p: F.regexp_extract_all(text, F.lit(p(pattern)), F.lit(0)), ascii_)


def all_emails(text: Column, ascii_: Column | None = None) -> Column:
    """Every e-mail address; texts without an ``@`` never reach the regex."""
    return F.when(F.contains(text, F.lit("@")), _all(text, EMAIL, ascii_)).otherwise(F.array().cast(_NO_STRINGS))


def all_phones(text: Column, ascii_: Column | None = None) -> Column:
    return _all(text, PHONE, ascii_)


def all_amounts(text: Column, ascii_: Column | None = None) -> Column:
    return _all(text, MONEY, ascii_)


def all_references(text: Column, ascii_: Column | None = None) -> Column:
    """Every reference number; texts without a hyphen never reach the regex."""
    return F.when(F.contains(text, F.lit("-")), _all(text, REFERENCE, ascii_)).otherwise(F.array().cast(_NO_STRINGS))


def all_placeholders(text: Column) -> Column:
    """Every template placeholder; texts without an opening never reach the regex.

    Behind the last closing bracket no bracketed placeholder can end, so none is looked
    for there: an opening without an end would be followed to the end of the text each
    time. No other placeholder contains that bracket, so nothing is cut apart.
    """
    tail = F.substring_index(text, "]", -1)
    head = F.left(text, F.length(text) - F.length(tail))
    found = [F.regexp_extract_all(t, F.lit(p), F.lit(0)) for t, p in ((head, PLACEHOLDER), (tail, _OTHER_PLACEHOLDER))]
    opened = F.contains(text, F.lit("[")) | F.contains(text, F.lit("{")) | F.contains(text, F.lit("<"))
    return F.when(~opened, F.array().cast(_NO_STRINGS)).otherwise(F.concat(*found))


def first_email(text: Column) -> Column:
    """First e-mail address, else an empty string; likewise the two functions below."""
    return F.when(~F.contains(text, F.lit("@")), F.lit("")).otherwise(F.regexp_extract(text, EMAIL, 0))


def first_phone(text: Column, ascii_: Column | None = None) -> Column:
    return _first(text, PHONE_LOOSE, ascii_=ascii_)


def first_reference(text: Column, ascii_: Column | None = None) -> Column:
    return _first(text, REFERENCE, ascii_=ascii_)


def is_email(value: Column) -> Column:
    return F.rlike(value, F.lit(EMAIL_FULL))


def person_name(text: Column, ascii_: Column | None = None) -> Column:
    """Name after a label, else the name under a sign-off, else an empty string."""
    labelled = _first(text, NAME_AFTER_LABEL, 1, ascii_)
    signed = _first(text, NAME_AFTER_SIGN_OFF, 1, ascii_)
    return F.coalesce(F.nullif(labelled, F.lit("")), signed)


def resolution_line(text: Column, ascii_: Column | None = None) -> Column:
    """What stands after a resolution heading, else an empty string."""
    return _first(text, RESOLUTION_LINE, 1, ascii_)


def digits(text: Column) -> Column:
    return F.regexp_replace(text, NON_DIGITS, "")


def close_digit_gaps(text: Column, ascii_: Column | None = None) -> Column:
    """Text in which digits that belong together are adjacent.

    Removing every gap of one to three other characters between two digits turns
    "is this digit sequence here, however it was formatted" into a plain substring
    test. One pass over the source serves all lookups against it; no pattern has to
    be built and compiled per row.
    """
    # Found by its digit, a gap costs no look back at every other character.
    by_digit = F.regexp_replace(text, plain(DIGIT_AND_GAP), "$1")
    return F.when(is_ascii(text) if ascii_ is None else ascii_, by_digit).otherwise(F.regexp_replace(text, SHORT_DIGIT_GAP, ""))


def digits_present(needle: Column, closed_text: Column) -> Column:
    """True if ``needle`` (digits only) occurs in text prepared by ``close_digit_gaps``."""
    return (F.length(needle) > 0) & F.contains(closed_text, needle)


def amount_key(amount: Column) -> Column:
    """Amount as a two-decimal string, whatever its currency mark and separators."""
    bare = F.regexp_replace(F.regexp_replace(amount, r"[^\p{Nd}.]", ""), r"\A\.+|\.+\z", "")
    return F.coalesce(bare.try_cast("decimal(38,2)").cast("string"), bare)
