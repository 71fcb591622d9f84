"""Independent SQL for the registered queries, in the dialect of the check engine.

Shared with the Spark side: the case tables and the fixed values. Everything else is
written a second time, with other means: RE2 patterns with capture groups instead of
look-around, a pattern built per phone number instead of closed digit gaps, whole
transcripts instead of merged turns, long rows instead of one row per document.
"""

from __future__ import annotations

from casemill import fixed_values as V
from casemill.functions import prompts
from casemill.params import Params
from casemill.plans.tables import CASES_SQL

PARAMS = Params()
NP = "'Not Provided'"
WS = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
HWS = WS.replace(r"\t-\r", r"\t\x0b\x0c\r")


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def qlist(values) -> str:
    return ", ".join(q(v) for v in values)


def lines(text: str) -> str:
    """Literal that may span lines."""
    return " || chr(10) || ".join(q(part) for part in text.split("\n"))


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '\A[{WS}]+|[{WS}]+\z', '', 'g')"


def collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, '[{WS}]+', ' ', 'g'))"


def normal(x: str) -> str:
    lf = rf"regexp_replace(replace({x}, chr(0), ''), '\r\n?', chr(10), 'g')"
    right = rf"regexp_replace({lf}, '[{HWS}]+(\n|\z)', '\1', 'g')"
    return strip(rf"regexp_replace({right}, '\n{{3,}}', chr(10) || chr(10), 'g')")


def clean(x: str) -> str:
    flat = collapse(x)
    return f"CASE WHEN {x} IS NULL OR lower({flat}) IN ({qlist(V.MISSING_TOKENS)}) THEN {NP} ELSE {flat} END"


def yes_no(x: str) -> str:
    key = f"lower({strip(x)})"
    return f"CASE WHEN {key} IN ({qlist(V.YES_TOKENS)}) THEN 'Yes' WHEN {key} IN ({qlist(V.NO_TOKENS)}) THEN 'No' END"


def option(x: str, values: list[str]) -> str:
    arms = " ".join(f"WHEN {q(v.lower())} THEN {q(v)}" for v in values)
    return f"CASE lower({strip(x)}) {arms} END"


EMAIL = r"[A-Za-z0-9._%+''-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
PHONE_CORE = rf"(?:\+?\p{{Nd}}{{1,3}}[{WS}.-]?)?\(?\p{{Nd}}{{3}}\)?[{WS}.-]?\p{{Nd}}{{3}}[{WS}.-]?\p{{Nd}}{{4}}"
PHONE = rf"(?:\A|[^\p{{L}}\p{{N}}_-])({PHONE_CORE})(?:[^\p{{L}}\p{{N}}_-]|\z)"
MONEY = rf"(?i)(?:[$€£₹][{WS}]?|\b(?:USD|CAD|INR|EUR|GBP|Rs\.?)[{WS}]?)\d[\d,]*(?:\.\d{{1,2}})?"
REFERENCE = r"\b[A-Z]{2,6}-\d{3,}(?:-\d+)*\b"
PLACEHOLDER = r"\[(?:[A-Z][A-Za-z ]{1,30}|insert[^\]]*|your [^\]]*)\]|\{\{?\s*[a-z_ ]+\s*\}?\}|<[A-Z][A-Za-z ]{2,30}>"
PERSON = r"([A-Z][A-Za-z''.-]+(?:[ \t]+[A-Z][A-Za-z''.-]+){0,3})"
NAME = rf"(?i:customer name|my name is|name|from|policyholder|account holder)[{WS}]*[:|\n]?[{WS}]*{PERSON}"
SIGNED = rf"(?i:regards|sincerely|thanks|thank you|cheers)[,!]?[{WS}]*\n+[{WS}]*{PERSON}"
HEADING = rf"(?is)\A.*?(?:description|details|complaint|message)[{WS}]*[:|][{WS}]*"
RESOLUTION = rf"(?i)(?:resolution provided|action taken|branch response)[^:\n]*[:|\n][{WS}]*([^\n]+)"


def emails(x: str) -> str:
    return f"regexp_extract_all({x}, '{EMAIL}')"


def phones(x: str) -> str:
    return f"regexp_extract_all({x}, '{PHONE}', 1)"


def amounts(x: str) -> str:
    return f"regexp_extract_all({x}, '{MONEY}')"


def references(x: str) -> str:
    return f"regexp_extract_all({x}, '{REFERENCE}')"


def placeholders(x: str) -> str:
    return f"regexp_extract_all({x}, '{PLACEHOLDER}')"


def joined(items: str) -> str:
    return f"coalesce(array_to_string({items}, ' | '), '')"


def digits(x: str) -> str:
    return rf"regexp_replace({x}, '\P{{Nd}}', '', 'g')"


def amount_key(x: str) -> str:
    bare = rf"trim(regexp_replace({x}, '[^\d.]', '', 'g'), '.')"
    return f"coalesce(cast(try_cast({bare} as decimal(38,2)) as varchar), {bare})"


def digits_found(number: str, text: str) -> str:
    # The case tables hold ASCII digits only; the short class keeps the many patterns cheap to build.
    pattern = rf"regexp_replace({number}, '([0-9])', '\1[^0-9]{{0,3}}', 'g')"
    return f"(length({number}) > 0 AND regexp_matches({text}, {pattern}))"


def any_of(lowered: str, words) -> str:
    return "(" + " OR ".join(f"contains({lowered}, {q(w)})" for w in words) + ")"


def issue(text: str) -> str:
    body = collapse(f"regexp_replace({text}, '{HEADING}', '')")
    two = rf"regexp_extract({body}, '(?s)\A(.*?[.!?] .*?[.!?]) ', 1)"
    return f"coalesce(nullif(CASE WHEN {two} <> '' THEN {two} ELSE {body} END, ''), {NP})"


def issues(draft: str, ref: str) -> str:
    """Sorted finding list of a draft column against a reference text column."""

    def tag(code: str, items: str) -> str:
        return f"list_transform({items}, lambda v: '{code}: ' || v)"

    ref_amounts = f"list_transform({amounts(ref)}, lambda a: {amount_key('a')})"
    parts = [
        tag("blank_placeholder", f"list_distinct({placeholders(draft)})"),
        tag("ungrounded_amount", f"list_transform(list_filter(list_distinct({amounts(draft)}), lambda a: NOT list_contains({ref_amounts}, {amount_key('a')})), lambda a: trim(a))"),
        tag("ungrounded_email", f"list_filter(list_distinct({emails(draft)}), lambda e: NOT contains(lower({ref}), lower(e)))"),
        tag("ungrounded_phone", f"list_transform(list_filter(list_distinct({phones(draft)}), lambda p: NOT {digits_found(digits('p'), ref)}), lambda p: trim(p))"),
        tag("ungrounded_reference", f"list_filter(list_distinct({references(draft)}), lambda r: NOT contains(lower({ref}), lower(r)))"),
    ]
    return f"list_sort(list_concat({', '.join(parts)}))"


FIELDS = ", ".join(V.RECORD_FIELDS)

_KEYWORD_CHAIN = " ".join(
    f"WHEN {any_of('low', words)} THEN {q(name)}" for name, words in V.CATEGORY_KEYWORDS
)
_ESCALATED = any_of("low", V.ESCALATION_WORDS)


def classified(source: str) -> str:
    """The six classified fields of ``source`` rows holding (id columns, text)."""
    return f"""
SELECT *, CASE WHEN is_complaint = 'No' THEN 'Low'
       WHEN complaint_category = 'Fraud & Security' OR {any_of('low', V.CRITICAL_PHRASES)} THEN 'Critical'
       WHEN escalation_required = 'Yes' OR {any_of('low', V.HIGH_PHRASES)} THEN 'High' ELSE 'Medium' END AS priority
FROM (SELECT *, CASE {_KEYWORD_CHAIN} ELSE 'Other' END AS complaint_category,
       CASE WHEN {any_of('low', V.NON_COMPLAINT_PHRASES)} THEN 'No' ELSE 'Yes' END AS is_complaint,
       CASE WHEN {_ESCALATED} THEN 'Yes' ELSE 'No' END AS escalation_required,
       CASE WHEN {any_of('low', V.ATTACHMENT_WORDS)} THEN 'Yes' ELSE 'No' END AS supporting_document_available,
       CASE WHEN {_ESCALATED} THEN 'Escalated' WHEN {any_of('low', V.RESOLVED_PHRASES)} THEN 'Resolved'
            WHEN {any_of('low', V.WAITING_PHRASES)} THEN 'Pending Customer Response'
            WHEN {any_of('low', V.IN_PROGRESS_PHRASES)} THEN 'In Progress' ELSE 'Open' END AS overall_case_status
      FROM (SELECT *, lower(text) AS low FROM {source}) AS lowered) AS labelled"""


def found_items(source: str) -> str:
    return f"""
SELECT *, {clean(f"coalesce(nullif(regexp_extract(text, '{NAME}', 1), ''), nullif(regexp_extract(text, '{SIGNED}', 1), ''))")} AS customer_name,
       {clean(f"lower(nullif(regexp_extract(text, '{EMAIL}'), ''))")} AS email,
       {clean(f"nullif(regexp_extract(text, '{PHONE_CORE}'), '')")} AS phone_number,
       {clean(f"nullif(regexp_extract(text, '{REFERENCE}'), '')")} AS reference_number,
       {NP} AS product_or_service, {clean(issue('text'))} AS issue_description,
       {clean(f"nullif(regexp_extract(text, '{RESOLUTION}', 1), '')")} AS resolution_provided
FROM {source}"""


def verified(source: str) -> str:
    """Corrected record and warning list for rows holding a record and ``text``."""
    name_tokens = f"list_filter(regexp_split_to_array(lower(customer_name), '[{WS},]+'), lambda t: length(t) > 1)"

    def squeeze(x: str) -> str:
        return f"regexp_replace({x}, '[{WS}]+', '', 'g')"

    others = [f for f in V.RECORD_FIELDS if f not in ("email", "phone_number", "reference_number")]
    return f"""
SELECT * EXCLUDE (w1, w2, w3, w4, w5), list_filter([w1, w2, w3, w4, w5,
       CASE WHEN escalation_required = 'Yes' AND overall_case_status IN ('Resolved', 'Closed') THEN 'consistency: escalation on a finished case' END,
       CASE WHEN overall_case_status = 'Resolved' AND resolution_provided = {NP} THEN 'consistency: resolved without a resolution' END,
       CASE WHEN is_complaint = 'No' AND escalation_required = 'Yes' THEN 'consistency: escalation of a non-complaint' END,
       CASE WHEN email = {NP} AND phone_number = {NP} THEN 'no contact details: reply cannot be delivered' END], lambda w: w IS NOT NULL) AS warnings
FROM (SELECT * EXCLUDE ({FIELDS}), {', '.join(others)}, w1, w2, w3, w4, w5,
       CASE WHEN w1 IS NOT NULL OR w2 IS NOT NULL THEN {NP} ELSE email END AS email,
       CASE WHEN w3 IS NOT NULL THEN {NP} ELSE phone_number END AS phone_number,
       CASE WHEN w4 IS NOT NULL THEN {NP} ELSE reference_number END AS reference_number
  FROM (SELECT *,
       CASE WHEN email <> {NP} AND NOT regexp_full_match(email, '{EMAIL}') THEN 'email_bad_format: ' || email END AS w1,
       CASE WHEN email <> {NP} AND regexp_full_match(email, '{EMAIL}') AND NOT contains(lower(text), lower(email)) THEN 'email_not_in_source: ' || email END AS w2,
       CASE WHEN phone_number <> {NP} AND (length({digits('phone_number')}) < 7 OR NOT {digits_found(digits('phone_number'), 'text')}) THEN 'phone_not_in_source: ' || phone_number END AS w3,
       CASE WHEN reference_number <> {NP} AND NOT contains({squeeze('lower(text)')}, {squeeze('lower(reference_number)')}) THEN 'reference_not_in_source: ' || reference_number END AS w4,
       CASE WHEN customer_name <> {NP} AND length({name_tokens}) > 0 AND length(list_filter({name_tokens}, lambda t: contains(lower(text), t))) = 0 THEN 'name_not_in_source: ' || customer_name END AS w5
    FROM {source}) AS tested) AS corrected"""


def json_record() -> str:
    return "CAST(json_object(" + ", ".join(f"'{f}', {f}" for f in V.RECORD_FIELDS) + ") AS VARCHAR)"


def _case(column: str, table: dict[str, str], default: str = "NULL") -> str:
    arms = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in table.items())
    return f"CASE {column} {arms} ELSE {default} END"


def templates(source: str) -> str:
    ref = f"CASE WHEN reference_number = {NP} THEN '' ELSE ', number ' || reference_number END"
    greeting = f"CASE WHEN customer_name = {NP} THEN 'Dear Customer,' ELSE 'Dear ' || customer_name || ',' END"
    resolution = f"CASE WHEN resolution_provided = {NP} THEN '' ELSE {q(V.REPLY_RESOLUTION)} || resolution_provided END"
    end = lines(f"\n\n{V.REPLY_CLOSING}\n\n{V.REPLY_SIGN_OFF}\n{PARAMS.email_signature}")
    return f"""
SELECT *, {q(V.REPLY_SUBJECT)} || {ref} AS email_subject,
       {greeting} || chr(10) || chr(10) || {q(V.REPLY_OPENING)} || {ref} || {q(V.REPLY_CONCERN)} || issue_description
       || chr(10) || chr(10) || {_case('overall_case_status', V.REPLY_STATUS_LINES)} || {resolution} || {end} AS email_body,
       customer_name || {q(V.OVERVIEW_CATEGORY)} || complaint_category || {q(V.OVERVIEW_PRIORITY)} || priority || '.' AS case_overview,
       issue_description AS key_issue,
       CASE WHEN resolution_provided = {NP} THEN {q(V.NO_ACTION)} ELSE resolution_provided END AS action_taken,
       overall_case_status AS current_status,
       {_case('overall_case_status', V.NEXT_ACTIONS, q(V.NEXT_ACTION_DEFAULT))} AS recommended_next_action
FROM {source}"""


def _feedback(list_expr: str) -> str:
    head = lines("\n\nThe grounding check rejected the last draft because of:\n")
    tail = lines("\nWrite it again without anything the document does not contain.")
    items = f"array_to_string(list_transform({list_expr}, lambda i: '- ' || i), chr(10))"
    return f"CASE WHEN length({list_expr}) > 0 THEN {head} || {items} || {tail} ELSE '' END"


def user_prompt(record_json: str, text: str, feedback: str = "''") -> str:
    return (
        f"{q(prompts.RECORD_OPEN)} || chr(10) || {record_json} || chr(10) || {q(prompts.RECORD_CLOSE)} || chr(10) || chr(10) || "
        f"{q(prompts.DOCUMENT_OPEN)} || chr(10) || {text} || chr(10) || {q(prompts.DOCUMENT_CLOSE)} || {feedback}"
    )


def record_prompt(name: str, text: str) -> str:
    return (
        f"'File: ' || {name} || chr(10) || chr(10) || {q(prompts.DOCUMENT_OPEN)} || chr(10) || {text} || chr(10) || {q(prompts.DOCUMENT_CLOSE)}"
    )


EMAIL_ALLOWED = lines(f"{PARAMS.company_name}\n{PARAMS.email_signature}")
SUMMARY_ALLOWED = q(PARAMS.company_name)
EMAIL_TEXT = "email_subject || chr(10) || email_body"
SUMMARY_TEXT = " || ' ' || ".join(V.SUMMARY_FIELDS)
N_SYS_RECORD = len(prompts.RECORD_SYSTEM)
N_SYS_EMAIL = len(prompts.email_system(PARAMS))
N_SYS_SUMMARY = len(prompts.SUMMARY_SYSTEM)
_EMAIL_JSON = "CAST(json_object('subject', email_subject, 'body', email_body) AS VARCHAR)"
_SUMMARY_JSON = "CAST(json_object(" + ", ".join(f"'{f}', {f}" for f in V.SUMMARY_FIELDS) + ") AS VARCHAR)"

_ANSWER_FIELDS = ", ".join(f"json_extract_string(j, '$.{f}') AS raw_{f}" for f in V.RECORD_FIELDS)


def _answer_value(f: str) -> str:
    raw = f"raw_{f}"
    if f == "email":
        return f"CASE WHEN {clean(raw)} = {NP} THEN {NP} ELSE lower({clean(raw)}) END"
    if f in V.TEXT_FIELDS:
        return clean(raw)
    if f in V.YES_NO_FIELDS:
        return yes_no(raw)
    if f == "complaint_category":
        return f"coalesce({option(raw, V.CATEGORIES)}, 'Other')"
    return option(raw, V.CASE_STATUSES if f == "overall_case_status" else V.PRIORITIES)


_MISSING = [f"CASE WHEN NOT list_contains(keys, '{f}') THEN 'missing:{f}' END" for f in V.RECORD_FIELDS]
_INVALID = [f"CASE WHEN list_contains(keys, '{f}') AND {f} IS NULL THEN 'invalid:{f}' END" for f in V.RECORD_FIELDS]

CTES: dict[str, str] = {
    "cases": CASES_SQL,
    "src": f"SELECT *, {normal('raw_text')} AS full_text FROM cases",
    "docs": (
        "SELECT *, CASE WHEN length(full_text) < 20 THEN 'no_text' END AS load_error, full_text AS text FROM src"
    ),
    "good": "SELECT * FROM docs WHERE load_error IS NULL",
    "labelled": classified("good"),
    "extracted": found_items("labelled"),
    "checked": verified("extracted"),
    "templated": templates("checked"),
    "grounded": (
        f"SELECT *, {issues('email_text', 'email_ref')} AS email_issues, {issues('summary_text', 'summary_ref')} AS summary_issues "
        f"FROM (SELECT *, {EMAIL_TEXT} AS email_text, {SUMMARY_TEXT} AS summary_text, text || chr(10) || {EMAIL_ALLOWED} AS email_ref, "
        f"text || chr(10) || {SUMMARY_ALLOWED} AS summary_ref FROM templated) AS t"
    ),
    "answers_parsed": (
        f"SELECT *, CASE WHEN json_valid(answer_json) THEN CAST(answer_json AS JSON) END AS j FROM docs"
    ),
    "answers_raw": f"SELECT *, json_keys(j) AS keys, {_ANSWER_FIELDS} FROM answers_parsed",
    "answers_typed": "SELECT *, " + ", ".join(f"{_answer_value(f)} AS {f}" for f in V.RECORD_FIELDS) + " FROM answers_raw",
    "answers": (
        "SELECT *, CASE WHEN j IS NULL THEN ['unparseable'] ELSE list_filter(["
        + ", ".join(_MISSING + _INVALID)
        + "], lambda w: w IS NOT NULL) END AS problems FROM answers_typed"
    ),
    "answers_good": "SELECT * FROM answers WHERE length(problems) = 0 AND load_error IS NULL",
    "answers_checked": verified("answers_good"),
}
_NEEDS = {
    "src": ["cases"], "docs": ["src"], "good": ["docs"], "labelled": ["good"], "extracted": ["labelled"],
    "checked": ["extracted"], "templated": ["checked"], "grounded": ["templated"],
    "answers_parsed": ["docs"], "answers_raw": ["answers_parsed"], "answers_typed": ["answers_raw"],
    "answers": ["answers_typed"], "answers_good": ["answers"], "answers_checked": ["answers_good"],
}


def add_cte(name: str, needs: list[str], sql: str) -> None:
    CTES[name] = sql
    _NEEDS[name] = needs


def with_ctes(needs: list[str], final: str) -> str:
    order: list[str] = []

    def visit(name: str) -> None:
        for n in _NEEDS.get(name, []):
            visit(n)
        if name not in order:
            order.append(name)

    for n in needs:
        visit(n)
    head = ",\n".join(f"{n} AS ({CTES[n]})" for n in order)
    return f"WITH {head}\n{final}" if order else final
