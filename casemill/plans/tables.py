"""Case tables derived row by row from the order and document tables.

The given tables hold no case documents, so the queries work on documents written from
the order rows: every order becomes one document, one model answer, two reply drafts, one
input file name and one truth spec. The SQL below is plain enough to run unchanged on
any engine, which is how the checks get the same input without sharing any other code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

K = "o_orderkey"
C = "o_custkey"


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _pick(key: str, options: list[str]) -> str:
    """SQL expression among ``options`` (already SQL) by remainder of ``key``."""
    arms = " ".join(f"WHEN {i} THEN {option}" for i, option in enumerate(options[:-1]))
    return f"CASE {key} % {len(options)} {arms} ELSE {options[-1]} END"


def _pick_text(key: str, options: list[str]) -> str:
    return _pick(key, [_q(o) for o in options])


FIRST = ["Ines", "Tobias", "Wanda", "Kofi", "Ylva", "Bruno", "Signe", "Mateo", "Olga", "Farid", "Noemi"]
LAST = ["Halvorsen", "Quist", "Zeman", "Abara", "Lindqvist", "Pereira", "Novak", "Duarte", "O''Brien", "Marsh-Weber",
        "Ueda", "Kovacs", "Bakker"]

ISSUES = [
    "I see a payment I did not make, it is unauthorised and my card may be stolen.",
    "My claim for the kitchen is still open and the adjuster never called.",
    "There is an outage in our street and the line is not working since Monday!",
    "The courier did not deliver the parcel and the shipment is late.",
    "I was charged twice for one order and the invoice is wrong.",
    "The kettle came with a defect. It arrived damaged and the lid is broken.",
    "Please cancel the order and refund me.",
    "The woman at the desk was rude to me. Is that how you treat people?",
    "I cannot open my account and my loyalty points are gone.",
    "I do not understand the letter you sent me about the café meeting.",
    "I just wanted to say that the visit was lovely. General inquiry only: when do you open?",
]
STATES = [
    "This has been escalated to the second line and I will write to the ombudsman.",
    "It has been resolved in the meantime.",
    "You wrote: please provide the missing papers.",
    "A visit is scheduled for next week.",
    "Nothing has happened so far.",
    "The refund has been posted. Case closed.",
    "Your team is investigating and it is under review.",
]
PAPERS = ["I have attached the receipt.", "Two photos are enclosed.", "I kept no papers.", "See the screenshot.", "Nothing else."]


def _text() -> str:
    """Expression for the raw document text of one order."""
    state, issue, paper = _pick_text(K, STATES), _pick_text(K, ISSUES), _pick_text(C, PAPERS)
    money = _pick(K, [
        "' The amount is $' || amount || '.'", "' It cost me CAD ' || amount || ' in total.'", "''",
        "' They took Rs. 1,' || lpad(cast(o_orderkey % 1000 as string), 3, '0') || ', from me.'",
    ])
    story = f"{issue} || {money} || ' ' || {state} || ' ' || {paper}"
    resolution = "CASE WHEN o_orderkey % 7 IN (1, 5) THEN nl || 'Action taken by branch: money returned on ' || day ELSE '' END"
    contact = "CASE WHEN has_email THEN nl || {0} || email ELSE '' END || CASE WHEN has_phone THEN nl || {1} || phone ELSE '' END || CASE WHEN has_ref THEN nl || {2} || ref ELSE '' END"
    form = (
        "'Complaint form of ' || day || nl || 'Customer name: ' || full_name || "
        + contact.format("'Email: '", "'Phone: '", "'Reference: '")
        + f" || nl || gap || nl || 'Details: ' || {story} || {resolution}"
    )
    letter = (
        f"'Dear team,' || nl || gap || nl || {story} || "
        + contact.format("'Write to me at '", "'Call me on '", "'It is about '")
        + f" || {resolution} || nl || nl || 'Kind regards,' || nl || nl || full_name"
    )
    chat = (
        "'user: hi my name is ' || full_name || ', hello' || "
        + contact.format("'user: mail '", "'user: number '", "'user: case '")
        + f" || nl || 'user: ' || {story} || nl || 'desk: understood [Agent Name], noted {{{{date}}}} for you'"
    )
    table = (
        "'Customer name | ' || full_name || "
        + contact.format("'Email | '", "'Phone | '", "'Reference | '")
        + f" || nl || 'Message | ' || {story} || {resolution}"
    )
    body = _pick(K, [form, letter, chat, table])
    return (
        "CASE WHEN o_orderkey % 97 = 5 THEN ' Hi' || nl || ' '"
        f" WHEN o_orderkey % 101 = 7 THEN {body} || nl || repeat('All of this was written down in full. ', 600)"
        f" ELSE '  ' || {body} || nl || ' ' END"
    )


def _answer() -> str:
    """Expression for the JSON a model might have answered, faults included."""
    r = f"{K} % 17"

    def field(name: str, normal: str, faults: dict[int, str]) -> str:
        arms = " ".join(f"WHEN {n} THEN {value}" for n, value in faults.items())
        value = f"CASE {r} {arms} ELSE {normal} END" if faults else normal
        return f"'\"{name}\": ' || {value}"

    def s(expr: str) -> str:
        return f"'\"' || {expr} || '\"'"

    first_break = "CASE WHEN o_orderkey % 17 = 0 THEN '{\"customer_name\": \"x\"' ELSE '{' || "
    fields = [
        field("customer_name", s("full_name"), {14: s(_q("Nobody Known")), 13: s(_q("Unknown"))}),
        field("email", s("upper(email)"), {8: s(_q("someone.else@example.com")), 9: s(_q("not an email")), 13: s(_q("N/A"))}),
        field("phone_number", s("phone"), {2: "'null'", 10: s("'(613) 555 ' || tail"), 11: s(_q("999-555-1234")), 13: s(_q("  not provided "))}),
        field("reference_number", s("ref"), {12: s(_q("CMP-1")), 15: s("lower(ref)"), 13: s(_q(" - "))}),
        field("product_or_service", s("'Plan ' || day"), {13: "'null'"}),
        field("complaint_category", s(_pick_text(K, [
            "Billing & Payments", "delivery & shipping", "FRAUD & SECURITY", "Other", " insurance claim "])), {5: s(_q("Weird stuff"))}),
        field("issue_description", s("'Issue   of  ' || day || '.'"), {}),
        field("resolution_provided", s(_q("Money returned.")), {13: s(_q("none")), 16: s(_q("NULL"))}),
        field("is_complaint", s(_q("Yes")), {3: "'true'", 6: s(_q("perhaps")), 7: s(_q("n")), 10: "'0'"}),
        field("escalation_required", s(_q("no")), {3: "'false'", 16: s(_q("Y")), 7: s(_q("yes"))}),
        field("supporting_document_available", s(_q("No")), {4: "'1'", 11: "'null'"}),
        field("overall_case_status", s(_q("In Progress")), {4: s(_q("ESCALATED")), 16: s(_q("resolved")), 9: s(_q(" closed "))}),
        field("priority", s(_q("Medium")), {12: s(_q("urgent")), 4: s(_q("critical"))}),
    ]
    parts = []
    for i, expr in enumerate(fields):
        sep = "', '" if i else "''"
        piece = f"{sep} || {expr}"
        if i == 1:
            piece = f"CASE WHEN {r} = 1 THEN '' ELSE {piece} END"
        parts.append(piece)
    extra = f"CASE WHEN {r} = 15 THEN ', \"mood\": \"calm\"' ELSE '' END"
    return first_break + " || ".join(parts) + f" || {extra} || '}}' END"


def _draft(second: bool) -> str:
    """Expression for the body of a reply draft; half of the second drafts are clean."""
    faults = _pick(K, [
        "' We will return $77777.77 to you.'",
        "' Call 800-555-0' || lpad(cast(o_orderkey % 1000 as string), 3, '0') || ' at any time.'",
        "' Your new case is ZZZ-9' || ref_no || '.'",
        "' Write to help' || cast(o_orderkey % 5 as string) || '@desk.example.'",
        "' Regards, [Agent Name] and {{date}} <Customer Name>.'",
        "' Known to us: ' || email || ', ' || phone || ', ' || ref || ', $' || amount || '.'",
        "' We add $ 50 and EUR 50 and $50.00 on CASE-000-1.'",
        "''",
        "' Contact Customer Care Team, Example.'",
    ])
    text = f"'Dear ' || full_name || ',' || chr(10) || chr(10) || 'thank you for writing to us about this matter.' || {faults}"
    if second:
        text = f"CASE WHEN {K} % 2 = 0 THEN 'Dear ' || full_name || ',' || chr(10) || chr(10) || 'we have read your letter with care.' ELSE {text} END"
    return text + " || chr(10) || chr(10) || 'Kind regards'"


def _truth() -> str:
    """Expression for the truth spec of one case as JSON."""
    status = _pick(K, ["'[\"Escalated\"]'", "'[\"Resolved\", \"Closed\"]'", "'\"Pending Customer Response\"'",
                       "'\"In Progress\"'", "'\"Open\"'", "'[\"Resolved\"]'", "'\"Open\"'"])
    name = "CASE WHEN o_orderkey % 10 = 4 THEN 'Someone Else' WHEN o_orderkey % 10 = 6 THEN upper(full_name) WHEN o_orderkey % 10 = 8 THEN first_name ELSE full_name END"
    email = "CASE WHEN has_email THEN upper(email) ELSE 'Not Provided' END"
    phone = "CASE WHEN has_phone THEN '613555' || tail ELSE 'Not Provided' END"
    hard = (
        f"'\"customer_name\": \"' || {name} || '\", \"email\": \"' || {email} || '\", \"phone_number\": \"' || {phone}"
        f" || '\", \"is_complaint\": \"Yes\", \"overall_case_status\": ' || {status}"
    )
    soft = (
        "'\"priority\": [\"Medium\", \"High\"], \"supporting_document_available\": [' || "
        f"{_pick(C, [_q(x) for x in ['\"Yes\"', '\"Yes\"', '\"No\"', '\"Yes\"', '\"No\", \"Yes\"']])} || ']'"
    )
    forbidden = "CASE WHEN o_orderkey % 4 = 1 THEN ', \"forbidden\": {\"priority\": [\"Low\"], \"overall_case_status\": [\"Closed\", \"Open\"]}, \"note\": \"read with care\"' ELSE '' END"
    return f"'{{\"hard\": {{' || {hard} || '}}, \"soft\": {{' || {soft} || '}}' || {forbidden} || '}}'"


def _file_name() -> str:
    ext = _pick_text(K, [".txt", ".TXT", ".pdf", ".docx", ".csv", "", ".tar.gz", ".txt", ".Docx"])
    return (
        "CASE WHEN o_orderkey % 23 = 0 THEN '.hidden_' || key_text || '.txt'"
        " WHEN o_orderkey % 29 = 0 THEN '~$lock_' || key_text || '.docx'"
        f" WHEN o_orderkey % 3 = 1 THEN 'scan' || {ext}"
        f" WHEN o_orderkey % 5 = 0 THEN 'Case ' || cast(o_orderkey - o_orderkey % 10 as string) || {ext}"
        f" ELSE 'case_' || key_text || {ext} END"
    )


CASES_SQL = f"""
SELECT o_orderkey AS case_id, 'case_' || key_text AS doc_id, 'case_' || key_text || '.txt' AS case_file,
       {_text()} AS raw_text,
       {_answer()} AS answer_json,
       'Your case ' || ref AS subject, {_draft(False)} AS body_1, {_draft(True)} AS body_2,
       CASE WHEN o_orderkey % 19 = 3 THEN 'lost_' ELSE 'case_' END || key_text AS truth_id,
       {_truth()} AS truth_json,
       'inbox_' || key_text || '/' || {_file_name()} AS path, {_file_name()} AS file_name,
       CASE WHEN o_orderkey % 31 = 0 THEN 0 WHEN o_orderkey % 37 = 0 THEN 10485760
            WHEN o_orderkey % 41 = 0 THEN 10485761 + o_orderkey * 1000
            ELSE cast(floor(o_totalprice) as bigint) END AS length
FROM (
  SELECT *, first_name || ' ' || last_name AS full_name,
         lower(first_name) || '.' || key_text || '@example.' || {_pick_text(K, ["com", "org", "net"])} AS email,
         {_pick(K, ["'613-555-' || tail", "'+1 (613) 555-' || tail", "'613.555.' || tail", "'613555' || tail"])} AS phone,
         {_pick_text(K, ["CMP", "TKT", "ORD"])} || '-' || ref_no AS ref
  FROM (
    SELECT o_orderkey, o_custkey, o_totalprice,
           cast(o_orderkey as string) AS key_text,
           cast(cast(o_totalprice as decimal(18,2)) as string) AS amount,
           cast(cast(o_orderdate as date) as string) AS day,
           lpad(cast(o_orderkey % 10000 as string), 4, '0') AS tail,
           {_pick(K, ["'2026-' || lpad(cast(o_orderkey as string), 6, '0')", "lpad(cast(o_orderkey as string), 6, '0')"])} AS ref_no,
           {_pick_text(C, FIRST)} AS first_name, {_pick(C, ["'" + n + "'" for n in LAST])} AS last_name,
           o_orderkey % 8 <> 3 AS has_email, o_orderkey % 9 <> 4 AS has_phone, o_orderkey % 7 <> 2 AS has_ref,
           CASE WHEN o_orderkey % 6 = 0 THEN chr(13) || chr(10) WHEN o_orderkey % 6 = 1 THEN '  ' || chr(9) || chr(10)
                WHEN o_orderkey % 6 = 2 THEN chr(13) ELSE chr(10) END AS nl,
           CASE WHEN o_orderkey % 5 = 2 THEN chr(10) || chr(10) || ' ' || chr(10) ELSE '' END AS gap
    FROM orders
  ) AS base
) AS named
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with everything the case queries start from.

    A projection of the order table: nothing is written, and columns that a query does not
    use are not made. The few narrow order columns are dealt out by key before the texts
    are made from them, since the text work is far larger than the table it comes from. A set
    number of partitions, because adaptive execution would join partitions of so few bytes to one or two.
    """
    parts = max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    narrow = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    narrow.repartition(parts, "o_orderkey").createOrReplaceTempView("casemill_orders")
    return spark.sql(CASES_SQL.replace("FROM orders", "FROM casemill_orders"))
