"""Secret scan over a trigram inverted index, in DataFrame functions only.

From each rule's regular expression a Boolean query over trigrams is derived (``regex_trigrams``): a
text can match only if, for one of the query's alternatives, it holds every trigram of that
alternative. The index has postings (trigram, document) for the trigrams that some rule asks for.
Postings are intersected to candidates, and only candidates meet the regular expression. A rule with
no mandatory trigram is run on every text.

Positions come from the pieces between matches: the lengths of the pieces and matches before a match
add up to where it starts, in code points.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casemill.llm.common import stage, text_of
from casemill.llm.regex_trigrams import derive


@dataclass(frozen=True)
class Rule:
    """``pattern`` for Java. Of a match, ``group`` must have ``least`` characters at least, or the match is dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1

    @property
    def folded(self) -> bool:
        """Whether the trigrams are looked up in the lower-case text."""
        return derive(self.pattern)[0]

    def queries(self) -> list[frozenset[str]]:
        """The trigrams of each alternative; none if a match need not hold any."""
        return derive(self.pattern)[1]


# The three base rules, then common published key formats.
BASE = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""",
         group=2, least=8),
    Rule("access", r"AKIA[A-Z0-9]+", least=16),
    Rule("hex", r"[0-9a-f]+", least=32),
)
ADDED = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", least=40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", least=15),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
RULES = BASE + ADDED


def _postings(keyed: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``trigram, id, digest``: postings of all trigrams that a rule asks for; folded ones begin with "~"."""
    exact = sorted({t for r in rules if not r.folded for q in r.queries() for t in q})
    folded = sorted({t for r in rules if r.folded for q in r.queries() for t in q})
    has = [F.when(F.contains(F.col("text"), F.lit(t)), F.lit(t)) for t in exact]
    has += [F.when(F.contains(F.col("small"), F.lit(t)), F.lit(f"~{t}")) for t in folded]
    found = keyed.withColumn("small", F.lower("text")).select("id", "digest", F.array_compact(F.array(*has)).alias("t"))
    return found.select(F.explode("t").alias("trigram"), "id", "digest").distinct()


def candidates(postings: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``id, digest, kinds``: the rules whose query the postings of a text satisfy."""
    asked = []  # one row of the query table for each (rule, alternative, trigram)
    for r in rules:
        for k, q in enumerate(r.queries()):
            asked += [(r.kind, k, f"~{t}" if r.folded else t, len(q)) for t in sorted(q)]
    names = ("kind", "alternative", "trigram", "needed")
    rows = F.array(*(F.struct(*(F.lit(v).alias(n) for n, v in zip(names, row, strict=True))) for row in asked))
    query = postings.sparkSession.range(1).select(F.inline(rows))
    met = postings.join(F.broadcast(query), "trigram").groupBy("id", "digest", "kind", "alternative", "needed").count()
    return met.filter("count = needed").groupBy("id", "digest").agg(F.collect_set("kind").alias("kinds"))


def _spans(rule: Rule, order: int) -> Column:
    """Matches of the rule in ``text`` as an array of (begin, order, kind, stop), in code points."""
    pattern = F.lit(rule.pattern)
    between = F.split("text", rule.pattern, -1)
    match = F.regexp_extract_all("text", pattern, F.lit(0))
    checked = F.regexp_extract_all("text", pattern, F.lit(rule.group))
    lengths = F.arrays_zip(
        F.transform(F.slice(between, F.lit(1), F.size(match)), lambda x: F.char_length(x)).alias("gap"),
        F.transform(match, lambda x: F.char_length(x)).alias("len"),
        F.transform(checked, lambda x: F.char_length(x)).alias("tested"),
    )
    none = F.array().cast("array<struct<begin:bigint,ord:int,kind:string,stop:bigint>>")

    def add(done, m):
        begin = done["at"] + m["gap"]
        stop = begin + m["len"]
        span = F.array(F.struct(begin.alias("begin"), F.lit(order).alias("ord"), F.lit(rule.kind).alias("kind"), stop.alias("stop")))
        return F.struct(
            stop.alias("at"), F.when(m["tested"] >= rule.least, F.concat(done["spans"], span)).otherwise(done["spans"]).alias("spans")
        )

    return F.aggregate(lengths, F.struct(F.lit(0).cast("long").alias("at"), none.alias("spans")), add)["spans"]


def _joined(spans: str) -> Column:
    shown = F.transform(
        F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["begin"].cast("string"), s["stop"].cast("string"))
    )
    return F.array_join(shown, ",")


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id, hits``, the matches of all rules as an array of (begin, ord, kind, stop).

    Matches are leftmost and do not overlap within a rule, and ``stop`` is exclusive. Null text
    counts as empty. Rows are told apart by id and a hash of the text, so repeated rows, null ids and
    ids with several texts each get their own result.

    The candidates are written first, and Spark joins them by their size: while they are few they go
    to the texts; when they are many, texts are shuffled once by id.
    """
    written = stage(docs.sparkSession)
    keyed = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).withColumn("digest", F.xxhash64("text"))
    hits = written.write(candidates(written.write(_postings(keyed, rules)), rules))
    hits = hits.select(F.col("id").alias("_id"), F.col("digest").alias("_digest"), "kinds")
    met = keyed.join(hits, F.col("id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest")), "left")
    none = F.array().cast("array<struct<begin:bigint,ord:int,kind:string,stop:bigint>>")
    found = []
    for order, rule in enumerate(rules):
        # Rules without a query look at every text; a short test spares most texts the splitting.
        due = F.array_contains("kinds", rule.kind) if rule.queries() else F.col("text").rlike(_due(rule))
        found.append(F.when(due, _spans(rule, order)).otherwise(none))
    return met.select(F.col("id").alias("doc_id"), F.concat(*found).alias("hits"))


def _due(rule: Rule) -> str:
    """A pattern that matches whenever the rule has a match of the needed length."""
    return rule.pattern[:-1] + f"{{{rule.least}}}" if rule.pattern.endswith("]+") and not rule.group else rule.pattern


def report(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per row: counts of the base rules, the digest of their spans, and all spans as text."""
    found = scan(docs, rules)
    base = F.filter("hits", lambda h: h["ord"] < len(BASE))

    def number(rule: Rule) -> Column:
        return F.size(F.filter("hits", lambda h: h["kind"] == rule.kind)).cast("long").alias(f"n_{rule.kind}")

    counts = [number(r) for r in BASE]
    return found.withColumn("base", base).select(
        "doc_id", *counts, F.sha2(_joined("base"), 256).alias("base_sha256"), _joined("hits").alias("spans")
    )
