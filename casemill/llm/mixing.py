"""Mixing sources to target weights with hash thresholds.

Every document has a number made from its id. A source takes the documents whose number is under a
threshold, so a larger budget takes a superset of a smaller one and reruns agree. The thresholds
come from histograms: words are summed by source and leading hash byte, the bucket in which the
budget runs out is found, and only that bucket is divided again by the next byte, until it holds
documents of a single number. Nothing is sorted by hash and no text is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casemill.llm.common import stage, text_of, wrapped

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (5, 2, 1)
#: All targets together, as a share of all words; and the most that a source may take, in times its words.
TOTAL_SHARE, MOST = 1.5, 2
_WORD = r"[^\x20\x09-\x0D]+"
#: 15 hex digits of the digest: 60 bits, taken 8 (at last 4) at a time.
HASH_BITS, STEP_BITS = 60, 8


def hash_number(id_col: Column) -> Column:
    """60 bits of the MD5 of the id in decimal; rows of equal id (or null id) share one number."""
    return F.conv(F.substring(F.md5(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long")


def sizes(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size, h``: words of each whole text (null: 0) and the hash number."""
    return docs.select(
        "doc_id", F.col("source").cast("string").alias("source"),
        F.size(F.regexp_extract_all(text_of(), F.lit(_WORD), F.lit(0))).cast("long").alias("size"),
        hash_number(F.col("doc_id")).alias("h"),
    )


def source_targets(sources: DataFrame) -> DataFrame:
    """Targets of ``sources`` (source, source_size): ``source, source_size, target``.

    Sources in code-point order, null last, weigh 5, 2, 1, repeating. A target that would be above
    twice the source's words stops there, and what is over goes to the others by weight, until none
    is above. Each round is one aggregate over the sources; only its two sums reach the driver.
    """
    # UTF-8 bytes sort as code points do. One row per source, whatever the number of documents.
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), ((F.row_number().over(order) - 1) % len(WEIGHTS) + 1).cast("int"))
    weighed = sources.select("source", "source_size", weight.cast("double").alias("w"))
    cap = F.col("source_size") * F.lit(float(MOST))
    total = weighed.agg(F.sum("source_size")).first()[0]
    if not total:
        return weighed.select("source", "source_size", F.lit(0.0).alias("target"))
    # A round's rate is a number per unit of weight; sources it lifts above their cap are capped for good.
    capped, budget = F.lit(False), total * TOTAL_SHARE
    while True:
        open_w, spent = weighed.select(capped.alias("c"), "w", cap.alias("cap")).agg(
            F.sum(F.when(~F.col("c"), F.col("w"))), F.sum(F.when(F.col("c"), F.col("cap")))
        ).first()
        if open_w is None:
            return weighed.select("source", "source_size", cap.alias("target"))
        share = (F.lit(budget - (spent or 0.0)) * F.col("w")) / F.lit(open_w)
        above = capped | (share > cap)
        more = weighed.filter(above & ~capped).isEmpty()
        if more:
            return weighed.select("source", "source_size", F.when(capped, cap).otherwise(share).alias("target"))
        capped = above


def _bucket(level: int) -> Column:
    """The first ``level + 1`` bytes of the hash number."""
    return F.shiftright(F.col("h"), max(0, HASH_BITS - STEP_BITS * (level + 1)))


def thresholds(rows: DataFrame, budgets: DataFrame, written) -> DataFrame:
    """``source, budget_id, below, upto``: take numbers up to ``upto`` (-1: none) of each source.

    ``budgets`` has ``source, budget_id, budget`` in words; budgets of one source give nested sets.
    The last group of equal numbers is taken when that comes nearer to the budget than leaving it.
    """
    spare = written.write(budgets.withColumn("prefix", F.lit(None).cast("long")).withColumn("before", F.lit(0).cast("long")))
    done = []
    for level in range(-(-HASH_BITS // STEP_BITS)):
        inner = rows.select(F.col("source").alias("s"), "size", "h", _bucket(level).alias("bucket"))
        if level:
            at = spare.select("source", F.col("prefix").alias("p")).distinct()
            up = F.shiftright(F.col("h"), max(0, HASH_BITS - STEP_BITS * level))
            inner = inner.join(at, F.col("s").eqNullSafe(F.col("source")) & (up == F.col("p")), "left_semi").withColumn("up", up)
        else:
            inner = inner.withColumn("up", F.lit(None).cast("long"))
        histogram = inner.groupBy("s", "up", "bucket").agg(
            F.sum("size").alias("words"), F.min("h").alias("low"), F.max("h").alias("high")
        )
        # At most 256 buckets for each source and prefix.
        run = Window.partitionBy("s", "up").orderBy("bucket")
        histogram = written.write(histogram.withColumn("upto_here", F.sum("words").over(run)))
        meets = F.col("s").eqNullSafe(F.col("source")) & F.col("up").eqNullSafe(F.col("prefix"))
        hit = spare.join(histogram, meets & (F.col("before") + F.col("upto_here") > F.col("budget")), "left")
        first = hit.groupBy("source", "budget_id", "budget", "before", "prefix").agg(
            F.min(F.struct("bucket", "words", "upto_here", "low", "high")).alias("b")
        )
        first = written.write(
            first.withColumn("start", F.col("before") + F.col("b.upto_here") - F.col("b.words")).select(
                "source", "budget_id", "budget", "before", "b", "start"
            )
        )
        single = F.col("b.low") == F.col("b.high")
        nearer = (F.col("b.words") + F.col("start") - F.col("budget")) <= (F.col("budget") - F.col("start"))
        upto = (
            F.when(F.col("b").isNull(), F.lit(2**62))
            .when(nearer, F.col("b.high"))
            .otherwise(F.col("b.low") - 1)
        )
        done.append(first.filter(F.col("b").isNull() | single).select("source", "budget_id", upto.alias("upto")))
        spare = first.filter(F.col("b").isNotNull() & ~single).select(
            "source", "budget_id", "budget", F.col("b.bucket").alias("prefix"), F.col("start").alias("before")
        )
        if spare.isEmpty():
            break
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def mix_plan(rows: DataFrame, written) -> DataFrame:
    """One row per source of ``sizes()`` rows: ``s, source_size, target, base, upto``, written.

    Each document of the source is taken ``base`` times, and once more if its number is at most ``upto``.
    """
    sources = written.write(rows.groupBy("source").agg(F.sum("size").alias("source_size")))
    times = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0)
    targets = source_targets(sources).withColumn("base", F.least(F.floor(times), F.lit(MOST)).cast("long"))
    targets = written.write(targets)
    rest = (F.col("target") - F.col("base") * F.col("source_size")).alias("budget")
    limits = thresholds(rows, targets.select("source", F.lit(0).alias("budget_id"), rest), written)
    limits = limits.select(F.col("source").alias("s"), "upto")
    upto = F.when((F.col("base") < MOST) & (F.col("target") > 0), F.col("upto")).otherwise(F.lit(-1)).alias("upto")
    joined = targets.join(limits, F.col("source").eqNullSafe(F.col("s")))
    return written.write(joined.select("s", "source_size", "target", "base", upto))


def mix(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, taken, copies``.

    A target of r times the source's words takes every document floor(r) times and those under the
    hash threshold once more, so no document exceeds twice its size, and the words taken differ from
    the target by half of one document (one group of equal ids) at most. Null text has size 0;
    documents without words never count. A source whose target is 0 takes nothing; an empty table
    gives no rows. Columns other than doc_id, text and source play no part.
    """
    written = stage(docs.sparkSession)
    rows = written.write(sizes(docs))
    plan = mix_plan(rows, written)
    return rows.join(plan, F.col("source").eqNullSafe(F.col("s"))).select(
        "doc_id", "source", "size", "source_size", "target",
        (F.col("size") * _copies(F.col("h"))).cast("long").alias("taken"), _copies(F.col("h")).alias("copies"),
    )


def _copies(h: Column) -> Column:
    return (F.col("base") + F.when(h <= F.col("upto"), 1).otherwise(0)).cast("long")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with each row as often as the mix takes it, columns as they were."""
    written = stage(docs.sparkSession)
    plan = mix_plan(written.write(sizes(docs)), written)
    joined = wrapped(docs).join(plan, F.col("_row.source").cast("string").eqNullSafe(F.col("s")))
    again = F.array_repeat(F.lit(1), _copies(hash_number(F.col("_row.doc_id"))).cast("int"))
    return joined.select("_row", F.explode(again)).select("_row.*")
