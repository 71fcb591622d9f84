"""Exact dedup by recipes of content-defined chunks, in DataFrame functions only.

Each text is cut where its own content says so: a chunk ends after a white-space character that
follows one of a few letters, not before ``MIN_CHUNK`` and not after ``MAX_CHUNK`` characters. So an
insertion changes the chunks around it and no others. A chunk is named by a 64-bit number; the chunk
dictionary verifies every name by the SHA-256 of its content, and a name that stands for two
contents is completed by the digest. The recipe of a text is the ordered list of its names. Equal
recipes are equal texts, and only recipes and digests are ever shuffled: no text moves at all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemill.llm.common import stage, text_of, wrapped

MIN_CHUNK, MAX_CHUNK = 1024, 8192
_CHUNK = rf"(?s).{{{MIN_CHUNK - 2},{MAX_CHUNK - 2}}}?[aeiostr][\x09-\x0D\x20]|.{{1,{MAX_CHUNK}}}"


def recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: a row number, the id, SHA-256 of the text, the names of its chunks, and their digests.

    Null text counts as empty; an empty text has an empty recipe.
    """
    text = text_of(text_col)
    chunks = F.regexp_extract_all(F.col("_text"), F.lit(_CHUNK), F.lit(0))
    return (
        docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), text.alias("_text"))
        .select("row", "doc_id", F.sha2("_text", 256).alias("text_sha256"), chunks.alias("_chunks"))
        .select(
            "row", "doc_id", "text_sha256",
            F.transform("_chunks", lambda c: F.xxhash64(c)).alias("recipe"),
            F.transform("_chunks", lambda c: F.unhex(F.sha2(c, 256))).alias("digests"),
        )
    )


def shared_names(recipe_rows: DataFrame) -> DataFrame:
    """Chunk names that stand for more than one content: the dictionary holds each (name, digest) once."""
    pieces = recipe_rows.select(F.explode(F.arrays_zip("recipe", "digests")).alias("c"))
    dictionary = pieces.groupBy(F.col("c.recipe").alias("name"), F.col("c.digests").alias("digest")).count()
    return dictionary.groupBy("name").count().filter("count > 1").select("name")


def verified(recipe_rows: DataFrame, shared: DataFrame) -> DataFrame:
    """``recipe_rows`` with ``fix``: the digests, in order, of the chunks whose names are shared."""
    if shared.isEmpty():
        return recipe_rows.withColumn("fix", F.array().cast("array<binary>"))
    pieces = recipe_rows.select("row", F.posexplode(F.arrays_zip("recipe", "digests")).alias("pos", "c"))
    hits = pieces.select("row", "pos", F.col("c.recipe").alias("name"), F.col("c.digests").alias("digest")).join(shared, "name")
    fixes = hits.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("pos", "digest"))).alias("f"))
    fixes = fixes.select("row", F.col("f.digest").alias("fix"))
    return recipe_rows.join(fixes, "row", "left").withColumn("fix", F.coalesce("fix", F.array().cast("array<binary>")))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Of equal texts the row with the largest id stays; null ids count as smallest, and of rows that
    share id and text one stays. Other columns of the input, whatever their names, play no part.
    """
    written = stage(docs.sparkSession)
    rows = written.write(recipes(docs, id_col, text_col))
    key = ["recipe", "fix"]
    rows = verified(rows, written.write(shared_names(rows))).select("row", "doc_id", "text_sha256", *key)
    groups = rows.groupBy(*key).agg(
        F.count(F.lit(1)).alias("group_size"), F.max(F.struct("doc_id", "row")).alias("stays")
    )
    # Written, so that the join below meets two plain inputs: Spark then splits a group of a third of all rows.
    copies = written.write(groups.filter("group_size > 1"))
    return rows.join(copies, key, "left").select(
        "doc_id",
        F.when(F.col("stays").isNull(), F.col("doc_id")).otherwise(F.col("stays.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("stays").isNull() | (F.col("row") == F.col("stays.row"))).alias("kept"),
        "text_sha256",
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with their columns as they were.

    Losing rows are named by id and digest, narrow keys that Spark joins as their size demands. Rows
    that share id and text with the one that stays are told apart last, among themselves.
    """
    written = stage(docs.sparkSession)
    lost = written.write(exact_groups(docs, id_col, text_col).filter("not kept"))
    id_, digest = F.col(f"_row.{id_col}"), F.sha2(text_of(f"_row.{text_col}"), 256)

    def named(rows: DataFrame):
        names = rows.select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha")).distinct()
        return names, id_.eqNullSafe(F.col("_id")) & (digest == F.col("_sha"))

    others, is_other = named(lost.filter(~F.col("doc_id").eqNullSafe(F.col("keep_id"))))
    kept = wrapped(docs).join(others, is_other, "left_anti")
    twins, is_twin = named(lost.filter(F.col("doc_id").eqNullSafe(F.col("keep_id"))))
    if twins.isEmpty():
        return kept.select("_row.*")
    alone = kept.join(twins, is_twin, "left_anti").select("_row.*")
    paired = kept.join(twins, is_twin, "left_semi").select("_row.*")
    paired = paired.withColumn(text_col, text_of(text_col)).dropDuplicates([id_col, text_col])
    return alone.unionByName(paired)
