"""Exact duplicates by content hash.

Documents are grouped by a 128-bit hash of the text. The bytes inside a group are
compared by its smallest and largest text: both are combined per task before the
shuffle, so a group of any size sends two texts per task, and they differ exactly if
the hash brought different texts together. Such groups are split by the text itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymonth.llm.common import stored, texts


def content_hash(text: Column) -> Column:
    """128 bits."""
    return F.unhex(F.md5(text))


Hash = Callable[[Column], Column]


def id_key(doc_id: Column) -> Column:
    """The id as an equality key: no id has the empty text, so nulls match nulls."""
    return F.coalesce(doc_id.cast("string"), F.lit(""))


def duplicate_groups(
    docs: DataFrame, keep: str = "min", hash_of: Hash = content_hash
) -> tuple[DataFrame, DataFrame | None]:
    """Groups of equal texts, as (hash, keep_id, group_size), one row per group.

    The second table has the groups whose hash is shared by different texts, with
    their text; it is None unless the hash collides. ``keep`` says whether the
    smallest ("min") or the largest ("max") id of a group stays. A null id stays
    only in a group without any other; a null text counts as empty.
    """
    chosen = {"min": F.min, "max": F.max}[keep]("doc_id").alias("keep_id")
    hashed = texts(docs).withColumn("hash", hash_of(F.col("text")))
    groups = stored(
        hashed.groupBy("hash")
        .agg(
            chosen,
            F.count("*").alias("group_size"),
            F.min("text").alias("first_text"),
            F.max("text").alias("last_text"),
        )
        .select(
            "hash",
            "keep_id",
            "group_size",
            (F.col("first_text") != F.col("last_text")).alias("collided"),
        ),
        "hash-groups",
    )
    plain = groups.filter("not collided").drop("collided")
    collided = groups.filter("collided").select("hash")
    if collided.isEmpty():
        return plain, None
    by_text = hashed.join(collided, "hash", "left_semi").groupBy("hash", "text")
    return plain, by_text.agg(chosen, F.count("*").alias("group_size"))


def assignments(docs: DataFrame, keep: str = "min", hash_of: Hash = content_hash) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Of rows that repeat both id and text one is kept. Empty input, empty result.
    """
    groups, by_text = duplicate_groups(docs, keep, hash_of)
    hashed = texts(docs).withColumn("hash", hash_of(F.col("text")))
    columns = ["hash", "doc_id", "text_sha256"]

    def counted(rows: DataFrame, *more: str) -> DataFrame:
        return rows.groupBy(*columns, *more).agg(F.count("*").alias("times"))

    rows = hashed.select("hash", "doc_id", F.sha2("text", 256).alias("text_sha256"))
    placed = counted(rows).join(groups, "hash")
    if by_text is not None:
        rows = hashed.join(by_text.select("hash").distinct(), "hash", "left_semi")
        rows = rows.withColumn("text_sha256", F.sha2("text", 256))
        placed = placed.unionByName(
            counted(rows, "text").join(by_text, ["hash", "text"]).drop("text")
        )
    each = placed.withColumn("nth", F.explode(F.sequence(F.lit(1), F.col("times"))))
    return each.select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)).alias("kept"),
        "text_sha256",
    )


def deduplicated(docs: DataFrame, keep: str = "min", hash_of: Hash = content_hash) -> DataFrame:
    """The documents that stay, with all their columns."""
    groups, by_text = duplicate_groups(docs, keep, hash_of)
    rows = docs.select(
        F.struct("*").alias("row"),
        hash_of(F.coalesce("text", F.lit(""))).alias("hash"),
        id_key(F.col("doc_id")).alias("key"),
    )
    # As many as there are texts, whatever their file's size says of them.
    keepers = groups.select("hash", id_key(F.col("keep_id")).alias("key")).hint("merge")
    stay = rows.join(keepers, ["hash", "key"]).dropDuplicates(["hash", "key"]).select("row.*")
    if by_text is None:
        return stay
    keepers = by_text.select("hash", id_key(F.col("keep_id")).alias("key"), "text")
    names = keepers.columns
    exact = rows.withColumn("text", F.coalesce("row.text", F.lit(""))).join(keepers, names)
    return stay.unionByName(exact.dropDuplicates(names).select("row.*"))
