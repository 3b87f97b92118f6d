"""Sharding by extendible hashing.

A directory is indexed by the first bits of a hash of each document. A bucket that
exceeds the byte limit splits on one more bit, until every shard fits; other buckets stay.
Sums by a longer prefix give those of all shorter ones, so a few passes over narrow
rows find every split; only what is still too large is looked at again.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymonth.llm.common import stored

HASH_BITS = 63
SPARE_BITS = 4
LEVELS = 4


def _prefix(value: Column, bits: int | Column, of: int | Column) -> Column:
    """The first ``bits`` of a number of ``of`` bits."""
    shift = (F.lit(of) - F.lit(bits)).cast("int")
    return F.call_function("shiftright", value, shift)


def _sums(pending: DataFrame, start: int, depth: int) -> DataFrame:
    """(bits, parent, bytes): the bytes under every prefix of ``start`` to ``depth`` bits.

    Summed upward a few bits at a time, so that no sum or join has more than
    2 ^ ``LEVELS`` rows under one key, the shortest prefixes among them.
    """
    level = pending.groupBy(_prefix(F.col("hash"), depth, HASH_BITS).alias("prefix")).agg(
        F.sum("bytes").alias("bytes")
    )
    levels, top = [], depth
    while True:
        low = max(start, top - LEVELS)
        upper = top if top == depth else top - 1
        every = level.withColumn("bits", F.explode(F.sequence(F.lit(low), F.lit(upper))))
        parent = _prefix(F.col("prefix"), F.col("bits"), top).alias("parent")
        sums = stored(every.groupBy("bits", parent).agg(F.sum("bytes").alias("bytes")), "prefixes")
        levels.append(sums)
        if low == start:
            return reduce(DataFrame.unionByName, levels)
        level, top = sums.filter(F.col("bits") == low).select(F.col("parent").alias("prefix"), "bytes"), low


def _leaves(sums: DataFrame, start: int, limit: int) -> DataFrame:
    """(split, leaf, shard_bytes): the prefixes that fit and whose parent does not."""
    fits = (F.col("bytes") <= limit) | (F.col("bits") == HASH_BITS)
    nodes = sums.select("bits", "parent", "bytes", fits.alias("fits"))
    above = nodes.select(
        (F.col("bits") + 1).alias("bits"), F.col("parent").alias("above"), F.col("fits").alias("above_fits")
    )
    child = nodes.filter("fits").withColumn("above", F.call_function("shiftright", "parent", F.lit(1)))
    found = child.join(above, ["bits", "above"], "left").filter(
        (F.col("bits") == start) | ~F.coalesce("above_fits", F.lit(False))
    )
    return found.select(
        F.col("bits").alias("split"), F.col("parent").alias("leaf"), F.col("bytes").alias("shard_bytes")
    )


def _directory(pending: DataFrame, start: int, depth: int, limit: int) -> DataFrame:
    """(prefix, split, shard_bytes) for prefixes of ``depth`` bits; split is the number of
    bits at which the shard fits, null if it does not yet."""
    sums = _sums(pending, start, depth)
    leaves = stored(_leaves(sums, start, limit), "leaves")
    used = sorted(row["split"] for row in leaves.select("split").distinct().collect())
    prefixes = sums.filter(F.col("bits") == depth).select(F.col("parent").alias("prefix"))
    tried = F.array(*map(F.lit, used)) if used else F.array().cast("array<int>")
    each = prefixes.withColumn("split", F.explode_outer(tried)).withColumn(
        "leaf", _prefix(F.col("prefix"), F.col("split"), depth)
    )
    # A prefix is under one leaf at most; max passes over the lengths that are none.
    found = each.join(leaves, ["split", "leaf"], "left").groupBy("prefix").agg(
        F.max(F.when(F.col("shard_bytes").isNotNull(), F.struct("split", "shard_bytes"))).alias("found")
    )
    return stored(found.select("prefix", "found.split", "found.shard_bytes"), "directory")


def shards(docs: DataFrame, limit_bytes: int) -> DataFrame:
    """One row per row: doc_id, bytes, shard (its prefix as 0s and 1s), shard_bytes.

    ``bytes`` is the text's length in UTF-8, 0 for a null text. Every shard has at most
    ``limit_bytes``, except one that no bit divides: a document that is larger alone, or
    rows that repeat id and text. If everything fits there is one shard, named ''. The
    hash depends on id and text alone, so reruns agree. An empty table gives no rows; null
    ids, repeated rows and texts of any length are rows like any other; other columns are not
    read, so their names may be any.
    """
    text = F.coalesce("text", F.lit(""))
    whole = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), text)
    rows = stored(
        docs.select(
            F.col("doc_id"),
            F.octet_length(text).cast("long").alias("bytes"),
            F.shiftrightunsigned(whole, 1).alias("hash"),
        ),
        "hashes",
    )
    total = rows.agg(F.sum("bytes")).first()[0] or 0
    start, step = 0, SPARE_BITS + max(0, math.ceil(math.log2(max(1, total / limit_bytes))))
    pending, done = rows, []
    while True:
        depth = min(HASH_BITS, start + step)
        directory = _directory(pending, start, depth, limit_bytes)
        placed = pending.withColumn("prefix", _prefix(F.col("hash"), depth, HASH_BITS))
        placed = placed.join(directory, "prefix")
        bits = F.lpad(F.bin(_prefix(F.col("hash"), F.col("split"), HASH_BITS)), F.lit(HASH_BITS), "0")
        shard = F.substring(bits, F.lit(HASH_BITS + 1) - F.col("split"), F.col("split"))
        fit = placed.filter("split is not null")
        done.append(fit.select("doc_id", "bytes", shard.alias("shard"), "shard_bytes"))
        if directory.filter("split is null").isEmpty():
            return reduce(DataFrame.unionByName, done)
        pending = stored(placed.filter("split is null").select(*rows.columns), "oversized")
        start, step = depth, 2 * SPARE_BITS
