"""Mixing sources to target weights by Sainte-Lague apportionment of equal blocks.

The mix has a fixed number of blocks of equally many words. They go to the sources one by
one, each to the highest quotient target / (2 s - 1), where s is the number of the block that the
source would get. The first blocks dealt this way make the first shard, the next
ones the second and so on, so every source has an integer quota in every shard and every
shard is mixed like the whole. Blocks have ``BLOCK_WORDS`` words, fewer where the smallest target
is not at least four times that.

A source's documents are laid end to end in an order drawn by the seed, over and over; its
blocks are cut from that line, and each shard takes the next blocks of its quota. So
documents stay whole, but for one cut document at the end of each source's line.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallymonth.llm.common import WORD, stored
from tallymonth.operators.spread import most_frequent

BLOCK_WORDS = 32
SHARD_WORDS = 1 << 30
BUCKET_ROWS = 2_000
PARTS_A_RUN = 4_096
SEED = 42


def cyclic_weights(docs: DataFrame, weights: list[float]) -> DataFrame:
    """(source, weight): the sources by code point, null last, take the weights in turn."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1
    values = F.array(*[F.lit(float(weight)) for weight in weights])
    return docs.select("source").distinct().select(
        "source", F.element_at(values, turn.cast("int")).alias("weight")
    )


def _join_source(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join on source, where null equals null."""
    named = right.withColumnRenamed("source", "same_source")
    return left.join(
        named, F.col("source").eqNullSafe(F.col("same_source")), how
    ).drop("same_source")


def targets(sizes: DataFrame, weights: DataFrame, cap: float = 3.0) -> DataFrame:
    """(source, source_size, target) of (source, source_size), one row per source.

    The targets share all sizes by weight; what exceeds ``cap`` times a source's size
    is shared anew among the others, until none exceeds. Sources fill up in the order of
    size by weight, so running sums over the sources find the level at which the rest
    stand. A source without a weight, or with none above 0, gets nothing.
    """
    given = weights.groupBy("source").agg(F.max("weight").alias("given"))
    both = _join_source(sizes, given, "left").select(
        "source", "source_size", F.greatest("given", F.lit(0.0)).alias("weight")
    )
    most = F.when(F.col("weight") > 0, F.col("source_size") * cap).otherwise(0.0)
    fill = F.when(F.col("weight") > 0, most / F.col("weight")).otherwise(0.0)
    both = both.withColumn("most", most).withColumn("fill", fill)
    every = Window.partitionBy()
    before = Window.orderBy("fill", F.col("source").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    open_weights = F.sum("weight").over(every) - F.coalesce(
        F.sum("weight").over(before), F.lit(0.0)
    )
    levels = both.withColumn("level", F.try_divide(left, open_weights)).withColumn(
        "full", F.coalesce(F.col("fill") <= F.col("level"), F.lit(True))
    )
    level = F.max(F.when(~F.col("full"), F.col("level"))).over(every)
    target = F.when(F.col("full"), F.col("most")).otherwise(level * F.col("weight"))
    return levels.select("source", "source_size", target.alias("target"))


def with_blocks(
    planned: DataFrame, block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS, cap: float = 3.0
) -> DataFrame:
    """Of (source, source_size, target): ``block`` (words of a block), ``most`` (blocks that a
    source can fill), ``all_blocks`` and ``shards`` of the mix."""
    every = Window.partitionBy()
    least = F.min(F.when(F.col("target") > 0, F.col("target"))).over(every)
    block = F.greatest(F.least(F.floor(least / 4), F.lit(block_words)), F.lit(1))
    words = F.sum("target").over(every)
    sized = planned.withColumn("block", F.coalesce(block, F.lit(1)).cast("long")).withColumn("words", words)
    shards = F.greatest(F.ceil(F.col("words") / shard_words), F.lit(1)).cast("long")
    most = F.when(F.col("target") > 0, F.floor(F.col("source_size") * cap / F.col("block"))).otherwise(0)
    # Half a block of rounding in the sums of doubles must not cost a block.
    return sized.select(
        "source",
        "source_size",
        "target",
        "block",
        most.cast("long").alias("most"),
        F.floor(F.col("words") / F.col("block") + 1e-6).cast("long").alias("all_blocks"),
        shards.alias("shards"),
    )


def _seats(divisor: Column) -> Column:
    """How many blocks of a source have quotients of at least half the divisor."""
    return F.least(F.floor(F.col("target") / divisor + 0.5), F.col("most"))


def apportioned(planned: DataFrame) -> DataFrame:
    """(source, shard, dealt): how many blocks each source has in a shard and those before.

    ``planned`` is what ``with_blocks`` gives. Shard k ends after block all_blocks * (k + 1) /
    shards. By highest quotients; of equal ones the source first by code point, null last. Blocks
    that are certain and blocks that are out of the question follow from two divisors, as
    rounding moves each source by half a block at most; only those between are ranked, a
    few for each source and shard.
    """
    cut = planned.filter("target > 0").withColumn(
        "shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1))
    )
    house = F.call_function("div", F.col("all_blocks") * (F.col("shard") + 1), F.col("shards"))
    cut = cut.withColumn("house", house)
    of_shard = Window.partitionBy("shard")
    n, weight = F.count("*").over(of_shard), F.sum("target").over(of_shard)
    sure = F.when(F.col("house") > n / 2, _seats(weight / (F.col("house") - n / 2))).otherwise(0)
    cut = cut.withColumn("sure", sure).withColumn("divisor", weight / (F.col("house") + n))
    for _ in range(3):
        # Sources at their limit leave their blocks to the others, who need a smaller divisor.
        seats = _seats(F.col("divisor"))
        open_ = seats < F.col("most")
        rest = F.sum(F.when(open_, F.col("target"))).over(of_shard)
        left = F.col("house") - F.sum(F.when(open_, 0).otherwise(F.col("most"))).over(of_shard)
        smaller = F.try_divide(rest, F.greatest(left, F.lit(0)) + n)
        cut = cut.withColumn("divisor", F.coalesce(F.least("divisor", smaller), F.col("divisor")))
    cut = cut.withColumn("possible", F.greatest(_seats(F.col("divisor")), F.col("sure")))
    cut = cut.withColumn("missing", F.col("house") - F.sum("sure").over(of_shard))
    between = F.when(
        F.col("possible") > F.col("sure"), F.sequence(F.col("sure") + 1, F.col("possible"))
    )
    seats = cut.select("source", "shard", "target", "missing", F.explode(between).alias("seat"))
    order = Window.partitionBy("shard").orderBy(
        F.desc(F.col("target") / (2 * F.col("seat") - 1)), F.col("source").asc_nulls_last(), "seat"
    )
    won = seats.withColumn("place", F.row_number().over(order)).filter(
        F.col("place") <= F.col("missing")
    )
    both = cut.select("source", "shard", F.col("sure").alias("dealt")).unionByName(
        won.select("source", "shard", F.lit(1).cast("long").alias("dealt"))
    )
    return both.groupBy("source", "shard").agg(F.sum("dealt").alias("dealt"))


def shard_quotas(planned: DataFrame) -> DataFrame:
    """(source, shard, first_block, blocks): each source's blocks of every shard."""
    order = Window.partitionBy("source").orderBy("shard")
    before = F.coalesce(F.lag("dealt").over(order), F.lit(0))
    return apportioned(planned).select(
        "source", "shard", before.alias("first_block"), (F.col("dealt") - before).alias("blocks")
    )


def _with_ends(planned: DataFrame) -> DataFrame:
    """Add ``ends``, the blocks of a source before the end of each shard, and ``blocks``, all."""
    dealt = apportioned(planned).groupBy("source").agg(
        F.sort_array(F.collect_list(F.struct("shard", "dealt"))).alias("dealt")
    )
    ends = dealt.select("source", F.col("dealt.dealt").alias("ends"))
    return _join_source(planned, ends, "left").select(
        "*",
        F.coalesce(F.element_at("ends", -1), F.lit(0)).alias("blocks"),
    )


def _laid_out(rows: DataFrame) -> DataFrame:
    """Add to rows (name, unnamed, order, exact, nth, size) the keys of their place on the line:
    ``run`` and ``part`` of their source, and for rows that repeat too often, ``bulk`` and ``sub``.

    A part has about ``BUCKET_ROWS`` rows. Equal rows are always in the same part; where they
    are more than that, their copies are numbered and dealt to subparts of their own. Copies are
    the same, so it does not matter which of them comes first.
    """
    parts = 1 + rows.count() // BUCKET_ROWS
    place = F.shiftrightunsigned("order", 1)
    part = F.least(F.floor(place / F.lit(2.0**63) * parts), F.lit(parts - 1)).cast("long")
    cut = rows.withColumn("part", part)
    crowded = most_frequent(cut, ["name", "unnamed", "part"], 4 * BUCKET_ROWS).drop("hot_n")
    inside = cut.join(F.broadcast(crowded), ["name", "unnamed", "part"], "left_semi")
    bulk = most_frequent(inside, ["exact"], BUCKET_ROWS).select(
        F.col("exact").alias("bulk"), F.ceil(F.col("hot_n") / BUCKET_ROWS).cast("long").alias("subs")
    )
    marked = cut.join(F.broadcast(bulk), F.col("exact") == F.col("bulk"), "left")
    # The number of a copy holds its partition in the upper bits.
    number = F.col("nth") + F.shiftright("nth", 33)
    return marked.withColumns(
        {
            "run": F.call_function("div", F.col("part"), F.lit(PARTS_A_RUN)),
            "sub": F.coalesce(F.pmod(number, F.col("subs")), F.lit(0)),
        }
    ).drop("subs")


LINE = ["name", "unnamed", "run", "part", "bulk", "sub"]


def _starts(rows: DataFrame) -> DataFrame:
    """(the keys of ``LINE``, part_size, start): where each part begins on its source's line.

    Sums of parts are added up within runs of parts, and the runs one after the other.
    """
    sums = rows.groupBy(*LINE).agg(F.sum("size").alias("part_size"))
    runs = sums.groupBy("name", "unnamed", "run").agg(F.sum("part_size").alias("run_size"))
    whole = Window.partitionBy("name", "unnamed").orderBy("run")
    runs = runs.withColumn("run_start", F.sum("run_size").over(whole) - F.col("run_size"))
    ahead = Window.partitionBy("name", "unnamed", "run").orderBy(
        "part", F.col("bulk").asc_nulls_first(), "sub"
    ).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = F.sum("part_size").over(ahead) - F.col("part_size")
    placed = sums.withColumn("inside", inside).join(runs, ["name", "unnamed", "run"])
    return placed.select(*LINE, "part_size", (F.col("run_start") + F.col("inside")).alias("start"))


def mix(
    docs: DataFrame,
    weights: DataFrame,
    cap: float = 3.0,
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
    seed: int = SEED,
    carry: list[str] | None = None,
) -> DataFrame:
    """Every document with its place in the mix; ``carry`` names the columns in ``row``.

    Columns: row (struct), source, size (words), source_size, target, block (words of a
    block), blocks (the source's quota), spans: an array of (epoch, first_block, last_block, first_shard, last_shard,
    words), one for each time that the document, or its first ``words`` words, is taken;
    the shards are those to which the first and the last block are dealt. Null texts have no
    words and are never taken; a null source is a source. Rows that repeat a document
    are documents of their own. The order depends on seed, id and text alone, so
    reruns agree. An empty table gives an empty result.

    A source of any size is laid out in parts of about ``BUCKET_ROWS`` rows; only sums
    of these parts and of the sources are ever brought together.
    """
    columns = [F.col(f"`{name}`") for name in carry or docs.columns]
    text = F.coalesce("text", F.lit(""))
    # Stored, so that words are counted once and the numbers of copies never change.
    rows = docs.select(
        F.struct(*columns).alias("row"),
        F.col("source"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        F.xxhash64(F.lit(seed), F.col("doc_id"), text).alias("order"),
        F.col("doc_id").alias("tie"),
        F.monotonically_increasing_id().alias("nth"),
    )
    rows = stored(rows, "sized-documents").withColumns(
        {
            "name": F.coalesce("source", F.lit("")),
            "unnamed": F.col("source").isNull(),
            "exact": F.xxhash64("order", "row"),
        }
    )
    rows = _laid_out(rows)
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    planned = with_blocks(targets(sizes, weights, cap), block_words, shard_words, cap)
    planned = _with_ends(planned)

    named = _starts(rows).withColumn("source", F.when(~F.col("unnamed"), F.col("name")))
    epochs = F.sequence(F.lit(0).cast("long"), F.lit(math.ceil(cap) - 1).cast("long"))

    def near(epoch: Column) -> Column:
        """The shard in which a part begins, and the ends of shards within the part."""
        start = F.col("start") + epoch * F.col("source_size")
        low = F.floor(start / F.col("block"))
        high = F.floor((start + F.col("part_size")) / F.col("block"))
        return F.struct(
            F.size(F.filter("ends", lambda end: end <= low)).cast("long").alias("shard"),
            F.filter("ends", lambda end: (end > low) & (end <= high)).alias("ends"),
        )

    starts = _join_source(named, planned, "inner").select(
        *LINE, "start", "source_size", "target", "block", "blocks", F.transform(epochs, near).alias("near")
    )

    within = Window.partitionBy(*LINE).orderBy(F.shiftrightunsigned("order", 1), "order", "tie", "exact")
    before = F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, -1))
    same = F.lit(True)
    laid = rows.withColumn("before", F.coalesce(before, F.lit(0)))
    there = starts.select(*[F.col(key).alias(f"{key}_at") for key in LINE], *starts.columns[len(LINE):])
    for key in LINE:
        same &= F.col(key).eqNullSafe(F.col(f"{key}_at"))
    laid = laid.join(there, same)

    first = F.col("start") + F.col("before")
    taken = F.col("blocks") * F.col("block")
    last_epoch = F.floor((taken - 1) / F.col("source_size"))

    def shard_of(block: Column, epoch: Column) -> Column:
        known = F.get("near", epoch.cast("int"))
        return known["shard"] + F.size(F.filter(known["ends"], lambda end: end <= block))

    def span(epoch: Column) -> Column:
        start = first + epoch * F.col("source_size")
        words = F.least(F.col("size"), taken - start)
        first_block = F.floor(start / F.col("block"))
        last_block = F.floor((start + words - 1) / F.col("block"))
        return F.struct(
            epoch.cast("int").alias("epoch"),
            first_block.alias("first_block"),
            last_block.alias("last_block"),
            shard_of(first_block, epoch).alias("first_shard"),
            shard_of(last_block, epoch).alias("last_shard"),
            words.alias("words"),
        )

    taken_in = F.when(taken > 0, F.sequence(F.lit(0).cast("long"), last_epoch))
    spans = F.filter(F.transform(taken_in, span), lambda s: s["words"] > 0)
    return laid.select(
        "row",
        "source",
        "size",
        "source_size",
        "target",
        "block",
        "blocks",
        F.coalesce(spans, F.array().cast(_SPANS)).alias("spans"),
    )


_SPANS = """array<struct<epoch:int,first_block:bigint,last_block:bigint,
    first_shard:bigint,last_shard:bigint,words:bigint>>"""


def taken_words(spans: Column) -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda sum_, s: sum_ + s["words"])


def mixed_documents(docs: DataFrame, weights: DataFrame, cap: float = 3.0) -> DataFrame:
    """The mix as documents, with the columns of ``docs``: each as often as it is taken.

    The last time may take its first words only; then the text ends after the last of
    them, and ``n_chars``, where there is such a column, counts what is left.
    """
    each = mix(docs, weights, cap).select("row", "size", F.explode("spans").alias("span"))
    cut = F.col("span.words") < F.col("size")
    runs = F.regexp_extract_all(F.col("row.text"), F.lit(rf"[\x20\x09-\x0D]*{WORD}"), F.lit(0))
    words = F.slice(runs, F.lit(1), F.when(cut, F.col("span.words")).otherwise(1).cast("int"))
    out = each.withColumn(
        "new", F.when(cut, F.array_join(words, "")).otherwise(F.col("row.text"))
    )
    changed = {"text": F.col("new")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed["n_chars"] = F.when(cut, F.char_length("new")).otherwise(F.col("row.n_chars")).cast(kind)
    return out.select(
        *[changed.get(name, F.col(f"row.`{name}`")).alias(name) for name in docs.columns]
    )
