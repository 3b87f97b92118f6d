"""Near-duplicates by SimHash, found through deletion-variant signatures.

Two fingerprints that differ in at most two of 64 bits differ in at most one bit of
the upper half, or in two of it and none of the lower. So the upper half is indexed as
it is and with each one of its bits left out (a wildcard), the lower half as it is;
equal keys bring the candidates together, and their bit distance is verified. Equal
fingerprints are one class from the start, so copies are never paired. Where more than
``PAIR_LIMIT`` fingerprints share a key they are not paired either: leaving out further
bits divides them exactly, until a key holds four fingerprints at most.

Joins of tables that grow with the documents are merge joins, always. Their size as Spark has
it says little: keys made by an explode count as the rows before it, and columns of a file as
their compressed bytes; by these it would broadcast millions of keys.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymonth.llm.common import stored, texts, word_lists
from tallymonth.llm.components import connected_components
from tallymonth.llm.exact_dedup import content_hash, id_key

SEED = 42
HALF = 32

# Fingerprints under one key that are still compared pair by pair.
PAIR_LIMIT = 64


def fingerprint(text: str, shingle: int = 3) -> int:
    """64 bits, each set if set in over half of the shingles' hashes; 0 without words."""
    ones, total, carried = np.zeros(64, np.int64), 0, []

    def add(shingles: list[bytes]) -> None:
        nonlocal ones, total
        hashes = [xxhash.xxh64_intdigest(s, SEED) for s in shingles]
        for at in range(0, len(hashes), 1 << 16):
            part = np.array(hashes[at : at + (1 << 16)], dtype="<u8")
            bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.int64)
        total += len(hashes)

    for words in word_lists(text):
        words = carried + words
        add([b" ".join(run) for run in zip(*(words[i:] for i in range(shingle)), strict=False)])
        carried = words[-(shingle - 1) :] if shingle > 1 else []
    if not total and carried:
        add([b" ".join(carried)])
    bits = (2 * ones > total).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, hash, bits): a hash and the fingerprint, as a signed long, of each whole text."""
    rows = texts(docs).withColumn("hash", content_hash(F.col("text")))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            bits = [fingerprint(text.as_py(), shingle) for text in part.column("text")]
            signed = pa.array(np.array(bits, dtype="<u8").view("<i8"))
            kept = [part.column("doc_id"), part.column("hash"), signed]
            yield pa.RecordBatch.from_arrays(kept, ["doc_id", "hash", "bits"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(batches, f"doc_id {kind}, hash binary, bits long")


def _upper(bits: Column) -> Column:
    return F.shiftrightunsigned(bits, HALF)


def _lower(bits: Column) -> Column:
    return bits.bitwiseAND(F.lit((1 << HALF) - 1))


def _without(value: Column, bit: Column) -> Column:
    """The value with that bit left out, i.e. always 0; -1 leaves out none."""
    mask = F.when(bit < 0, F.lit(0)).otherwise(
        F.call_function("shiftleft", F.lit(1).cast("long"), bit)
    )
    return value.bitwiseAND(F.bitwise_not(mask))


def _bit(value: Column, bit: Column) -> Column:
    return F.call_function("shiftright", value, bit).bitwiseAND(F.lit(1))


LOWER, EXACT, LAST = -2, -1, HALF - 1
KEY = ["left_out", "rest"]


def _indexed(classes: DataFrame) -> DataFrame:
    """(left_out, rest, bits): the lower half (-2), the upper half (-1), and the upper
    half without its bit 0, 1, ... 31."""
    every = classes.select(
        "bits", F.explode(F.sequence(F.lit(LOWER), F.lit(LAST))).alias("left_out")
    )
    upper = _without(_upper(F.col("bits")), F.greatest("left_out", F.lit(EXACT)))
    lower = F.col("left_out") == LOWER
    return every.select(
        "left_out", F.when(lower, _lower(F.col("bits"))).otherwise(upper).alias("rest"), "bits"
    )


def _near(distance: int) -> Column:
    return F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance


def _few(members: DataFrame, distance: int) -> DataFrame:
    """Verified pairs under keys with few fingerprints.

    A pair meets once: under the upper half if that is equal, under the key that
    leaves out the one upper bit in which it differs, or under the lower half.
    """
    left = members.select(*KEY, F.col("bits").alias("a"))
    right = members.select(*KEY, F.col("bits").alias("b"))
    place = F.greatest("left_out", F.lit(0)) + HALF
    meets = F.when(F.col("left_out") < 0, F.col("a") < F.col("b")).otherwise(
        (_bit(F.col("a"), place) == 0) & (_bit(F.col("b"), place) == 1)
    )
    return left.join(right.hint("merge"), KEY).filter(meets & _near(distance)).select("a", "b")


def _many(members: DataFrame, distance: int) -> DataFrame:
    """Verified pairs under keys with many fingerprints, without pairing all of them.

    Under a whole half, a pair differs in at most two bits of the other half: each two
    of these are left out. Under an upper half without one bit, it differs in one more
    bit of the lower half: each of these is left out. So a key has two bits of play,
    and holds four fingerprints at most.
    """
    whole = F.col("left_out") < 0
    first = F.when(whole, F.sequence(F.lit(0), F.lit(LAST - 1))).otherwise(F.array(F.lit(-1)))
    other = F.when(F.col("left_out") == LOWER, _upper(F.col("bits"))).otherwise(
        _lower(F.col("bits"))
    )
    cut = (
        members.withColumn("i", F.explode(first))
        .withColumn("j", F.explode(F.sequence(F.col("i") + 1, F.lit(LAST))))
        .withColumn("other", _without(_without(other, F.col("i")), F.col("j")))
    )
    groups = (
        cut.groupBy(*KEY, "i", "j", "other")
        .agg(F.collect_set("bits").alias("group"))
        .filter(F.size("group") > 1)
    )
    pairs = groups.select("group", F.explode("group").alias("a"))
    return pairs.select("a", F.explode("group").alias("b")).filter((F.col("a") < F.col("b")) & _near(distance))


def links(classes: DataFrame, distance: int = 2, pair_limit: int = PAIR_LIMIT) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints at most ``distance`` (0 to 2) bits apart.

    All of them, however many share a key; ``pair_limit`` only chooses the way.
    A pair may be returned more than once.
    """
    if not 0 <= distance <= 2:
        raise ValueError("one wildcard in a half finds at most two differing bits")
    indexed = _indexed(classes)
    counts = indexed.groupBy(*KEY).agg(F.count("*").alias("n")).filter("n > 1")
    members = stored(indexed.join(counts.hint("merge"), KEY), "key-members")
    few = _few(members.filter(F.col("n") <= pair_limit), distance)
    return few.unionByName(_many(members.filter(F.col("n") > pair_limit), distance))


def _grouped(docs: DataFrame, shingle: int, distance: int) -> tuple[DataFrame, DataFrame]:
    """Every document with its fingerprint; every fingerprint with its component's first row."""
    marked = stored(fingerprints(docs, shingle), "fingerprints")
    row = F.struct(F.col("doc_id").isNull().alias("null_id"), "doc_id", "hash")
    classes = stored(marked.groupBy("bits").agg(F.min(row).alias("first")), "classes")
    roots = connected_components(links(classes.select("bits"), distance))
    rooted = classes.join(roots.hint("merge"), classes["bits"] == roots["node"], "left").select(
        "bits", "first", F.coalesce("component", "bits").alias("root")
    )
    firsts = rooted.groupBy("root").agg(F.min("first").alias("first"))
    return marked, rooted.select("bits", "root").join(firsts.hint("merge"), "root")


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 2) -> DataFrame:
    """One row per document: doc_id, bits, component_id.

    ``component_id`` is the smallest doc_id reachable over fingerprints at most
    ``distance`` bits apart; null ids are passed over, and it is null where a
    component has no other. Null and empty texts have fingerprint 0. Repeated rows
    stay. An empty table gives an empty result.
    """
    marked, named = _grouped(docs, shingle, distance)
    named = named.select("bits", F.col("first.doc_id").alias("component_id"))
    return marked.join(named.hint("merge"), "bits").select("doc_id", "bits", "component_id")


def one_of_each(docs: DataFrame, shingle: int = 3, distance: int = 2) -> DataFrame:
    """The documents that stay, with all their columns: the smallest id of each component.

    Of rows that repeat id and text one stays; a null id stays only where its
    component has no other.
    """
    _, named = _grouped(docs, shingle, distance)
    keepers = named.select(
        F.col("first.hash").alias("hash"), id_key(F.col("first.doc_id")).alias("key")
    ).distinct()
    rows = docs.select(
        F.struct("*").alias("row"),
        content_hash(F.coalesce("text", F.lit(""))).alias("hash"),
        id_key(F.col("doc_id")).alias("key"),
    )
    stay = rows.join(keepers.hint("merge"), ["hash", "key"]).dropDuplicates(["hash", "key"])
    return stay.select("row.*")


def hexadecimal(bits: Column) -> Column:
    return F.lower(F.lpad(F.hex(bits), 16, "0"))
