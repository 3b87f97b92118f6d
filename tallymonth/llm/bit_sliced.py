"""Exact top-k search by integer inner product through a bit-sliced index.

Vectors of whole numbers are packed into blocks of rows. In a block every attribute is
quantised to ``SLICES`` bits and kept as that many bitmaps over the block's rows, one for
each bit, beside the exact numbers. For a query the slices of all attributes, each times
the query's quantised weight, are added with bitmap arithmetic alone: full adders reduce
three numbers to a sum and a carry for all rows of the block, until one bit-sliced sum is
left. Attributes with a negative weight enter as the complement of their slices.

The sum lies within a known error of the true score. Going through its slices from the
most significant one, rows are taken, kept open or dropped until the k-th largest sum is
known. Rows less than twice the error below it may still belong to the answer; these
boundary rows, and the taken ones, are resolved by their exact scores. So the result is
exact whatever the data; its distribution decides only how many rows are resolved.

Queries and blocks meet in a grid: both are dealt to lanes, so that no task holds more than
a few blocks and chunks of queries. Each block gives k rows a query at most, and the
best of these are ranked at last.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallymonth.llm.common import stored

BLOCK_ROWS = 2048
CHUNK_QUERIES = 256
LANE_BLOCKS = 4
LANE_CHUNKS = 1
MOST_CELLS = 20_000
SLICES = 6
WEIGHT_BITS = 5
QUERIES_AT_ONCE = 2

# Sums of squares up to here leave room for every inner product in 64 bits.
MOST_SQUARES = 2**62
# Whole numbers up to here are exact as doubles, and so are the bounds of errors.
LARGEST = 2**31 - 1


def take_part(vector: Column) -> Column:
    """Neither null nor with a null, infinite or undefined component."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad, F.lit(False))


def quantised(vector: Column, scale: float = 256.0) -> Column:
    """floor(scale * x) of every component, x as double."""
    return F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))


@dataclass(frozen=True)
class Block:
    """Rows of one width: their exact numbers, and their quantised slices as bitmaps.

    Row r is bit r % 64 of word r // 64 of every bitmap. ``slices`` holds, for every
    attribute, ``SLICES`` bitmaps of (number - low) >> shift, least significant first.
    """

    numbers: np.ndarray  # rows x width
    low: np.ndarray  # of each attribute
    shift: int
    slices: np.ndarray  # width x SLICES x words

    @staticmethod
    def of(numbers: np.ndarray) -> Block:
        low = numbers.min(axis=0)
        spread = int((numbers - low).max(initial=0))
        shift = max(0, spread.bit_length() - SLICES)
        coarse = (numbers - low) >> shift
        return Block(numbers, low, shift, packed(coarse, SLICES))


def packed(coarse: np.ndarray, bits: int) -> np.ndarray:
    """Bitmaps of whole numbers (rows x width): width x bits x words, the last word padded."""
    rows, width = coarse.shape
    words = -(-rows // 64)
    out = np.zeros((width, bits, words * 8), np.uint8)
    for bit in range(bits):
        out[:, bit, : -(-rows // 8)] = np.packbits(
            (coarse >> bit & 1).astype(np.uint8), axis=0, bitorder="little"
        ).T
    return out.view("<u8")


def add(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sum of bit-sliced numbers (... x bits x words); the top bit must not carry."""
    out = np.empty_like(a)
    carry = np.zeros_like(a[..., 0, :])
    for bit in range(a.shape[-2]):
        x, y = a[..., bit, :], b[..., bit, :]
        either = x ^ y
        out[..., bit, :] = either ^ carry
        carry = (x & y) | (carry & either)
    return out


def total(numbers: np.ndarray) -> np.ndarray:
    """The sum over axis 1 of bit-sliced numbers (queries x addends x bits x words).

    Full adders turn three addends into their sum without carries and their carries, one
    place up, until two are left; the top bits must have room for the sum.
    """
    while numbers.shape[1] > 2:
        threes = numbers.shape[1] // 3
        a, b, c = (numbers[:, at : 3 * threes : 3] for at in range(3))
        either = a ^ b
        carried = np.zeros_like(a)
        carried[:, :, 1:] = ((a & b) | (c & either))[:, :, :-1]
        numbers = np.concatenate([either ^ c, carried, numbers[:, 3 * threes :]], axis=1)
    if numbers.shape[1] == 1:
        return numbers[:, 0]
    return add(numbers[:, 0], numbers[:, 1])


def products(block: Block, bits: int) -> np.ndarray:
    """Every attribute's slices, then their complements, times 0, 1, ... 2^WEIGHT_BITS - 1.

    Shape: 2 * width x weights x bits x words, made by shifted additions of slices.
    """
    width, _, words = block.slices.shape
    out = np.zeros((2 * width, 1 << WEIGHT_BITS, bits, words), np.uint64)
    for weight in range(1, 1 << WEIGHT_BITS):
        top = weight.bit_length() - 1
        once = np.zeros((2 * width, bits, words), np.uint64)
        once[:width, top : top + SLICES] = block.slices
        once[width:, top : top + SLICES] = ~block.slices
        rest = weight - (1 << top)
        out[:, weight] = add(once, out[:, rest]) if rest else once
    return out


def kth_largest(sums: np.ndarray, valid: np.ndarray, k: int) -> int:
    """The k-th largest of bit-sliced sums (bits x words) among the rows of a bitmap.

    From the most significant slice downward: rows with the bit are enough, or all of them
    are taken and the rest is searched on. With fewer than k rows, 0.
    """
    taken, open_rows, value = 0, valid, 0
    for bit in range(len(sums) - 1, -1, -1):
        high = open_rows & sums[bit]
        count = int(np.bitwise_count(high).sum())
        if taken + count >= k:
            open_rows = high
            value |= 1 << bit
        else:
            taken += count
            open_rows = open_rows & ~sums[bit]
    return value if int(np.bitwise_count(open_rows).sum()) + taken >= k else 0


def at_least(sums: np.ndarray, valid: np.ndarray, value: int) -> np.ndarray:
    """The bitmap of the rows whose sums reach a value, from the top slice downward."""
    if value >> len(sums):
        return np.zeros_like(valid)
    above, equal = np.zeros_like(valid), valid
    for bit in range(len(sums) - 1, -1, -1):
        if value >> bit & 1:
            equal = equal & sums[bit]
        else:
            above = above | (equal & sums[bit])
            equal = equal & ~sums[bit]
    return above | equal


class Searcher:
    """Finds the candidates of queries in one block."""

    def __init__(self, block: Block) -> None:
        self.block = block
        rows, width = block.numbers.shape
        most = max(1, width) * ((1 << SLICES) - 1) * ((1 << WEIGHT_BITS) - 1)
        self.bits = most.bit_length()
        self.products = products(block, self.bits)
        self.valid = packed(np.ones((rows, 1), np.int64), 1)[0, 0]
        middle = ((1 << block.shift) - 1) / 2
        coarse = ((block.numbers - block.low) >> block.shift << block.shift) + block.low
        self.rest = float(np.sqrt(((block.numbers - coarse - middle) ** 2).sum(axis=1)).max(initial=0))
        self.longest = float(np.sqrt((block.numbers.astype(float) ** 2).sum(axis=1)).max(initial=0))

    def candidates(self, queries: np.ndarray, k: int) -> Iterator[np.ndarray]:
        """For each query (rows x width), the rows that may be among its k best."""
        width = queries.shape[1]
        if not width or len(self.block.numbers) <= k:
            yield from [np.arange(len(self.block.numbers))] * len(queries)
            return
        size = np.abs(queries)
        shift = np.array([max(0, int(m).bit_length() - WEIGHT_BITS) for m in size.max(axis=1)])
        # Rounded to the nearest weight there is.
        half = np.where(shift > 0, 1 << np.maximum(shift - 1, 0), 0)
        weights = np.minimum((size + half[:, None]) >> shift[:, None], (1 << WEIGHT_BITS) - 1)
        used = weights << shift[:, None]
        # By Cauchy-Schwarz: what rounding the weights, and the attributes, can make a score differ.
        error = np.sqrt(((size - used).astype(float) ** 2).sum(axis=1)) * self.longest
        error += np.sqrt((used.astype(float) ** 2).sum(axis=1)) * self.rest
        row = np.arange(width) + np.where(queries < 0, width, 0)
        for at in range(0, len(queries), QUERIES_AT_ONCE):
            some = slice(at, at + QUERIES_AT_ONCE)
            sums = total(self.products[row[some], weights[some]])
            for one, off, shifted in zip(sums, error[some], shift[some], strict=True):
                # Sums are in units of both shifts. A little more than twice the error is safe.
                unit = 2.0 ** (int(shifted) + self.block.shift)
                least = kth_largest(one, self.valid, k) - (int(2 * off / unit * (1 + 1e-9)) + 2)
                found = at_least(one, self.valid, max(0, least))
                bits = np.unpackbits(found.view(np.uint8), bitorder="little")
                yield np.flatnonzero(bits)


_BLOCK = "block string, width int, ids array<long>, numbers binary"


def _packed_rows(rows: DataFrame, most: int) -> DataFrame:
    """Blocks of the rows (id, x) of each partition, by width, in the order they come."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        partition, made = TaskContext.get().partitionId(), 0

        def flushed(width: int) -> pa.RecordBatch:
            nonlocal made
            found = held.pop(width)
            ids, numbers = zip(*found, strict=True)
            numbers = np.concatenate(numbers).reshape(len(ids), width)
            if max(numbers.max(initial=0), -1 - numbers.min(initial=0)) > LARGEST or (
                (numbers.astype(float) ** 2).sum(axis=1).max(initial=0) > MOST_SQUARES
            ):
                raise ValueError("components are too large for scores of 64 bits")
            made += 1
            columns = [
                pa.array([f"{partition}-{made}"], pa.string()),
                pa.array([width], pa.int32()),
                pa.array([list(ids)], pa.list_(pa.int64())),
                pa.array([numbers.astype("<i4").tobytes()], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(columns, ["block", "width", "ids", "numbers"])

        for part in parts:
            if not len(part):
                continue
            x = part.column("x")
            flat, ends = x.flatten().to_numpy(zero_copy_only=False), np.cumsum(x.value_lengths().to_numpy())
            for id_, numbers in zip(part.column("id").to_pylist(), np.split(flat, ends[:-1]), strict=True):
                held.setdefault(len(numbers), []).append((id_, numbers))
                if len(held[len(numbers)]) == most:
                    yield flushed(len(numbers))
        for width in list(held):
            yield flushed(width)

    return rows.mapInArrow(batches, _BLOCK)


def build(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The index of (id, x): a row per block, with its attributes' slices.

    Blocks hold rows of one partition and one width, so building shuffles nothing.
    """

    def sliced(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in parts:
            for at in range(len(whole)):
                part = whole.slice(at, 1)
                width = part.column("width")[0].as_py()
                numbers = np.frombuffer(part.column("numbers")[0].as_py(), "<i4").astype(np.int64)
                block = Block.of(numbers.reshape(len(part.column("ids")[0]), width))
                columns = [
                    *part.columns,
                    pa.array([block.low.tolist()], pa.list_(pa.int64())),
                    pa.array([block.shift], pa.int32()),
                    pa.array([block.slices.tobytes()], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, [*part.schema.names, "low", "shift", "slices"])

    packed_rows = _packed_rows(rows, block_rows)
    return stored(
        packed_rows.mapInArrow(sliced, f"{_BLOCK}, low array<long>, shift int, slices binary"),
        "bit-sliced-index",
    )


_CHUNK = "chunk string, width int, query_ids array<long>, homes array<string>, places array<int>, weights binary"


def _chunks(queries: DataFrame, most: int) -> DataFrame:
    """Chunks of queries (id, home, place, width, numbers), by width; home and place name the
    row that a query is, if it is one."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        partition, made = TaskContext.get().partitionId(), 0

        def flushed(width: int) -> pa.RecordBatch:
            nonlocal made
            ids, homes, places, numbers = zip(*held.pop(width), strict=True)
            made += 1
            columns = [
                pa.array([f"{partition}-{made}"], pa.string()),
                pa.array([width], pa.int32()),
                pa.array([list(ids)], pa.list_(pa.int64())),
                pa.array([list(homes)], pa.list_(pa.string())),
                pa.array([list(places)], pa.list_(pa.int32())),
                pa.array([b"".join(numbers)], pa.binary()),
            ]
            names = ["chunk", "width", "query_ids", "homes", "places", "weights"]
            return pa.RecordBatch.from_arrays(columns, names)

        for part in parts:
            names = ("id", "home", "place", "width", "numbers")
            for id_, home, place, width, numbers in zip(
                *(part.column(name).to_pylist() for name in names), strict=True
            ):
                held.setdefault(width, []).append((id_, home, place, numbers))
                if len(held[width]) == most:
                    yield flushed(width)
        for width in list(held):
            yield flushed(width)

    return queries.mapInArrow(batches, _CHUNK)


def queries_of(index: DataFrame, divisor: int) -> DataFrame:
    """The indexed rows whose id the divisor divides: (id, home, place, width, numbers)."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for block, width, ids, numbers in zip(
                *(part.column(name) for name in ("block", "width", "ids", "numbers")), strict=True
            ):
                ids, width, data = ids.as_py(), width.as_py(), numbers.as_py()
                places = [at for at, id_ in enumerate(ids) if id_ is not None and id_ % divisor == 0]
                columns = [
                    pa.array([ids[at] for at in places], pa.int64()),
                    pa.array([block.as_py()] * len(places), pa.string()),
                    pa.array(places, pa.int32()),
                    pa.array([width] * len(places), pa.int32()),
                    pa.array([data[4 * width * at : 4 * width * (at + 1)] for at in places], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["id", "home", "place", "width", "numbers"])

    narrow = index.select("block", "width", "ids", "numbers")
    return narrow.mapInArrow(
        batches, "id long, home string, place int, width int, numbers binary"
    )


def _best(pairs: DataFrame, k: int) -> DataFrame:
    """(chunk, nth, query_id, id, score): each query's k best rows in each block it meets."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, searcher, block_ids, ranks = None, None, None, None
        for whole in parts:
            for at in range(len(whole)):
                row = {n: whole.column(n)[at] for n in whole.schema.names}
                width = row["width"].as_py()
                if row["block"].as_py() != name:
                    name = row["block"].as_py()
                    block_ids = row["ids"].as_py()
                    numbers = np.frombuffer(row["numbers"].as_py(), "<i4").astype(np.int64)
                    slices = np.frombuffer(row["slices"].as_py(), "<u8")
                    searcher = Searcher(
                        Block(
                            numbers.reshape(len(block_ids), width),
                            np.array(row["low"].as_py(), np.int64),
                            row["shift"].as_py(),
                            slices.reshape(width, SLICES, -1 if width else 0),
                        )
                    )
                    # Rows without an id come after all others of their score.
                    missing = np.array([i is None for i in block_ids], bool)
                    plain = np.array([i or 0 for i in block_ids], np.int64)
                    ranks = np.empty(len(plain), np.int64)
                    ranks[np.lexsort((plain, missing))] = np.arange(len(plain))
                query_ids, homes, places = (row[n].as_py() for n in ("query_ids", "homes", "places"))
                weights = np.frombuffer(row["weights"].as_py(), "<i4").astype(np.int64)
                weights = weights.reshape(len(query_ids), width)
                out: list[list] = [[], [], [], []]
                # One more, as the query's own row may be among them.
                for nth, rows in enumerate(searcher.candidates(weights, k + 1)):
                    if homes[nth] == name:
                        rows = rows[rows != places[nth]]
                    scores = searcher.block.numbers[rows] @ weights[nth]
                    order = np.lexsort((ranks[rows], -scores))[:k]
                    out[0].extend([nth] * len(order))
                    out[1].extend([query_ids[nth]] * len(order))
                    out[2].extend(block_ids[r] for r in rows[order].tolist())
                    out[3].extend(scores[order].tolist())
                types = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
                columns = [pa.array(c, t) for c, t in zip(out, types, strict=True)]
                chunk = pa.array([row["chunk"].as_py()] * len(out[0]), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [chunk, *columns], ["chunk", "nth", "query_id", "id", "score"]
                )

    return pairs.mapInArrow(batches, "chunk string, nth int, query_id long, id long, score long")


def _lanes(rows: float, columns: float) -> tuple[int, int]:
    """How many lanes to deal blocks and chunks to; beyond ``MOST_CELLS`` tasks, fewer and longer."""
    wider = max(1.0, math.sqrt(rows * columns / MOST_CELLS))
    return max(1, math.ceil(rows / wider)), max(1, math.ceil(columns / wider))


def _lane(name: str, lanes: int) -> Column:
    return F.pmod(F.xxhash64(name), F.lit(lanes)).cast("int")


def _every_lane(lanes: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(lanes - 1)))


def top_k(
    rows: DataFrame,
    divisor: int = 50,
    k: int = 5,
    scale: float = 256.0,
    block_rows: int = BLOCK_ROWS,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best rows for each query, exactly.

    Queries are the rows whose id the divisor divides; every row but a query's own is a
    candidate, rows that repeat its id or vector too. The score is the inner product of the
    components floor(scale * x). Equal scores go to the smaller id; rows without an id come
    last among equals and are no queries. Rows that repeat an id are queries of their own,
    with their own ranks. Vectors that are null or hold a null or non-finite component take
    no part; vectors of different lengths do not meet, and empty ones score 0. With
    fewer than k candidates all are returned; an empty table gives an empty result.
    Components that leave no room for a score in 64 bits raise an error. Columns besides the
    two named are not read.
    """
    good = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    good = good.filter(take_part(F.col("vector")))
    index = build(good.select("id", quantised(F.col("vector"), scale).alias("x")), block_rows)
    chunks = stored(_chunks(queries_of(index, divisor), CHUNK_QUERIES), "query-chunks")
    rows_of, columns_of = _lanes(index.count() / LANE_BLOCKS, chunks.count() / LANE_CHUNKS)
    keys = ["block_lane", "chunk_lane", "width"]
    cells = rows_of * columns_of
    blocks = index.withColumn("block_lane", _lane("block", rows_of)).withColumn(
        "chunk_lane", _every_lane(columns_of)
    )
    asked = chunks.withColumn("chunk_lane", _lane("chunk", columns_of)).withColumn(
        "block_lane", _every_lane(rows_of)
    )
    # Cells of the grid cost work, not bytes: their number sets the tasks, not their size.
    pairs = blocks.repartition(cells, *keys).join(
        asked.repartition(cells, *keys).hint("shuffle_hash"), keys
    )
    found = stored(_best(pairs.drop("block_lane", "chunk_lane"), k), "best-of-blocks")
    best = Window.partitionBy("chunk", "nth").orderBy(
        F.desc("score"), F.col("id").asc_nulls_last()
    )
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias("vec_id"), "score")
