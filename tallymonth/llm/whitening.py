"""Whitening of vectors through distributed block matrices.

Rows are centred exactly and packed into blocks of ``ROWS_A_BLOCK`` rows, each in the task that
reads them; a block has a number and each row a place in it. The blocks are stored as a table
of MLlib matrices and used twice:

* as one tall matrix, whose transpose times itself is the scatter matrix. Its row blocks are
  multiplied in many parts and the small products are added up;
* as a square grid of the same blocks, times a block-diagonal matrix that holds the whitening
  matrix once for each column of the grid. The result is the projected rows, block by block. A
  tall grid would be cut into as many tasks as the square root of its partitions only.

Between them the scatter matrix, of the vectors' width squared, is decomposed locally. Empty
places of a block are zero rows, which change neither sum nor product.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import MatrixUDT
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymonth.llm.common import stored
from tallymonth.scratch import new_directory

ROWS_A_BLOCK = 1024
BLOCKS_A_PART = 4

_DENSE = 1

# How a matrix column is laid out in a table, as MLlib's own type has it.
_MATRIX = (
    "struct<type:tinyint,numRows:int,numCols:int,colPtrs:array<int>,rowIndices:array<int>,"
    "values:array<double>,isTransposed:boolean>"
)


def finite(vector: Column) -> Column:
    """Neither null nor with a null, infinite or undefined component."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad, F.lit(False))


def quantised(vector: Column, scale: float = 1024.0, offset: int = 100_000) -> Column:
    """floor(scale * c) + offset of every component, c as double, as long."""
    return F.transform(
        vector, lambda c: F.floor(F.lit(scale) * c.cast("double")).cast("long") + F.lit(offset)
    )


def common_width(rows: DataFrame) -> int:
    """The most frequent length of ``x``; the longest of equally frequent ones, 0 if there is none."""
    widths = rows.groupBy(F.size("x").alias("width")).agg(F.count("*").alias("n"))
    first = widths.filter("width > 0").orderBy(F.desc("n"), F.desc("width")).first()
    return first["width"] if first else 0


def _numbers(part: pa.RecordBatch, width: int) -> np.ndarray:
    flat = part.column("x").flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.int64, copy=False).reshape(len(part), width)


def sums(rows: DataFrame, width: int) -> tuple[int, list[int]]:
    """The number of rows (id, x) and the exact sums of their dimensions."""

    def add(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(width, object)
        for part in parts:
            n += len(part)
            # A batch's sums fit 64 bits, those of many batches need not.
            total = total + _numbers(part, width).sum(axis=0).astype(object)
        columns = [
            pa.array([n] * width, pa.int64()),
            pa.array(range(width), pa.int32()),
            pa.array([str(s) for s in total], pa.string()),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["n", "dim", "total"])

    parts = rows.mapInArrow(add, "n long, dim int, total string")
    found = parts.groupBy("dim").agg(
        F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    )
    by_dim = sorted(found.collect(), key=lambda row: row["dim"])
    return by_dim[0]["n"] if by_dim else 0, [int(row["total"]) for row in by_dim]


def _squares(differences: np.ndarray) -> list[int]:
    """The exact sum of squares of each row, as whole numbers of any size."""
    # Limbs of 24 bits: their products leave room for the sums over many dimensions.
    limbs = [differences >> 48, differences >> 24 & 0xFFFFFF, differences & 0xFFFFFF]
    rows = [0] * len(differences)
    for i, a in enumerate(limbs):
        for j, b in enumerate(limbs):
            up = 24 * (4 - i - j)
            rows = [r + (p << up) for r, p in zip(rows, (a * b).sum(axis=1).tolist(), strict=True)]
    return rows


def _packed(rows: DataFrame, size: int, width: int, n: int, total: list[int]) -> DataFrame:
    """(part, nth, ids, deviations, centred): the rows of each partition in blocks."""
    kind = rows.schema["id"].dataType.simpleString()

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition, made, s = TaskContext.get().partitionId(), 0, np.array(total, np.int64)
        ids: list = []
        held: list[np.ndarray] = []
        id_type = None

        def flushed(count: int) -> pa.RecordBatch:
            nonlocal made, ids, held
            every = np.concatenate(held)
            differences = n * every[:count] - s
            block = np.zeros((size, width))
            block[:count] = differences / n
            deviations = [str(d) for d in _squares(differences)]
            columns = [
                pa.array([partition], pa.int32()),
                pa.array([made], pa.int32()),
                pa.array([ids[:count]], pa.list_(id_type)),
                pa.array([deviations], pa.list_(pa.string())),
                # Column after column, as MLlib's matrices are.
                pa.array([block.T.ravel()], pa.list_(pa.float64())),
            ]
            made += 1
            ids, held = ids[count:], [every[count:]]
            return pa.RecordBatch.from_arrays(columns, ["part", "nth", "ids", "deviations", "centred"])

        for part in parts:
            if not len(part):
                continue
            id_type = part.column("id").type
            ids.extend(part.column("id").to_pylist())
            held.append(_numbers(part, width))
            while len(ids) >= size:
                yield flushed(size)
        if ids:
            yield flushed(len(ids))

    schema = f"part int, nth int, ids array<{kind}>, deviations array<string>, centred array<double>"
    return rows.mapInArrow(batches, schema)


def _matrix_column(values: Column, rows: int, columns: int) -> Column:
    """A dense matrix from its values, column after column, in MLlib's layout."""
    none = F.lit(None).cast("array<int>")
    fields = [F.lit(_DENSE), F.lit(rows), F.lit(columns), none, none, values, F.lit(False)]
    return F.struct(*fields).cast(_MATRIX)


def _block_table(
    blocks: DataFrame, row: Column, column: Column, shape: tuple[int, int], purpose: str
) -> DataFrame:
    """Blocks (centred) as MLlib reads them: (blockIndex, subMatrix), stored."""
    spark = blocks.sparkSession
    path = new_directory(spark, purpose)
    index = F.struct(row.cast("long").alias("_1"), column.cast("long").alias("_2"))
    blocks.select(
        index.alias("blockIndex"),
        _matrix_column(F.col("centred"), *shape).alias("subMatrix"),
    ).write.parquet(path)
    return _matrices(spark, path)


def _matrices(spark: SparkSession, path: str) -> DataFrame:
    index = T.StructType([T.StructField("_1", T.LongType()), T.StructField("_2", T.LongType())])
    schema = T.StructType([T.StructField("blockIndex", index), T.StructField("subMatrix", MatrixUDT())])
    return spark.read.schema(schema).parquet(path)


def _block_matrix(table: DataFrame, row_size: int, column_size: int, shape: tuple[int, int]) -> BlockMatrix:
    made = callMLlibFunc("createBlockMatrix", table, row_size, column_size, *shape)
    return BlockMatrix(made, row_size, column_size)


def _multiplied(left: BlockMatrix, right: BlockMatrix, parts: int) -> BlockMatrix:
    """The product, its middle dimension cut into ``parts`` that are multiplied apart.

    The Python class has no such argument and would gather a tall matrix in one task.
    """
    other = right._java_matrix_wrapper._java_model
    product = left._java_matrix_wrapper.call("multiply", other, parts)
    return BlockMatrix(product, left.rowsPerBlock, right.colsPerBlock)


def scatter(blocks: DataFrame, size: int, width: int, most: int, count: int) -> np.ndarray:
    """The sum of each centred row's products with itself; ``count`` blocks, numbered below ``most``."""
    table = _block_table(blocks, F.col("number"), F.lit(0), (size, width), "tall-blocks")
    tall = _block_matrix(table, size, width, (most * size, width))
    parts = max(1, count // BLOCKS_A_PART)
    return _multiplied(tall.transpose(), tall, parts).toLocalMatrix().toArray()


def projected(blocks: DataFrame, size: int, matrix: np.ndarray, most: int) -> DataFrame:
    """(number, values): every block times the matrix, column after column."""
    spark, (width, columns) = blocks.sparkSession, matrix.shape
    side = math.isqrt(most - 1) + 1
    row, column = F.floor(F.col("number") / side), F.col("number") % side
    grid = _block_table(blocks, row, column, (size, width), "grid-blocks")
    high = -(-most // side)
    left = _block_matrix(grid, size, width, (high * size, side * width))
    values = F.array(*[F.lit(float(v)) for v in matrix.T.ravel()])
    path = new_directory(spark, "whitening-matrix")
    spark.range(side).select(
        F.struct(F.col("id").alias("_1"), F.col("id").alias("_2")).alias("blockIndex"),
        _matrix_column(values, width, columns).alias("subMatrix"),
    ).write.parquet(path)
    right = _block_matrix(_matrices(spark, path), width, columns, (side * width, side * columns))
    product = _multiplied(left, right, 1)._java_matrix_wrapper._java_model
    path = new_directory(spark, "projected-blocks")
    callMLlibFunc("getMatrixBlocks", product).write.parquet(path)
    back = spark.read.schema(f"_1 struct<_1:int,_2:int>, _2 {_MATRIX}").parquet(path)
    number = F.col("_1._1").cast("long") * side + F.col("_1._2")
    return back.select(number.alias("number"), F.col("_2.values").alias("values"))


def whitening_matrix(covariance: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """(width x components matrix, eigenvalues by size) of a covariance.

    A component without variance, but for rounding, has a column of zeros.
    """
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    values, vectors = values[::-1], vectors[:, ::-1]
    values = np.maximum(values, 0)
    least = values[0] * len(values) * np.finfo(float).eps * 4
    spread = np.where(values > least, values, np.inf)[:components]
    return vectors[:, :components] / np.sqrt(spread), values


def _whitened_sums(whitened: DataFrame, columns: int, mean: np.ndarray | None = None) -> np.ndarray:
    """The sums of the components of all rows or, given their mean, their scatter around it."""
    shape = (columns,) if mean is None else (columns, columns)

    def add(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for part in parts:
            rows = _rows_of(part, columns)
            for block in rows:
                total += block.sum(axis=0) if mean is None else (block - mean).T @ (block - mean)
        flat = total.ravel()
        yield pa.RecordBatch.from_pydict({"place": np.arange(len(flat)), "total": flat})

    found = whitened.mapInArrow(add, "place long, total double").groupBy("place").agg(F.sum("total"))
    out = np.zeros(int(np.prod(shape)))
    for place, total in found.collect():
        out[place] = total
    return out.reshape(shape)


def _rows_of(part: pa.RecordBatch, columns: int) -> Iterator[np.ndarray]:
    """The rows (count x components) that each block of a batch really holds."""
    for ids, values in zip(part.column("ids"), part.column("values"), strict=True):
        block = np.asarray(values.values).reshape(columns, -1).T
        yield block[: len(ids)]


def whiten(
    rows: DataFrame, components: int = 8, rows_a_block: int = ROWS_A_BLOCK
) -> DataFrame:
    """Of (id, x), x whole numbers: id, component (from 1), n, deviation, whitened, explained,
    identity_error; a row for each row and component.

    All rows are the fit list. ``deviation`` is the exact sum over the dimensions of
    (n * x - sum)^2. ``whitened`` is the centred row, projected on a unit eigenvector of the
    covariance (divisor n) and divided by the root of its eigenvalue; components are
    numbered by falling eigenvalue, up to the width of the vectors. ``explained`` is the
    eigenvalue's share of the trace; ``identity_error`` the largest difference of the whitened
    rows' covariance from the identity, over the components that vary.

    A component without any variance has whitened 0 and explained 0. Rows with null ids
    and repeated rows count like any other. Rows that are not of the most frequent width
    (the longest of equally frequent ones) are left out, and so are empty vectors. An
    empty table gives an empty result. Columns besides the two are not read.
    """
    spark, kind = rows.sparkSession, rows.schema["id"].dataType.simpleString()
    schema = (
        f"id {kind}, component int, n long, deviation decimal(38,0), whitened double, "
        "explained double, identity_error double"
    )
    rows = stored(rows.select("id", "x").filter("x is not null"), "vectors")
    width = common_width(rows)
    if not width:
        return spark.createDataFrame([], schema)
    rows = rows.filter(F.size("x") == width)
    n, total = sums(rows, width)
    blocks = stored(_packed(rows, rows_a_block, width, n, total), "blocks")
    bound = blocks.agg(F.max("part").alias("part"), F.max("nth").alias("nth"), F.count("*").alias("count")).first()
    each = bound["nth"] + 1
    most = (bound["part"] + 1) * each
    blocks = blocks.withColumn("number", F.col("part").cast("long") * each + F.col("nth"))

    covariance = scatter(blocks, rows_a_block, width, most, bound["count"]) / n
    matrix, values = whitening_matrix(covariance, components)
    columns = matrix.shape[1]
    held = blocks.select("number", "ids", "deviations")
    whitened = stored(held.join(projected(blocks, rows_a_block, matrix, most), "number"), "whitened")
    mean = _whitened_sums(whitened, columns) / n
    varies = (matrix != 0).any(axis=0)
    difference = _whitened_sums(whitened, columns, mean) / n - np.diag(varies.astype(float))
    error = float(np.abs(difference).max(initial=0))
    trace = values.sum()
    explained = (values[:columns] * varies / trace if trace else np.zeros(columns)).tolist()

    def unpacked(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in parts:
            for at in range(len(whole)):
                part = whole.slice(at, 1)
                (block,) = _rows_of(part, columns)
                place = np.repeat(np.arange(len(block)), columns)
                out = [
                    part.column("ids").flatten().take(pa.array(place)),
                    pa.array(np.tile(np.arange(1, columns + 1, dtype=np.int32), len(block))),
                    part.column("deviations").flatten().take(pa.array(place)),
                    pa.array(block.ravel()),
                ]
                yield pa.RecordBatch.from_arrays(out, ["id", "component", "deviation", "whitened"])

    found = whitened.mapInArrow(
        unpacked, f"id {kind}, component int, deviation string, whitened double"
    )
    shares = F.array(*map(F.lit, explained))
    return found.select(
        "id",
        "component",
        F.lit(n).cast("long").alias("n"),
        F.col("deviation").cast("decimal(38,0)").alias("deviation"),
        "whitened",
        F.element_at(shares, F.col("component")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
