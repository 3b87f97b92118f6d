"""Helpers that several operators share: inputs, stored tables, folds, words."""

from __future__ import annotations

import os
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymonth.scratch import new_directory

# Words as the contracts define them; bytes.split() cuts at the same six characters.
WORD = r"[^\x20\x09-\x0D]+"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _let_workers_import(spark: SparkSession) -> None:
    """Name the folder of this package to the Python workers, where it is a plain folder.

    A driver may have put it on its own path alone; clusters get it by --py-files.
    """
    folder = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    paths = [path for path in environment.get("PYTHONPATH", "").split(os.pathsep) if path]
    if os.path.isdir(folder) and folder not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, folder])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    _let_workers_import(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) alone, so that other columns cannot clash; a null text is empty."""
    return docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """The frame written to the shared folder and read back.

    Cuts the lineage: executors lost later cost a read, not a recomputation.
    """
    spark = frame.sparkSession
    path = new_directory(spark, purpose)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def in_fold(id_col: str, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves the remainder; a null id does not."""
    crc = F.crc32(F.col(id_col).cast("string"))
    return F.coalesce(F.pmod(crc, F.lit(modulus)) == remainder, F.lit(False))


def word_lists(text: str, chunk_bytes: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of a text in order, A-Z lower-cased, a bounded list at a time.

    A list covers about ``chunk_bytes`` of the text and never cuts a word, so the
    words of a very long text are never all in memory at once.
    """
    data = text.encode().lower()
    if len(data) <= chunk_bytes:
        yield data.split()
        return
    start = 0
    while start < len(data):
        end = start + chunk_bytes
        while end < len(data) and data[end] not in b" \t\n\r\x0b\x0c":
            end += 1
        yield data[start:end].split()
        start = end
