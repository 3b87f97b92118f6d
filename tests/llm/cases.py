"""Documents with every awkward property the operators promise to bear."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"

LONG = ("the onere of thand " * 70_000) + "end"

ROWS = [
    (1, "The cat sat on the mat and the dog", "en", "a", 34),
    (2, "The cat sat on the mat and the dog", "en", "a", 34),
    (2, "The cat sat on the mat and the dog", "en", "a", 34),
    (3, "the CAT sat on the mat and the dog", "en", "b", 34),
    (4, "", "en", "b", 0),
    (5, None, "en", None, None),
    (6, "   \t\n ", None, "b", 6),
    (7, "12345 !!! 678", "en", "c", 13),
    (8, "Der Hund schläft über dem Ofen <|endoftext|>", "de", "c", 40),
    (9, "Über die Brücke geht der Hund Σίσυφος", "de", "c", 40),
    (10, LONG, "en", "c", len(LONG)),
    (11, "word", None, None, 4),
    (None, "a text without an id", "en", "a", 20),
    (None, "a text without an id", "en", "a", 20),
    (12, "x" * 5000, "en", "", 5000),
]

# Names that the operators use for columns of their own.
CLASHES = ["hash", "key", "row", "score", "kept", "component_id", "size", "target", "h", "word"]


def documents(spark: SparkSession, rows: list = ROWS) -> DataFrame:
    return spark.createDataFrame(rows, COLUMNS)


def with_clashes(docs: DataFrame) -> DataFrame:
    from pyspark.sql import functions as F

    return docs.select("*", *[F.lit(name).alias(name) for name in CLASHES])
