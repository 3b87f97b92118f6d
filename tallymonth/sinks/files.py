"""Writers of the report.

All of them write from the tasks. Only file names pass through the driver.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymonth.functions import rules
from tallymonth.profiles import AS_IMPLEMENTED, RuleProfile
from tallymonth.schemas import REPORT

FILE_COLUMN = "report_file"

# The prescribed form of the monthly files.
SEPARATOR = "|"
LINE_END = "\r\n"

# Nulls and empty strings both print as nothing.
MONTHLY_FORMAT = {
    "sep": SEPARATOR,
    "lineSep": LINE_END,
    "header": "true",
    "nullValue": "",
    "emptyValue": "",
    # Values are written as they are; a quote inside a quoted value is doubled.
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "escape": '"',
}


def write_month_partitions(
    report: DataFrame, path: str, profile: RuleProfile = AS_IMPLEMENTED
) -> None:
    """One directory per report date, each with a single part file.

    Rows are shuffled by file name, so one task writes each date's file; this
    moves group totals, not transactions. The number of tasks is given, or
    adaptive execution would merge small months into one task that writes them
    in turn. A report limited to a date later reads its directory only. Replaces
    what ``path`` holds.
    """
    tasks = int(report.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    stem = rules.report_file_stem(F.to_date("date"))
    printed = rules.amount_text(profile, F.col("amount"))
    (
        report.withColumns({"amount": printed, FILE_COLUMN: stem})
        .repartition(tasks, FILE_COLUMN)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .option("maxRecordsPerFile", 0)
        .partitionBy(FILE_COLUMN)
        .options(**MONTHLY_FORMAT)
        .csv(path)
    )


def write_monthly_files(
    report: DataFrame, path: str, profile: RuleProfile = AS_IMPLEMENTED
) -> list[str]:
    """One file per report date, named after it, directly in ``path``.

    The tasks write to a staging directory beside the files. Each file is then
    renamed over an earlier one of that date, which stays until then. Files of
    other dates stay. Returns the file names.
    """
    spark = report.sparkSession
    staging = f"{path.rstrip('/')}/_staging-{uuid.uuid4().hex}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop
    staging_dir = hadoop.fs.Path(staging)
    files = staging_dir.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    try:
        write_month_partitions(report, staging, profile)
        parts = files.globStatus(hadoop.fs.Path(f"{staging}/{FILE_COLUMN}=*/part-*")) or []
        sources = [part.getPath() for part in parts]
        names = [
            source.getParent().getName().removeprefix(f"{FILE_COLUMN}=") + ".csv"
            for source in sources
        ]
        if len(set(names)) < len(names):
            raise OSError(f"{staging} holds more than one part for a month: {sorted(names)}")
        context = hadoop.fs.FileContext.getFileContext(
            files.getUri(), spark.sparkContext._jsc.hadoopConfiguration()
        )
        replace = spark.sparkContext._gateway.new_array(hadoop.fs.Options.Rename, 1)
        replace[0] = hadoop.fs.Options.Rename.OVERWRITE
        for source, name in zip(sources, names, strict=True):
            context.rename(source, files.makeQualified(hadoop.fs.Path(path, name)), replace)
    finally:
        files.delete(staging_dir, True)
    return sorted(names)


def read_monthly_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """A report written by either monthly writer. Empty fields read as null."""
    names = ("sep", "header", "escape", "ignoreLeadingWhiteSpace", "ignoreTrailingWhiteSpace")
    options = {name: MONTHLY_FORMAT[name] for name in names}
    return spark.read.schema(REPORT).options(**options).csv(path).select(*REPORT.fieldNames())


def write_plain_csv(report: DataFrame, path: str) -> None:
    """A plain CSV directory: commas, no header. Fails if ``path`` exists."""
    report.write.mode("errorifexists").csv(path)


def read_plain_csv(spark: SparkSession, path: str) -> DataFrame:
    """A report written by :func:`write_plain_csv`."""
    return spark.read.schema(REPORT).csv(path)
