"""The monthly report of a stream of transaction files.

Every micro-batch is summed to a few totals per group and category id, which are the stream's
state: a table with a part for each batch and month. Then the months that the batch has
touched are put together anew from their totals and replace the files of these months. So
rows may come in any order and any number of batches, however late: the report always
equals that of a batch run over all files so far.

Event time decides when a month is closed: the latest date of the batches before, less the
lateness that is allowed for, has passed the month's end. Rows for a closed month are taken all the
same, but noted as corrections, so that readers of a closed month learn that it has changed.
Spark's own watermark would drop them, which a report of record cannot do; the state
does not need it either, as it holds totals, not transactions.

A batch that is run again, after a restart from the checkpoint, writes the same parts once
more in the place of the first ones: nothing is counted twice. Every ``compact_every`` batches
all parts are merged into one generation, and older parts are removed after that.
"""

from __future__ import annotations

import datetime
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallymonth.operators import dimensions
from tallymonth.operators.totals import merged_totals
from tallymonth.plans.report import as_report, classified, with_merchant_category
from tallymonth.profiles import AS_IMPLEMENTED, RuleProfile
from tallymonth.schemas import GROUP_KEYS, ID_KEYS, TRANSACTIONS
from tallymonth.sinks.files import write_monthly_files

STATE = (
    "service_system_type STRING, transaction_type STRING, merchant_business_type STRING, "
    "merchant_category_id STRING, amount DECIMAL(38,6), number BIGINT, records BIGINT, latest DATE"
)
CORRECTIONS = "date DATE, records BIGINT, amount DECIMAL(38,6), closed_before DATE"
STATE_KEYS = [*ID_KEYS, "merchant_category_id"]


def read_transaction_stream(
    spark: SparkSession, path: str, files_a_batch: int | None = None
) -> DataFrame:
    """Transactions from the CSV files of a directory, those that are there and those that come.

    All files have a header with the transaction columns in their order. A malformed value is
    null. Files must appear whole, as a rename makes them.
    """
    reader = spark.readStream.schema(TRANSACTIONS).option("header", True)
    reader = reader.option("enforceSchema", False)
    if files_a_batch:
        reader = reader.option("maxFilesPerTrigger", files_a_batch)
    return reader.csv(path)


@dataclass(frozen=True)
class MonthlyReportSink:
    """What is done with each micro-batch; pass it to ``foreachBatch``.

    ``state`` and ``output`` are folders that all executors share. ``categories`` are read for
    every batch; a month keeps the codes it was last put together with.
    """

    categories: DataFrame
    output: str
    state: str
    profile: RuleProfile = AS_IMPLEMENTED
    lateness: datetime.timedelta = datetime.timedelta(days=31)
    compact_every: int = 50

    def __call__(self, rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        part = f"{self.state}/totals/generation={self._generation(spark, batch)}/batch={batch}"
        self._totals(rows).write.mode("overwrite").partitionBy("date").parquet(part)
        months = [row["date"] for row in self._read(spark, batch, only=batch).select("date").distinct().collect()]
        self._note_corrections(spark, batch)
        if months:
            changed = F.col("date").isin([m for m in months if m]) | (
                F.col("date").isNull() if None in months else F.lit(False)
            )
            self._replace(self._read(spark, batch).filter(changed))
        if (batch + 1) % self.compact_every == 0:
            self._compact(spark, batch)

    def _totals(self, rows: DataFrame) -> DataFrame:
        classes = classified(rows, self.profile, {"day": F.col("date")})
        counted = F.count("*") if self.profile.counts_missing_amounts else F.count("amount")
        return classes.groupBy(*STATE_KEYS).agg(
            F.sum("amount").cast("decimal(38,6)").alias("amount"),
            counted.alias("number"),
            F.count("*").alias("records"),
            F.max("day").alias("latest"),
        )

    def _replace(self, parts: DataFrame) -> None:
        """The files of the months in ``parts``, each renamed over the one before."""
        summed = merged_totals(parts, STATE_KEYS)
        if dimensions.fits_broadcast(self.categories):
            coded = dimensions.with_category_code_broadcast(summed, self.categories)
        else:
            coded = dimensions.join_category_code(summed, self.categories.hint("merge"))
        grouped = merged_totals(with_merchant_category(coded, self.profile), GROUP_KEYS)
        write_monthly_files(as_report(grouped, self.profile), self.output, self.profile)

    def _note_corrections(self, spark: SparkSession, batch: int) -> None:
        """Record what a batch brings for months that were closed before it."""
        before = self._read(spark, batch - 1).agg(F.max("latest").alias("latest")).first()["latest"]
        if before is None:
            return
        closed = before - self.lateness
        late = (
            self._read(spark, batch, only=batch)
            .filter(F.col("date") < F.lit(closed))
            .groupBy("date")
            .agg(F.sum("records").alias("records"), F.sum("amount").cast("decimal(38,6)").alias("amount"))
            .withColumn("closed_before", F.lit(closed))
        )
        late.write.mode("overwrite").parquet(f"{self.state}/corrections/batch={batch}")

    # The state's parts

    def _files(self, spark: SparkSession):
        hadoop = spark.sparkContext._jvm.org.apache.hadoop
        root = hadoop.fs.Path(self.state)
        return hadoop, root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _generation(self, spark: SparkSession, batch: int) -> int:
        """The newest generation that was made before a batch and is complete; 0 is the first.

        Generation g holds, as its batch -1, the totals of all batches below g.
        """
        hadoop, files = self._files(spark)
        marks = files.globStatus(hadoop.fs.Path(f"{self.state}/totals/generation=*/batch=-1/_SUCCESS")) or []
        numbers = [int(mark.getPath().getParent().getParent().getName().partition("=")[2]) for mark in marks]
        return max((number for number in numbers if number <= batch), default=0)

    def _read(self, spark: SparkSession, batch: int, only: int | None = None) -> DataFrame:
        """The totals of all batches up to one, or of a single one, with their month."""
        generation = self._generation(spark, max(batch, 0) if only is None else only)
        path = f"{self.state}/totals/generation={generation}"
        hadoop, files = self._files(spark)
        schema = f"{STATE}, batch INT, date DATE"
        if not files.exists(hadoop.fs.Path(path)):
            return spark.createDataFrame([], schema)
        rows = spark.read.schema(schema).option("basePath", path).parquet(path)
        return rows.filter(F.col("batch") == only if only is not None else F.col("batch") <= batch)

    def _compact(self, spark: SparkSession, batch: int) -> None:
        """Start the next generation: one part with the sums of all before, then remove those."""
        merged = self._read(spark, batch).groupBy(*STATE_KEYS).agg(
            F.sum("amount").cast("decimal(38,6)").alias("amount"),
            F.sum("number").alias("number"),
            F.sum("records").alias("records"),
            F.max("latest").alias("latest"),
        )
        old = self._generation(spark, batch)
        target = f"{self.state}/totals/generation={batch + 1}/batch=-1"
        merged.write.mode("overwrite").partitionBy("date").parquet(target)
        hadoop, files = self._files(spark)
        # The generation before the last stays: the last batch may have to be run again.
        for status in files.globStatus(hadoop.fs.Path(f"{self.state}/totals/generation=*")) or []:
            if int(status.getPath().getName().partition("=")[2]) < old:
                files.delete(status.getPath(), True)

    def corrections(self, spark: SparkSession) -> DataFrame:
        """batch, date (the closed month), records, amount and the day before which months were
        closed then: what has come for closed months."""
        path = f"{self.state}/corrections"
        hadoop, files = self._files(spark)
        schema = f"{CORRECTIONS}, batch INT"
        if not files.exists(hadoop.fs.Path(path)):
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).option("basePath", path).parquet(path)


def start_monthly_report(
    transactions: DataFrame, sink: MonthlyReportSink, checkpoint: str, once: bool = False
) -> StreamingQuery:
    """Keep the monthly files up to date with a stream of transactions.

    With ``once`` the query ends when all that is there has been taken. A query started again
    with the same checkpoint, state and output goes on where the last one ended.
    """
    writer = transactions.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
