"""The physical plans: joins, shuffles, pruning, and how hot keys spread."""

from __future__ import annotations

import datetime
import re
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallymonth import AS_IMPLEMENTED, AS_SPECIFIED, monthly_report, report_for_month, report_months
from tallymonth.operators import dimensions
from tallymonth.queries import fixture
from tallymonth.queries.registry import QUERIES
from tests.helpers import categories_of, plan_of, settings, transactions_of
from tests.model import Category, Transaction

PROFILES = [AS_IMPLEMENTED, AS_SPECIFIED]

# The JVM does not compile larger methods, and interprets them instead.
LARGEST_COMPILED_METHOD = 8000


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Transactions and categories as parquet tables."""
    base = tmp_path_factory.mktemp("stored")
    rows = [
        Transaction(date=datetime.date(2018, month, 5), merchant_category_id=month)
        for month in range(1, 13)
    ]
    transactions_of(spark, rows).withColumn("note", F.lit("unused")).write.parquet(f"{base}/tx")
    categories_of(spark, [Category(1, "0742")]).write.parquet(f"{base}/mcc")
    return spark.read.parquet(f"{base}/tx"), spark.read.parquet(f"{base}/mcc")


def shuffles(plan: str) -> int:
    return len(re.findall(r"^\(\d+\) Exchange", plan, re.MULTILINE))


@pytest.mark.parametrize("profile", PROFILES, ids=lambda p: p.name)
def test_report_takes_one_shuffle_and_two_broadcasts(stored, profile) -> None:
    plan = plan_of(monthly_report(*stored, profile, small_categories=True))
    assert shuffles(plan) == 1
    assert len(re.findall(r"^\(\d+\) BroadcastHashJoin", plan, re.MULTILINE)) == 2
    assert "SortMergeJoin" not in plan
    assert "partial_sum(amount" in plan
    assert "Python" not in plan


def test_only_used_columns_are_read(stored) -> None:
    plan = plan_of(monthly_report(*stored, AS_IMPLEMENTED, small_categories=True))
    (schema,) = re.findall(r"ReadSchema: struct<(date:[^>]*)>", plan)
    read = {column.split(":")[0] for column in schema.split(",")}
    # What only the other profile needs is not read.
    assert read == set(Transaction._fields) - {"backend_name"} | {"6)"}
    assert "ReadSchema: struct<date:date>" in plan_of(report_months(stored[0]))


def test_one_month_is_filtered_in_the_scan(stored) -> None:
    plan = plan_of(report_for_month(*stored, datetime.date(2018, 2, 28)))
    assert "GreaterThanOrEqual(date,2018-02-01)" in plan
    assert "LessThanOrEqual(date,2018-02-28)" in plan


def test_large_categories_are_never_broadcast(spark, stored) -> None:
    transactions, categories = stored
    with settings(spark, autoBroadcastJoinThreshold="-1"):
        plan = plan_of(monthly_report(transactions, categories, small_categories=False))
    # Only the sixteen fixed rows are broadcast; transactions are summed first.
    assert len(re.findall(r"^\(\d+\) BroadcastExchange", plan, re.MULTILINE)) == 1
    (number,) = re.findall(r"^\((\d+)\) SortMergeJoin", plan, re.MULTILINE)
    summed = [int(n) for n in re.findall(r"^\((\d+)\) HashAggregate", plan, re.MULTILINE)]
    assert min(summed) < int(number)
    assert "Keys [5]: [date" in plan


def test_planning_runs_no_job(spark, stored) -> None:
    context = spark.sparkContext
    context.setJobGroup("planning", "nothing should run")
    for small in (True, False):
        monthly_report(*stored, AS_SPECIFIED, small_categories=small)
        dimensions.with_category_code(*stored, small_categories=small)
    assert list(context.statusTracker().getJobIdsForGroup("planning")) == []
    stored[0].count()
    assert len(context.statusTracker().getJobIdsForGroup("planning")) > 0
    context.setLocalProperty("spark.jobGroup.id", None)


def test_size_check_counts_rows_and_text(spark) -> None:
    categories = categories_of(spark, [Category(n, "0742") for n in range(10)])
    size = 10 * (dimensions.ROW_OVERHEAD_BYTES + 1 + 4)
    assert dimensions.fits_broadcast(categories, size)
    assert not dimensions.fits_broadcast(categories, size - 1)
    assert dimensions.fits_broadcast(categories.limit(0), 0)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_stay_compiled_and_out_of_python(spark, sf_dir, name) -> None:
    with settings(spark, adaptive_enabled="false"):
        frame = QUERIES[name](spark, sf_dir)
        code = plan_of(frame, "codegen")
        plan = plan_of(frame)
    sizes = [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert max(sizes, default=0) < LARGEST_COMPILED_METHOD
    assert "Python" not in plan and "Pandas" not in plan
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_hot_and_missing_categories_are_spread(spark) -> None:
    """A third of the rows in one category and a third in none."""
    third = 3000
    # Hot rows stay in the tasks that read them: as many as the shuffle has.
    rows = spark.range(0, 3 * third, 1, 16).select(
        F.lit(datetime.date(2018, 12, 3)).alias("date"),
        F.col("id").cast("decimal(18,2)").alias("amount"),
        F.lit("payment01").alias("payment_method"),
        F.when(F.col("id") < third, F.lit(1))
        .when(F.col("id") < 2 * third, F.lit(None))
        .otherwise(F.col("id"))
        .cast("int")
        .alias("merchant_category_id"),
    )
    categories = spark.range(3 * third).select(
        F.col("id").cast("int").alias("id"), F.lpad(F.col("id").cast("string"), 4, "0").alias("code")
    )
    with settings(
        spark, autoBroadcastJoinThreshold="-1", adaptive_enabled="false", shuffle_partitions="16"
    ):
        assert dimensions.hot_category_ids(rows, third - 1).collect() == [("1",)]
        joined = dimensions.with_category_code_shuffled(rows, categories, third - 1)
        per_task = joined.groupBy(F.spark_partition_id()).count().collect()
        plain = dimensions.join_category_code(rows, categories)
        plain_per_task = plain.groupBy(F.spark_partition_id()).count().collect()
        same = joined.exceptAll(plain).isEmpty() and plain.exceptAll(joined).isEmpty()
    assert same
    assert max(row["count"] for row in plain_per_task) > third
    assert max(row["count"] for row in per_task) < 3 * third / 16 * 2


@pytest.mark.parametrize(("hot_rows", "most"), [(0, 99), (19, 99), (19, 1), (1000, 99)])
def test_spread_lookup_equals_the_plain_join(spark, hot_rows, most) -> None:
    """With hot, rare, missing, unmatched and repeated ids."""
    ids = [1] * 40 + [2] * 20 + [3, 4, 5, 99] + [None] * 30
    rows = transactions_of(
        spark,
        [Transaction(amount=Decimal(n), merchant_category_id=key) for n, key in enumerate(ids)],
    )
    categories = categories_of(
        spark,
        [
            Category(1, "0001"),
            Category(1, "1111"),
            Category(2, "0002"),
            Category(3, None),
            Category(4, "0004"),
            Category(4, "0004"),
            Category(None, "5555"),
            Category(77, "0077"),
        ],
    )
    spread = dimensions.with_category_code_shuffled(rows, categories, hot_rows, most).collect()
    plain = dimensions.join_category_code(rows, categories).collect()
    assert Counter(map(tuple, spread)) == Counter(map(tuple, plain))
    assert len(spread) == len(ids) + 40 + 1


def test_equal_rows_of_one_category_are_no_single_task(spark) -> None:
    rows = spark.range(0, 20_000, 1, 20).selectExpr("1 AS merchant_category_id", "'x' AS same")
    with settings(spark, autoBroadcastJoinThreshold="-1", adaptive_enabled="false"):
        joined = dimensions.with_category_code_shuffled(
            rows, categories_of(spark, [Category(1, "0001")]), hot_rows=1000
        )
        per_task = joined.groupBy(F.spark_partition_id()).count().collect()
    assert max(row["count"] for row in per_task) <= 3 * 20_000 / 20


@pytest.mark.parametrize("name", ["report_with_large_categories", "merchant_category_code_shuffled"])
def test_registered_shuffled_lookups_are_no_broadcasts(spark, sf_dir, name) -> None:
    assert "SortMergeJoin" in plan_of(QUERIES[name](spark, sf_dir))


def test_a_hot_line_item_key_is_split_when_tables_are_derived(spark, tmp_path) -> None:
    """Half of the line items share one part and one order."""
    spark.range(0, 40_000, 1, 8).selectExpr(
        "IF(id % 2 = 0, 0, id) AS l_orderkey",
        "IF(id % 2 = 0, 0, id) AS l_partkey",
        "id AS l_suppkey",
        "CAST(id % 7 + 1 AS INT) AS l_linenumber",
        "CAST(id AS DOUBLE) AS l_quantity",
        "CAST(id AS DOUBLE) AS l_extendedprice",
        "'A' AS l_returnflag",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    keys = spark.range(0, 40_000, 1, 8)
    keys.selectExpr(
        "id AS o_orderkey",
        "id AS o_custkey",
        "TIMESTAMP_NTZ '1998-01-01 00:00:00' AS o_orderdate",
        "'1-URGENT' AS o_orderpriority",
    ).write.parquet(f"{tmp_path}/orders.parquet")
    keys.selectExpr("id AS c_custkey", "1 AS c_nationkey").write.parquet(
        f"{tmp_path}/customer.parquet"
    )
    keys.selectExpr(
        "id AS p_partkey", "CAST(id % 50 AS INT) AS p_size", "10.0D AS p_retailprice"
    ).write.parquet(f"{tmp_path}/part.parquet")

    with settings(
        spark,
        autoBroadcastJoinThreshold="-1",
        adaptive_advisoryPartitionSizeInBytes="20KB",
        adaptive_skewJoin_skewedPartitionThresholdInBytes="40KB",
        adaptive_skewJoin_skewedPartitionFactor="2",
    ):
        rows = fixture.transactions(spark, str(tmp_path)).groupBy("payment_method").count()
        assert rows.collect() == [("payment01", 40_000)]
        assert plan_of(rows).count("SortMergeJoin(skew=true)") >= 2


def test_a_hot_group_is_summed_before_the_shuffle(spark) -> None:
    def field(value):
        """A value the planner cannot fold away."""
        return F.when(F.col("id") >= 0, F.lit(value))

    group = Transaction()
    rows = spark.range(0, 100_000, 1, 10).select(
        *[field(value).alias(name) for name, value in group._asdict().items()]
    )
    rows = rows.withColumn("amount", F.lit(Decimal("0.01")).cast("decimal(18,2)"))
    for small in (True, False):
        report = monthly_report(
            rows, categories_of(spark, [Category()]), small_categories=small
        )
        plan = plan_of(report)
        assert plan.index("partial_sum") < plan.index("Arguments: hashpartitioning(date")
        (row,) = report.collect()
        assert (row["amount"], row["number"]) == (Decimal("1000.00"), 100_000)


@pytest.mark.parametrize("most_codes", [0, 3, 10_000])
def test_hot_ids_with_many_codes_are_dealt_not_broadcast(spark, most_codes) -> None:
    """Two hot ids, one of them with more codes than may be broadcast."""
    rows = spark.range(0, 6_000, 1, 32).select(
        (F.col("id") % 3).cast("int").alias("merchant_category_id"), F.col("id").alias("row")
    )
    rows = rows.withColumn("merchant_category_id", F.when(F.col("row") % 3 > 0, F.col("merchant_category_id")))
    few = [Category(1, f"{n:04}") for n in range(3)]
    many = [Category(2, f"{n:04}") for n in range(20)]
    categories = categories_of(spark, few + many)
    with settings(
        spark, autoBroadcastJoinThreshold="-1", adaptive_enabled="false", shuffle_partitions="8"
    ):
        hot = dimensions._hot_ids(rows, categories, 100, 99, most_codes).collect()
        joined = dimensions.with_category_code_shuffled(rows, categories, 100, 99, most_codes)
        plain = dimensions.join_category_code(rows, categories)
        counts = Counter(map(tuple, joined.collect()))
        loads = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert counts == Counter(map(tuple, plain.collect()))
    stays = {r["hot_id"]: r["stays"] for r in hot}
    assert stays == {"1": most_codes >= 3, "2": most_codes >= 23}
    assert {r["groups"] for r in hot} == {20}
    total = 2_000 * (1 + 3 + 20)
    if most_codes == 0:
        assert max(loads) < 3 * total / 8


def test_the_scratch_folder_is_refused_on_a_cluster_unless_it_is_given(spark) -> None:
    from types import SimpleNamespace

    from tallymonth import scratch

    def session(master: str, **conf: str):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
        return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda name, *default: conf.get(name.replace(".", "_"), *default)))

    for master in ("yarn", "local-cluster[2,1,1024]", "spark://host:7077"):
        with pytest.raises(ValueError, match="checkpoint"):
            scratch.new_directory(session(master), "x")
    assert scratch.new_directory(session("yarn", spark_checkpoint_dir="s3a://b/c"), "x").startswith("s3a://b/c/x-")
    local = session("local[4]", spark_sql_warehouse_dir="/w")
    assert scratch.new_directory(local, "x").startswith("/w/_scratch/x-")
