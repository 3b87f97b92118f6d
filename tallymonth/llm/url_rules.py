"""URL rules by a sort-merge range join.

With the labels of its host reversed, a rule is a prefix of the keys it fits, and the
keys with one prefix are an interval. Prefixes nest or are apart, so a sweep over the
sorted ends of the intervals needs a stack alone; it cuts the key space into segments,
each with the innermost rule. The urls' keys are sorted among the segments' starts, and
each takes the last start before it. Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallymonth.llm.common import UPPER, stored

DEFAULT = "allow"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host between the first :// and / ? # or the end, A-Z lower-cased; path up to ? or #."""
    pattern = r"(?s)\A.*?://([^/?#]*)([^?#]*)"
    host, path = (
        F.coalesce(F.regexp_extract(url, pattern, group), F.lit("")) for group in (1, 2)
    )
    return F.translate(host, UPPER, UPPER.lower()), path


def _key(labels: Column, path: Column) -> Column:
    """Labels from the last, a slash that no host has, and the path; as bytes."""
    text = F.concat(F.array_join(F.reverse(labels), "."), F.lit("/"), path)
    return F.encode(text, "utf-8")


def _labels(host: Column) -> Column:
    return F.split(host, r"\.", -1)


def _segments(rules: DataFrame) -> DataFrame:
    """(key, rule): from that key on, until the next one, the innermost rule is ``rule``.

    A rule opens at its prefix and closes before the byte 255, which no text has. The
    depth of the stack is a running sum; what a closing rule lays bare is the last
    rule that opened to the depth it leaves. The rules, not the urls, are sorted in one task.
    """
    low = _key(_labels(F.col("host")), F.col("path"))
    rule = F.struct(
        F.length(F.concat("host", "path")).alias("length"),
        F.length("host").alias("host_length"),
        F.concat("host", "path").alias("rule"),
        "verdict",
    )
    ends = rules.select(
        F.explode(
            F.array(
                F.struct(low.alias("key"), F.lit(1).alias("step"), rule.alias("opens")),
                F.struct(
                    F.concat(low, F.unhex(F.lit("FF"))).alias("key"),
                    F.lit(-1).alias("step"),
                    F.lit(None).cast(_RULE).alias("opens"),
                ),
            )
        ).alias("end")
    ).select("end.*")
    sweep = Window.orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    deep = ends.withColumn("depth", F.sum("step").over(sweep))
    level = Window.partitionBy("depth").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    top = F.when(F.col("depth") > 0, F.last("opens", ignorenulls=True).over(level))
    return deep.select("key", top.alias("rule"))


_RULE = "struct<length:int,host_length:int,rule:string,verdict:string>"


def judged(
    pages: DataFrame, rules: DataFrame, default: str = DEFAULT, id_col: str = "page_id"
) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict.

    ``rules`` has host, path and verdict (allow or block). A rule fits its host and all
    subdomains if the url's path starts with the rule's path; of those that fit, the
    one with the longest host and path wins, then the one with the longer host, then
    ``block``. Without any, rule is null and the verdict is ``default``. Null urls and
    those without ``://`` have an empty host and path. Repeated rows and null ids stay.

    A url is looked up once for each label of its host, up to the labels of the longest
    rule, as a rule fits subdomains too. Equal keys are dealt out by id as well, so a
    host of any size is spread over many tasks.
    """
    rules = rules.select(
        F.translate("host", UPPER, UPPER.lower()).alias("host"),
        F.coalesce("path", F.lit("")).alias("path"),
        "verdict",
    )
    rules = rules.filter("host is not null").groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    bounds = rules.agg(
        F.max(F.size(_labels(F.col("host")))).alias("labels"),
        F.max(F.length("path")).alias("path"),
    ).first()
    deepest, longest = bounds["labels"] or 1, bounds["path"] or 0

    urls = pages.select(F.col(id_col).alias("page_id"), F.col("url"))
    urls = urls.groupBy("page_id", "url").agg(F.count("*").alias("times"))
    host, path = host_and_path(F.col("url"))
    labels = F.col("labels")
    probes = (
        urls.withColumn("labels", _labels(host))
        .withColumn("n", F.explode(F.sequence(F.lit(1), F.least(F.size(labels), F.lit(deepest)))))
        .select(
            _key(F.slice(labels, -F.col("n"), F.col("n")), F.substring(path, 1, longest)).alias("key"),
            F.lit(True).alias("is_url"),
            "page_id",
            "url",
            "times",
            F.lit(None).cast(f"struct<rule:{_RULE}>").alias("segment"),
        )
    )
    starts = _segments(rules).select(
        "key", F.lit(False).alias("is_url"), F.struct("rule").alias("segment")
    )
    order = ["key", "is_url"]
    dealt = probes.unionByName(starts, allowMissingColumns=True)
    dealt = stored(
        dealt.repartitionByRange(*order, "page_id", "url").withColumn(
            "part", F.spark_partition_id()
        ),
        "sorted-urls",
    )

    # What is open where a part begins: the last start in the parts before it.
    last = F.max_by("segment", F.when(~F.col("is_url"), F.col("key")))
    parts = dealt.groupBy("part").agg(last.alias("segment"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = parts.select("part", F.last("segment", ignorenulls=True).over(before).alias("carried"))
    sweep = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    swept = dealt.withColumn("now", F.last("segment", ignorenulls=True).over(sweep))
    swept = swept.filter("is_url").join(carried, "part")
    now = F.when(F.col("now").isNotNull(), F.col("now.rule")).otherwise(F.col("carried.rule"))
    found = swept.groupBy("page_id", "url", "times").agg(F.max(now).alias("rule"))
    each = found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times"))))
    return each.select(
        "page_id",
        host.alias("host"),
        path.alias("path"),
        F.col("rule.rule").alias("rule"),
        F.coalesce("rule.verdict", F.lit(default)).alias("verdict"),
    )
