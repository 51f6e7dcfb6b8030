"""The usage rows as a table of the catalog, laid out by user.

Rows are bucketed by the clean user id, so what groups or joins by user, raw id or
clean one, finds each user's rows in one place and moves nothing. A bucket is one
task's, which a user of many rows would make too long. Users with more rows than
an even bucket holds are therefore kept in a second table without buckets, where
map-side aggregation brings their rows down to a few before they move. There are
fewer such users than buckets, so their list is small by construction.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seatwise.functions.text import clean_user_id

#: What the second table's name ends in.
HEAVY = "_heavy"


class UsageTable(NamedTuple):
    """``even``: rows by bucket. ``heavy``: rows of the users too large for one."""

    even: DataFrame
    heavy: DataFrame


def write_usage_table(
    usage: DataFrame, name: str, buckets: int | None = None, folder: str | None = None
) -> None:
    """Lays out usage rows under a name, ``folder`` tells where if not the warehouse.

    Without ``buckets`` there are as many as a shuffle has partitions.
    """
    spark = usage.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = usage.withColumn("user_id", clean_user_id(F.col("userid")))
    counts = rows.groupBy("user_id").agg(F.count("*").alias("n"))
    # Fewer than there are buckets, whatever the rows; rows without an id count as one.
    heavy = counts.where(F.col("n") > usage.count() / buckets).select(F.col("user_id").alias("of"))
    few, same = F.broadcast(heavy), F.col("user_id").eqNullSafe(F.col("of"))
    even = (
        rows.join(few, same, "left_anti")
        .repartition(buckets, "user_id")
        .write.bucketBy(buckets, "user_id")
        .sortBy("user_id", "userid")
    )
    large = rows.join(few, same, "left_semi").hint("rebalance").write
    for writer, table in ((even, name), (large, name + HEAVY)):
        if folder:
            writer = writer.option("path", f"{folder.rstrip('/')}/{table}")
        writer.format("parquet").mode("errorifexists").saveAsTable(table)


def usage_table(spark: SparkSession, name: str) -> UsageTable:
    return UsageTable(spark.table(name), spark.table(name + HEAVY))
