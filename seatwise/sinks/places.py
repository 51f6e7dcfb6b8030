"""Where each line of an ordered text stands in the one file it makes.

Numbers and byte offsets are prefix sums. They are taken in three steps, none of
which sees all lines: sums of each run of lines as the sort deals them out, the
sums of the runs before each, a few rows in all, and sums within each run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seatwise.session import scratch_path


def _before(runs: DataFrame, order: str) -> DataFrame:
    """Sums of all earlier rows; one row a task or file comes here, never a line."""
    earlier = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return runs.withColumns(
        {
            "lines_before": F.coalesce(F.sum("lines").over(earlier), F.lit(0)),
            "bytes_before": F.coalesce(F.sum("bytes").over(earlier), F.lit(0)),
        }
    )


def with_places(lines: DataFrame, order: Sequence[str], line: str = "line") -> DataFrame:
    """The lines with ``line_number`` from 1, ``byte_offset`` from 0 and ``byte_length``.

    ``order`` names the columns that put them in order, nulls first; lines alike in
    all of them go by their text. Lengths count the line feed. Dealt out by range
    and stored, so that both sums see the same runs, also after a lost executor.
    """
    keys = [F.col(c).asc_nulls_first() for c in (*order, line)]
    path = scratch_path(lines.sparkSession, "lines")
    dealt = (
        lines.repartitionByRange(*keys)
        .withColumn("_run", F.spark_partition_id())
        .withColumn("byte_length", F.octet_length(line).cast("long") + 1)
    )
    dealt.write.parquet(path)
    held = lines.sparkSession.read.schema(dealt.schema).parquet(path)
    runs = held.groupBy("_run").agg(
        F.count("*").alias("lines"), F.sum("byte_length").alias("bytes")
    )
    before = _before(runs, "_run").select("_run", "lines_before", "bytes_before")
    upto = Window.partitionBy("_run").orderBy(*keys).rowsBetween(Window.unboundedPreceding, 0)
    told = held.withColumns(
        {"_number": F.row_number().over(upto), "_bytes": F.sum("byte_length").over(upto)}
    )
    return told.join(before, "_run").select(
        *lines.columns,
        (F.col("lines_before") + F.col("_number")).alias("line_number"),
        (F.col("bytes_before") + F.col("_bytes") - F.col("byte_length")).alias("byte_offset"),
        "byte_length",
    )


def part_places(spark: SparkSession, path: str) -> DataFrame:
    """``(file, lines, bytes, lines_before, bytes_before)`` of a written text's parts.

    Whoever joins the parts into one file can put each in its place without the
    others, however many there are.
    """
    text = spark.read.option("lineSep", "\n").text(path)
    files = text.groupBy(F.col("_metadata.file_name").alias("file")).agg(
        F.count("*").alias("lines"),
        F.sum(F.octet_length("value").cast("long") + 1).alias("bytes"),
    )
    return _before(files, "file")
