"""Results that readers see whole or not at all.

A result is written to a folder of its own first, then read back once to take down
what each part holds, and only then named in a manifest. Readers go by the newest
manifest. A run that fails on the way leaves the old result as it was, and what it
wrote is never read.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seatwise.sinks.files import write_csv

DATA, PUBLISHED = "data", "published"
MANIFEST = "version long, run string, part int, rows long, bytes long, checksum decimal(38,0)"


def parts(lines: DataFrame) -> DataFrame:
    """``(part, rows, bytes, checksum)`` of the text lines of a written result.

    The checksum adds up a hash of every line, so it does not depend on who read
    which line, and equal lines do not cancel out. Map-side aggregation leaves one
    row for each part and task.
    """
    number = F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1).cast("int")
    return (
        lines.select(number.alias("part"), "value")
        .groupBy("part")
        .agg(
            F.count("*").alias("rows"),
            F.sum(F.octet_length("value").cast("long") + 1).alias("bytes"),
            F.sum(F.xxhash64("value").cast("decimal(38,0)")).alias("checksum"),
        )
    )


def _lines(spark: SparkSession, out: str, run: str) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(f"{out}/{DATA}/{run}")


def manifests(spark: SparkSession, out: str) -> DataFrame | None:
    """All manifests under ``out``, one row a part, None where nothing is published."""
    try:
        found = spark.read.schema(MANIFEST).parquet(f"{out.rstrip('/')}/{PUBLISHED}")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return None if found.isEmpty() else found


def manifest(spark: SparkSession, out: str) -> DataFrame:
    """The newest manifest."""
    known = manifests(spark, out)
    if known is None:
        raise ValueError(f"nothing is published in {out}")
    # Two that began at once are told apart by their runs, alike for all readers.
    newest = known.agg(F.max(F.struct("version", "run")).alias("of")).first()["of"]
    return known.where((F.col("version") == newest["version"]) & (F.col("run") == newest["run"]))


def publish(
    result: DataFrame, out: str, write: Callable[[DataFrame, str], object] = write_csv
) -> DataFrame:
    """Writes a result with ``write`` and makes it the one readers see.

    Returns its manifest. ``write`` takes a result and a folder and writes text.
    """
    spark, out = result.sparkSession, out.rstrip("/")
    known, run = manifests(spark, out), uuid.uuid4().hex
    version = 1 if known is None else known.agg(F.max("version")).first()[0] + 1
    write(result, f"{out}/{DATA}/{run}")
    told = parts(_lines(spark, out, run)).select(
        F.lit(version).cast("long").alias("version"), F.lit(run).alias("run"), "*"
    )
    # One file: the committer puts it in place at once or not at all.
    told.coalesce(1).write.mode("append").parquet(f"{out}/{PUBLISHED}")
    return manifest(spark, out)


def published_folder(spark: SparkSession, out: str, verify: bool = False) -> str:
    """The folder of the result that readers see.

    ``verify`` reads it through and fails if it is not what its manifest says.
    """
    current, out = manifest(spark, out), out.rstrip("/")
    run = current.first()["run"]
    if verify:
        columns = ["part", "rows", "bytes", "checksum"]
        now, told = parts(_lines(spark, out, run)).select(columns), current.select(columns)
        wrong = told.exceptAll(now).unionByName(now.exceptAll(told)).orderBy("part").first()
        if wrong is not None:
            raise ValueError(f"part {wrong['part']} of {out} is not as published")
    return f"{out}/{DATA}/{run}"
