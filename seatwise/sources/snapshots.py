"""Landings of a directory over time, and its state as of a day.

A landing is a folder of its day, whole or with what changed since, as
``kind=full/landed=2025-03-01`` or ``kind=changes/landed=2025-03-02``. The state as
of a day is the last whole landing up to it with all changes after it laid on top:
the last object of each id counts, and one marked as removed takes the id away.
Folders before that landing and after the day are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

FULL, CHANGES = "full", "changes"

#: What an object of a landing has besides those of a single snapshot.
LANDING = T.StructType(
    [
        T.StructField("kind", T.StringType(), True),
        T.StructField("landed", T.StringType(), True),
        T.StructField("Removed", T.BooleanType(), True),
    ]
)


def with_landing(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, *LANDING.fields])


def base_landing(rows: DataFrame, day: str) -> str | None:
    """The day of the last whole landing up to ``day``."""
    whole = (F.col("kind") == FULL) & (F.col("landed") <= day)
    return rows.where(whole).agg(F.max("landed")).first()[0]


def as_of(rows: DataFrame, key: str, day: str) -> DataFrame:
    """The objects that stand on ``day`` (as ``2025-03-01``), one or more rows an id.

    Several rows of an id come only if one landing holds it more than once, which
    is for whoever reads them to refuse. On the same day changes come after the
    whole landing. No whole landing up to the day is an error. Each task looks for
    the last objects among its own rows before any are moved.
    """
    base = base_landing(rows, day)
    if base is None:
        raise ValueError(f"no whole landing up to {day}")
    later = rows.where(
        ((F.col("kind") == FULL) & (F.col("landed") == base))
        | ((F.col("kind") == CHANGES) & F.col("landed").between(base, day))
    )
    newest = Window.partitionBy(key).orderBy(
        F.col("landed").desc(), (F.col("kind") == CHANGES).desc()
    )
    last = later.withColumn("_place", F.rank().over(newest)).where("_place = 1")
    return last.where(~F.coalesce("Removed", F.lit(False))).drop("_place", *LANDING.names)
