"""A usage rollup that new days can be added to without reading the old ones.

What a set of usage rows adds to the rollup is kept as a state: the sums of each
user, and the user's days as bits, 64 days to a word. Sums add up and words join
by OR, so states of any parts of the rows, in any grouping, merge into that of
all. Days are exact: a text that is not the usual spelling of a day stays a text.
A word takes 8 bytes where the built-in bitmap aggregates hold 4 KB for each user,
and merging words is an ordinary aggregate with map-side combining.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seatwise.functions.metrics import ACCEPTANCE, TOTALS
from seatwise.operators.usage import busiest_first

#: How a day is usually spelt; other spellings count as days of their own.
USUAL_DAY = "MM-dd-yyyy"
WORD = 64

KEY = ["_user", "_absent"]


class UsageState(NamedTuple):
    """``sums``: one row a user. ``days``: (user, word, odd, bits), a word or an odd text."""

    sums: DataFrame
    days: DataFrame


def usage_state(usage: DataFrame, day_col: str = "act_date") -> UsageState:
    """What these rows add to the rollup."""
    keyed = usage.withColumns(
        {"_user": F.coalesce("userid", F.lit("")), "_absent": F.col("userid").isNull()}
    )
    sums = keyed.groupBy(*KEY).agg(*(total.column() for total in TOTALS))
    parsed = F.try_to_date(F.col(day_col), USUAL_DAY)
    usual = F.coalesce(F.date_format(parsed, USUAL_DAY) == F.col(day_col), F.lit(False))
    number = F.when(usual, F.unix_date(parsed).cast("long"))
    days = (
        keyed.where(F.col(day_col).isNotNull())
        .select(*KEY, number.alias("number"), F.when(~usual, F.col(day_col)).alias("odd"))
        .select(
            *KEY,
            F.floor(F.col("number") / WORD).alias("word"),
            "odd",
            F.expr(f"shiftleft(1L, cast(pmod(number, {WORD}) AS int))").alias("bits"),
        )
    )
    return UsageState(sums, _joined_days(days))


def _joined_days(days: DataFrame) -> DataFrame:
    return days.groupBy(*KEY, "word", "odd").agg(F.bit_or("bits").alias("bits"))


def merged(*states: UsageState) -> UsageState:
    """The state of all rows that the states stand for, each row in one of them."""
    sums = reduce(DataFrame.unionByName, (s.sums for s in states))
    days = reduce(DataFrame.unionByName, (s.days for s in states))
    return UsageState(
        sums.groupBy(*KEY).agg(*(F.sum(t.name).alias(t.name) for t in TOTALS)), _joined_days(days)
    )


def rollup_of(state: UsageState, ordered: bool = True) -> DataFrame:
    """The rollup that ``usage_rollup`` makes of the rows themselves."""
    counted = F.when(F.col("odd").isNotNull(), 1).otherwise(F.bit_count("bits"))
    days = state.days.groupBy(*KEY).agg(F.sum(counted).cast("long").alias("active_days"))
    names = {inputs: t.name for t in TOTALS for inputs in [t.inputs]}
    ratios = [
        column
        for kind in ("whole", "fraction")
        for ratio in ACCEPTANCE
        for column in [ratio.of(names[ratio.accepted,], names[ratio.generated,], kind)]
    ]
    joined = state.sums.join(days, KEY, "left")
    rollup = joined.select(
        F.when(~F.col("_absent"), F.col("_user")).alias("userid"),
        F.coalesce("active_days", F.lit(0).cast("long")).alias("active_days"),
        *(t.name for t in TOTALS),
        *ratios,
    )
    return busiest_first(rollup) if ordered else rollup


def write_state(state: UsageState, path: str, batch: str) -> None:
    """Adds the state of one batch, a day's files say, to those under ``path``.

    Written again under the same name it replaces what it wrote before, so a batch
    that failed halfway can simply be repeated and none counts twice.
    """
    for name, part in state._asdict().items():
        part.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{name}/batch={batch}")


def read_state(spark: SparkSession, path: str) -> UsageState:
    """All batches under ``path``, one state each; ``merged`` joins them."""
    sums, days = (spark.read.parquet(f"{path.rstrip('/')}/{name}") for name in UsageState._fields)
    return UsageState(sums.drop("batch"), days.drop("batch"))
