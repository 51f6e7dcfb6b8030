"""Per-user aggregates over the usage table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatwise.functions.dates import is_bad_day, parse_day
from seatwise.functions.metrics import ACCEPTANCE, PAIR_TOTALS, TOTALS
from seatwise.functions.text import clean_user_id


def usage_rollup(usage: DataFrame, day_col: str = "act_date", ordered: bool = True) -> DataFrame:
    """Active days, 33 totals and the acceptance ratios per raw user id.

    One aggregate holding both the sums and the distinct count would shuffle
    every sum once per (user, day) and again per user. Here the sums go to their
    user in one shuffle, after map-side aggregation, and only (user, day) pairs
    take the way a distinct count needs. Both sides arrive partitioned by the
    same two key columns, so joining them moves nothing. The keys are never
    NULL, which keeps rows without a user id as a group of their own.
    """
    keyed = usage.withColumns(
        {"_user": F.coalesce("userid", F.lit("")), "_absent": F.col("userid").isNull()}
    )
    key = ["_user", "_absent"]
    sums = keyed.groupBy(*key).agg(
        *(total.column() for total in TOTALS),
        *(ratio.whole() for ratio in ACCEPTANCE),
        *(ratio.fraction() for ratio in ACCEPTANCE),
    )
    days = keyed.groupBy(*key).agg(F.count_distinct(day_col).alias("active_days"))
    joined = days.join(sums, key)
    rollup = joined.select(
        F.when(~F.col("_absent"), F.col("_user")).alias("userid"),
        *(c for c in joined.columns if c not in key),
    )
    return busiest_first(rollup) if ordered else rollup


def active_days(usage: DataFrame, day_col: str = "act_date", ordered: bool = True) -> DataFrame:
    """Distinct days per user, as text: '' is a day, NULL is not."""
    days = usage.groupBy("userid").agg(F.count_distinct(day_col).alias("active_days"))
    return busiest_first(days) if ordered else days


def busiest_first(per_user: DataFrame) -> DataFrame:
    """Most active days first, the id last."""
    # Few distinct day counts exist, so the id has to take part in the range
    # partitioning for the sort to spread over tasks.
    return per_user.orderBy(F.col("active_days").desc_nulls_last(), F.col("userid"))


def usage_pair_sums(usage: DataFrame) -> DataFrame:
    """The six totals over two counters of the same row."""
    return _per_user(usage, [total.column() for total in PAIR_TOTALS])


def acceptance_ratio(usage: DataFrame) -> DataFrame:
    """Accepted over generated as whole numbers: 3 of 4 gives 0."""
    return _per_user(usage, [ratio.whole() for ratio in ACCEPTANCE])


def acceptance_fraction(usage: DataFrame) -> DataFrame:
    """Accepted over generated as a fraction: 3 of 4 gives 0.75."""
    return _per_user(usage, [ratio.fraction() for ratio in ACCEPTANCE])


def _per_user(usage: DataFrame, columns: Sequence[Column]) -> DataFrame:
    return usage.groupBy("userid").agg(*columns)


def latest_activity(
    usage: DataFrame,
    day_col: str = "act_date",
    normalize: bool = False,
    on_bad_date: str = "raise",
    ordered: bool = True,
) -> DataFrame:
    """Last active day per user, newest first.

    Rows are grouped by the raw id and shown with the clean one, so an id that
    occurs with and without quotes gives two rows unless their days agree.
    ``normalize`` groups by the clean id instead, which also saves the shuffle
    of the distinct step.
    """
    latest = F.max(parse_day(F.col(day_col), on_bad_date)).alias("latest_activity_date")
    user = clean_user_id(F.col("userid"))
    if normalize:
        result = usage.groupBy(user.alias("user_id")).agg(latest)
    else:
        result = (
            usage.groupBy("userid")
            .agg(latest)
            .select(user.alias("user_id"), "latest_activity_date")
            # Brought together by user, the rows need not move again for a lookup.
            .repartition("user_id")
            .distinct()
        )
    return newest_first(result) if ordered else result


def newest_first(latest: DataFrame) -> DataFrame:
    """Latest day first, the id last."""
    return latest.orderBy(F.col("latest_activity_date").desc_nulls_last(), F.col("user_id"))


def bad_days(usage: DataFrame, day_col: str = "act_date") -> DataFrame:
    """How many rows the lenient date mode turned into NULL."""
    return usage.agg(F.count_if(is_bad_day(F.col(day_col))).alias("rejected"))


def sample_rows(usage: DataFrame, n: int = 100) -> DataFrame:
    """Any ``n`` whole rows, for a look at the table."""
    return usage.select("*").limit(n)
