"""Per-user analyses of a table laid out by user.

Every step groups by the clean user id and more, or joins on it, which the buckets
already satisfy: no row of the bucketed part moves before the final sort. The
heavy users' part is analysed as any other usage rows are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seatwise.functions.dates import parse_day
from seatwise.functions.metrics import ACCEPTANCE, TOTALS
from seatwise.operators import enrich, usage
from seatwise.sources.usage_table import UsageTable

SUMS = {t.inputs: t.name for t in TOTALS}


def even_rollup(even: DataFrame, day_col: str = "act_date") -> DataFrame:
    """First per user and day, then per user, all in place."""
    by_day = even.groupBy("user_id", "userid", day_col).agg(*(total.column() for total in TOTALS))
    per_user = by_day.groupBy("user_id", "userid").agg(
        F.count(day_col).alias("active_days"), *(F.sum(t.name).alias(t.name) for t in TOTALS)
    )
    ratios = [
        ratio.of(SUMS[ratio.accepted,], SUMS[ratio.generated,], kind)
        for kind in ("whole", "fraction")
        for ratio in ACCEPTANCE
    ]
    return per_user.select("userid", "active_days", *(t.name for t in TOTALS), *ratios)


def even_latest(even: DataFrame, day_col: str = "act_date", on_bad_date: str = "raise") -> DataFrame:
    day = F.max(parse_day(F.col(day_col), on_bad_date)).alias("latest_activity_date")
    per_user = even.groupBy("user_id", "userid").agg(day)
    return per_user.select("user_id", "latest_activity_date").distinct()


def usage_rollup(table: UsageTable, day_col: str = "act_date", ordered: bool = True) -> DataFrame:
    """As ``usage.usage_rollup``."""
    heavy = usage.usage_rollup(table.heavy, day_col, ordered=False)
    both = even_rollup(table.even, day_col).unionByName(heavy)
    return usage.busiest_first(both) if ordered else both


def latest_activity(
    table: UsageTable, day_col: str = "act_date", on_bad_date: str = "raise", ordered: bool = True
) -> DataFrame:
    """As ``usage.latest_activity``."""
    heavy = usage.latest_activity(table.heavy, day_col, on_bad_date=on_bad_date, ordered=False)
    both = even_latest(table.even, day_col, on_bad_date).unionByName(heavy)
    return usage.newest_first(both) if ordered else both


def even_profiles(even: DataFrame, users: DataFrame, **options) -> DataFrame:
    """Only profiles move, to the buckets."""
    listed = even_latest(even, **options)
    return enrich.enrich_activity(
        listed.withColumnRenamed("latest_activity_date", "last_activity_date"), users
    )


def activity_with_profile(table: UsageTable, users: DataFrame, **options) -> DataFrame:
    """As ``enrich.activity_with_profile``."""
    heavy = enrich.activity_with_profile(table.heavy, users, **options)
    return even_profiles(table.even, users, **options).unionByName(heavy)
