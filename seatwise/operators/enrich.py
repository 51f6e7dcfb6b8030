"""Profiles attached to a list of users with their last active day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seatwise.operators.access import short_profiles
from seatwise.operators.usage import latest_activity


def enrich_activity(listed: DataFrame, users: DataFrame, keep_date: bool = False) -> DataFrame:
    """One row per listed row, copies included.

    A user without a usable profile keeps the id only: even the known date is
    lost unless ``keep_date`` asks for it. The list is the streamed side of a
    left join whose other side holds a user once, so the adaptive planner can
    split a user that fills much of the list.
    """
    known = short_profiles(users).withColumn("_known", F.lit(True))
    date = F.col("last_activity_date")
    return listed.join(known, "user_id", "left").select(
        "user_id",
        "user_name",
        "email",
        "display_name",
        (date if keep_date else F.when(F.col("_known"), date)).alias("last_activity_date"),
    )


def activity_with_profile(
    usage: DataFrame, users: DataFrame, day_col: str = "act_date", **options
) -> DataFrame:
    """Last active day of every user with the profile beside it, in one plan."""
    listed = latest_activity(usage, day_col, ordered=False, **options)
    return enrich_activity(
        listed.withColumnRenamed("latest_activity_date", "last_activity_date"), users
    )
