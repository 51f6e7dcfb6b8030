"""Who has access to which of several applications, in one run.

Memberships are kept by bucket of their group, a folder each. The groups that the
chosen applications are assigned tell, while the query runs, which of the folders
hold any of them, and only those are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatwise.operators.access import short_profiles

BUCKETS = 1024
BUCKET = "group_bucket"


def group_bucket(group_id: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(group_id), F.lit(buckets)).cast("int")


def write_memberships(memberships: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Memberships as Parquet, in folders by bucket of the group.

    The rebalance hint lets the adaptive planner split a bucket too big for a task.
    """
    (
        memberships.withColumn(BUCKET, group_bucket(F.col("group_id"), buckets))
        .hint("rebalance", BUCKET)
        .write.partitionBy(BUCKET)
        .parquet(path)
    )


def effective_users(
    assignments: DataFrame,
    memberships: DataFrame,
    users: DataFrame,
    applications: Sequence[str] | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """(application_arn, user_id, profile): everyone with access, once an application.

    ``assignments`` has ``application_arn``, ``memberships`` comes from
    :func:`write_memberships` with as many buckets. A group assigned to several
    applications is read once. An id without a usable profile keeps its row.
    """
    chosen = assignments
    if applications is not None:
        chosen = assignments.where(F.col("application_arn").isin(*applications))
    direct = chosen.where("principal_type = 'USER'").select(
        "application_arn", F.col("principal_id").alias("user_id")
    )
    groups = (
        chosen.where("principal_type = 'GROUP'")
        .select("application_arn", F.col("principal_id").alias("group_id"))
        .distinct()
        .withColumn(BUCKET, group_bucket(F.col("group_id"), buckets))
    )
    members = memberships.join(groups, [BUCKET, "group_id"]).select("application_arn", "user_id")
    ids = direct.unionByName(members).distinct()
    return ids.join(short_profiles(users), "user_id", "left").select(
        "application_arn", "user_id", "user_name", "email", "display_name"
    )
