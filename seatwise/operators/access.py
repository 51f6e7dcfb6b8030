"""Who may use the application: directly, or by way of a group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seatwise.functions.emails import first_or_null, has_usable_emails, primary_or_blank


def principals(assignments: DataFrame, kind: str) -> DataFrame:
    """(page, pos, principal_id) of the assignments of one kind, copies included."""
    return assignments.where(F.col("principal_type") == kind).select("page", "pos", "principal_id")


def distinct_principals(assignments: DataFrame, kind: str, name: str) -> DataFrame:
    return (
        assignments.where(F.col("principal_type") == kind)
        .select(F.col("principal_id").alias(name))
        .distinct()
    )


def full_profiles(users: DataFrame) -> DataFrame:
    """Six fields with blanks for what is missing, primary address."""
    return users.select(
        "user_id",
        F.coalesce("user_name", F.lit("")).alias("user_name"),
        primary_or_blank(F.col("emails")).alias("email"),
        F.coalesce("name.GivenName", F.lit("")).alias("first_name"),
        F.coalesce("name.FamilyName", F.lit("")).alias("last_name"),
        F.coalesce("display_name", F.lit("")).alias("display_name"),
    )


def short_profiles(users: DataFrame) -> DataFrame:
    """Four fields with NULL for what is missing, first address.

    Profiles whose address list is present but empty are left out here, before
    any join, so that for them every field counts as unknown.
    """
    return users.where(has_usable_emails(F.col("emails"))).select(
        "user_id",
        "user_name",
        first_or_null(F.col("emails")).alias("email"),
        "display_name",
    )


def direct_users(assignments: DataFrame, users: DataFrame) -> DataFrame:
    """Users assigned by name, once each; ids without a profile are dropped."""
    ids = distinct_principals(assignments, "USER", "user_id")
    return ids.join(full_profiles(users), "user_id")


def direct_user_count(assignments: DataFrame, users: DataFrame) -> DataFrame:
    """How many distinct users are assigned by name, and how many have a profile."""
    ids = distinct_principals(assignments, "USER", "user_id")
    known = users.select("user_id", F.lit(True).alias("_known"))
    return ids.join(known, "user_id", "left").agg(
        F.count("*").alias("assigned_users"), F.count("_known").alias("known_users")
    )


def effective_user_ids(assignments: DataFrame, memberships: DataFrame) -> DataFrame:
    """Direct users and members of assigned groups; a group nobody is in adds none."""
    direct = principals(assignments, "USER").select(F.col("principal_id").alias("user_id"))
    groups = distinct_principals(assignments, "GROUP", "group_id")
    via_group = memberships.join(groups, "group_id")
    return direct.union(via_group.select("user_id")).distinct()


def effective_users(
    assignments: DataFrame, memberships: DataFrame, users: DataFrame
) -> DataFrame:
    """Everyone with access; an id without a usable profile keeps a row of its own."""
    ids = effective_user_ids(assignments, memberships)
    # The rows are already partitioned by user id, so this last step moves nothing.
    return ids.join(short_profiles(users), "user_id", "left").dropDuplicates()
