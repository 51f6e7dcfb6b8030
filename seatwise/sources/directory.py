"""Landed snapshots of the identity directory, one JSON object per line.

Each list call of the service lands as pages (application or group, page
number, entries); each profile lands as one object. Looking users up is then a
join against the snapshot instead of one call per user.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seatwise.functions.text import shown
from seatwise.schemas import (
    ASSIGNMENT_PAGE,
    GROUP_PROFILE,
    INSTANCES,
    MEMBERSHIP_PAGE,
    USER_PROFILE,
)
from seatwise.sources import snapshots
from seatwise.sources.page_order import in_token_order

# The numbers a first page may have.
FIRST_PAGES = (0, 1)


def read_assignments(
    spark: SparkSession, path: str, application_arn: str | None = None, by_token: bool = False
) -> DataFrame:
    """(application_arn, page, pos, principal_type, principal_id).

    Where the pages lie in one folder per application, naming the application
    reads that folder only. A page without entries gives no rows. A page landed
    without its number fails any query that needs an assignment's place;
    ``by_token`` numbers pages along their tokens, see ``page_order``.
    """
    pages = assignment_pages(spark, path, application_arn)
    if by_token:
        pages = in_token_order(pages, "application_arn")
    return (
        pages.select(
            "application_arn",
            _page_number(),
            F.posexplode("ApplicationAssignments").alias("pos", "entry"),
        )
        .select(
            "application_arn",
            "page",
            "pos",
            F.col("entry.PrincipalType").alias("principal_type"),
            F.col("entry.PrincipalId").alias("principal_id"),
        )
    )


def assignment_pages(
    spark: SparkSession, path: str, application_arn: str | None = None
) -> DataFrame:
    pages = spark.read.schema(ASSIGNMENT_PAGE).json(path)
    if application_arn is not None:
        pages = pages.where(F.col("application_arn") == application_arn)
    return pages


def read_memberships(
    spark: SparkSession, path: str, store_id: str | None = None, by_token: bool = False
) -> DataFrame:
    """(group_id, page, pos, user_id) of one identity store."""
    landed = membership_pages(spark, path, store_id)
    if by_token:
        landed = in_token_order(landed, "GroupId")
    pages = landed.select(
        F.col("GroupId").alias("group_id"),
        _page_number(),
        F.posexplode("GroupMemberships").alias("pos", "entry"),
    )
    return pages.select("group_id", "page", "pos", F.col("entry.MemberId.UserId").alias("user_id"))


def membership_pages(spark: SparkSession, path: str, store_id: str | None = None) -> DataFrame:
    return in_store(_landed(spark, path, MEMBERSHIP_PAGE), store_id)


def _page_number() -> Column:
    missing = F.raise_error(F.lit("a landed page has no page number"))
    return F.coalesce("page", missing).alias("page")


def incomplete_landings(pages: DataFrame, key: str) -> DataFrame:
    """(key, first_page, last_page, pages, problem) of list calls landed in part.

    The service gives a token with every page but the last. A landing is whole if
    its pages are numbered without a gap from the first, each there once, and
    only the last has no token. Only page numbers and tokens are read.
    """
    token = F.nullif(F.trim("NextToken"), F.lit(""))
    landed = pages.select(F.col(key), "page", token.alias("token")).groupBy(key).agg(
        F.min("page").alias("first_page"),
        F.max("page").alias("last_page"),
        F.count("*").alias("pages"),
        F.count_distinct("page").alias("numbers"),
        F.max(F.struct("page", F.col("token").isNotNull().alias("more"))).alias("last"),
        F.count("token").alias("tokens"),
    )
    followed = F.col("tokens") - F.col("last.more").cast("int")
    problem = (
        F.when(F.col("first_page").isNull() | (F.col("numbers") == 0), "no page number")
        .when(~F.col("first_page").isin(*FIRST_PAGES), "first page missing")
        .when(F.col("numbers") <= F.col("last_page") - F.col("first_page"), "page missing")
        .when(F.col("pages") > F.col("numbers"), "page repeated")
        .when(F.col("last.more"), "last page missing")
        .when(followed < F.col("pages") - 1, "token missing")
    )
    return landed.select(key, "first_page", "last_page", "pages", problem.alias("problem")).where(
        "problem IS NOT NULL"
    )


def require_complete(pages: DataFrame, key: str) -> None:
    """Fails naming an application or group whose pages did not all land."""
    found = incomplete_landings(pages, key).orderBy(key).first()
    if found is not None:
        raise ValueError(f"incomplete landing of {found[key]}: {found['problem']}")


def read_users(
    spark: SparkSession, path: str, store_id: str | None = None, as_of: str | None = None
) -> DataFrame:
    """(user_id, user_name, display_name, name, emails), one row per user.

    A user who is landed twice fails the query by name. ``as_of`` reads landings
    over time as they stood on that day, see ``snapshots``.
    """
    profiles = in_store(_landed(spark, path, USER_PROFILE, "UserId", as_of), store_id).select(
        F.col("UserId").alias("user_id"),
        F.col("UserName").alias("user_name"),
        F.col("DisplayName").alias("display_name"),
        F.col("Name").alias("name"),
        F.col("Emails").alias("emails"),
    )
    return one_each(profiles, "user_id")


def read_groups(
    spark: SparkSession, path: str, store_id: str | None = None, as_of: str | None = None
) -> DataFrame:
    """(group_id, group_name), one row per group; one landed twice fails the query."""
    profiles = in_store(_landed(spark, path, GROUP_PROFILE, "GroupId", as_of), store_id).select(
        F.col("GroupId").alias("group_id"), F.col("Group.DisplayName").alias("group_name")
    )
    return one_each(profiles, "group_id")


def one_each(profiles: DataFrame, key: str) -> DataFrame:
    """The profiles if each id occurs once; those without an id belong to nobody.

    Lookups join on the id, so grouping by it first moves nothing twice. The
    check is a condition on rows and holds whichever columns are read.
    """
    rest = [c for c in profiles.columns if c != key]
    grouped = (
        profiles.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count("*").alias("landed"), F.first(F.struct(*rest)).alias("profile"))
    )
    twice = F.raise_error(F.concat(F.lit(f"landed more than once: {key} "), shown(F.col(key))))
    once = F.when(F.col("landed") > 1, twice.cast("boolean")).otherwise(True)
    return grouped.where(once).select(key, "profile.*").select(*profiles.columns)


def _landed(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    key: str | None = None,
    as_of: str | None = None,
) -> DataFrame:
    """Rows with ``store``: from the folder's name or from the landed object."""
    if as_of is None:
        rows = spark.read.schema(schema).json(path)
    else:
        landings = spark.read.schema(snapshots.with_landing(schema)).json(path)
        rows = snapshots.as_of(landings, key, as_of)
    return rows.withColumn("store", F.coalesce("identity_store_id", "IdentityStoreId")).drop(
        "identity_store_id", "IdentityStoreId"
    )


def in_store(snapshot: DataFrame, store_id: str | None = None) -> DataFrame:
    """Rows of one identity store; a row that names no store fails the query.

    Without ``store_id`` the snapshot has to come from a single store, which a
    scan of that one column makes sure of. Nothing landed gives no rows.
    """
    if store_id is None:
        stores = [r[0] for r in snapshot.select("store").distinct().limit(3).collect()]
        named = sorted(s for s in stores if s is not None)
        if len(named) > 1:
            raise ValueError(f"several identity stores are landed, name one: {', '.join(named)}")
        if None in stores:
            raise ValueError("a landed object has no identity store id")
        return snapshot
    missing = F.raise_error(F.lit("a landed object has no identity store id"))
    wanted = F.when(F.col("store").isNull(), missing.cast("boolean")).otherwise(
        F.col("store") == store_id
    )
    return snapshot.where(wanted)


def first_store(spark: SparkSession, path: str) -> str | None:
    """The store of the first instance of page one, None where none is listed.

    Several list files have to carry page numbers, or which one is first would be
    the scan's choice. A first instance without a store id is an error.
    """
    listed = spark.read.schema(INSTANCES).json(path)
    pages = listed.select(
        "page", F.size("Instances").alias("n"), F.get("Instances", F.lit(0)).alias("first")
    )
    rows = pages.orderBy(F.col("page").asc_nulls_first()).limit(2).collect()
    if len(rows) > 1 and (rows[0]["page"] is None or rows[0]["page"] == rows[1]["page"]):
        raise ValueError("the files of an instance list need page numbers of their own")
    if not rows or (rows[0]["n"] or 0) <= 0:
        return None
    if rows[0]["first"] is None or rows[0]["first"]["IdentityStoreId"] is None:
        raise ValueError("the first instance has no identity store id")
    return rows[0]["first"]["IdentityStoreId"]
