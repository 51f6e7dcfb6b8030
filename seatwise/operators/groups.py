"""Groups assigned to the application, and who is in them.

An assignment is known by (page, pos), its place in the landed pages: a group
assigned twice is listed twice and its members count twice. A member is known
by (member_page, member_pos) within its group, and copies count as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatwise.functions.text import shown, user_line
from seatwise.operators.access import distinct_principals, principals, short_profiles

#: Landed pages of a group's members that make one row of the nested view. The
#: service returns at most 100 members a page.
PAGES_PER_ROW = 10

# The report's wording.
RULE = "-" * 39
TOTAL_LINE = "Total Users Across All Groups: %d"
GROUPS_LINE = "Group Details:"
NAME_LINE = "Group Name: %s"
ID_LINE = "Group ID: %s"
COUNT_LINE = "Number of Users: %d"
USERS_LINE = "Users in this group:"

# The order of a block's parts.
_TITLE, _NAME, _USER, _END = 0, 1, 2, 3


def assigned_groups(
    assignments: DataFrame, profiles: DataFrame, dedupe: bool = False
) -> DataFrame:
    """(page, pos, group_id, group_name); an unknown group fails the query.

    ``dedupe`` keeps the first place of a group that is assigned several times.
    """
    return _checked(_listed(assignments, profiles, dedupe))


def _listed(assignments: DataFrame, profiles: DataFrame, dedupe: bool) -> DataFrame:
    """The assigned groups, those without a profile among them."""
    listed = principals(assignments, "GROUP").withColumnRenamed("principal_id", "group_id")
    if dedupe:
        place = F.min(F.struct("page", "pos")).alias("place")
        listed = listed.groupBy("group_id").agg(place).select("place.*", "group_id")
    named = listed.join(profiles, "group_id", "left")
    return named.select("page", "pos", "group_id", "group_name")


def _checked(named: DataFrame) -> DataFrame:
    """The check is a condition on rows, so it holds whichever columns are read."""
    unknown = F.raise_error(
        F.concat(F.lit("no profile for assigned group "), shown(F.col("group_id")))
    )
    known = F.when(F.col("group_name").isNull(), unknown.cast("boolean")).otherwise(True)
    return named.where(known)


def _members(memberships: DataFrame) -> DataFrame:
    return memberships.select(
        "group_id", F.col("page").alias("member_page"), F.col("pos").alias("member_pos"), "user_id"
    )


def _known_ids(users: DataFrame) -> DataFrame:
    """Ids with a usable profile, to be joined inner and not as a semi join.

    The directory holds a user once, so both give the same rows. But a semi join
    is pushed below the join with the assigned groups, and would then shuffle
    the memberships of every group there is.
    """
    return short_profiles(users).select("user_id")


def roster_in_order(
    assignments: DataFrame,
    memberships: DataFrame,
    profiles: DataFrame,
    users: DataFrame,
    dedupe: bool = False,
) -> DataFrame:
    """The roster with each member's place in its group.

    Members are the left side of both joins. The other sides hold a key a few
    times at most, so the adaptive planner can split a huge group or a user who
    is in most groups.
    """
    listed = assigned_groups(assignments, profiles, dedupe)
    return _roster(listed, memberships, users)


def _roster(listed: DataFrame, memberships: DataFrame, users: DataFrame) -> DataFrame:
    members = _members(memberships).join(listed, "group_id")
    return members.join(short_profiles(users), "user_id").select(
        "page",
        "pos",
        "group_id",
        "group_name",
        "member_page",
        "member_pos",
        "user_id",
        "user_name",
        "email",
        "display_name",
    )


def group_roster(
    assignments: DataFrame,
    memberships: DataFrame,
    profiles: DataFrame,
    users: DataFrame,
    dedupe: bool = False,
) -> DataFrame:
    """One row per assignment and known member; unknown members are dropped."""
    roster = roster_in_order(assignments, memberships, profiles, users, dedupe)
    return roster.drop("member_page", "member_pos")


def group_summary(
    assignments: DataFrame,
    memberships: DataFrame,
    profiles: DataFrame,
    users: DataFrame,
    dedupe: bool = False,
) -> DataFrame:
    """Known members per assignment, zero included.

    Members are counted once per group, then the counts go to the assignments:
    listing a group again does not repeat the work on its members.
    """
    ids = distinct_principals(assignments, "GROUP", "group_id")
    counts = (
        _members(memberships)
        .join(ids, "group_id")
        .join(_known_ids(users), "user_id")
        .groupBy("group_id")
        .agg(F.count("*").alias("user_count"))
    )
    listed = assigned_groups(assignments, profiles, dedupe)
    return _with_count(listed.join(counts, "group_id", "left"))


def _with_count(listed: DataFrame) -> DataFrame:
    count = F.coalesce("user_count", F.lit(0)).alias("user_count")
    return listed.select("page", "pos", "group_id", "group_name", count)


def group_totals(
    assignments: DataFrame,
    memberships: DataFrame,
    profiles: DataFrame,
    users: DataFrame,
    dedupe: bool = False,
) -> DataFrame:
    """Sum of all group sizes, and the distinct users behind it.

    Members are added up per user on the map side before anything is shuffled,
    so a user who is in most groups is one row by the time of the lookup.
    """
    listed = principals(assignments, "GROUP").withColumnRenamed("principal_id", "group_id")
    times = F.lit(1).cast("bigint") if dedupe else F.count("*")
    times = listed.groupBy("group_id").agg(times.alias("times"))
    times = _checked(times.join(profiles, "group_id", "left"))
    per_user = (
        _members(memberships)
        .join(times, "group_id")
        .groupBy("user_id")
        .agg(F.sum("times").alias("times"))
    )
    return per_user.join(_known_ids(users), "user_id").agg(
        F.coalesce(F.sum("times"), F.lit(0)).alias("total_users"),
        F.count("*").alias("distinct_users"),
    )


def group_nested(
    assignments: DataFrame,
    memberships: DataFrame,
    profiles: DataFrame,
    users: DataFrame,
    pages_per_row: int = PAGES_PER_ROW,
    dedupe: bool = False,
) -> DataFrame:
    """The roster with users as an array, see :func:`nested`."""
    listed = _listed(assignments, profiles, dedupe)
    return nested(_checked(listed), _roster(listed, memberships, users), pages_per_row)


def group_report(
    assignments: DataFrame,
    memberships: DataFrame,
    profiles: DataFrame,
    users: DataFrame,
    dedupe: bool = False,
) -> DataFrame:
    """The access report as ordered lines, see :func:`report`."""
    listed = _listed(assignments, profiles, dedupe)
    return report(_checked(listed), _roster(listed, memberships, users))


def _pages(roster: DataFrame, pages_per_row: int) -> DataFrame:
    """Members of consecutive landed pages as one list, for each assignment.

    A landed page is bounded by the service, so a list is bounded too, without
    anyone knowing how large the group is. Collecting cannot shrink rows on the
    map side, so they are moved as they are. Whatever reads lists and counts from
    this goes through one exchange, as both need all of it.
    """
    entry = F.struct(
        "member_page", "member_pos", "user_id", "user_name", "email", "display_name"
    )
    place = ["page", "pos", "chunk"]
    return (
        roster.withColumn("chunk", F.floor(F.col("member_page") / pages_per_row))
        .select(*place, entry.alias("entry"))
        .repartition(*place)
        .groupBy(*place)
        .agg(F.sort_array(F.collect_list("entry")).alias("entries"))
    )


def _counted(listed: DataFrame, pages: DataFrame) -> DataFrame:
    counts = pages.groupBy("page", "pos").agg(
        F.sum(F.size("entries")).alias("user_count")
    )
    return _with_count(listed.join(counts, ["page", "pos"], "left"))


def nested(
    listed: DataFrame, roster: DataFrame, pages_per_row: int = PAGES_PER_ROW
) -> DataFrame:
    """The ordered roster with users as an array, in listing order.

    A row holds the members of ``pages_per_row`` consecutive landed pages of one
    assignment, numbered by ``chunk``: read in that order, the rows of a group
    are its listing, at every size. A group without members is one row.
    """
    head = ["page", "pos", "group_id", "group_name", "user_count"]
    pages = _pages(roster, pages_per_row)
    summary = _counted(listed, pages)
    filled = pages.join(summary, ["page", "pos"]).select(
        *head, "chunk", _without_place("entries")
    )
    empty = summary.where(F.col("user_count") == 0).select(
        *head,
        F.lit(0).cast("bigint").alias("chunk"),
        F.array().cast(filled.schema["users"].dataType).alias("users"),
    )
    return filled.unionByName(empty)


def _without_place(entries: str) -> Column:
    fields = ("user_id", "user_name", "email", "display_name")
    return F.transform(entries, lambda e: F.struct(*(e[f].alias(f) for f in fields))).alias("users")


def summary_of(listed: DataFrame, roster: DataFrame) -> DataFrame:
    """What :func:`group_summary` gives, where the roster is at hand."""
    counts = roster.groupBy("page", "pos").agg(F.count("*").alias("user_count"))
    return _with_count(listed.join(counts, ["page", "pos"], "left"))


def totals(roster: DataFrame) -> DataFrame:
    """What :func:`group_totals` gives, where the roster is at hand."""
    return roster.agg(
        F.count("*").alias("total_users"), F.count_distinct("user_id").alias("distinct_users")
    )


def report(
    listed: DataFrame, roster: DataFrame, pages_per_row: int = PAGES_PER_ROW
) -> DataFrame:
    """Totals, then a block per assignment, as lines in order.

    ``line`` is the text; the other columns are its place. Members keep the
    order of their group's listing.
    """
    pages = _pages(roster, pages_per_row)
    summary = _counted(listed, pages)
    total = pages.agg(F.coalesce(F.sum(F.size("entries")), F.lit(0)).alias("total_users"))
    title = total.select(
        F.lit(None).cast("int").alias("page"),
        F.lit(None).cast("int").alias("pos"),
        F.inline(
            _lines(
                _TITLE,
                F.lit(""),
                F.lit("Group Access Summary:"),
                F.lit(RULE),
                F.format_string(TOTAL_LINE, "total_users"),
                F.lit(""),
                F.lit(GROUPS_LINE),
            )
        ),
    )
    head = _lines(
        _NAME,
        F.lit(""),
        F.format_string(NAME_LINE, "group_name"),
        F.format_string(ID_LINE, "group_id"),
        F.format_string(COUNT_LINE, "user_count"),
        F.lit(""),
        F.lit(USERS_LINE),
    )
    blocks = summary.select(
        "page", "pos", F.inline(F.concat(head, _lines(_END, F.lit(RULE))))
    )
    members = pages.select("page", "pos", F.inline("entries")).select(
        "page",
        "pos",
        F.lit(_USER).alias("part"),
        F.col("member_page").alias("major"),
        F.col("member_pos").alias("minor"),
        user_line(F.col("display_name"), F.col("email")).alias("line"),
    )
    lines = title.unionByName(blocks).unionByName(members)
    return lines.orderBy(*(F.col(c).asc_nulls_first() for c in lines.columns if c != "line"))


def _lines(part: int, *texts: Column) -> Column:
    return F.array(
        *(
            F.struct(
                F.lit(part).alias("part"),
                F.lit(number).alias("major"),
                F.lit(0).alias("minor"),
                text.alias("line"),
            )
            for number, text in enumerate(texts)
        )
    )
