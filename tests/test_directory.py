"""Access and group semantics over small directories."""

import inputs
import pytest
from inputs import FIRST, PRIMARY
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from seatwise.functions.emails import primary_or_blank
from seatwise.operators import access, enrich, groups


@pytest.fixture(scope="module")
def mail_users(spark):
    return inputs.users(
        spark, ("none", None), ("empty", []), ("one", [FIRST]), ("two", [FIRST, PRIMARY])
    )


def test_primary_address_or_blank(mail_users):
    result = mail_users.select("user_id", primary_or_blank(F.col("emails")))
    assert dict(inputs.collected(result)) == {"none": "", "empty": "", "one": "", "two": "b@x"}


def test_primary_without_mark_or_value(spark):
    users = inputs.users(spark, ("u", [("a", None), (None, True), ("c", True)]))
    assert users.select(primary_or_blank(F.col("emails"))).first()[0] == ""


def test_first_address_and_unusable_profiles(mail_users):
    result = access.short_profiles(mail_users).select("user_id", "email")
    assert dict(inputs.collected(result)) == {"none": None, "one": "a@x", "two": "a@x"}


def test_direct_users_are_distinct_known_and_blank_filled(spark):
    users = spark.createDataFrame(
        [("u1", None, None, None, None), ("g1", "n", "d", None, None)], inputs.USERS
    )
    assigned = inputs.assignments(
        spark,
        (1, 0, "USER", "u1"),
        (1, 1, "USER", "gone"),
        (2, 0, "USER", "u1"),
        (2, 1, "GROUP", "g1"),
        (2, 2, "USER", None),
    )
    result = access.direct_users(assigned, users)
    assert inputs.collected(result) == [("u1", "", "", "", "", "")]
    counts = access.direct_user_count(assigned.where("principal_id IS NOT NULL"), users)
    assert tuple(counts.first()) == (2, 1)


def test_enrich_keeps_copies_and_unknown_users(spark):
    listed = spark.createDataFrame(
        [("u1", "d1"), ("u1", "d1"), ("gone", "d2"), ("nomail", "d3")],
        "user_id string, last_activity_date string",
    )
    users = inputs.users(spark, ("u1", [FIRST]), ("nomail", []))
    result = enrich.enrich_activity(listed, users)
    known = ("u1", "name-u1", "a@x", "Shown u1", "d1")
    assert {tuple(r) for r in result.collect()} == {
        known,
        ("gone", None, None, None, None),
        ("nomail", None, None, None, None),
    }
    assert [tuple(r) for r in result.collect()].count(known) == 2
    dated = enrich.enrich_activity(listed, users, keep_date=True)
    assert {r["last_activity_date"] for r in dated.collect()} == {"d1", "d2", "d3"}


def test_known_user_with_empty_profile_keeps_the_date(spark):
    listed = spark.createDataFrame([("u", "d")], "user_id string, last_activity_date string")
    users = spark.createDataFrame([("u", None, None, None, None)], inputs.USERS)
    assert tuple(enrich.enrich_activity(listed, users).first()) == ("u", None, None, None, "d")


def test_effective_users_join_both_ways_in(spark):
    assigned = inputs.assignments(
        spark,
        (1, 0, "USER", "u1"),
        (1, 1, "USER", "u2"),
        (1, 2, "GROUP", "g1"),
        (1, 3, "GROUP", "unlisted"),
    )
    members = inputs.memberships(spark, ("g1", "u2"), ("g1", "gone"), ("g1", "gone"), ("g9", "u9"))
    users = inputs.users(spark, ("u1", [FIRST]), ("u2", None), ("u9", None))
    result = access.effective_users(assigned, members, users)
    assert {tuple(r) for r in result.collect()} == {
        ("u1", "name-u1", "a@x", "Shown u1"),
        ("u2", "name-u2", None, "Shown u2"),
        ("gone", None, None, None),
    }
    assert result.count() == 3


@pytest.fixture(scope="module")
def team(spark):
    """g1 assigned twice with a member unknown, g2 assigned without members."""
    return (
        inputs.assignments(
            spark,
            (1, 0, "GROUP", "g1"),
            (1, 1, "USER", "u9"),
            (1, 2, "GROUP", "g2"),
            (2, 0, "GROUP", "g1"),
        ),
        inputs.memberships(spark, ("g1", "u2"), ("g1", "u1"), ("g1", "gone"), ("g3", "u9")),
        inputs.profiles(spark, "g1", "g2", "g3"),
        inputs.users(spark, ("u1", [FIRST]), ("u2", None), ("u9", None)),
    )


def test_groups_assigned_twice_count_twice(team):
    assert inputs.collected(groups.group_summary(*team)) == [
        (1, 0, "g1", "G1", 2),
        (1, 2, "g2", "G2", 0),
        (2, 0, "g1", "G1", 2),
    ]
    assert tuple(groups.group_totals(*team).first()) == (4, 2)
    roster = groups.group_roster(*team).select("page", "pos", "user_id")
    assert inputs.collected(roster) == [(1, 0, "u1"), (1, 0, "u2"), (2, 0, "u1"), (2, 0, "u2")]


def test_results_from_a_kept_roster_are_the_same(team):
    listed = groups.assigned_groups(team[0], team[2])
    roster = groups.roster_in_order(*team)
    assert inputs.collected(groups.summary_of(listed, roster)) == inputs.collected(
        groups.group_summary(*team)
    )
    assert groups.totals(roster).collect() == groups.group_totals(*team).collect()
    kept = groups.nested(listed, roster)
    assert sorted(kept.collect()) == sorted(groups.group_nested(*team).collect())
    assert groups.report(listed, roster).collect() == groups.group_report(*team).collect()
    none = roster.where("user_id IS NULL")
    assert tuple(groups.totals(none).first()) == (0, 0)


def test_a_group_assigned_twice_can_be_listed_once(team):
    assert inputs.collected(groups.group_summary(*team, dedupe=True)) == [
        (1, 0, "g1", "G1", 2),
        (1, 2, "g2", "G2", 0),
    ]
    assert tuple(groups.group_totals(*team, dedupe=True).first()) == (2, 2)
    assert groups.group_roster(*team, dedupe=True).count() == 2
    assert len(groups.group_nested(*team, dedupe=True).collect()) == 2
    assert groups.group_report(*team, dedupe=True).collect()[3]["line"].endswith(" 2")


def test_members_listed_twice_count_twice(spark, team):
    assigned, _, names, users = team
    members = inputs.memberships(spark, ("g1", "u1"), ("g1", "u1"))
    assert groups.group_summary(assigned, members, names, users).first()["user_count"] == 2
    assert tuple(groups.group_totals(assigned, members, names, users).first()) == (4, 1)


def test_nested_view_keeps_listing_order_and_empty_groups(team):
    nested = groups.group_nested(*team).collect()
    by_place = {(r["page"], r["pos"]): [u["user_id"] for u in r["users"]] for r in nested}
    assert by_place == {(1, 0): ["u2", "u1"], (1, 2): [], (2, 0): ["u2", "u1"]}
    assert nested[0]["users"][0].asDict().keys() == {
        "user_id",
        "user_name",
        "email",
        "display_name",
    }


def test_rows_of_a_big_group_are_its_listing(spark):
    n = 950
    assigned = inputs.assignments(spark, (1, 0, "GROUP", "g1"))
    who = [f"u{i * 7 % 400}" for i in range(n)]
    members = inputs.memberships(spark, *(("g1", u) for u in who)).repartition(7)
    users = inputs.users(spark, *((f"u{i}", None) for i in range(400)))
    names = inputs.profiles(spark, "g1")
    for pages, rows_expected in ((1, 10), (3, 4), (10, 1)):
        rows = groups.group_nested(assigned, members, names, users, pages_per_row=pages).collect()
        rows.sort(key=lambda r: r["chunk"])
        assert {r["user_count"] for r in rows} == {n}
        assert [r["chunk"] for r in rows] == list(range(rows_expected))
        assert [u["user_id"] for r in rows for u in r["users"]] == who


@pytest.mark.parametrize("read", [lambda df: df.count(), lambda df: df.select("pos").collect()])
def test_an_unknown_group_fails_whichever_columns_are_read(spark, team, read):
    _, members, names, users = team
    assigned = inputs.assignments(spark, (1, 0, "GROUP", "g1"))
    data = (assigned, members, names.where("group_id <> 'g1'"), users)
    for analysis in (groups.group_roster, groups.group_summary, groups.roster_in_order):
        with pytest.raises(PySparkException, match="no profile for assigned group g1"):
            read(analysis(*data))


@pytest.mark.parametrize("with_members", [True, False])
@pytest.mark.parametrize(
    "analysis",
    [
        groups.group_roster,
        groups.group_summary,
        groups.group_totals,
        groups.group_nested,
        groups.group_report,
    ],
)
def test_unknown_group_is_named_in_an_error(spark, team, analysis, with_members):
    _, members, names, users = team
    group = "g9" if not with_members else "g1"
    assigned = inputs.assignments(spark, (1, 0, "GROUP", group))
    with pytest.raises(PySparkException, match=f"no profile for assigned group {group}"):
        analysis(assigned, members, names.where(F.col("group_id") != group), users).collect()


def test_no_groups_give_zero_totals(spark, team):
    _, members, names, users = team
    none = inputs.assignments(spark, (1, 0, "USER", "u1"))
    assert tuple(groups.group_totals(none, members, names, users).first()) == (0, 0)
    lines = [r["line"] for r in groups.group_report(none, members, names, users).collect()]
    assert lines[3] == "Total Users Across All Groups: 0"
    assert len(lines) == 6


def test_report_text(team):
    lines = [r["line"] for r in groups.group_report(*team).collect()]
    rule = "-" * 39
    assert lines[:14] == [
        "",
        "Group Access Summary:",
        rule,
        "Total Users Across All Groups: 4",
        "",
        "Group Details:",
        "",
        "Group Name: G1",
        "Group ID: g1",
        "Number of Users: 2",
        "",
        "Users in this group:",
        "- Shown u2 (None)",
        "- Shown u1 (a@x)",
    ]
    assert lines[14] == rule
    assert lines[15:22] == [
        "",
        "Group Name: G2",
        "Group ID: g2",
        "Number of Users: 0",
        "",
        "Users in this group:",
        rule,
    ]
    assert len(lines) == 6 + 3 * 7 + 4
