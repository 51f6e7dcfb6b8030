"""Small hand-made inputs in the engine's schemas."""

from __future__ import annotations

from seatwise.schemas import USAGE

USERS = (
    "user_id string, user_name string, display_name string, "
    "name struct<GivenName:string,FamilyName:string>, "
    "emails array<struct<Value:string,Primary:boolean>>"
)
ASSIGNMENTS = "page int, pos int, principal_type string, principal_id string"
MEMBERSHIPS = "group_id string, page int, pos int, user_id string"
PROFILES = "group_id string, group_name string"

FIRST = ("a@x", False)
PRIMARY = ("b@x", True)


def usage(spark, *records):
    """Each record: user id, day and any counters by name; the others are NULL."""
    rows = []
    for userid, day, *counters in records:
        values = counters[0] if counters else {}
        rows.append((userid, day, *(values.get(f.name) for f in USAGE.fields[2:])))
    return spark.createDataFrame(rows, USAGE)


def users(spark, *records):
    """Each record: user id and its address list."""
    rows = [(u, f"name-{u}", f"Shown {u}", ("Given", "Family"), mails) for u, mails in records]
    return spark.createDataFrame(rows, USERS)


def assignments(spark, *records):
    return spark.createDataFrame(list(records), ASSIGNMENTS)


def memberships(spark, *records):
    """Each record: group id and user id; the place is the record's number."""
    rows = [(g, i // 100, i % 100, u) for i, (g, u) in enumerate(records)]
    return spark.createDataFrame(rows, MEMBERSHIPS)


def profiles(spark, *ids):
    return spark.createDataFrame([(i, i.upper()) for i in ids], PROFILES)


def collected(df):
    return sorted(tuple(r) for r in df.collect())
