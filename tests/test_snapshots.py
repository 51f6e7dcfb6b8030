"""A directory as it stood on a day."""

import json

import pytest
from pyspark.errors import PySparkException

from seatwise.sources import directory


def land(folder, kind, day, *objects):
    place = folder / f"kind={kind}" / f"landed={day}"
    place.mkdir(parents=True, exist_ok=True)
    text = "".join(json.dumps({"IdentityStoreId": "d-1", **o}) + "\n" for o in objects)
    (place / "part.json").write_text(text)


def user(i, name, **more):
    return {"UserId": i, "UserName": name, **more}


@pytest.fixture
def landings(tmp_path):
    land(tmp_path, "full", "2025-03-01", user("a", "a1"), user("b", "b1"), user("c", "c1"))
    land(tmp_path, "changes", "2025-03-02", user("a", "a2"), user("d", "d2"))
    land(tmp_path, "changes", "2025-03-03", user("b", None, Removed=True))
    land(tmp_path, "full", "2025-03-05", user("a", "a5"), user("b", "b5"), user("e", "e5"))
    land(tmp_path, "changes", "2025-03-05", user("e", "later that day"))
    land(tmp_path, "changes", "2025-03-07", user("a", None, Removed=True), user("b", "b7", Removed=False))
    land(tmp_path, "changes", "2025-03-08", user("a", "back"))
    return str(tmp_path)


@pytest.mark.parametrize(
    "day,names",
    [
        ("2025-03-01", {"a": "a1", "b": "b1", "c": "c1"}),
        ("2025-03-02", {"a": "a2", "b": "b1", "c": "c1", "d": "d2"}),
        ("2025-03-04", {"a": "a2", "c": "c1", "d": "d2"}),
        ("2025-03-05", {"a": "a5", "b": "b5", "e": "later that day"}),
        ("2025-03-07", {"b": "b7", "e": "later that day"}),
        ("2026-01-01", {"a": "back", "b": "b7", "e": "later that day"}),
    ],
)
def test_state_on_a_day(spark, landings, day, names):
    rows = directory.read_users(spark, landings, "d-1", as_of=day).collect()
    assert {r["user_id"]: r["user_name"] for r in rows} == names and len(rows) == len(names)


def test_groups_as_of_a_day(spark, tmp_path):
    name = lambda n: {"GroupId": "g", "Group": {"DisplayName": n}}
    land(tmp_path, "full", "2025-03-01", name("old"))
    land(tmp_path, "changes", "2025-03-02", name("new"))
    for day, shown in (("2025-03-01", "old"), ("2025-03-02", "new")):
        rows = directory.read_groups(spark, str(tmp_path), as_of=day).collect()
        assert [tuple(r) for r in rows] == [("g", shown)]


def test_no_whole_landing_and_an_id_twice_in_one(spark, landings, tmp_path):
    with pytest.raises(ValueError, match="no whole landing up to 2025-02-28"):
        directory.read_users(spark, landings, "d-1", as_of="2025-02-28")
    land(tmp_path / "twice", "full", "2025-03-01", user("a", "x"), user("a", "y"))
    with pytest.raises(PySparkException, match="landed more than once: user_id a"):
        directory.read_users(spark, str(tmp_path / "twice"), "d-1", as_of="2025-03-01").collect()


def test_other_days_are_not_read(spark, landings):
    plan = directory.read_users(spark, landings, "d-1", as_of="2025-03-06")._jdf.queryExecution()
    text = plan.executedPlan().toString()
    filters = text[text.index("PartitionFilters") :].split("]")[0]
    assert "(landed" in filters and "2025-03-05" in filters and "DataFilters: [is" in text
    # The last object of an id is looked for before any row moves.
    assert text.count("WindowGroupLimit") == 2
