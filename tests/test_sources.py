"""Readers over files written by hand."""

import datetime
import json

import inputs
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seatwise.functions.sql import register_sql_functions
from seatwise.functions.text import strip_blanks, uri_bucket, uri_key
from seatwise.schemas import USAGE
from seatwise.sources import directory, usage_files, user_list


def put(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_bytes(text.encode())
    return str(folder)


def first_three(df):
    return {tuple(r)[:3] for r in df.collect()}


def test_usage_text_has_no_quoting_and_keeps_blank_apart_from_missing(spark, tmp_path):
    lines = [
        "userid,act_date,chat_aicodelines",
        '"u1",03-01-2025,5',
        "u2,,",
        "\\N,\\N,\\N",
        "u4,03-03-2025",
        ",03-06-2025,9",
        "u7,03-07-2025,abc",
        'u8,03-08-2025,"8"',
        "u9",
        "u10,03-10-2025,99999999999",
        " u11 ,03-11-2025,-3",
    ]
    path = put(tmp_path / "usage", "a.csv", "\n".join(lines) + "\n")
    assert first_three(usage_files.read_usage_text(spark, path)) == {
        ('"u1"', "03-01-2025", 5),
        ("u2", "", None),
        (None, None, None),
        ("u4", "03-03-2025", None),
        ("", "03-06-2025", 9),
        ("u7", "03-07-2025", None),
        ("u8", "03-08-2025", None),
        ("u9", None, None),
        ("u10", "03-10-2025", None),
        (" u11 ", "03-11-2025", -3),
    }


def test_usage_text_goes_by_position_and_drops_surplus_fields(spark, tmp_path):
    counters = len(USAGE.fields) - 2
    full = ",".join(["u1", "d", *(str(i) for i in range(counters))])
    holed = ",".join(["u2", "d", *("x" if i == 1 else str(i) for i in range(counters))])
    path = put(tmp_path / "usage", "a.csv", f"any header\n{full},77,88\n{holed}\n")
    rows = {r["userid"]: tuple(r)[2:] for r in usage_files.read_usage_text(spark, path).collect()}
    assert rows["u1"] == tuple(range(counters))
    assert rows["u2"] == (0, None, *range(2, counters))


def test_usage_text_header_goes_once_per_file_and_only_there(spark, tmp_path):
    folder = tmp_path / "usage"
    put(folder, "a.csv", "userid,act_date\r\nu1,a\r\nuserid,act_date\r\n")
    path = put(folder, "b.csv", "userid,act_date\nu2,b\n")
    schema = T.StructType(USAGE.fields[:2])
    rows = usage_files.read_usage_text(spark, path, schema).collect()
    assert {tuple(r) for r in rows} == {("u1", "a"), ("userid", "act_date"), ("u2", "b")}


def test_usage_text_includes_dated_subfolders(spark, tmp_path):
    folder = tmp_path / "usage"
    put(folder, "a.csv", "h\nu1,03-01-2025,1\n")
    put(folder / "2025" / "03" / "02", "b.csv", "h\nu1,03-02-2025,2\n")
    put(folder / "2025" / "03" / "03", "c.csv", "h\nu1,03-03-2025,4\n")
    table = usage_files.read_usage_text(spark, str(folder))
    assert table.agg(F.sum("chat_aicodelines")).first()[0] == 7


def test_usage_text_parses_counters_only_when_asked(spark, tmp_path):
    path = put(tmp_path / "usage", "a.csv", "h\nu1,03-01-2025,1\n")
    table = usage_files.read_usage_text(spark, path)
    days = table.select("userid", "act_date")._jdf.queryExecution().executedPlan().toString()
    assert "from_csv" not in days


def test_usage_text_is_split_without_losing_lines(spark, tmp_path):
    n = 5000
    text = "h\n" + "".join(f"u{i},03-01-2025,{i}\n" for i in range(n))
    path = put(tmp_path / "usage", "a.csv", text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        table = usage_files.read_usage_text(spark, path)
        assert table.select(F.spark_partition_id()).distinct().count() > 3
        assert table.agg(F.sum("chat_aicodelines")).first()[0] == n * (n - 1) // 2
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_text_columns_may_stand_anywhere(spark, tmp_path):
    schema = "n int, who string, m int, note string"
    text = "h\n1,u1,2,a b\nx,\\N,,\n7,u2\n 3,u3,4,c,more\n"
    path = put(tmp_path / "u", "a", text)
    rows = usage_files.read_usage_text(spark, path, T.StructType.fromDDL(schema)).collect()
    assert {tuple(r) for r in rows} == {
        (1, "u1", 2, "a b"),
        (None, None, None, ""),
        (7, "u2", None, None),
        (None, "u3", 4, "c"),
    }


def test_user_list(spark, tmp_path):
    text = 'id,date\n"\tu1 ","a, b"\n\nu2,x\nu3\n"u""4","two\nlines"\nu2,x\n'
    path = put(tmp_path / "list", "a.csv", text)
    rows = sorted(tuple(r) for r in user_list.read_user_list(spark, path, True).collect())
    assert rows == sorted(
        [("u1", "a, b"), ("u2", "x"), ("u2", "x"), ("u3", None), ('u"4', "two\nlines")],
        key=lambda r: r[0],
    )


def test_a_large_user_list_is_split(spark, tmp_path):
    path = put(tmp_path / "list", "a.csv", "id,date\n" + "u1,03-01-2025\n" * 60_000)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100KB")
    try:
        listed = user_list.read_user_list(spark, path)
        assert listed.rdd.getNumPartitions() > 3
        assert listed.count() == 60_000
        assert user_list.read_user_list(spark, path, True).rdd.getNumPartitions() == 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_strip_takes_every_blank_off_both_ends(spark):
    df = spark.createDataFrame([("\t  a b　\r\n",), ("",), (None,)], "s string")
    assert [r[0] for r in df.select(strip_blanks(F.col("s"))).collect()] == ["a b", "", None]


def test_uri_parts(spark):
    rows = [("s3://b/k/e/y.csv",), ("s3://b/",), ("b/k",), ("s3://b",)]
    df = spark.createDataFrame(rows, "u string")
    got = df.select(uri_bucket(F.col("u")), uri_key(F.col("u"))).collect()
    assert [tuple(r) for r in got] == [("b", "k/e/y.csv"), ("b", ""), ("b", "k"), ("b", None)]


def test_assignment_pages(spark, tmp_path):
    def page(number, entries):
        body = {"page": number, "NextToken": "t"}
        if entries is not None:
            body["ApplicationAssignments"] = [
                {"PrincipalType": kind, "PrincipalId": who} for kind, who in entries
            ]
        return json.dumps(body) + "\n"

    folder = tmp_path / "assignments"
    put(
        folder / "application_arn=a1",
        "1.json",
        page(0, [("USER", "u1"), ("GROUP", "g1")]) + page(1, None) + page(2, []),
    )
    put(folder / "application_arn=a1", "2.json", page(3, [("USER", "u1")]))
    put(folder / "application_arn=a2", "1.json", page(0, [("USER", "u9")]))
    result = directory.read_assignments(spark, str(folder), "a1").drop("application_arn")
    assert sorted(tuple(r) for r in result.collect()) == [
        (0, 0, "USER", "u1"),
        (0, 1, "GROUP", "g1"),
        (3, 0, "USER", "u1"),
    ]
    assert directory.read_assignments(spark, str(folder)).count() == 4
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(application_arn" in plan


def test_a_page_needs_its_number_only_where_the_place_counts(spark, tmp_path):
    entry = {"PrincipalType": "USER", "PrincipalId": "u1"}
    page = json.dumps({"application_arn": "a1", "ApplicationAssignments": [entry]}) + "\n"
    result = directory.read_assignments(spark, put(tmp_path / "a", "p.json", page))
    assert result.select("principal_id").collect()[0][0] == "u1"
    with pytest.raises(PySparkException, match="no page number"):
        result.collect()


def test_the_first_listed_instance_names_the_store(spark, tmp_path):
    listed = {"Instances": [{"IdentityStoreId": "d-7"}, {"IdentityStoreId": "d-1"}]}
    some = put(tmp_path / "some", "i.json", json.dumps(listed) + "\n")
    none = put(tmp_path / "none", "i.json", json.dumps({"Instances": []}) + "\n")
    assert directory.first_store(spark, some) == "d-7"
    assert directory.first_store(spark, none) is None


def test_list_files_need_page_numbers_and_a_first_store(spark, tmp_path):
    def instances(page, *ids):
        body = {"Instances": [{"IdentityStoreId": i} if i else {} for i in ids]}
        return json.dumps(body | ({} if page is None else {"page": page})) + "\n"

    put(tmp_path / "paged", "b.json", instances(0, "d-0", "d-5"))
    paged = put(tmp_path / "paged", "a.json", instances(1, "d-9"))
    assert directory.first_store(spark, paged) == "d-0"
    put(tmp_path / "bare", "a.json", instances(None, "d-1"))
    bare = put(tmp_path / "bare", "b.json", instances(None, "d-2"))
    with pytest.raises(ValueError, match="page numbers"):
        directory.first_store(spark, bare)
    blank = put(tmp_path / "blank", "a.json", instances(0, None, "d-2"))
    with pytest.raises(ValueError, match="no identity store"):
        directory.first_store(spark, blank)


def user(uid, **more):
    return json.dumps({"UserId": uid, "UserName": uid, "Emails": []} | more) + "\n"


def test_directory_snapshots_come_from_the_store_named(spark, tmp_path):
    def group(gid):
        return json.dumps({"GroupId": gid, "Group": {"DisplayName": gid.upper()}}) + "\n"

    def members(gid, *uids):
        entries = [{"MemberId": {"UserId": u}} for u in uids]
        return json.dumps({"GroupId": gid, "page": 0, "GroupMemberships": entries}) + "\n"

    users, groups, joined = tmp_path / "users", tmp_path / "groups", tmp_path / "members"
    for store, mark in (("d-2", "z"), ("d-1", "a")):
        put(users / f"identity_store_id={store}", "u.json", user(f"{mark}1") + user(f"{mark}2"))
        put(groups / f"identity_store_id={store}", "g.json", group(f"g{mark}"))
        put(joined / f"identity_store_id={store}", "m.json", members(f"g{mark}", "x", "y"))
    read = directory.read_users(spark, str(users), "d-1")
    assert sorted(r["user_id"] for r in read.collect()) == ["a1", "a2"]
    assert read.first()["emails"] == []
    assert directory.read_users(spark, str(users), "d-3").isEmpty()
    found = directory.read_groups(spark, str(groups), "d-1").collect()
    assert [tuple(r) for r in found] == [("ga", "GA")]
    rows = directory.read_memberships(spark, str(joined), "d-1").collect()
    assert sorted(tuple(r) for r in rows) == [("ga", 0, 0, "x"), ("ga", 0, 1, "y")]
    with pytest.raises(ValueError, match="several identity stores are landed, name one: d-1, d-2"):
        directory.read_users(spark, str(users))


def test_the_store_may_stand_in_the_object_but_has_to_stand_somewhere(spark, tmp_path):
    whole = put(tmp_path / "whole", "u.json", user("a", IdentityStoreId="d-1"))
    assert [r["user_id"] for r in directory.read_users(spark, whole).collect()] == ["a"]
    assert directory.read_users(spark, whole, "d-1").count() == 1
    for name, text in (
        ("none", user("a") + user("b")),
        ("some", user("a", IdentityStoreId="d-1") + user("b")),
    ):
        path = put(tmp_path / name, "u.json", text)
        with pytest.raises(ValueError, match="no identity store id"):
            directory.read_users(spark, path)
        with pytest.raises(PySparkException, match="no identity store id"):
            directory.read_users(spark, path, "d-1").count()


def test_a_profile_landed_twice_is_named(spark, tmp_path):
    from seatwise.operators import access

    store = {"IdentityStoreId": "d-1"}
    once = put(tmp_path / "once", "u.json", user("a", **store) + user("b", **store))
    put(tmp_path / "twice", "1.json", user("a", **store) + user("b", **store))
    twice = put(tmp_path / "twice", "2.json", user("b", **store, DisplayName="newer"))
    assigned = inputs.assignments(spark, (1, 0, "USER", "a"), (1, 1, "USER", "b"))
    counts = access.direct_user_count(assigned, directory.read_users(spark, once))
    assert tuple(counts.first()) == (2, 2)
    for read in (lambda df: df.count(), lambda df: df.select("user_name").collect()):
        with pytest.raises(PySparkException, match="landed more than once: user_id b"):
            read(directory.read_users(spark, twice))
    group = json.dumps({"GroupId": "g", "Group": {"DisplayName": "G"}, **store}) + "\n"
    path = put(tmp_path / "groups", "g.json", group + group)
    with pytest.raises(PySparkException, match="landed more than once: group_id g"):
        directory.read_groups(spark, path).collect()


def test_incomplete_landings_are_named(spark):
    def problems(*pages):
        rows = [("g", page, token) for page, token in pages]
        df = spark.createDataFrame(rows, "GroupId string, page int, NextToken string")
        found = directory.incomplete_landings(df, "GroupId").collect()
        return [r["problem"] for r in found]

    assert problems((0, "t"), (1, "t"), (2, None)) == []
    assert problems((1, "t"), (2, "")) == []
    assert problems((0, None)) == []
    assert problems((2, "t"), (3, None)) == ["first page missing"]
    assert problems((0, "t"), (2, None)) == ["page missing"]
    assert problems((0, "t"), (0, "t"), (1, None)) == ["page repeated"]
    assert problems((0, "t"), (1, "t")) == ["last page missing"]
    assert problems((0, None), (1, None)) == ["token missing"]
    assert problems((None, None)) == ["no page number"]


def test_datetime_patterns_of_the_query_service(spark):
    register_sql_functions(spark)
    for text, pattern in (
        ("20250301", "YYYYMMdd"),
        ("Mar-1-2025", "MMM-dd-YYYY"),
        ("March 1 2025", "MMMM dd YYYY"),
        ("3-1-2025", "MM-dd-YYYY"),
        ("03-01-2025", "MM-dd-YYYY"),
        ("2025/3/1", "YYYY/MM/dd"),
    ):
        row = spark.sql(f"SELECT parse_datetime('{text}', '{pattern}')").first()
        assert row[0] == datetime.datetime(2025, 3, 1), pattern


def test_losses_are_counted_by_column_in_the_converting_pass(spark, tmp_path):
    schema = type(USAGE)(USAGE.fields[:4])
    lines = ["u,d,a,b", "u1,d,1,2", "u2,d,x,\\N", "u3,d", "u4,d,,99999999999", "u5,d,1,2,3,4", "u6,d,1.5,y"]
    text = put(tmp_path / "text", "a.csv", "\n".join(lines) + "\n")
    out = str(tmp_path / "out")
    rows = usage_files.read_usage_text(spark, text, schema, with_source=True, with_lost=True)
    assert rows._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    usage_files.write_usage_parquet(rows, out)
    counted = {(r["measure"], r["column"]): r["n"] for r in usage_files.read_losses(spark, out).collect()}
    a, b = schema.names[2:]
    assert counted == {
        ("rows", None): 6, ("short rows", None): 1, ("missing fields", None): 2,
        ("rows with surplus", None): 1, ("surplus fields", None): 2,
        ("failed", a): 2, ("failed", b): 2,
    }
    back = spark.read.parquet(out)
    assert back.count() == 6 and usage_files.LOST not in back.columns
    usage_files.write_usage_parquet(rows, out, "append")
    assert usage_files.read_losses(spark, out).where("measure = 'rows'").first()["n"] == 12
