"""The jobs end to end, from landed files to exports."""

import csv
import glob
import json
import uuid

import pytest

from seatwise import jobs
from seatwise.sinks import publish
from seatwise.sources import usage_files


def land(folder, name, *objects):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("".join(json.dumps(o) + "\n" for o in objects))


@pytest.fixture(scope="module")
def landed(tmp_path_factory):
    root = tmp_path_factory.mktemp("landed")
    text = root / "text"
    text.mkdir()
    (text / "1.csv").write_text('userid,act_date,x\n"u1",03-01-2025,4\n"u2",03-01-2025,1\n')
    (text / "2.csv").write_text('userid,act_date,x\n"u1",03-02-2025,5\n"u3",03-05-2025,\n')
    entries = [
        {"PrincipalType": "USER", "PrincipalId": "u1"},
        {"PrincipalType": "USER", "PrincipalId": "lost"},
        {"PrincipalType": "GROUP", "PrincipalId": "g1"},
    ]
    land(
        root / "assignments" / "application_arn=app", "p.json",
        {"page": 0, "ApplicationAssignments": entries, "NextToken": "t"},
        {"page": 1, "ApplicationAssignments": [{"PrincipalType": "GROUP", "PrincipalId": "g2"}]},
    )
    store = "identity_store_id=d-1"
    land(
        root / "memberships" / store, "m.json",
        {
            "GroupId": "g1",
            "page": 0,
            "GroupMemberships": [{"MemberId": {"UserId": u}} for u in ("u2", "u1", "nomail")],
        },
    )
    land(
        root / "users" / store, "u.json",
        {
            "UserId": "u1",
            "UserName": "one",
            "DisplayName": "One, First",
            "Name": {"GivenName": "O", "FamilyName": "F"},
            "Emails": [{"Value": "a@x"}, {"Value": "b@x", "Primary": True}],
        },
        {"UserId": "u2", "UserName": "two"},
        {"UserId": "nomail", "UserName": "none", "Emails": []},
    )
    land(root / "two" / "identity_store_id=d-2", "u.json", {"UserId": "u1", "UserName": "no"})
    land(root / "two" / store, "u.json", {"UserId": "u1", "UserName": "one"})
    land(
        root / "groups" / store, "g.json",
        {"GroupId": "g1", "Group": {"DisplayName": "First"}},
        {"GroupId": "g2", "Group": {"DisplayName": "Second"}},
    )
    return root


@pytest.fixture(scope="module")
def run(spark, landed, tmp_path_factory):
    out = tmp_path_factory.mktemp("out")

    def start(job, name, *options, **inputs):
        target = f"{out}/{name}"
        paths = [part for key, value in inputs.items() for part in (f"--{key}", str(value))]
        jobs.main([job, *paths, "--out", target, *options], spark)
        return target

    return start


def read(folder):
    rows = []
    for name in sorted(glob.glob(f"{folder}/part-*.csv")):
        with open(name, newline="") as file:
            rows += list(csv.DictReader(file))
    return rows


@pytest.fixture(scope="module")
def table(run, landed):
    return run("convert-usage", "usage", text=landed / "text")


def test_usage_rollup(run, table):
    rows = read(run("usage-rollup", "rollup", usage=table))
    assert [(r["userid"], r["active_days"], r["total_chat_aicodelines"]) for r in rows] == [
        ('"u1"', "2", "9"),
        ('"u2"', "1", "1"),
        ('"u3"', "1", ""),
    ]


def test_latest_activity_then_enrichment(run, landed, table):
    latest = run("latest-activity", "latest", "--normalize", usage=table)
    expected = [("u3", "2025-03-05"), ("u1", "2025-03-02"), ("u2", "2025-03-01")]
    assert [tuple(r.values()) for r in read(latest)] == expected
    users = landed / "users"
    listed = read(run("enrich-activity", "listed", list=latest, users=users))
    direct = read(run("activity-with-profile", "direct", usage=table, users=users))
    key = lambda r: r["UserId"]
    assert sorted(listed, key=key) == sorted(direct, key=key)
    assert {r["UserId"]: (r["Username"], r["Email"], r["LastActivityDate"]) for r in listed} == {
        "u1": ("one", "a@x", "2025-03-02"),
        "u2": ("two", "", "2025-03-01"),
        "u3": ("", "", ""),
    }


def test_sql_text_over_landed_files(run, landed):
    sql = """
        SELECT DISTINCT replace(userid, '"', '') AS who,
               max(parse_datetime(act_date, 'MM-dd-YYYY')) AS seen
        FROM daily GROUP BY userid ORDER BY seen DESC;
    """
    rows = read(run("query", "query", "--sql", sql, "--view", f"daily={landed / 'text'}"))
    assert [(r["who"], r["seen"][:10]) for r in rows] == [
        ("u3", "2025-03-05"),
        ("u1", "2025-03-02"),
        ("u2", "2025-03-01"),
    ]


def test_usage_by_table_name(spark, run, table):
    spark.read.parquet(table).createOrReplaceTempView("converted")
    rows = read(run("usage-rollup", "by-name", usage="table:converted"))
    assert [r["active_days"] for r in rows] == ["2", "1", "1"]


def test_direct_and_effective_users(run, landed):
    directory = {
        "assignments": landed / "assignments",
        "application": "app",
        "users": landed / "users",
    }
    out = run("direct-users", "direct-users", "--name", "users.csv", **directory)
    assert [tuple(r.values()) for r in read(f"{out}/users.csv")] == [
        ("u1", "one", "b@x", "O", "F", "One, First")
    ]
    members = landed / "memberships"
    rows = read(run("effective-users", "effective", memberships=members, **directory))
    assert {r["user_id"]: r["user_name"] for r in rows} == {
        "u1": "one",
        "u2": "two",
        "lost": "",
        "nomail": "",
    }


def test_store_of_the_first_instance(run, landed, tmp_path):
    land(tmp_path / "two", "i.json", {"Instances": [{"IdentityStoreId": "d-2"}]})
    land(tmp_path / "none", "i.json", {"Instances": []})
    directory = {
        "assignments": landed / "assignments",
        "application": "app",
        "users": landed / "two",
    }
    with pytest.raises(ValueError, match="several identity stores"):
        run("direct-users", "unnamed", "--name", "u", **directory)
    out = run("direct-users", "two", "--name", "u", instances=tmp_path / "two", **directory)
    assert [r["Username"] for r in read(f"{out}/u")] == ["no"]
    out = run("direct-users", "none", "--name", "u", instances=tmp_path / "none", **directory)
    assert not glob.glob(f"{out}/*")


def test_group_access(run, landed):
    out = run(
        "group-access",
        "groups",
        application="app",
        **{k: landed / k for k in ("assignments", "memberships", "groups", "users")},
    )
    counts = sorted((r["group_name"], r["user_count"]) for r in read(f"{out}/summary"))
    assert counts == [("First", "2"), ("Second", "0")]
    assert read(f"{out}/totals") == [{"total_users": "2", "distinct_users": "2"}]
    assert {r["user_id"] for r in read(f"{out}/roster")} == {"u1", "u2"}
    lines = "".join(open(f).read() for f in sorted(glob.glob(f"{out}/report/part-*"))).split("\n")
    assert lines[3] == "Total Users Across All Groups: 2"
    assert lines[12:14] == ["- None (None)", "- One, First (a@x)"]
    assert lines[16] == "Group Name: Second"
    nested = [json.loads(x) for f in glob.glob(f"{out}/nested/part-*") for x in open(f)]
    assert {n["group_id"]: [u["user_id"] for u in n["users"]] for n in nested} == {
        "g1": ["u2", "u1"],
        "g2": [],
    }


def test_files_are_added_once_however_often_they_are_converted(run, landed, tmp_path):
    root = tmp_path / "text"
    (root / "2025-03-01").mkdir(parents=True)
    (root / "2025-03-01" / "a.csv").write_text('userid,act_date,x\n"u1",03-01-2025,5\n')
    grown = run("convert-usage", "grown", text=root)

    def totals(name):
        rows = read(run("usage-rollup", name, usage=grown))
        return [(r["userid"], r["active_days"], r["total_chat_aicodelines"]) for r in rows]

    assert totals("grown-1") == [('"u1"', "1", "5")]
    run("convert-usage", "grown", "--append", text=root)
    assert totals("grown-2") == [('"u1"', "1", "5")]
    (root / "2025-03-09").mkdir()
    (root / "2025-03-09" / "b.csv").write_text('userid,act_date,x\n"u1",03-09-2025,1\n')
    run("convert-usage", "grown", "--append", text=root)
    run("convert-usage", "grown", "--append", text=root)
    assert totals("grown-3") == [('"u1"', "2", "6")]


def test_the_second_usage_table(run, tmp_path):
    root = tmp_path / "log"
    root.mkdir()
    (root / "a.csv").write_text('userid,data\n"u1",3-1-2025\n"u1",3-9-2025\n"u2",3-2-2025\n')
    columns = "userid string, data string"
    table = run("convert-usage", "log", "--schema", columns, text=root)
    latest = read(run("latest-activity", "log-latest", "--day-col", "data", usage=table))
    assert [tuple(r.values()) for r in latest] == [("u1", "2025-03-09"), ("u2", "2025-03-02")]
    sql = "SELECT userid, data FROM seen WHERE data LIKE '3-1%'"
    options = ("--sql", sql, "--view", f"seen={root}", "--schema", f"seen={columns}")
    assert [r["data"] for r in read(run("query", "log-query", *options))] == ["3-1-2025"]


def test_a_landing_in_part_fails_the_job(run, landed, tmp_path):
    entry = [{"PrincipalType": "USER", "PrincipalId": "u1"}]
    for name, pages in (
        ("gap", [{"page": 0, "NextToken": "t"}, {"page": 2}]),
        ("cut", [{"page": 0, "NextToken": "t"}]),
    ):
        folder = tmp_path / name / "application_arn=app"
        land(folder, "p.json", *({**p, "ApplicationAssignments": entry} for p in pages))
        directory = {"assignments": tmp_path / name, "application": "app"}
        with pytest.raises(ValueError, match="incomplete landing of app"):
            run("direct-users", f"{name}-out", users=landed / "users", **directory)


def test_a_failed_group_job_can_be_repeated(spark, run, landed, tmp_path):
    data = {k: landed / k for k in ("assignments", "memberships", "groups", "users")}
    land(tmp_path / "g" / "identity_store_id=d-1", "g.json",
         {"GroupId": "g1", "Group": {"DisplayName": "First"}})
    with pytest.raises(Exception, match="no profile for assigned group g2"):
        run("group-access", "again", application="app", **{**data, "groups": tmp_path / "g"})
    out = run("group-access", "again", application="app", **data)
    assert len(read(f"{out}/summary")) == 2
    with pytest.raises(ValueError, match="PATH_ALREADY_EXISTS"):
        run("group-access", "again", application="app", **data)


def test_an_existing_result_is_not_overwritten(run, table):
    run("usage-rollup", "once", usage=table)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        run("usage-rollup", "once", usage=table)


def test_a_conversion_that_ended_early_is_looked_into(spark, run, tmp_path):
    root = tmp_path / "te xt+1"
    root.mkdir()
    (root / "a b.csv").write_text('userid,act_date,x\n"u1",03-01-2025,5\n')
    table = run("convert-usage", "early", text=root)
    (root / "c%20d.csv").write_text('userid,act_date,x\n"u2",03-02-2025,5\n')
    (root / "e.csv").write_text('userid,act_date,x\n"u3",03-02-2025,5\n')
    # Begun: one file's rows are there, the other's are not, and the end was never noted.
    begun = [(f"file:{root}/{n}",) for n in ("c%20d.csv", "e.csv")]
    noted = spark.createDataFrame(begun, "file string").selectExpr("'x' AS batch", "file", "false AS ended")
    noted.write.mode("append").parquet(f"{table}/_sources")
    rows = usage_files.read_usage_text(spark, [str(root / "e.csv")], with_source=True)
    usage_files.write_usage_parquet(rows, table, "append")
    assert [n.rsplit("/", 1)[1] for n in usage_files.new_files(spark, str(root), table)] == ["c%20d.csv"]
    run("convert-usage", "early", "--append", "--count-losses", text=root)
    assert usage_files.new_files(spark, str(root), table) == []
    assert sorted(r[0] for r in spark.read.parquet(table).select("userid").collect()) == ['"u1"', '"u2"', '"u3"']
    assert usage_files.read_losses(spark, table).where("measure = 'rows'").first()["n"] == 1


def test_a_table_without_names_of_its_files(spark, run, landed, tmp_path):
    rows = usage_files.read_usage_text(spark, str(landed / "text"), with_source=True)
    usage_files.write_usage_parquet(rows, str(tmp_path / "old"))
    assert usage_files.new_files(spark, str(landed / "text"), str(tmp_path / "old")) == []


def test_rollup_of_batches(spark, run, landed, tmp_path):
    state = tmp_path / "state"
    for name in ("1", "2", "2"):
        only = tmp_path / f"only{name}"
        only.mkdir(exist_ok=True)
        (only / "x.csv").write_text((landed / "text" / f"{name}.csv").read_text())
        table = f"{tmp_path}/table{name}"
        if not glob.glob(table):
            jobs.main(["convert-usage", "--text", str(only), "--out", table], spark)
        out = run(
            "update-rollup", "folded", "--publish", usage=table, state=state, batch=f"day{name}"
        )
    whole = read(run("usage-rollup", "unfolded", usage=run("convert-usage", "all", text=landed / "text")))
    runs = sorted(glob.glob(f"{out}/data/*"))
    assert len(runs) == 3
    assert read(publish.published_folder(spark, out, verify=True)) == whole


def test_usage_laid_out_by_name(spark, run, landed, table, tmp_path):
    name = "laid_" + uuid.uuid4().hex
    jobs.main(
        ["lay-out-usage", "--usage", table, "--out", name, "--buckets", "3", "--folder", str(tmp_path)],
        spark,
    )
    laid = f"laid-out:{name}"
    assert read(run("usage-rollup", "laid-rollup", usage=laid)) == read(
        run("usage-rollup", "flat-rollup", usage=table)
    )
    assert read(run("latest-activity", "laid-latest", usage=laid)) == read(
        run("latest-activity", "flat-latest", usage=table)
    )
    users = landed / "users"
    key = lambda r: r["UserId"]
    assert sorted(read(run("activity-with-profile", "laid-both", usage=laid, users=users)), key=key) == (
        sorted(read(run("activity-with-profile", "flat-both", usage=table, users=users)), key=key)
    )


def test_pages_by_token_and_profiles_as_of_a_day(run, landed, tmp_path):
    entry = lambda u: [{"PrincipalType": "USER", "PrincipalId": u}]
    land(
        tmp_path / "a" / "application_arn=app", "p.json",
        {"Token": "t", "ApplicationAssignments": entry("u2"), "NextToken": ""},
        {"ApplicationAssignments": entry("u1"), "NextToken": "t"},
    )
    for kind, day, name in (("full", "2025-03-01", "old"), ("changes", "2025-03-04", "new")):
        land(
            tmp_path / "u" / f"kind={kind}" / f"landed={day}", "u.json",
            {"IdentityStoreId": "d-1", "UserId": "u1", "UserName": name},
        )
    directory = {"assignments": tmp_path / "a", "application": "app", "users": tmp_path / "u"}
    for day, name in (("2025-03-02", "old"), ("2025-03-05", "new")):
        out = run("direct-users", f"as-of-{day}", "--by-token", "--as-of", day, "--name", "u", **directory)
        assert [(r["UserId"], r["Username"]) for r in read(f"{out}/u")] == [("u1", name)]
    entries = [{"PrincipalType": "USER", "PrincipalId": "u1"}]
    land(tmp_path / "b" / "application_arn=app", "p.json", {"Token": "t", "ApplicationAssignments": entries})
    with pytest.raises(ValueError, match="cut off at token 't'"):
        run("direct-users", "headless", "--by-token", "--as-of", "2025-03-05",
            **{**directory, "assignments": tmp_path / "b"})
