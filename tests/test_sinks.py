"""Writers: exact text, empty results, and what comes back."""

import csv
import glob
import re

import inputs

from seatwise.functions.text import clean_user_id
from seatwise.operators import usage
from seatwise.sinks import files
from seatwise.sources import usage_files, user_list

ACTIVITY = ", ".join(f"{c} string" for c in files.ACTIVITY_EXPORT)
USERS = ", ".join(f"{c} string" for c in files.USER_EXPORT)


def texts(path):
    out = []
    for name in sorted(glob.glob(f"{path}/part-*")):
        with open(name, newline="") as file:
            out.append(file.read())
    return out


def test_csv_quotes_only_where_needed(spark, tmp_path):
    row = ("u1", 'say "hi"', "a,b", None, " padded ")
    df = spark.createDataFrame([row], ACTIVITY).coalesce(1)
    path = files.export_activity(df, str(tmp_path / "out"))
    assert texts(path) == [
        "UserId,Username,Email,DisplayName,LastActivityDate\n"
        'u1,"say ""hi""","a,b",, padded \n'
    ]


def test_csv_reads_back_with_an_independent_reader(spark, tmp_path):
    rows = [("u1", "two\nlines", "", None, "x"), ("u2", '"', ",", "\\", "y\\")]
    path = files.export_activity(spark.createDataFrame(rows, ACTIVITY), str(tmp_path / "out"))
    back = []
    for name in sorted(glob.glob(f"{path}/part-*")):
        with open(name, newline="") as file:
            back += [tuple(r) for r in list(csv.reader(file))[1:]]
    assert sorted(back) == [tuple(v or "" for v in r) for r in rows]


def test_empty_results(spark, tmp_path):
    nobody = spark.createDataFrame([], USERS)
    assert files.export_users(nobody, str(tmp_path / "users")) is None
    assert not (tmp_path / "users").exists()
    path = files.export_activity(spark.createDataFrame([], ACTIVITY), str(tmp_path / "activity"))
    assert "".join(texts(path)).startswith("UserId,Username,Email,DisplayName,LastActivityDate")


def test_empty_result_of_a_join_still_has_a_header(spark, tmp_path):
    rows = spark.createDataFrame([("u1", "n", "e", "d", "x")], ACTIVITY)
    none = rows.join(rows.select("user_id").where("user_id = 'zz'"), "user_id")
    path = files.export_activity(none, str(tmp_path / "activity"))
    assert "UserId,Username" in "".join(texts(path))


def test_default_export_name_has_a_time_stamp(spark, tmp_path):
    users = spark.createDataFrame([("u1", "n", "e", "f", "l", "d")], USERS)
    path = files.export_users(users, str(tmp_path))
    assert re.fullmatch(r"application_users_\d{8}_\d{6}\.csv", path.rsplit("/", 1)[1])
    assert texts(path)[0].split("\n")[0] == "UserId,Username,Email,FirstName,LastName,DisplayName"


def test_sorted_results_stay_sorted_over_the_files(spark, tmp_path):
    table = inputs.usage(
        spark, *((f"u{i % 40:02}", f"03-{d + 1:02}-2025") for i in range(400) for d in range(i % 7))
    )
    path = files.write_csv(usage.active_days(table), str(tmp_path / "days"))
    days = [int(line.split(",")[1]) for t in texts(path) for line in t.split("\n")[1:] if line]
    assert len(days) > 30
    assert days == sorted(days, reverse=True)


def test_latest_activity_feeds_the_user_list(spark, tmp_path):
    table = inputs.usage(spark, ('"u1"', "03-01-2025"), ("u2", "03-02-2025"))
    path = files.write_csv(usage.latest_activity(table), str(tmp_path / "latest"))
    rows = user_list.read_user_list(spark, path).collect()
    assert sorted(tuple(r) for r in rows) == [("u1", "2025-03-01"), ("u2", "2025-03-02")]


def test_usage_text_round_trip(spark, tmp_path):
    table = inputs.usage(
        spark,
        ('"u1"', "03-01-2025", {"chat_aicodelines": 5}),
        (None, "", {"transformation_linesingested": -1}),
        (" u ", None),
    )
    path = str(tmp_path / "usage")
    usage_files.write_usage_text(table, path)
    back = usage_files.read_usage_text(spark, path)
    assert back.schema.simpleString() == table.schema.simpleString()
    assert back.exceptAll(table).isEmpty() and table.exceptAll(back).isEmpty()


def test_converted_usage_keeps_raw_and_clean_ids(spark, tmp_path):
    table = inputs.usage(spark, *((f'"u{i % 9}"', f"03-{i % 28 + 1:02}-2025") for i in range(300)))
    path = str(tmp_path / "usage")
    usage_files.write_usage_parquet(table, path)
    back = spark.read.parquet(path)
    assert back.where(back.user_id != clean_user_id(back.userid)).isEmpty()
    assert back.drop("user_id").exceptAll(table).isEmpty()
    assert back.count() == 300


def test_report_text(spark, tmp_path):
    lines = spark.createDataFrame([(1, ""), (2, "- a (b)")], "n int, line string").coalesce(1)
    path = files.write_report(lines, str(tmp_path / "report"))
    assert texts(path) == ["\n- a (b)\n"]
