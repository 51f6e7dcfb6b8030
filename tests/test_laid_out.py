"""Usage laid out by user in the catalog: nothing moves before the final sort."""

import uuid

import inputs
import pytest
from pyspark.sql import functions as F

from seatwise.operators import enrich, laid_out, usage
from seatwise.plans import driver_tables as tables
from seatwise.sources import usage_table


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def written(spark, tmp_path, rows, buckets=4):
    name = "usage_" + uuid.uuid4().hex
    usage_table.write_usage_table(rows, name, buckets, str(tmp_path))
    return usage_table.usage_table(spark, name)


@pytest.fixture(scope="module")
def users(spark, sf_dir):
    return tables.users(spark, sf_dir)


@pytest.fixture(scope="module")
def table(spark, sf_dir, tmp_path_factory):
    return written(spark, tmp_path_factory.mktemp("table"), tables.usage(spark, sf_dir))


@pytest.fixture(autouse=True)
def no_small_tables(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rollup_and_latest_day_move_nothing(table):
    for result in (laid_out.even_rollup(table.even), laid_out.even_latest(table.even)):
        assert "Exchange" not in plan(result)
        assert "Bucketed: true" in plan(result)


def test_the_lookup_moves_profiles_only(table, users):
    text = plan(laid_out.even_profiles(table.even, users))
    assert text.count("Exchange") == 1
    below = text[text.index("Exchange") :].split("\n")
    assert not any("userid" in line for line in below[:6])


def test_a_user_too_large_for_a_bucket_lives_apart(spark, tmp_path):
    rows = inputs.usage(
        spark,
        *(("hot", f"03-{i % 28 + 1:02}-2025", {"chat_aicodelines": i}) for i in range(300)),
        *((f'"u{i}"' if i % 2 else f"u{i}", "03-01-2025", {"dev_generatedlines": 2}) for i in range(200)),
        *((None, None) for _ in range(400)),
    )
    table = written(spark, tmp_path, rows)
    assert {r[0] for r in table.heavy.select("userid").distinct().collect()} == {"hot", None}
    assert table.even.where("userid = 'hot' OR userid IS NULL").isEmpty()
    assert table.even.count() + table.heavy.count() == rows.count()
    users = inputs.users(spark, *((f"u{i}", [inputs.FIRST]) for i in range(50)), ("hot", None))
    key = lambda r: str(r)
    for got, expected in (
        (laid_out.usage_rollup(table), usage.usage_rollup(rows)),
        (laid_out.latest_activity(table), usage.latest_activity(rows)),
        (laid_out.activity_with_profile(table, users), enrich.activity_with_profile(rows, users)),
    ):
        assert got.columns == expected.columns
        assert sorted(got.collect(), key=key) == sorted(expected.collect(), key=key)


def test_results_stay_sorted(table):
    days = [r["active_days"] for r in laid_out.usage_rollup(table).collect()]
    assert days == sorted(days, reverse=True)


def test_an_empty_table(spark, tmp_path):
    table = written(spark, tmp_path, inputs.usage(spark, ("u", "d")).limit(0))
    assert laid_out.usage_rollup(table).count() == laid_out.latest_activity(table).count() == 0
    assert table.even.where(F.col("user_id") == "u").isEmpty()
