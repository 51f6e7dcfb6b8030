"""What the physical plans must and must not contain."""

import re

import inputs
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from seatwise.operators import enrich, groups, usage
from seatwise.plans import driver_tables as tables
from seatwise.plans.registry import QUERIES

SLOW = ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def settings(spark):
    """Sets options for one test."""
    before = {}

    def use(**options):
        for key, value in options.items():
            key = key.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield use
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture(scope="module")
def silver(spark, sf_dir):
    return contract.queries()["src_usage_parquet"](spark, sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_pair_joins(spark, sf_dir, name):
    text = plan(contract.queries()[name](spark, sf_dir))
    assert not [word for word in SLOW if word in text]


def test_rollup_moves_the_sums_once(silver, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    text = plan(usage.usage_rollup(silver))
    assert "Expand" not in text
    hashed = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)
    by_user = [h for h in hashed if "act_date" not in h]
    # One for the distinct count, one for the sums, none for joining them.
    assert len(hashed) == 3 and len(by_user) == 2
    assert text.count("Exchange rangepartitioning") == 1
    assert "Exchange rangepartitioning" not in plan(usage.usage_rollup(silver, ordered=False))


def test_latest_activity_reads_two_columns(silver):
    text = plan(usage.latest_activity(silver))
    assert "ReadSchema: struct<userid:string,act_date:string>" in text
    assert text.count("Exchange hashpartitioning") == 2
    normalized = plan(usage.latest_activity(silver, normalize=True))
    assert normalized.count("Exchange hashpartitioning") == 1


def test_directory_joins_reuse_the_partitioning_of_distinct_ids(spark, sf_dir, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    for name in ("direct_users", "effective_users"):
        text = plan(contract.queries()[name](spark, sf_dir))
        # Ids once, the directory once; deduplicating the rows moves nothing.
        assert text.count("Exchange hashpartitioning(user_id") == 2, name


@pytest.mark.parametrize("analysis", [groups.group_nested, groups.group_report])
def test_lists_and_counts_come_from_one_scan_of_the_memberships(
    spark, tmp_path, settings, analysis
):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    members = inputs.memberships(spark, *((f"g{i % 9}", f"u{i}") for i in range(90)))
    members.write.parquet(str(tmp_path / "members"))
    assigned = inputs.assignments(spark, *((1, i, "GROUP", f"g{i}") for i in range(5)))
    landed = spark.read.parquet(str(tmp_path / "members"))
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    result = analysis(
        assigned,
        landed,
        inputs.profiles(spark, *(f"g{i}" for i in range(9))),
        some_users(spark, 90),
    )
    # Nothing runs while the plan is built.
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before
    result.collect()
    text = plan(result).split("== Initial Plan ==")[0]
    assert len(re.findall(r"FileScan parquet \[group_id", text)) == 1
    assert "ReusedExchange" in text


SKEW = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "10KB",
    "spark__sql__shuffle__partitions": "20",
}


def some_users(spark, n):
    return spark.range(0, n, 2).select(
        F.concat(F.lit("u"), F.col("id") + 1).alias("user_id"),
        F.lit("n").alias("user_name"),
        F.lit("d").alias("display_name"),
        F.lit(None).cast("array<struct<Value:string,Primary:boolean>>").alias("emails"),
    )


@pytest.mark.parametrize("analysis", [groups.group_roster, groups.group_summary])
def test_adaptive_planner_splits_a_user_who_is_in_most_groups(spark, settings, analysis):
    settings(**SKEW)
    n = 40000
    members = spark.range(0, n, 1, 8).select(
        F.concat(F.lit("g"), F.sha2(F.col("id").cast("string"), 256)).alias("group_id"),
        F.lit(0).alias("page"),
        F.col("id").cast("int").alias("pos"),
        F.expr("if(id % 3 = 0, 'u1', concat('u', id))").alias("user_id"),
    )
    listed = members.select(
        "page",
        "pos",
        F.lit("GROUP").alias("principal_type"),
        F.col("group_id").alias("principal_id"),
    )
    names = members.select("group_id", F.lit("name").alias("group_name"))
    result = analysis(listed, members, names, some_users(spark, n))
    rows = result.collect()
    counted = sum(r["user_count"] for r in rows) if "user_count" in result.columns else len(rows)
    assert counted == sum(i % 3 == 0 or i % 2 == 1 for i in range(n))
    assert "skew=true" in plan(result)


@pytest.mark.parametrize("analysis", [groups.group_summary, groups.group_totals])
def test_members_of_other_groups_are_dropped_before_the_user_lookup(
    spark, tmp_path, settings, analysis
):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    members = inputs.memberships(spark, *((f"g{i % 9}", f"u{i}") for i in range(90)))
    members.write.parquet(str(tmp_path / "members"))
    assigned = inputs.assignments(spark, (1, 0, "GROUP", "g1"))
    result = analysis(
        assigned,
        spark.read.parquet(str(tmp_path / "members")),
        inputs.profiles(spark, "g1"),
        some_users(spark, 90),
    )
    lines = plan(result).split("\n")
    scan = next(i for i, line in enumerate(lines) if "FileScan parquet [group_id" in line)
    above = [re.sub(r"^[ :+\-*()\d]*", "", line) for line in lines[:scan]]
    # Going up from the scan, the groups come first and the lookup by user later.
    joins = [line for line in reversed(above) if re.match(r"\w*Join \[", line)]
    assert "[group_id" in joins[0]


def test_profiles_beside_the_last_day_move_three_times(spark, silver, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    result = enrich.activity_with_profile(silver, some_users(spark, 50))
    assert plan(result).count("Exchange hashpartitioning") == 3


def test_totals_add_up_per_user_before_the_lookup(spark, sf_dir, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    text = plan(groups.group_totals(*tables.directory(spark, sf_dir)))
    lookup = text[text.index("SortMergeJoin [user_id") :]
    assert re.match(r"[^\n]*\n[^\n]*Sort[^\n]*\n[^\n]*HashAggregate\(keys=\[user_id", lookup)


def test_adaptive_planner_splits_a_user_that_fills_the_list(spark, settings):
    settings(**SKEW)
    n = 40000
    listed = spark.range(0, n, 1, 8).select(
        F.expr("if(id % 3 = 0, 'u1', concat('u', id))").alias("user_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("last_activity_date"),
    )
    result = enrich.enrich_activity(listed, some_users(spark, n))
    rows = result.collect()
    assert len(rows) == n
    assert sum(r["user_id"] == "u1" and r["user_name"] == "n" for r in rows) >= n // 3
    assert "skew=true" in plan(result)


def test_converted_usage_splits_a_user_too_big_for_one_file(spark, tmp_path, settings):
    from seatwise.sources.usage_files import write_usage_parquet

    settings(spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB")
    table = inputs.usage(spark, ("hot", "03-01-2025")).select(
        "userid", F.explode(F.sequence(F.lit(1), F.lit(60000))).alias("n")
    )
    days = table.repartition(12).select(
        "userid", F.sha2(F.col("n").cast("string"), 256).alias("act_date")
    )
    write_usage_parquet(days, str(tmp_path / "usage"))
    back = spark.read.parquet(str(tmp_path / "usage"))
    assert back.count() == 60000
    assert len(back.inputFiles()) > 2
