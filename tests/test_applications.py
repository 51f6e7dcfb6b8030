"""Access to several applications in one run."""

import inputs
import pytest
from pyspark.sql import functions as F

from seatwise.operators import access, applications


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    members = inputs.memberships(spark, *((f"g{i % 40}", f"u{i % 70}") for i in range(800)))
    path = str(tmp_path_factory.mktemp("members") / "m")
    applications.write_memberships(members, path, buckets=32)
    return members, spark.read.parquet(path)


@pytest.fixture(scope="module")
def assigned(spark, tmp_path_factory):
    rows = [("a1", 1, 0, "GROUP", "g1"), ("a1", 1, 1, "USER", "u2"), ("a2", 1, 0, "GROUP", "g1"),
            ("a2", 1, 1, "GROUP", "g2"), ("a2", 1, 2, "GROUP", "g1"), ("a3", 1, 0, "USER", "alone"),
            ("a4", 1, 0, "GROUP", "g9")]
    df = spark.createDataFrame(rows, f"application_arn string, {inputs.ASSIGNMENTS}")
    path = str(tmp_path_factory.mktemp("assigned") / "a")
    df.write.json(path)
    return spark.read.schema(df.schema).json(path)


@pytest.fixture(scope="module")
def users(spark):
    return inputs.users(spark, *((f"u{i}", [inputs.FIRST]) for i in range(0, 70, 2)))


def test_each_application_by_itself_gives_the_same(landed, assigned, users):
    members, kept = landed
    both = applications.effective_users(assigned, kept, users, buckets=32)
    for arn in ("a1", "a2", "a3", "a4"):
        own = assigned.where(F.col("application_arn") == arn).drop("application_arn")
        expected = inputs.collected(access.effective_users(own, members, users).na.fill("none"))
        got = both.where(F.col("application_arn") == arn).drop("application_arn").na.fill("none")
        assert inputs.collected(got) == expected
    some = applications.effective_users(assigned, kept, users, ["a1", "a3"], buckets=32)
    assert {r[0] for r in some.select("application_arn").distinct().collect()} == {"a1", "a3"}


def test_only_folders_of_assigned_groups_are_read(landed, assigned, users):
    _, kept = landed
    result = applications.effective_users(assigned, kept, users, ["a1", "a2"], buckets=32)
    result.collect()
    execution = result._jdf.queryExecution()
    text = execution.executedPlan().toString()
    assert "dynamicpruningexpression" in text and "group_bucket" in text
    read = _partitions_read(execution.executedPlan())
    assert read and max(read) <= 2 < len(kept.select("group_bucket").distinct().collect())


def _partitions_read(plan):
    found, todo = [], [plan]
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
            continue
        if node.nodeName().endswith("QueryStage"):
            todo.append(node.plan())
        if node.nodeName().startswith("Scan parquet"):
            metric = node.metrics().get("numPartitions")
            if metric.isDefined():
                found.append(metric.get().value())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found
