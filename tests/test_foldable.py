"""States of parts of the usage rows, merged in any grouping."""

import random

import inputs
import pytest
from pyspark.sql import functions as F

from seatwise.operators import foldable, usage
from seatwise.plans import driver_tables as tables


def some_usage(spark):
    days = ["03-01-2025", "3-1-2025", "12-31-1969", "01-01-1970", "", "nonsense", None, "02-30-2025"]
    rng = random.Random(1)
    users = ["u1", '"u1"', None, "", "u2", "quiet"]
    counters = ("chat_aicodelines", "dev_acceptedlines", "dev_generatedlines")
    return inputs.usage(
        spark,
        *(
            (rng.choice(users), rng.choice(days), {c: rng.choice([None, 0, 5, -2]) for c in counters})
            for _ in range(200)
        ),
        ("only absent days", None),
    )


@pytest.mark.parametrize("parts", [1, 2, 5])
def test_any_split_gives_the_rollup_of_all_rows(spark, parts):
    rows = some_usage(spark).withColumn("part", F.pmod(F.xxhash64(F.rand(parts)), F.lit(parts)))
    kept = spark.createDataFrame(rows.collect(), rows.schema)
    states = [foldable.usage_state(kept.where(F.col("part") == i).drop("part")) for i in range(parts)]
    left = states[0] if parts == 1 else foldable.merged(states[0], foldable.merged(*states[1:]))
    expected = usage.usage_rollup(kept.drop("part"))
    got = foldable.rollup_of(left)
    assert got.columns == expected.columns and got.dtypes == expected.dtypes
    key = lambda r: str(r)
    assert sorted(got.collect(), key=key) == sorted(expected.collect(), key=key)


def test_a_batch_written_again_counts_once(spark, tmp_path):
    rows = some_usage(spark)
    for _ in range(2):
        foldable.write_state(foldable.usage_state(rows), str(tmp_path / "state"), "day1")
    foldable.write_state(foldable.usage_state(rows.limit(0)), str(tmp_path / "state"), "day2")
    got = foldable.rollup_of(foldable.merged(foldable.read_state(spark, str(tmp_path / "state"))))
    expected = usage.usage_rollup(rows)
    key = lambda r: str(r)
    assert sorted(got.collect(), key=key) == sorted(expected.collect(), key=key)


def test_the_rollup_reads_states_and_no_usage(spark, sf_dir, tmp_path):
    state = foldable.usage_state(tables.usage(spark, sf_dir))
    foldable.write_state(state, str(tmp_path / "state"), "day1")
    rollup = foldable.rollup_of(foldable.merged(foldable.read_state(spark, str(tmp_path / "state"))))
    files = rollup.inputFiles()
    assert files and all("/state/" in f for f in files)
    # One word holds 64 days: far fewer rows than (user, day) pairs.
    days = spark.read.parquet(str(tmp_path / "state/days"))
    pairs = tables.usage(spark, sf_dir).select("userid", "act_date").distinct().count()
    assert days.count() < pairs / 3
    plan = rollup._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan
