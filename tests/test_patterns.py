"""Date patterns, compiled ahead and by the SQL function alike."""

from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from seatwise.functions.patterns import parse_datetime, spark_pattern
from seatwise.functions.sql import register_sql_functions

CASES = [
    ("03-04-2024", "MM-dd-YYYY", datetime(2024, 3, 4)),
    ("3-4-2024", "MM-dd-YYYY", datetime(2024, 3, 4)),
    ("2024-03-04 5:06", "YYYY-MM-dd HH:mm", datetime(2024, 3, 4, 5, 6)),
    ("2024-03-04 5:6:7", "yyyy-MM-dd HH:mm:ss", datetime(2024, 3, 4, 5, 6, 7)),
    ("2024-03-04 15:06:07.250", "yyyy-MM-dd HH:mm:ss.SSS", datetime(2024, 3, 4, 15, 6, 7, 250000)),
    ("20240304", "YYYYMMdd", datetime(2024, 3, 4)),
    ("20240304T0506", "YYYYMMdd'T'HHmm", datetime(2024, 3, 4, 5, 6)),
    ("Year 2024 Month 3", "'Year' YYYY 'Month' MM", datetime(2024, 3, 1)),
    ("Y2024-3", "'Y'YYYY-MM", datetime(2024, 3, 1)),
    ("4 March 2024 5:06 PM", "d MMMM YYYY hh:mm a", datetime(2024, 3, 4, 17, 6)),
    ("4 Mar 2024 12:06 AM", "dd MMM YYYY hh:mm a", datetime(2024, 3, 4, 0, 6)),
    ("2024-064", "YYYY-DDD", datetime(2024, 3, 4)),
    ("5 o'clock on 2024-3-4", "HH 'o''clock on' YYYY-MM-dd", datetime(2024, 3, 4, 5)),
]


@pytest.mark.parametrize("text,pattern,moment", CASES)
def test_both_ways_of_parsing(spark, text, pattern, moment):
    register_sql_functions(spark)
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(parse_datetime(F.col("t"), pattern)).first()[0] == moment
    assert df.select(parse_datetime(F.col("t"), pattern, "null")).first()[0] == moment
    quoted = pattern.replace("'", "\\'")
    assert df.selectExpr(f"parse_datetime(t, '{quoted}')").first()[0] == moment


@pytest.mark.parametrize("pattern", ["YYYY-ww", "xxxx", "HH:mm Z", "EEE d", "C", "YYYY 'open"])
def test_what_is_not_known_is_refused(spark, pattern):
    register_sql_functions(spark)
    with pytest.raises(ValueError, match="pattern"):
        spark_pattern(pattern)
    quoted = pattern.replace("'", "\\'")
    with pytest.raises(PySparkException, match="pattern"):
        spark.range(1).selectExpr(f"parse_datetime('x', '{quoted}')").collect()


def test_letters_in_quotes_are_text():
    assert spark_pattern("YYYY 'Week' MM") == "yyyy 'Week' M"
    assert spark_pattern("'YYYY'") == "'YYYY'"


def test_the_plan_holds_the_pattern_as_a_literal(spark):
    register_sql_functions(spark)
    parsed = spark.createDataFrame([("1",)], "t string").selectExpr(
        "parse_datetime(t, 'YYYY-MM-dd HH:mm')"
    )
    plan = parsed._jdf.queryExecution().optimizedPlan().toString()
    assert "yyyy-M-d H:m" in plan
    assert "regexp" not in plan and "raise_error" not in plan


def test_bad_text(spark):
    df = spark.createDataFrame([("13-40-2024",)], "t string")
    assert df.select(parse_datetime(F.col("t"), "MM-dd-YYYY", "null")).first()[0] is None
    with pytest.raises(PySparkException):
        df.select(parse_datetime(F.col("t"), "MM-dd-YYYY")).collect()
    with pytest.raises(ValueError, match="on_bad_date"):
        parse_datetime(F.col("t"), "MM-dd-YYYY", "maybe")
