"""Usage semantics that are easy to get subtly wrong."""

import random
from datetime import date

import inputs
import pytest
from pyspark.errors import PySparkException

from seatwise.functions.metrics import RATIOS, TOTALS
from seatwise.operators import usage
from seatwise.schemas import COUNTERS

ACC, GEN = "dev_acceptedlines", "dev_generatedlines"


def test_ratio_is_whole_and_fraction_is_not(spark):
    table = inputs.usage(
        spark,
        ("u", "03-01-2025", {ACC: 1, GEN: 2}),
        ("u", "03-02-2025", {ACC: 2, GEN: 2}),
        ("v", "03-01-2025", {ACC: 5, GEN: 0}),
        ("w", "03-01-2025", {ACC: None, GEN: 4}),
    )
    rollup = usage.usage_rollup(table).select(
        "userid", "dev_acceptance_ratio", "dev_acceptance_fraction"
    )
    assert inputs.collected(rollup) == [("u", 0, 0.75), ("v", None, None), ("w", None, None)]


def test_pair_sum_skips_rows_with_either_side_missing(spark):
    a, b = "inlinechat_acceptedlineadditions", "inlinechat_acceptedlinedeletions"
    table = inputs.usage(spark, ("u", "d", {a: 1, b: None}), ("u", "d", {a: 2, b: 3}))
    row = usage.usage_rollup(table).first()
    assert row["total_inlinechat_acceptedlines"] == 5


def test_pair_overflow_raises(spark):
    a, b = "docgeneration_acceptedlineadditions", "docgeneration_acceptedlineupdates"
    table = inputs.usage(spark, ("u", "d", {a: 2147483647, b: 1}))
    with pytest.raises(PySparkException, match="OVERFLOW"):
        usage.usage_rollup(table).collect()


def test_totals_may_exceed_an_int(spark):
    table = inputs.usage(spark, *[("u", "d", {"chat_aicodelines": 2147483647})] * 3)
    assert usage.usage_rollup(table).first()["total_chat_aicodelines"] == 3 * 2147483647


def test_blank_day_counts_and_missing_day_does_not(spark):
    table = inputs.usage(spark, ("u", ""), ("u", None), ("u", "03-01-2025"), ("v", None))
    expected = [("u", 2), ("v", 0)]
    assert [tuple(r) for r in usage.active_days(table).collect()] == expected
    rollup = usage.usage_rollup(table).select("userid", "active_days")
    assert [tuple(r) for r in rollup.collect()] == expected


def test_missing_user_is_a_group_apart_from_the_blank_one(spark):
    n = "chat_messagessent"
    table = inputs.usage(
        spark, (None, "1", {n: 1}), (None, "2", {n: 2}), ("", "1", {n: 5}), ("u", "1", {n: 7})
    )
    rollup = usage.usage_rollup(table).select("userid", "active_days", f"total_{n}")
    assert {tuple(r) for r in rollup.collect()} == {(None, 2, 3), ("", 1, 5), ("u", 1, 7)}


def test_raw_ids_stay_apart_in_the_rollup(spark):
    table = inputs.usage(spark, ('"u1"', "03-01-2025"), ("u1", "03-01-2025"))
    assert usage.usage_rollup(table).count() == 2


def test_rollup_matches_a_plain_aggregate(spark):
    table = inputs.usage(
        spark,
        *(
            (f"u{i % 5}", f"03-0{i % 7 + 1}-2025", {c: i * j % 11 for j, c in enumerate(COUNTERS)})
            for i in range(60)
        ),
    )
    totals = ", ".join(f"sum({' + '.join(t.inputs)}) AS {t.name}" for t in TOTALS)
    table.createOrReplaceTempView("plain_usage")
    plain = spark.sql(
        f"SELECT userid, count(DISTINCT act_date) AS active_days, {totals} "
        "FROM plain_usage GROUP BY userid"
    )
    rollup = usage.usage_rollup(table).select(plain.columns)
    assert inputs.collected(rollup) == inputs.collected(plain)


@pytest.mark.parametrize("seed", range(3))
def test_random_usage_matches_a_model(spark, seed):
    rng = random.Random(seed)
    names = [None, "", "u1", '"u1"', "u2", '"u2"', "u3"]
    days = [None, "", "03-01-2025", "3-1-2025", "12-31-2024"]
    records = [
        (
            "u3" if rng.random() < 0.3 else rng.choice(names),
            rng.choice(days),
            {c: rng.choice([None, 0, 1, rng.randrange(50)]) for c in COUNTERS},
        )
        for _ in range(rng.randrange(1, 120))
    ]

    def total(inputs_, rows):
        known = [sum(v) for v in ([r[i] for i in inputs_] for r in rows) if None not in v]
        return sum(known) if known else None

    expected = {}
    for user in {u for u, _, _ in records}:
        rows = [c for u, _, c in records if u == user]
        seen = {d for u, d, _ in records if u == user and d is not None}
        line = {"active_days": len(seen), **{t.name: total(t.inputs, rows) for t in TOTALS}}
        for name, (accepted, generated) in RATIOS.items():
            a, g = total((accepted,), rows), total((generated,), rows)
            line[f"{name}_ratio"] = a // g if g and a is not None else None
            line[f"{name}_fraction"] = a / g if g and a is not None else None
        expected[user] = line
    rollup = usage.usage_rollup(inputs.usage(spark, *records)).collect()
    got = [r.asDict() for r in rollup]
    assert {r.pop("userid"): r for r in got} == expected
    order = [r["active_days"] for r in rollup]
    assert order == sorted(order, reverse=True)


def test_rollup_order_is_busiest_first(spark):
    table = inputs.usage(spark, ("b", "1"), ("a", "1"), ("c", "1"), ("c", "2"))
    assert [r["userid"] for r in usage.usage_rollup(table).collect()] == ["c", "a", "b"]


def test_latest_activity_goes_by_raw_id_and_shows_the_clean_one(spark):
    table = inputs.usage(
        spark,
        ('"u1"', "03-01-2025"),
        ("u1", "03-02-2025"),
        ("u1", "03-01-2025"),
        ('"u3"', "03-07-2025"),
        ("u3", "03-07-2025"),
    )
    expected = [
        ("u1", date(2025, 3, 1)),
        ("u1", date(2025, 3, 2)),
        ("u3", date(2025, 3, 7)),
    ]
    assert inputs.collected(usage.latest_activity(table)) == expected
    assert inputs.collected(usage.latest_activity(table, normalize=True)) == expected[1:]


def test_latest_activity_is_newest_first_with_missing_days_last(spark):
    table = inputs.usage(spark, ("a", "12-31-2024"), ("b", "01-02-2025"), ("c", None))
    assert [r["user_id"] for r in usage.latest_activity(table).collect()] == ["b", "a", "c"]


def test_day_pattern_takes_one_or_two_digits(spark):
    table = inputs.usage(spark, ("u", "03-26-2025"), ("v", "3-6-2025"))
    assert inputs.collected(usage.latest_activity(table)) == [
        ("u", date(2025, 3, 26)),
        ("v", date(2025, 3, 6)),
    ]


@pytest.mark.parametrize("text", ["bad", "", "13-01-2025", "02-30-2025", "2025-03-01"])
def test_bad_day_fails_unless_asked_otherwise(spark, text):
    table = inputs.usage(spark, ("u", text), ("u", "03-01-2025"), ("v", text), ("w", None))
    with pytest.raises(PySparkException):
        usage.latest_activity(table).collect()
    lenient = usage.latest_activity(table, on_bad_date="null", normalize=True)
    assert {tuple(r) for r in lenient.collect()} == {
        ("u", date(2025, 3, 1)),
        ("v", None),
        ("w", None),
    }
    assert usage.bad_days(table).first()["rejected"] == 2


def test_unknown_date_mode_is_refused(spark):
    with pytest.raises(ValueError):
        usage.latest_activity(inputs.usage(spark, ("u", "x")), on_bad_date="skip")


def test_the_day_column_may_have_another_name(spark):
    table = inputs.usage(spark, ("u", "03-01-2025")).withColumnRenamed("act_date", "data")
    assert usage.latest_activity(table, "data").count() == 1
    assert usage.usage_rollup(table, "data").first()["active_days"] == 1


def test_the_session_zone_does_not_move_a_day(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("America/Sao_Paulo", "Pacific/Apia", "UTC"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            table = inputs.usage(spark, ("u", "11-04-2018"))
            assert usage.latest_activity(table).first()[1] == date(2018, 11, 4)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
