"""Results that are seen whole or not at all, and where their lines stand."""

import glob

import inputs
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from seatwise.sinks import files, places, publish


def rows(spark, n, name="v"):
    return spark.range(n).select(
        F.concat(F.lit(f"{name} é "), "id").alias("text"), F.col("id").alias("n")
    ).repartitionByRange(3, "n").sortWithinPartitions("n")


def told(manifest):
    return sorted(tuple(r)[2:] for r in manifest.collect())


def seen(spark, out):
    return spark.read.option("header", True).csv(publish.published_folder(spark, out)).count()


def test_a_run_that_fails_leaves_the_old_result(spark, tmp_path):
    out = str(tmp_path / "out")
    first = publish.publish(rows(spark, 50), out)
    assert first.first()["version"] == 1 and seen(spark, out) == 50
    broken = rows(spark, 80).withColumn(
        "text", F.when(F.col("n") == 70, F.raise_error(F.lit("half way"))).otherwise(F.col("text"))
    )
    with pytest.raises(PySparkException, match="half way"):
        publish.publish(broken, out)
    assert seen(spark, out) == 50
    # Written whole, and ended before its manifest: never seen either.
    files.write_csv(rows(spark, 90), f"{out}/{publish.DATA}/lost")
    assert seen(spark, out) == 50
    second = publish.publish(rows(spark, 80), out)
    assert second.first()["version"] == 2 and seen(spark, out) == 80


def test_the_same_result_gives_the_same_manifest(spark, tmp_path):
    out = str(tmp_path / "out")
    first = told(publish.publish(rows(spark, 500), out))
    assert told(publish.publish(rows(spark, 500), out)) == first
    assert told(publish.publish(rows(spark, 500, "w"), out)) != first
    assert sum(r[1] for r in first) == 500 + 3
    on_disk = sum(len(open(f, "rb").read()) for f in glob.glob(f"{out}/data/*/part-*")) / 3
    assert sum(r[2] for r in first) == on_disk


def test_a_changed_part_is_named(spark, tmp_path):
    out = str(tmp_path / "out")
    publish.publish(rows(spark, 100), out)
    folder = publish.published_folder(spark, out, verify=True)
    part = sorted(glob.glob(f"{folder}/part-*"))[1]
    text = open(part, encoding="utf-8").read().replace("v é 50", "v é 51")
    for crc in glob.glob(f"{folder}/.*.crc"):
        open(crc, "wb").close()
    open(part, "w", encoding="utf-8").write(text)
    with pytest.raises((ValueError, PySparkException)):
        publish.published_folder(spark, out, verify=True)


def test_nothing_published(spark, tmp_path):
    assert publish.manifests(spark, str(tmp_path / "none")) is None
    with pytest.raises(ValueError, match="nothing is published"):
        publish.published_folder(spark, str(tmp_path / "none"))


def test_places_of_lines(spark):
    texts = ["", "é" * 3, "plain", "plain", "\U0001f600 x", "last"] * 40
    lines = [(None if i < 6 else i // 20, i % 3, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(lines, "a int, b int, line string").repartition(7)
    placed = places.with_places(df, ["a", "b"]).collect()
    ordered = sorted(lines, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2].encode()))
    assert [r["line"] for r in sorted(placed, key=lambda r: r["line_number"])] == [r[2] for r in ordered]
    offset = 0
    for number, r in enumerate(sorted(placed, key=lambda r: r["line_number"]), 1):
        assert (r["line_number"], r["byte_offset"]) == (number, offset)
        assert r["byte_length"] == len(r["line"].encode()) + 1
        offset += r["byte_length"]


def test_no_task_sees_all_lines(spark):
    df = spark.range(0, 5000, 1, 4).select(F.col("id").alias("a"), F.lit("x").alias("line"))
    text = places.with_places(df, ["a"])._jdf.queryExecution().executedPlan().toString()
    below = text[text.index("SinglePartition") :].split("\n")
    # What comes to one task are the sums of each run.
    assert "HashAggregate" in "".join(below[:6])
    assert text.count("SinglePartition") == 1


def test_parts_know_their_places(spark, tmp_path):
    path = str(tmp_path / "report")
    files.write_report(rows(spark, 300).withColumnRenamed("text", "line"), path)
    known = {r["file"]: r for r in places.part_places(spark, path).collect()}
    before = 0
    for part in sorted(glob.glob(f"{path}/part-*")):
        data = open(part, "rb").read()
        r = known[part.rsplit("/", 1)[1]]
        assert (r["bytes_before"], r["bytes"], r["lines"]) == (before, len(data), data.count(b"\n"))
        before += len(data)


def test_empty_results(spark, tmp_path):
    empty = inputs.usage(spark, ("u", "d")).select(F.col("userid").alias("line")).limit(0)
    assert places.with_places(empty, []).count() == 0
    out = str(tmp_path / "out")
    publish.publish(empty, out)
    assert seen(spark, out) == 0
