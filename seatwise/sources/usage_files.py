"""The daily usage files: delimited text as landed, Parquet once converted."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seatwise.functions.text import clean_user_id
from seatwise.schemas import USAGE

#: The column that tells the file a converted row comes from.
SOURCE = "source_file"

#: A character no text file holds, so that a reader keeps whole lines whole.
NO_DELIMITER = "\u0001"

#: What a converted row lost on the way: see ``read_usage_text``.
LOST = "lost"
#: Folder of the counts of such losses, beside the files of a table that readers see.
LOSSES = "_losses"

#: Where a table keeps the names of the files it was converted from, by conversion.
SOURCES_FOLDER = "_sources"
SOURCES = "batch string, file string, ended boolean"

# Fixed value: how a missing value is written in delimited table text.
MISSING = "\\N"


def read_usage_text(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType = USAGE,
    with_source: bool = False,
    with_lost: bool = False,
) -> DataFrame:
    """Every file under ``path``, dated subfolders included, as rows of ``schema``.

    Columns go by position. Fields are split at each comma; a quote is an ordinary
    character. The first line of each file is dropped. Short lines are filled
    with NULL, surplus fields ignored, text that is no integer becomes NULL, and
    an empty string stays apart from a missing one. Large files are split between
    tasks. ``with_source`` adds the file each row comes from, ``with_lost`` how many
    fields each row is short of or has too many, and which columns' numbers failed.
    """
    lines = (
        spark.read.schema("line string")
        .option("header", True)
        .option("sep", NO_DELIMITER)
        .option("quote", "")
        .option("recursiveFileLookup", True)
        .csv(path)
    )
    if with_source:
        lines = lines.select("line", F.col("_metadata.file_path").alias(SOURCE))
    kept = [SOURCE] if with_source else []
    if with_lost:
        lines = lines.withColumn("fields", F.split("line", ",", -1))
        kept.append("fields")
    # The text columns are cut off by hand, since a CSV reader cannot tell an
    # empty string from a missing one; the counters need no such care.
    text = [isinstance(f.dataType, T.StringType) for f in schema.fields]
    counters = [f for f, t in zip(schema.fields, text) if not t]
    lead = text.index(False) if counters else len(text)
    behind = not any(text[lead:])
    parts = lead + 1 if counters and behind else len(text) + 1
    cut = lines.select(F.split("line", ",", parts).alias("f"), *kept)
    if behind:
        rest = F.get("f", F.lit(lead))
    else:
        fields = [F.get("f", F.lit(i)) for i, t in enumerate(text) if not t]
        rest = F.concat_ws(",", *(F.coalesce(x, F.lit(MISSING)) for x in fields))
    rows = cut.select(
        *(
            F.nullif(F.get("f", F.lit(i)), F.lit(MISSING)).alias(field.name)
            for i, field in enumerate(schema.fields)
            if text[i]
        ),
        rest.alias("rest"),
        *kept,
    )
    if not counters:
        return _with_lost(rows.drop("rest"), schema, with_lost)
    numbers = F.from_csv(
        "rest", T.StructType(counters).toDDL(), {"quote": "", "nullValue": MISSING}
    )
    flat = rows.withColumn("n", numbers).select(*rows.drop("rest").columns, "n.*")
    return _with_lost(flat.select(*schema.names, *kept), schema, with_lost)


def _with_lost(rows: DataFrame, schema: T.StructType, wanted: bool) -> DataFrame:
    if not wanted:
        return rows
    n = len(schema.fields)
    failed = [
        F.when(_failed(F.get("fields", F.lit(i)), F.col(field.name)), F.lit(field.name))
        for i, field in enumerate(schema.fields)
        if not isinstance(field.dataType, T.StringType)
    ]
    lost = F.struct(
        F.greatest(n - F.size("fields"), F.lit(0)).alias("missing"),
        F.greatest(F.size("fields") - n, F.lit(0)).alias("surplus"),
        (F.array_compact(F.array(*failed)) if failed else F.array().cast("array<string>")).alias(
            "failed"
        ),
    )
    return rows.withColumn(LOST, lost).drop("fields")


def _failed(text: Column, number: Column) -> Column:
    """Text that is there, is not the sign of a missing value, and gave no number."""
    return number.isNull() & text.isNotNull() & (text != MISSING) & (text != "")


def _plain(name: Column, encoded: bool = True) -> Column:
    """One spelling of a file's address, however many slashes or escapes it has."""
    if encoded:
        name = F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(name, r"^(\w+):/+", "$1:/")


def new_files(spark: SparkSession, path: str, converted: str) -> list[str]:
    """Files under ``path`` of which the table at ``converted`` holds no row yet.

    Landed names meet the names the table has taken down of its files on the
    cluster; what comes back are the new ones, such as a reader plans with.
    """
    landed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    names = landed.select("path", _plain(F.col("path"), encoded=False).alias("file"))
    fresh = names.join(converted_files(spark, converted), "file", "left_anti")
    return sorted(r[0] for r in fresh.select("path").collect())


def _sources(spark: SparkSession, converted: str) -> DataFrame | None:
    try:
        return spark.read.schema(SOURCES).parquet(f"{converted.rstrip('/')}/{SOURCES_FOLDER}")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def converted_files(spark: SparkSession, converted: str) -> DataFrame:
    """``(file)``: the files the table's rows come from.

    The table's own rows are only asked about files of a conversion that was begun
    and not seen to end, or about all where nothing was taken down.
    """
    table = spark.read.parquet(converted)
    if SOURCE not in table.columns:
        raise ValueError(f"{converted} does not tell its rows' files, convert it anew")
    held = table.select(_plain(F.col(SOURCE)).alias("file"))
    told = _sources(spark, converted)
    if told is None:
        return held.distinct()
    ended = told.where("ended").select("batch").distinct()
    begun = told.where("NOT ended").select("batch", "file")
    sure = begun.join(ended, "batch", "left_semi").select("file").distinct()
    doubtful = begun.join(ended, "batch", "left_anti").select("file").distinct()
    if doubtful.isEmpty():
        return sure
    return sure.unionByName(held.join(doubtful, "file", "left_semi").distinct()).distinct()


def convert_files(
    spark: SparkSession,
    text: str,
    converted: str,
    schema: T.StructType = USAGE,
    append: bool = False,
    with_lost: bool = False,
) -> int:
    """Converts the files under ``text``, or with ``append`` those not converted yet.

    Returns how many files that were. Their names are taken down beside the table
    before rows are added and marked once they are, so that after a failure it is
    known which files to look for among the rows.
    """
    names = new_files(spark, text, converted) if append else None
    if append and not names:
        return 0
    batch = uuid.uuid4().hex
    folder = f"{converted.rstrip('/')}/{SOURCES_FOLDER}"

    def note(files: DataFrame, ended: bool) -> None:
        marked = files.select(
            F.lit(batch).alias("batch"), F.col("file").cast("string"), F.lit(ended).alias("ended")
        )
        marked.coalesce(1).write.mode("append").parquet(folder)

    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(names or text)
        .select(_plain(F.col("path"), encoded=False).alias("file"))
    )
    rows = read_usage_text(spark, names or text, schema, with_source=True, with_lost=with_lost)
    if append:
        note(listed, False)
        write_usage_parquet(rows, converted, "append")
    else:
        write_usage_parquet(rows, converted)
        note(listed, False)
    note(spark.range(1).select(F.lit(None).alias("file")), True)
    return listed.count()


def register_usage_text(
    spark: SparkSession, path: str, name: str, schema: T.StructType = USAGE
) -> None:
    """Makes the files under ``path`` readable by name in SQL."""
    read_usage_text(spark, path, schema).createOrReplaceTempView(name)


def write_usage_parquet(usage: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Converts once, laid out for the per-user aggregates that follow.

    Rows of a user are brought together, so later map-side aggregation leaves
    about one row per user and task to shuffle. The rebalance hint lets the
    adaptive planner split a user too big for one file and merge small ones.
    Raw and clean ids are both kept: the totals go by the raw one, directory
    lookups by the clean one.

    Rows read ``with_lost`` have their losses counted in the same pass. The counts
    are taken in the tasks that write, after the shuffle: each of those counts once,
    whereas tasks before a shuffle count again if their executor is lost.
    """
    laid_out = (
        usage.withColumn("user_id", clean_user_id(F.col("userid")))
        .hint("rebalance", "userid")
        .sortWithinPartitions("userid", *usage.columns[1:2])
    )
    if LOST not in usage.columns:
        laid_out.write.mode(mode).parquet(path)
        return
    numbers = [
        f.name for f in usage.schema.fields
        if not isinstance(f.dataType, (T.StringType, T.StructType))
    ]
    seen = Observation("losses")
    counts = {
        "rows": F.count(F.lit(1)),
        "short rows": F.count_if(F.col("lost.missing") > 0),
        "missing fields": F.sum("lost.missing"),
        "rows with surplus": F.count_if(F.col("lost.surplus") > 0),
        "surplus fields": F.sum("lost.surplus"),
    } | {f"failed {c}": F.count_if(F.array_contains("lost.failed", c)) for c in numbers}
    observed = laid_out.observe(seen, *(c.alias(n) for n, c in counts.items())).drop(LOST)
    observed.write.mode(mode).parquet(path)
    found = seen.get
    rows = [
        (*(n.split(" ", 1) if n.startswith("failed ") else (n, None)), int(found[n] or 0))
        for n in counts
    ]
    spark = usage.sparkSession
    spark.createDataFrame(rows, "measure string, column string, n long").coalesce(1).write.mode(
        mode if mode == "overwrite" else "append"
    ).parquet(f"{path.rstrip('/')}/{LOSSES}")


def read_losses(spark: SparkSession, path: str) -> DataFrame:
    """``(measure, column, n)``: what all conversions into ``path`` have lost."""
    found = spark.read.parquet(f"{path.rstrip('/')}/{LOSSES}")
    return found.groupBy("measure", "column").agg(F.sum("n").alias("n"))


def write_usage_text(usage: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Delimited text with a header line per file, as ``read_usage_text`` takes it."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit(MISSING)) for c in usage.columns]
    write_lines(usage.select(F.concat_ws(",", *fields).alias(",".join(usage.columns))), path, mode)


def write_lines(lines: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Whole lines of text, each file begun by the column's name."""
    (
        lines.write.mode(mode)
        .option("header", True)
        .option("sep", NO_DELIMITER)
        .option("quote", "")
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
