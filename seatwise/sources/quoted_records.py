"""Records of quoted CSV text whose fields may hold line breaks, read in parts.

A line alone does not tell whether it begins inside quotes. What it does tell is
where it ends for either beginning: each line is a function of one of four kinds
on the two states "outside" and "inside". Such functions can be put together in
any grouping, so every block of a file is worked on apart: first the function of
each block, then the state at the beginning of each block from those before it,
then the state before each line. Lines that begin outside begin a record, all
others belong to the record before, which may have begun in an earlier block.

No task holds more than a block of lines, however large the file is. Only records
of several lines are gathered, and those are bounded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seatwise.session import scratch_path

# Fixed value: the longest field that a CSV reader takes by default, and so the
# longest record of several lines; more is a quote that was never closed.
MAX_RECORD_CHARS = 131_072

# A quote opens a field only as its first character; after the closing quote, and
# in a field without one at its beginning, quotes are ordinary characters.
_INSIDE = '(?:[^"]++|"")*+'
_AFTER = '(?:[^",][^,]*+)?'
_FIELD = f'(?:"{_INSIDE}"{_AFTER}|{_AFTER})'
_OPEN = f'(?:{_FIELD},)*+"{_INSIDE}'

#: Lines that end inside quotes when they begin outside, and when they begin inside.
OPENS = f"^{_OPEN}\\z"
STAYS = f'^{_INSIDE}(?:\\z|"{_AFTER},{_OPEN}\\z)'


def ends_inside(line: Column, inside: bool) -> Column:
    """Whether a line that begins inside or outside of quotes ends inside."""
    return line.rlike(STAYS if inside else OPENS)


def _run(rows: DataFrame, window, name: str) -> DataFrame:
    """Adds what tells the state that a run of two-state functions leads to.

    A function sets the state (``sets`` is 0 or 1), or ``sets`` is null and it leaves
    it, turned over or not (``flips`` is 1 or 0).
    """
    whole = window.rowsBetween(Window.unboundedPreceding, 0)
    seen = F.when(
        F.col("sets").isNotNull(), F.struct("sets", F.sum("flips").over(whole).alias("turned"))
    )
    with_seen = rows.withColumns(
        {f"{name}_turned": F.coalesce(F.sum("flips").over(window), F.lit(0)), "seen": seen}
    )
    last = F.last("seen", ignorenulls=True).over(window)
    return with_seen.withColumn(f"{name}_last", last).drop("seen")


def _state(name: str, entry: Column) -> Column:
    """The state a run leads to from the state before it."""
    turned, last = F.col(f"{name}_turned"), F.col(f"{name}_last")
    return F.when(last.isNull(), (entry + turned) % 2).otherwise(
        (last["sets"] + turned - last["turned"]) % 2
    )


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines with their place: file, first byte of the block, number in the block."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").alias("line"),
    )
    opens = ends_inside(F.col("line"), False)
    stays = ends_inside(F.col("line"), True)
    return lines.select(
        "*",
        F.monotonically_increasing_id().alias("pos"),
        F.when(opens == stays, stays.cast("int")).alias("sets"),
        (opens & ~stays).cast("int").alias("flips"),
    )


def has_open_lines(spark: SparkSession, path: str | list[str]) -> bool:
    """Whether any record goes on beyond its first line."""
    return not spark.read.text(path).where(ends_inside(F.col("value"), False)).isEmpty()


def placed_lines(lines: DataFrame) -> DataFrame:
    """Lines with their record, ``(file, of, number)``, and whether they begin or end it.

    ``lines`` has ``file, block, pos, line, sets, flips``. It is read twice, so its
    blocks must not change meanwhile: hand over a written table.
    """
    own = Window.partitionBy("file", "block").orderBy("pos")
    upto = own.rowsBetween(Window.unboundedPreceding, 0)
    before = own.rowsBetween(Window.unboundedPreceding, -1)

    def run(rows: DataFrame) -> DataFrame:
        return _run(_run(rows, upto, "after"), before, "before")

    states = {
        f"{name}{e}": _state(name, F.lit(e)) for name in ("after", "before") for e in (0, 1)
    }
    each = run(lines.drop("line")).select("file", "block", "pos", *(c.alias(n) for n, c in states.items()))
    blocks = each.groupBy("file", "block").agg(
        F.max_by(F.struct("after0", "after1"), "pos").alias("out"),
        *(F.count_if(F.col(f"before{e}") == 0).alias(f"n{e}") for e in (0, 1)),
    )
    functions = blocks.select(
        "file",
        "block",
        "n0",
        "n1",
        F.when(F.col("out.after0") == F.col("out.after1"), F.col("out.after0")).alias("sets"),
        ((F.col("out.after0") == 1) & (F.col("out.after1") == 0)).cast("int").alias("flips"),
    )
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    entered = _run(functions, earlier, "before").select(
        "file",
        "block",
        _state("before", F.lit(0)).alias("entry"),
        "n0",
        "n1",
    )
    begun = F.when(F.col("entry") == 0, F.col("n0")).otherwise(F.col("n1"))
    begins = entered.withColumn("n", begun).select(
        "file",
        "block",
        "entry",
        F.last(F.when(F.col("n") > 0, F.struct("block", "n")), ignorenulls=True)
        .over(earlier)
        .alias("held"),
    )
    state = run(lines).join(begins, ["file", "block"])
    first = _state("before", F.col("entry")) == 0
    last = _state("after", F.col("entry")) == 0
    told = state.select(
        "file", "block", "pos", "line", "held", first.alias("begins"), last.alias("ends")
    ).withColumn("number", F.count_if("begins").over(upto))
    here = F.col("number") > 0
    return told.select(
        "file",
        "block",
        "pos",
        "line",
        "begins",
        "ends",
        F.when(here, F.col("block")).otherwise(F.col("held.block")).alias("of"),
        F.when(here, F.col("number")).otherwise(F.col("held.n")).alias("number"),
    )


def read_records(
    spark: SparkSession, path: str | list[str], most: int = MAX_RECORD_CHARS
) -> DataFrame:
    """``(record)``: the records under ``path`` without each file's first.

    Line ends within a record are line feeds, whatever they are in the file. Blank
    lines between records are no records; a record that its file's end leaves open
    ends there. One of several lines and more than ``most`` characters fails by name.
    """
    stored = scratch_path(spark, "lines")
    lines = _lines(spark, path)
    lines.write.parquet(stored)
    placed = placed_lines(spark.read.schema(lines.schema).parquet(stored)).where(
        "NOT (of = 0 AND number = 1)"
    )
    alone = F.col("begins") & F.col("ends")
    key = ["file", "of", "number"]
    several = placed.where(~alone)
    long = several.groupBy(*key).agg(F.sum(F.length("line") + 1).alias("chars")).where(
        F.col("chars") > most
    )
    found = long.orderBy(*key).first()
    if found is not None:
        raise ValueError(
            f"a record of {found['chars']} characters, is a quote left open? "
            f"{found['file']}, block {found['of']}, record {found['number']}"
        )
    joined = several.groupBy(*key).agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("block", "pos", "line"))), lambda x: x["line"]),
            "\n",
        ).alias("record")
    )
    single = placed.where(alone & (F.trim("line") != "")).select(F.col("line").alias("record"))
    return single.unionByName(joined.select("record"))
