"""A list of user ids with their last active day, as quoted CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seatwise.functions.text import strip_blanks
from seatwise.schemas import USER_LIST
from seatwise.sources.quoted_records import has_open_lines, read_records


def read_user_list(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Columns by position; header and blank lines dropped, copies kept.

    A record without a date gives a NULL date. Line breaks may stand inside quotes.
    Large files are split between tasks: where all records are lines of their own,
    which one look at the lines tells, as they are read, else record by record.
    ``multi_line`` leaves it to one task per file.
    """
    if multi_line or not has_open_lines(spark, path):
        rows = (
            spark.read.schema(USER_LIST)
            .option("header", True)
            .option("enforceSchema", True)
            .option("escape", '"')
            .option("multiLine", multi_line)
            .csv(path)
        )
    else:
        fields = F.from_csv("record", USER_LIST.toDDL(), {"escape": '"'})
        rows = read_records(spark, path).select(fields.alias("f")).select("f.*")
    return rows.select(strip_blanks(F.col("user_id")).alias("user_id"), "last_activity_date")
