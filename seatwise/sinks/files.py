"""CSV exports and the text report.

Results are written as a folder of part files by all tasks. A sorted result
keeps its order over the parts in name order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seatwise.functions.text import export_stamp

# The columns of the activity export and of the user export.
ACTIVITY_EXPORT = {
    "user_id": "UserId",
    "user_name": "Username",
    "email": "Email",
    "display_name": "DisplayName",
    "last_activity_date": "LastActivityDate",
}
USER_EXPORT = {
    "user_id": "UserId",
    "user_name": "Username",
    "email": "Email",
    "first_name": "FirstName",
    "last_name": "LastName",
    "display_name": "DisplayName",
}


def write_csv(result: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """Quotes only where needed, doubled inside; missing values are blank.

    Every file starts with a header line, also where there are no rows. Lines end
    in a plain line feed: with any other ending the writer would also change the
    line feeds inside values.
    """
    (
        result.write.mode(mode)
        .option("header", True)
        .option("escape", '"')
        .option("nullValue", "")
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path


def export_users(
    users: DataFrame, folder: str, name: str | None = None, mode: str = "errorifexists"
) -> str | None:
    """The direct users as CSV; nothing at all is written when there are none."""
    if users.isEmpty():
        return None
    if name is None:
        now = users.sparkSession.range(1).select(export_stamp(F.current_timestamp()))
        name = f"application_users_{now.first()[0]}.csv"
    return write_csv(_renamed(users, USER_EXPORT), f"{folder.rstrip('/')}/{name}", mode)


def export_activity(activity: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """Five fixed columns; with no rows the header is still written."""
    return write_csv(_renamed(activity, ACTIVITY_EXPORT), path, mode)


def _renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.select(*(F.col(old).alias(new) for old, new in names.items()))


def write_report(report: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """The lines of an ordered report as text."""
    report.select("line").write.mode(mode).text(path)
    return path
