"""Names for SQL text that was written for the hosted query service."""

from __future__ import annotations

from pyspark.sql import SparkSession

from seatwise.functions.patterns import LETTERS, SHORT

#: Text outside of quotes: an even number of quotes follows.
_OUTSIDE = "(?=(?:[^']*+'[^']*+')*+[^']*+$)"

# The rules of ``patterns.spark_pattern`` as expressions over the pattern. Patterns are
# literals, so all of this is worked out once while the query is planned and the plan
# holds the pattern it leads to. The function is expanded into the query, it is no UDF.
_COMPILED = rf"""regexp_replace(regexp_replace(pattern, r"Y{_OUTSIDE}", 'y'),
    r"(?<![A-Za-z])([{SHORT}])\1(?![A-Za-z]){_OUTSIDE}", '$1')"""
_UNKNOWN = rf"""regexp_extract(pattern, r"([A-Za-z&&[^{"".join(LETTERS)}]]){_OUTSIDE}", 1)"""
_PARSE_DATETIME = f"""
CREATE OR REPLACE TEMPORARY FUNCTION parse_datetime(value STRING, pattern STRING)
RETURNS TIMESTAMP_NTZ
RETURN CASE
    WHEN pattern NOT RLIKE r"^[^']*+(?:'[^']*+'[^']*+)*+$"
        THEN raise_error(concat('pattern ', pattern, ': a quote has no end'))
    WHEN {_UNKNOWN} <> ''
        THEN raise_error(concat('pattern ', pattern, ': letter ', {_UNKNOWN}, ' is not known'))
    ELSE to_timestamp_ntz(value, {_COMPILED}) END
"""


def register_sql_functions(spark: SparkSession) -> None:
    spark.sql(_PARSE_DATETIME)
