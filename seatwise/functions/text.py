"""Text clean-up and formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: every character that counts as white space at the ends of an id.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Fixed value: what an object address starts with.
SCHEME = "s3://"


def clean_user_id(raw: Column) -> Column:
    """The id without the literal quotes the usage files carry."""
    return F.replace(raw, F.lit('"'), F.lit(""))


def strip_blanks(value: Column) -> Column:
    """Both ends free of any blank, not only of spaces as ``trim`` does."""
    return F.btrim(value, F.lit(BLANKS))


def uri_bucket(uri: Column) -> Column:
    return F.get(_uri_parts(uri), F.lit(0))


def uri_key(uri: Column) -> Column:
    """Everything behind the first slash; NULL when there is none."""
    return F.get(_uri_parts(uri), F.lit(1))


def _uri_parts(uri: Column) -> Column:
    return F.split(F.replace(uri, F.lit(SCHEME), F.lit("")), "/", 2)


def export_stamp(moment: Column) -> Column:
    """Time stamp used in default export names."""
    return F.date_format(moment, "yyyyMMdd_HHmmss")


def shown(value: Column) -> Column:
    """Report text of a value that may be missing."""
    return F.coalesce(value, F.lit("None"))


def user_line(display_name: Column, email: Column) -> Column:
    return F.format_string("- %s (%s)", shown(display_name), shown(email))
