"""Which address of a profile counts, and when a profile counts at all."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def primary_or_blank(emails: Column) -> Column:
    """The first address marked primary, else blank."""
    primary = F.filter(emails, lambda e: F.coalesce(e["Primary"], F.lit(False)))
    return F.coalesce(F.get(primary, F.lit(0))["Value"], F.lit(""))


def first_or_null(emails: Column) -> Column:
    """The first address whatever its mark, NULL when the profile lists none."""
    return F.get(emails, F.lit(0))["Value"]


def has_usable_emails(emails: Column) -> Column:
    """An absent list is fine, a list that is there but empty is not.

    A profile with an empty list counts as unknown wherever the first address
    is asked for, so this gates the whole profile, not only the address.
    """
    return emails.isNull() | (F.size(emails) > 0)
