"""Date patterns of the hosted query service, made into Spark's.

A pattern is text known when the query is written, so it is compiled then and the
plan holds Spark's pattern as a literal. What cannot be said in Spark's patterns
is refused by name, in place of a pattern that quietly reads something else.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Pattern letters that mean the same or have another name in Spark's
# patterns. Years, months, days, hours of four kinds, minutes, seconds, parts of a
# second, half of the day, day of the year.
LETTERS = {
    "Y": "y", "y": "y", "M": "M", "d": "d", "H": "H", "k": "k", "K": "K", "h": "h",
    "m": "m", "s": "s", "S": "S", "a": "a", "D": "D",
}

#: Fields of at most two digits: standing alone they take one digit as well.
SHORT = "MdHkKhms"

_PIECE = re.compile(r"'(?:[^']|'')*'|([A-Za-z])\1*|'|[^A-Za-z']+")


def spark_pattern(pattern: str) -> str:
    """Spark's pattern for one of the service's.

    Quoted text stays as it is. A two-letter number between separators takes one
    digit or two; beside another field the letters tell how many digits to read.
    Raises for letters that are not known and for a quote without its end.
    """
    pieces = [m[0] for m in _PIECE.finditer(pattern)]
    out = []
    for i, piece in enumerate(pieces):
        letter = piece[0]
        if piece == "'":
            raise ValueError(f"pattern {pattern!r}: a quote has no end")
        if not letter.isalpha() or not letter.isascii():
            out.append(piece)
            continue
        if letter not in LETTERS:
            raise ValueError(f"pattern {pattern!r}: letter {letter!r} is not known")
        beside = [p for p in (pieces[i - 1 : i] + pieces[i + 1 : i + 2]) if p[0].isalpha()]
        short = len(piece) == 2 and letter in SHORT and not beside
        out.append(LETTERS[letter] * (1 if short else len(piece)))
    return "".join(out)


def parse_datetime(text: Column, pattern: str, on_bad_date: str = "raise") -> Column:
    """The moment as TIMESTAMP_NTZ; other text fails the query, or gives NULL if asked to."""
    compiled = F.lit(spark_pattern(pattern))
    if on_bad_date == "raise":
        return F.to_timestamp_ntz(text, compiled)
    if on_bad_date == "null":
        # By way of a day and a time zone where every hour exists.
        return F.try_to_timestamp(text, compiled).cast("timestamp_ntz")
    raise ValueError(f"on_bad_date must be 'raise' or 'null', not {on_bad_date!r}")
