"""What the usage rollup computes per user, as data."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from seatwise.schemas import COUNTERS

# The rollup's totals, in output order.
TOTAL_NAMES: tuple[str, ...] = (
    "total_chat_aicodelines",
    "total_chat_messagesinteracted",
    "total_chat_messagessent",
    "total_codefix_acceptanceeventcount",
    "total_codefix_acceptedlines",
    "total_codefix_generatedlines",
    "total_codefix_generationeventcount",
    "total_codereview_failedeventcount",
    "total_codereview_findingscount",
    "total_codereview_succeededeventcount",
    "total_dev_acceptanceeventcount",
    "total_dev_acceptedlines",
    "total_dev_generatedlines",
    "total_dev_generationeventcount",
    "total_docgeneration_eventcount",
    "total_docgeneration_acceptedfiles",
    "total_docgeneration_acceptedlines",
    "total_docgeneration_rejectedfiles",
    "total_docgeneration_rejectedlines",
    "total_inlinechat_eventcount",
    "total_inlinechat_acceptedlines",
    "total_inlinechat_rejectedlines",
    "total_inline_aicodelines",
    "total_inline_acceptancecount",
    "total_inline_suggestionscount",
    "total_testgeneration_eventcount",
    "total_testgeneration_acceptedlines",
    "total_testgeneration_acceptedtests",
    "total_testgeneration_generatedlines",
    "total_testgeneration_generatedtests",
    "total_transformation_eventcount",
    "total_transformation_linesgenerated",
    "total_transformation_linesingested",
)

# Totals over the row-wise sum of two counters.
PAIRS: dict[str, tuple[str, str]] = {
    "docgeneration_acceptedfiles": (
        "docgeneration_acceptedfileupdates",
        "docgeneration_acceptedfilescreations",
    ),
    "docgeneration_acceptedlines": (
        "docgeneration_acceptedlineadditions",
        "docgeneration_acceptedlineupdates",
    ),
    "docgeneration_rejectedfiles": (
        "docgeneration_rejectedfilecreations",
        "docgeneration_rejectedfileupdates",
    ),
    "docgeneration_rejectedlines": (
        "docgeneration_rejectedlineadditions",
        "docgeneration_rejectedlineupdates",
    ),
    "inlinechat_acceptedlines": (
        "inlinechat_acceptedlineadditions",
        "inlinechat_acceptedlinedeletions",
    ),
    "inlinechat_rejectedlines": (
        "inlinechat_rejectedlineadditions",
        "inlinechat_rejectedlinedeletions",
    ),
}

# Accepted over generated.
RATIOS: dict[str, tuple[str, str]] = {
    "codefix_acceptance": ("codefix_acceptedlines", "codefix_generatedlines"),
    "dev_acceptance": ("dev_acceptedlines", "dev_generatedlines"),
    "test_acceptance": ("testgeneration_acceptedtests", "testgeneration_generatedtests"),
}


@dataclass(frozen=True)
class Total:
    """Sum over one counter, or over the row-wise sum of two."""

    name: str
    inputs: tuple[str, ...]

    def column(self) -> Column:
        # A row with either side missing adds nothing, and int + int may not wrap.
        return F.expr(f"sum({' + '.join(self.inputs)})").alias(self.name)


@dataclass(frozen=True)
class Ratio:
    """Sum over sum; NULL when nothing was generated."""

    name: str
    accepted: str
    generated: str

    def whole(self) -> Column:
        """Integer division, as bigint over bigint is in the original query."""
        return self._over("div").alias(f"{self.name}_ratio")

    def fraction(self) -> Column:
        return self._over("/").alias(f"{self.name}_fraction")

    def of(self, accepted: str, generated: str, kind: str) -> Column:
        """From the two sums: ``kind`` is ``whole`` or ``fraction``."""
        operator, ending = {"whole": ("div", "ratio"), "fraction": ("/", "fraction")}[kind]
        return F.expr(f"{accepted} {operator} nullif({generated}, 0)").alias(f"{self.name}_{ending}")

    def _over(self, operator: str) -> Column:
        return F.expr(f"sum({self.accepted}) {operator} nullif(sum({self.generated}), 0)")


def _total(name: str) -> Total:
    counter = name.removeprefix("total_")
    return Total(name, PAIRS.get(counter, (counter,)))


TOTALS = tuple(_total(name) for name in TOTAL_NAMES)
PAIR_TOTALS = tuple(t for t in TOTALS if len(t.inputs) == 2)
ACCEPTANCE = tuple(Ratio(name, *pair) for name, pair in RATIOS.items())

assert sorted(c for t in TOTALS for c in t.inputs) == sorted(COUNTERS)
