"""Rule-based quality gate: valid rows, and the others with a reason."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.sources.schemas import MEASURES

INFINITY = float("inf")


@dataclass(frozen=True)
class Rule:
    """A test of one column and the reason given to rows that fail it.

    ``holds`` is never NULL, so ``valid`` and ``~valid`` split any input in two.
    ``broken`` may be NULL where the column is, which a CASE takes as false.
    """

    column: str
    check: str
    reason: str

    def holds(self) -> Column:
        col = F.col(self.column)
        if self.check == "not_null":
            return col.isNotNull()
        if self.check == "null":
            return col.isNull()
        if self.check == "not_negative":
            return col.isNotNull() & (col >= 0)
        if self.check == "finite":
            return col.isNotNull() & (F.abs(col) < INFINITY)  # false for NaN, the largest double
        raise ValueError(f"unknown check {self.check!r}")

    def broken(self) -> Column:
        col = F.col(self.column)
        if self.check == "not_null":
            return col.isNull()
        if self.check == "not_negative":
            return col < 0
        return ~self.holds()


# The tests in order of precedence and the text stored with each.
RULES = (
    Rule("time_tag", "not_null", "Missing Primary Key (time_tag)"),
    Rule("solar_wind_speed", "not_null", "Null Solar Wind Speed Measurement"),
    Rule("proton_density", "not_null", "Null Proton Density Measurement"),
    Rule("magnetic_field_total", "not_null", "Null Magnetic Field Measurement"),
    Rule("magnetic_field_bz", "not_null", "Null Z Magnetic Field Measurement"),
    Rule("plasma_temperature", "not_null", "Null Plasma Temperature Measurement"),
    Rule("solar_wind_speed", "not_negative", "Negative Solar Wind Speed Value"),
)
# Fixed value: the reason where no rule names one.
OTHER_REASON = "Failed Validation Check"

# For rows read with their malformed text (``scan.read_typed_csv``): put it first, and a
# cell that did not parse is told from an empty one.
MALFORMED = Rule("_malformed", "null", "Malformed Row")

# NaN and Infinity pass the rules above. Add these to turn them away, before an
# Infinity can reach the mean of the scaler.
FINITE_RULES = tuple(Rule(m, "finite", f"Non-finite value ({m})") for m in MEASURES)


def valid(rules: Sequence[Rule] = RULES) -> Column:
    """True where every rule holds; never NULL."""
    return reduce(and_, [rule.holds() for rule in rules])


def reason(rules: Sequence[Rule] = RULES) -> Column:
    """Text of the first broken rule."""
    first, *others = rules
    case = F.when(first.broken(), first.reason)
    for rule in others:
        case = case.when(rule.broken(), rule.reason)
    return case.otherwise(OTHER_REASON)


def quarantine(
    df: DataFrame, rules: Sequence[Rule] = RULES, col: str = "quarantine_reason"
) -> DataFrame:
    """The rows that fail, each with its reason."""
    return df.filter(~valid(rules)).withColumn(col, reason(rules))


def judged(
    df: DataFrame, rules: Sequence[Rule] = RULES, col: str = "quarantine_reason"
) -> DataFrame:
    """All rows, with the reason where one fails and NULL where it is valid."""
    return df.withColumn(col, F.when(~valid(rules), reason(rules)))


def split(df: DataFrame, rules: Sequence[Rule] = RULES) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows).

    Two filters over one source and no cache: both reach a Parquet scan as
    pushed filters, so the quarantine side skips row groups without NULLs or
    negative values by their statistics.
    """
    return df.filter(valid(rules)), quarantine(df, rules)

