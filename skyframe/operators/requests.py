"""Validation of scoring records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyframe.functions.columns import clean_code


class InvalidRequest(ValueError):
    """At least one record of a batch is out of range."""


# Allowed ranges and raw text lengths of a scoring record.
RANGES = {"Time": (0, 1439), "DayOfWeek": (1, 7)}
LENGTHS = {"Airline": (1, 10), "AirportFrom": (3, 4), "AirportTo": (3, 4)}
CODE_COLUMNS = list(LENGTHS)


def check_requests(records: DataFrame) -> DataFrame:
    """Add ``reasons``, the fields that break their rule (empty when the record is valid).

    Lengths are those of the text as sent; codes are trimmed and upper-cased afterwards.
    """
    # NaN would count as larger than every number.
    rules = {c: F.col(c).between(lo, hi) & ~F.isnan(F.col(c).cast("double")) for c, (lo, hi) in RANGES.items()}
    rules["DayOfWeek"] &= F.col("DayOfWeek").cast("double") == F.floor(F.col("DayOfWeek").cast("double"))
    rules["Length"] = (F.col("Length") > 0) & ~F.isnan(F.col("Length").cast("double"))
    rules |= {c: F.length(c).between(lo, hi) for c, (lo, hi) in LENGTHS.items()}
    broken = F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(c)) for c, ok in sorted(rules.items())])
    return records.withColumn("reasons", F.array_compact(broken)).withColumns(
        {c: clean_code(c) for c in CODE_COLUMNS}
    )


def valid_requests(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("reasons") == 0).drop("reasons")


def rejected_requests(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("reasons") > 0)


def require_valid(records: DataFrame) -> DataFrame:
    """The cleaned records, or an error if a single one is invalid."""
    checked = check_requests(records)
    bad = rejected_requests(checked)
    if not bad.isEmpty():
        raise InvalidRequest(f"invalid records, first: {bad.first().asDict()}")
    return valid_requests(checked)
