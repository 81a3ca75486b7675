"""The delay dataset as CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyframe import constants as K
from skyframe.schemas import DELAY

# Texts that count as missing in a CSV cell.
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


class InvalidDataset(ValueError):
    """The file lacks an expected column or holds a missing value."""


def null_counts_row(df: DataFrame) -> DataFrame:
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def load_flights(spark: SparkSession, path: str) -> DataFrame:
    """Read and check the file: every expected column there, no missing value anywhere.

    Extra columns are allowed and kept as text. Nulls of all columns are counted in one pass.
    """
    reader = spark.read.option("header", True)
    header = reader.csv(path).columns
    absent = [c for c in K.DELAY_COLUMNS if c not in header]
    if absent:
        raise InvalidDataset(f"missing columns: {absent}")
    raw = reader.option("enforceSchema", False).schema(
        T.StructType([T.StructField(c, T.StringType()) for c in header])
    ).csv(path)
    types = {f.name: f.dataType for f in DELAY}

    def cell(name: str):
        text = F.when(~F.col(name).isin(*MISSING_TEXTS), F.col(name))
        dtype = types.get(name, T.StringType())
        if isinstance(dtype, (T.IntegerType, T.LongType)):
            # Digits first, so that no integer goes through a double; "3.0" is whole, "3.9" is not.
            number = text.try_cast("double")
            whole = F.when(number == F.floor(number), number).try_cast(dtype)
            return F.when(text.rlike(r"^\s*[+-]?\d+\s*$"), text.try_cast(dtype)).otherwise(whole).alias(name)
        return text.try_cast(dtype).alias(name)

    flights = raw.select(*[cell(c) for c in header])
    nulls = {c: n for c, n in null_counts_row(flights).first().asDict().items() if n}
    if nulls:
        raise InvalidDataset(f"missing values: {nulls}")
    return flights
