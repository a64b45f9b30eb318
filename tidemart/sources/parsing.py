"""JSON records to typed rows, unreadable records kept apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.schemas import CDC_DDL

CORRUPT = "_corrupt_record"


def computed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df.withColumn(name, value)`` for a costly ``value`` that later filters look at.

    A filter on an ordinary computed column is pushed below it with a copy of the computation for every mention. The
    output of a generator is not: the value is computed once per row.
    """
    others = [c for c in df.columns if c != name]
    return df.select(*others, F.inline(F.array(F.struct(value.alias(name)))))


def parsed(df: DataFrame, ddl: str, value: str) -> DataFrame:
    """``df`` with the record as ``_row``, null or with its text in :data:`CORRUPT` where it can't be read."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return computed_once(df, "_row", F.from_json(F.col(value), f"{ddl}, {CORRUPT} string", options))


def parse_rows(df: DataFrame, ddl: str, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows that could be read, as the columns of ``ddl`` (plus the ``keep`` columns of the input)."""
    good = parsed(df, ddl, value).filter(F.col("_row").isNotNull() & F.col(f"_row.{CORRUPT}").isNull())
    return good.select(*keep, "_row.*").drop(CORRUPT)


def parse_records(
    df: DataFrame, ddl: str, value: str = "value", keep: tuple[str, ...] = ()
) -> tuple[DataFrame, DataFrame]:
    """``(rows, dead letters)``: a bad record lands in the second frame instead of failing the job."""
    dead = parsed(df, ddl, value).filter(F.col("_row").isNull() | F.col(f"_row.{CORRUPT}").isNotNull())
    return parse_rows(df, ddl, value, keep), dead.select(*keep, value)


def parse_cdc(df: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """CDC envelope ``table, type, data``; ``data`` stays JSON text, its columns depend on configuration."""
    return parse_rows(df, CDC_DDL, value, keep)
