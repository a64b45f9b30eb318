"""Batch tables and the routing configuration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, TimestampNTZType

from tidemart.schemas import TABLE_PROCESS_DDL, struct


def table(
    spark: SparkSession,
    folder: str,
    name: str,
    schema: StructType | str | None = None,
    where: Column | None = None,
) -> DataFrame:
    """One Parquet table; zone-less timestamps become session-zone timestamps (watermarks need them).

    With a declared ``schema`` no file is opened before the query runs. ``where`` sees the columns as they are stored, so
    that scans can evaluate it.
    """
    reader = spark.read.schema(schema) if schema else spark.read
    df = reader.parquet(f"{folder}/{name}.parquet")
    if where is not None:
        df = df.filter(where)
    casts = {
        f.name: F.col(f.name).cast("timestamp") for f in df.schema.fields if isinstance(f.dataType, TimestampNTZType)
    }
    return df.withColumns(casts) if casts else df


def read_routing(
    spark: SparkSession,
    path: str | None = None,
    jdbc: dict[str, str] | None = None,
) -> DataFrame:
    """The routing configuration ``table_process`` from a Parquet folder or over JDBC.

    Call it at the start of each micro-batch: every batch then sees one consistent version, deletions included.
    """
    if (path is None) == (jdbc is None):
        raise ValueError("give either path or jdbc options")
    if path is not None:
        return spark.read.schema(struct(TABLE_PROCESS_DDL)).parquet(path)
    names = [f.name for f in struct(TABLE_PROCESS_DDL).fields]
    return spark.read.format("jdbc").options(**{"dbtable": "table_process", **jdbc}).load().select(*names)
