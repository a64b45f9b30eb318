"""Sharding by rendezvous hashing: every record goes to the shard that draws the best lot for its key.

A shard's lot for a key is an exponential draw whose rate is the shard's weight, made from SHA-256 of key and shard
number; the smallest lot wins. A shard's share of the keys follows its weight, key and weights alone decide, and one more
shard takes records only into itself, as all other lots stay as they are.

:func:`write` lays the records down as Parquet, one folder for each shard, ordered by key in the shard. Records are dealt
to files by range of (shard, key, text, row), so that a key on very many rows is cut over many files. A record's slot
is its place in its shard: the rows of the shard's files before, and its row in its own file.

Defined cases: a null key is the key of no characters; rows of one key share a shard, equal texts of different keys need
not; null text is kept as it is and has no bytes; a shard without rows has no folder; a table without rows gives none; other
columns are carried along, but for one named like the shard column, which is replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.llm.work import work_path

SHARDS = 24
# hexadecimal digits of a digest that make a number a double holds exactly
DIGITS = 13


def key_of(column: str = "doc_id") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def lot(key: Column, shard: int, weight: float) -> Column:
    """The draw of a shard for a key: small lots win, more often for large weights."""
    digits = F.substring(F.sha2(F.concat(key, F.lit(f":{shard}")), 256), 1, DIGITS)
    number = F.conv(digits, 16, 10).cast("double")
    return -F.log((number + 0.5) / float(16**DIGITS)) / float(weight)


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """The shard of a key among shards of these weights; of equal lots the lower number's wins."""
    lots = [F.struct(lot(key, n, w).alias("lot"), F.lit(n).alias("shard")) for n, w in enumerate(weights)]
    return F.array_min(F.array(*lots))["shard"]


def write(docs: DataFrame, weights: Sequence[float] = (1,) * SHARDS, key: str = "doc_id", path: str | None = None) -> str:
    """Write the records of ``docs`` below one folder for each shard; returns their folder (new by default)."""
    path = path or work_path(docs.sparkSession, "shards")
    kept = [c for c in docs.columns if c.lower() != "shard"]
    rows = docs.select(
        F.struct(*kept).alias("_row"), shard_of(key_of(key), weights).alias("shard"), F.col(key).alias("_key"),
        F.xxhash64("text").alias("_text"), F.monotonically_increasing_id().alias("_tie"),
    )
    order = ["shard", "_key", "_text", "_tie"]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("_row.*", "shard")
    dealt.write.partitionBy("shard").option("compression", "zstd").parquet(path)
    return path


def read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The records of all shards, ``shard`` and ``slot``; ``schema`` is that of the records written."""
    fields = [f for f in schema.fields if f.name.lower() != "shard"]
    rows = spark.read.schema(T.StructType([*fields, T.StructField("shard", T.IntegerType())])).parquet(path)
    file = F.col("_metadata.file_name").alias("_file")
    # one row for each file
    files = rows.select("shard", file).groupBy("shard", "_file").count()
    number = F.regexp_extract("_file", r"part-(\d+)", 1).cast("long")
    earlier = Window.partitionBy("shard").orderBy(number, "_file").rowsBetween(Window.unboundedPreceding, -1)
    begins = files.select("shard", "_file", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("_begin"))
    placed = rows.select(*rows.columns, file, F.col("_metadata.row_index").alias("_place"))
    return placed.join(begins, ["shard", "_file"]).select(
        *rows.columns, (F.col("_begin") + F.col("_place")).alias("slot")
    )
