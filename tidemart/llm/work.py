"""Helpers the corpus operators share: words, staged tables, column hygiene."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.session import shared_dir

# a word: anything between ASCII white space; bytes.split() cuts the same way
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def work_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared work folder."""
    return f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: later steps start here, also after lost executors."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def content_hash(docs: DataFrame, salt: str | None = None) -> Column:
    """A hash of all columns, so that rows that differ have an order of their own; maps, which can't be hashed, as JSON."""
    maps = [f.name for f in docs.schema.fields if "map<" in f.dataType.simpleString()]
    plain = [F.col(f"`{c}`") for c in docs.columns if c not in maps]
    text = [F.to_json(F.struct(*[F.col(f"`{c}`") for c in maps]))] if maps else []
    return F.xxhash64(*([F.lit(salt)] if salt else []), *plain, *text)


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of 1,000 rows where the session has Spark's default of 10,000: texts may be long."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key, "10000") == "10000":
        spark.conf.set(key, "1000")
