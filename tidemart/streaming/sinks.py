"""Sinks that give the same result when a micro-batch is repeated, also to jobs that read them as file streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

EVERY_FIVE_SECONDS = {"processingTime": "5 seconds"}


def path_exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def published_batches(spark: SparkSession, path: str) -> list[int]:
    """Ids of the micro-batches that :func:`append_batch` has published below ``path``, in ascending order."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/batch_id=*/_SUCCESS")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    return sorted(int(f.getPath().getParent().getName().split("=")[1]) for f in found or [])


def append_batch(df: DataFrame, path: str, batch_id: int, by: tuple[str, ...] = ()) -> None:
    """Publish one micro-batch once, as its own ``batch_id`` folder with the ``by`` partitions below.

    The folder's success mark is set when all files are in place. A repeated batch that finds the mark writes nothing, so
    its files keep their names and a job that reads the folder as a file stream doesn't meet the rows again. Without the
    mark the batch did not end, and is written anew.
    """
    folder = f"{path}/batch_id={batch_id}"
    if not path_exists(df.sparkSession, f"{folder}/_SUCCESS"):
        df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*by).parquet(folder)


def append_metrics(df: DataFrame, path: str, batch_id: int) -> None:
    """Metric rows, partitioned by the day of their window start."""
    append_batch(df.withColumn("dt", F.to_date(F.substring("stt", 1, 10))), path, batch_id, ("dt",))


def append_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str], batch_size: int = 10_000) -> None:
    """Metric rows to a relational store, columns in the frame's order."""
    options = {**properties, "batchsize": str(batch_size)}
    df.write.jdbc(url, table, mode="append", properties=options)


def topic_records(df: DataFrame, topic: str | None = None, key: str | None = None) -> DataFrame:
    """``topic, key, value`` records with the row as JSON; shaped for the Kafka sink."""
    columns = [F.to_json(F.struct(*df.columns)).alias("value")]
    if key:
        columns.insert(0, F.col(key).cast("string").alias("key"))
    if topic:
        columns.insert(0, F.lit(topic).alias("topic"))
    return df.select(*columns)


def start_topic(records: DataFrame, bootstrap: str, checkpoint: str, topic: str | None = None) -> StreamingQuery:
    """Write ``value`` (and ``topic``, ``key``) records to Kafka; without ``topic`` each record names its own."""
    writer = records.writeStream.format("kafka").option("kafka.bootstrap.servers", bootstrap)
    if topic:
        writer = writer.option("topic", topic)
    return writer.option("checkpointLocation", checkpoint).trigger(**EVERY_FIVE_SECONDS).start()


def start_batches(
    df: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    name: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Run ``write(batch, batch_id)`` for every micro-batch, in append mode."""
    writer = df.writeStream.foreachBatch(write).outputMode("append").option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return writer.trigger(**(trigger or EVERY_FIVE_SECONDS)).start()
