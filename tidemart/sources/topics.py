"""Record streams: Kafka topics in production, ordered file replay elsewhere."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemart.sources.parsing import parse_rows


def read_topic(
    spark: SparkSession,
    topic: str,
    bootstrap: str,
    group_id: str | None = None,
    starting_offsets: str = "earliest",
    max_offsets: int | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """One topic as a streaming ``value string`` frame; offsets live in the query's checkpoint.

    A first start reads all the topic holds (``starting_offsets="latest"`` skips it). ``max_offsets`` limits a
    micro-batch; by default it takes all there is.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets))
    if group_id:
        reader = reader.option("groupIdPrefix", group_id)
    for key, value in (options or {}).items():
        reader = reader.option(key, value)
    return reader.load().selectExpr("cast(value as string) as value")


def replay_files(
    spark: SparkSession,
    path: str,
    schema,
    fmt: str = "parquet",
    files_per_batch: int | None = None,
) -> DataFrame:
    """A folder of files as a stream, oldest modification time first; ``files_per_batch`` sets the pace of a replay."""
    reader = spark.readStream.format(fmt).schema(schema).option("latestFirst", "false")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(files_per_batch))
    return reader.load(path)


def topic_view(
    records: DataFrame,
    ddl: str,
    name: str,
    rowtime: str | None = None,
    delay: str = "0 seconds",
) -> DataFrame:
    """Register a record stream as a SQL table: typed columns, an optional computed ``rowtime`` with a watermark.

    ``rowtime`` is a SQL expression over the columns. Query the view with ``spark.sql``.
    """
    rows = parse_rows(records, ddl)
    if rowtime:
        rows = rows.selectExpr("*", f"{rowtime} AS rowtime")
        if rows.isStreaming:
            rows = rows.withWatermark("rowtime", delay)
    rows.createOrReplaceTempView(name)
    return rows
