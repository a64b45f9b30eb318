"""Visit facts: daily unique visits and bounces."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.functions import day_of_millis
from tidemart.operators.logs import entry_pages, is_entry

BOUNCE_TIMEOUT_MS = 10_000


def visit_order(pages: DataFrame, tie: tuple[str, ...] = ()) -> dict[str, Column]:
    """Named columns that order a device's pages: time, then ``tie``.

    Without ``tie`` the content decides between pages of one millisecond, so that every run gives the same: first what
    metrics read, then all columns (maps can't be hashed and are left out).
    """
    if tie:
        return {c: F.col(c) for c in ("ts", *tie)}
    plain = [f.name for f in pages.schema.fields if "map<" not in f.dataType.simpleString()]
    read = F.xxhash64("common.vc", "common.ch", "common.ar", "page.last_page_id")
    return {"ts": F.col("ts"), "_read": read, "_content": F.xxhash64(*plain)}


def unique_visits(pages: DataFrame, tie: tuple[str, ...] = ()) -> DataFrame:
    """The first entry page of each device and day, from a batch table; pages without time belong to no day.

    Spark cuts each task's rows to one per (device, day) before the shuffle, so a hot device is no hot group. The
    streaming form is ``tidemart.streaming.unique_visits``.
    """
    first = Window.partitionBy("common.mid", "_day").orderBy(*visit_order(pages, tie).values())
    return (
        entry_pages(pages)
        .filter(F.col("ts").isNotNull())
        .withColumn("_day", day_of_millis(F.col("ts")))
        .withColumn("_rank", F.row_number().over(first))
        .filter(F.col("_rank") == 1)
        .drop("_rank", "_day")
    )


def bounces(
    pages: DataFrame,
    timeout_ms: int = BOUNCE_TIMEOUT_MS,
    tie: tuple[str, ...] = (),
    delay_ms: int = 0,
) -> DataFrame:
    """Entry pages not followed by another page of the device within the timeout; batch and streaming.

    Time is cut into slots as wide as the timeout. Two pages in one slot are always closer than the timeout, so
    only the last page of a slot can be a bounce, and only the first page of the next slot can prevent it. Both
    are plain maxima and minima: every page reports to its own slot, and its time to the slot before. One
    aggregate, combined before the shuffle, replaces an ordered window over all pages of a device.

    A report about a slot is filed one slot later, where the next slot's reports are filed too. On a stream that is
    the window in which the last of them can arrive; the watermark, ``delay_ms`` behind the pages, closes it.
    """
    order = F.struct(*[value.alias(name) for name, value in visit_order(pages, tie).items()])
    page = F.struct(*pages.columns)
    # only entry pages take their columns along; the other reports are times alone
    own = F.struct(
        (F.col("ts") + timeout_ms).alias("filed"),
        order.alias("order"),
        F.when(is_entry(), page).alias("page"),
        F.lit(None).cast("bigint").alias("next_ts"),
    )
    before = F.struct(
        F.col("ts").alias("filed"),
        F.when(F.lit(False), order).alias("order"),
        F.when(F.lit(False), page).alias("page"),
        F.col("ts").alias("next_ts"),
    )
    reports = pages.select(F.col("common.mid").alias("_mid"), F.explode(F.array(own, before)).alias("_at")).select(
        "_mid", "_at.*", F.timestamp_millis("_at.filed").alias("_filed")
    )
    if pages.isStreaming:
        reports = reports.withWatermark("_filed", f"{delay_ms + timeout_ms} milliseconds")
    return (
        reports.groupBy("_mid", F.window("_filed", f"{timeout_ms} milliseconds"))
        .agg(F.max_by("page", "order").alias("_last"), F.min("next_ts").alias("_next_ts"))
        .filter(F.col("_last").isNotNull())
        .filter(F.col("_next_ts").isNull() | (F.col("_next_ts") - F.col("_last.ts") >= timeout_ms))
        .select("_last.*")
    )
