"""Whole batch jobs composed of operators, arranged so that little data is shuffled."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.functions import day_of_millis
from tidemart.operators import logs, measures, stats, visits
from tidemart.operators.measures import VISITOR_MEASURES
from tidemart.operators.sizing import own_exchange


def visitor_stats_from_log(
    log: DataFrame,
    size: str = stats.WINDOW,
    bounce_timeout_ms: int = visits.BOUNCE_TIMEOUT_MS,
    tie: tuple[str, ...] = (),
    firsts: DataFrame | None = None,
) -> DataFrame:
    """Visitor metrics straight from the raw behaviour log.

    Unique visits and bounces do not depend on the new flag, so the flag is repaired last: measures are summed per
    device, day and window first, and only those sums meet the devices' first days. The log itself is never
    shuffled for the repair, and a busy device arrives there as a handful of rows.

    ``firsts`` are the devices' first days (``logs.first_days``) where ``log`` holds some days only.
    """
    pages = logs.page_log(log)
    # what the metrics read, so that no other column travels with unique visits and bounces
    narrow = pages.select(*tie, "common", F.struct("page.last_page_id").alias("page"), "ts")
    rows = measures.visitor_measures(
        pages,
        visits.unique_visits(narrow, tie),
        visits.bounces(narrow, bounce_timeout_ms, tie),
        keep=("common.mid",),
    ).withColumn("day", day_of_millis(F.col("ts"), "yyyyMMdd"))
    keys = ("vc", "ch", "ar")
    summed = rows.groupBy(F.window("event_time", size), *keys, "is_new", "mid", "day").agg(
        *[F.sum(m).alias(m) for m in VISITOR_MEASURES], F.min("ts").alias("ts")
    )
    firsts = own_exchange(logs.first_days(log) if firsts is None else firsts, "mid").withColumnRenamed("mid", "_mid")
    on = (F.col("mid") == F.col("_mid")) & (F.col("is_new") == "1")
    later = (F.col("is_new") == "1") & (F.col("day") != F.col("first_day"))
    repaired = summed.join(firsts, on, "left").withColumn("is_new", F.when(later, "0").otherwise(F.col("is_new")))
    total = repaired.groupBy("window", *keys, "is_new").agg(
        *[F.sum(m).alias(m) for m in VISITOR_MEASURES], F.min("ts").alias("ts")
    )
    return total.select(
        stats.window_text("start").alias("stt"),
        stats.window_text("end").alias("edt"),
        *keys,
        "is_new",
        *VISITOR_MEASURES,
        "ts",
    )
