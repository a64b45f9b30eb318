"""Behaviour log: new-visitor repair, split by kind, display rows, entry pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions import day_of_millis, millis_to_second
from tidemart.operators.sizing import own_exchange


def is_start() -> Column:
    return F.coalesce(F.size("start"), F.lit(0)) > 0


def is_entry(last_page: str = "page.last_page_id") -> Column:
    """No previous page, so the visit begins here."""
    return F.coalesce(F.col(last_page), F.lit("")) == ""


def start_log(log: DataFrame) -> DataFrame:
    return log.filter(is_start())


def page_log(log: DataFrame) -> DataFrame:
    """Every record that is not a start record."""
    return log.filter(~is_start())


def display_log(log: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per displayed item of a page record, with the page's id (and ``keep``); start records give none."""
    return (
        page_log(log)
        .select(*keep, F.col("page.page_id").alias("page_id"), F.explode("displays").alias("_display"))
        .select("_display.*", "page_id", *keep)
    )


def entry_pages(log: DataFrame) -> DataFrame:
    return log.filter(is_entry())


def first_days(log: DataFrame) -> DataFrame:
    """``mid, first_day``: the earliest day a device was logged as new.

    A hash aggregate over two narrow columns, combined before the shuffle, so a busy device costs one row per
    task.
    """
    new = log.filter(F.col("common.is_new") == "1")
    firsts = new.groupBy(F.col("common.mid").alias("mid")).agg(F.min("ts").alias("first_ts"))
    return firsts.select("mid", day_of_millis(F.col("first_ts"), "yyyyMMdd").alias("first_day"))


def repaired_flag(is_new: Column, ts: Column, first_day: Column) -> Column:
    """``'0'`` for a record flagged new on a later day than the device's first one."""
    later = (is_new == "1") & (day_of_millis(ts, "yyyyMMdd") != first_day)
    return F.when(later, F.lit("0")).otherwise(is_new)


def repair_new_visitors(log: DataFrame, firsts: DataFrame | None = None) -> DataFrame:
    """Correct ``common.is_new``: only a device's records of its first new day keep ``'1'``.

    A join to one narrow row per device instead of an ordered window per device: the optimizer broadcasts it
    when it is small, and adaptive execution splits the log side of a busy device when it is not.
    """
    firsts = own_exchange(first_days(log) if firsts is None else firsts, "mid")
    firsts = firsts.select(F.col("mid").alias("_mid"), "first_day")
    on = (F.col("common.mid") == F.col("_mid")) & (F.col("common.is_new") == "1")
    flag = repaired_flag(F.col("common.is_new"), F.col("ts"), F.col("first_day"))
    return (
        log.join(firsts, on, "left")
        .withColumn("common", F.col("common").withField("is_new", flag))
        .drop("_mid", "first_day")
    )


def search_fullwords(log: DataFrame) -> DataFrame:
    """``fullword, rowtime`` of result-list pages that carry a search text."""
    wanted = (F.col("page.page_id") == "good_list") & F.col("page.item").isNotNull()
    return log.filter(wanted).select(
        F.col("page.item").alias("fullword"), millis_to_second(F.col("ts")).alias("rowtime")
    )
