"""Rebuild the whole warehouse, or some days of it, from batch tables, layer by layer.

Every layer is written once, partitioned by day, and the next layers read what was written: nothing is computed twice,
lineage ends at each table, and a lost executor costs at most the layer in progress. Dashboard queries on the metric
tables then read one day's folder.

Where only the records of some days have changed since the last rebuild, each method takes these days and rewrites the
folders that can depend on them: the days themselves, and those that joins, timeouts and windows reach from there. Records
without a time belong to no day, so changes of them need a whole rebuild, as do changes of dimensions.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.functions import day_of_millis
from tidemart.operators import keywords, logs, measures, stats, visits, wide
from tidemart.operators.dims import VALID_FROM, current_rows
from tidemart.session import shared_dir

ONE_DAY = timedelta(days=1)
Days = Iterable[date] | None


@dataclass(frozen=True)
class Settings:
    window: str = stats.WINDOW
    keyword_window: str = stats.WINDOW
    bounce_timeout_ms: int = visits.BOUNCE_TIMEOUT_MS
    order_bound: timedelta = wide.ORDER_BOUND
    payment_bound: timedelta = wide.PAYMENT_BOUND
    tie: tuple[str, ...] = ()


def days_around(days: Days, before: timedelta = timedelta(0), after: timedelta = timedelta(0)) -> list[date] | None:
    """``days`` and those within reach of them."""
    if days is None:
        return None
    reach = range(-before // ONE_DAY, -(-after // ONE_DAY) + 1)
    return sorted({day + k * ONE_DAY for day in days for k in reach})


def on_days(time: Column, days: Days, millis: bool = False) -> Column:
    """A time on one of ``days``, as ranges of adjacent days, which scans evaluate."""
    if days is None:
        return F.lit(True)
    found, days = F.lit(False), sorted(days)
    starts = [d for d in days if d - ONE_DAY not in days]
    ends = [d + ONE_DAY for d in days if d + ONE_DAY not in days]
    for begin, end in zip(starts, ends, strict=True):
        edges = [F.lit(str(day)).cast("timestamp") for day in (begin, end)]
        low, high = [F.unix_millis(e) for e in edges] if millis else edges
        found = found | ((time >= low) & (time < high))
    return found


class Backfill:
    def __init__(self, spark: SparkSession, out: str | None = None, settings: Settings = Settings()):
        self.spark = spark
        self.out = out or f"{shared_dir(spark)}/warehouse"
        self.settings = settings

    def read(self, name: str, days: Days = None) -> DataFrame:
        rows = self.spark.read.parquet(f"{self.out}/{name}")
        return rows if days is None else rows.filter(F.col("dt").isin(list(days)))

    def _write(
        self, df: DataFrame, name: str, day: Column, by: tuple[str, ...] = (), days: list[date] | None = None
    ) -> DataFrame:
        """Write by day, all of them or ``days``. The rebalance hint gathers a day's rows into few files and splits the
        days that are large. A folder of ``days`` that has no rows any more is left with an empty file."""
        dated = df.withColumn("dt", day.cast("date"))
        mode = "static"
        if days is not None:
            dated, mode = dated.filter(F.col("dt").isin(days)), "dynamic"
        before = self._files(name, by, days or [])
        writer = dated.hint("rebalance", *by, "dt").write.mode("overwrite").option("partitionOverwriteMode", mode)
        writer.partitionBy(*by, "dt").parquet(f"{self.out}/{name}")
        after = self._files(name, by, days or [])
        for folder in [f for f, files in before.items() if after.get(f) == files]:
            nothing = self.spark.createDataFrame([], dated.drop(*by, "dt").schema)
            nothing.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(folder)
        return self.read(name)

    def _files(self, name: str, by: tuple[str, ...], days: list[date]) -> dict[str, set[str]]:
        """The folders of ``days`` and the names of their files."""
        found: dict[str, set[str]] = {}
        for day in days:
            place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.out}/{name}/{'*/' * len(by)}dt={day}/*.parquet")
            files = place.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(place)
            for file in files or []:
                found.setdefault(file.getPath().getParent().toString(), set()).add(file.getPath().getName())
        return found

    def _metrics(self, df: DataFrame, name: str, days: list[date] | None) -> DataFrame:
        return self._write(df, name, F.substring("stt", 1, 10), days=days)

    def _reach(self, window: str) -> timedelta:
        """How far a window can reach into the next day: not at all where it divides every time zone's offset."""
        seconds = self.spark.sql(f"SELECT unix_seconds(timestamp_seconds(0) + INTERVAL {window})").first()[0]
        return timedelta(0) if 900 % seconds == 0 else timedelta(seconds=seconds)

    def _first_days(self, log: DataFrame) -> DataFrame:
        logs.first_days(log).write.mode("overwrite").parquet(f"{self.out}/first_days_next")
        return self.read("first_days_next")

    def _days_repaired_anew(self, log: DataFrame, firsts: DataFrame) -> set[date]:
        """Days of new-flagged records of the devices whose first day is not the one of the last rebuild."""
        old = self.read("first_days").withColumnRenamed("first_day", "_old").filter(F.col("mid").isNotNull())
        both = old.join(firsts.filter(F.col("mid").isNotNull()), "mid", "full")
        moved = both.filter(~F.col("first_day").eqNullSafe(F.col("_old"))).select("mid")
        day = day_of_millis(F.col("ts")).cast("date").alias("dt")
        flagged = log.filter(F.col("common.is_new") == "1").select(F.col("common.mid").alias("mid"), day).distinct()
        found = flagged.join(moved, "mid", "left_semi").select("dt").distinct().collect()
        return {row["dt"] for row in found if row["dt"]}

    def behaviour(self, log: DataFrame, changed: Days = None) -> list[date] | None:
        """Log, visits, bounces, visitor and search keyword metrics. Returns the days of page records written, which
        :meth:`products` wants to know.

        ``changed``: the days whose records differ from the last rebuild. Days on which a device's new flag comes out
        otherwise because its first day has moved are found here and rewritten too; that reads three columns of the whole
        log.
        """
        s = self.settings
        firsts = self._first_days(log)
        days = None if changed is None else sorted({*changed, *self._days_repaired_anew(log, firsts)})
        kind = F.when(logs.is_start(), F.lit("start")).otherwise(F.lit("page"))
        read = log if days is None else log.filter(on_days(F.col("ts"), days, millis=True))
        repaired = logs.repair_new_visitors(read, firsts).withColumn("kind", kind)
        day = day_of_millis(F.col("ts"))
        # start and page records are one dataset of two folders: the repair runs once
        self._write(repaired, "dwd_log", day, ("kind",), days)
        dated = self.read("dwd_log", days).filter(F.col("kind") == "page")
        # display rows carry no time: they are of their page's day
        self._write(logs.display_log(dated, ("dt",)), "dwd_display_log", F.col("dt"), days=days)
        pages = self.pages(days)
        self._write(visits.unique_visits(pages, s.tie), "dwm_unique_visit", day, days=days)

        timeout = timedelta(milliseconds=s.bounce_timeout_ms)
        bounce_days = days_around(days, before=timeout)
        near = self.pages(days_around(bounce_days, after=timeout))
        self._write(visits.bounces(near, s.bounce_timeout_ms, s.tie), "dwm_user_jump_detail", day, days=bounce_days)

        span = self._reach(s.window)
        windows = days_around(bounce_days, before=span)
        read_days = days_around(windows, after=span)
        rows = measures.visitor_measures(
            self.pages(read_days), self.read("dwm_unique_visit", read_days), self.read("dwm_user_jump_detail", read_days)
        )
        self._metrics(stats.visitor_stats(rows, s.window), "visitor_stats", windows)

        span = self._reach(s.keyword_window)
        windows = days_around(days, before=span)
        found = keywords.tokenize(logs.search_fullwords(self.pages(days_around(windows, after=span))), "fullword")
        self._metrics(stats.keyword_stats_search(found, s.keyword_window), "keyword_stats/of=search", windows)
        # last, so that a rebuild that did not end finds the moved days again
        firsts.write.mode("overwrite").parquet(f"{self.out}/first_days")
        return days

    def pages(self, days: Days = None) -> DataFrame:
        return self.read("dwd_log", days).filter(F.col("kind") == "page").drop("kind", "dt")

    def orders(
        self,
        orders: DataFrame,
        details: DataFrame,
        payments: DataFrame,
        dims: dict[str, DataFrame],
        as_of=None,
        changed: Days = None,
    ) -> list[date] | None:
        """Wide orders and payments, province metrics; ``dims`` as for ``operators.wide.order_wide``. Returns the days of
        the wide rows written, those they replaced included, which :meth:`products` wants to know.

        Where some dimension is a log with ``valid_from``, orders get the dimension rows that held when they were made
        (``operators.wide.order_wide_as_of``). ``changed``: the days on which orders or details were made or payments
        called back that differ from the last rebuild.
        """
        s = self.settings
        days = days_around(changed, s.order_bound, s.order_bound)
        orders = wide.with_event_time(orders, "create_time", "create_ts")
        details = wide.with_event_time(details, "create_time", "create_ts")
        payments = wide.with_event_time(payments, "callback_time", "callback_ts")
        if days is not None:
            orders = orders.filter(on_days(F.col("create_ts"), days))
            details = details.filter(on_days(F.col("create_ts"), days_around(days, s.order_bound, s.order_bound)))
        pairs = wide.order_pairs(orders, details, s.order_bound)
        if any(VALID_FROM in dim.columns for dim in dims.values()):
            self._write(pairs, "dwm_order_pairs", F.col("create_ts"), days=days)
            rows = wide.order_wide_as_of(self.read("dwm_order_pairs", days).drop("dt"), **dims, as_of=as_of)
        else:
            rows = wide.order_wide(pairs, **dims, as_of=as_of)
        self._write(rows, "dwm_order_wide", F.col("create_ts"), days=days)

        paid_days = days_around(days, after=s.payment_bound)
        if paid_days is not None:
            payments = payments.filter(on_days(F.col("callback_ts"), paid_days))
        made = self.read("dwm_order_wide", days_around(paid_days, before=s.payment_bound))
        paid = wide.payment_wide(payments, made, s.payment_bound)
        replaced = self._days_paid(paid_days)
        self._write(paid, "dwm_payment_wide", F.substring("callback_time", 1, 10), days=paid_days)

        span = self._reach(s.window)
        windows = days_around(days, before=span)
        made = self.read("dwm_order_wide", days_around(windows, after=span))
        self._metrics(stats.province_stats(made, s.window), "province_stats", windows)
        return None if days is None else sorted({*days, *replaced, *self._days_paid(paid_days)})

    def _days_paid(self, days: Days) -> set[date]:
        """Payments lie in folders by callback and are measured by their creation: the days of it."""
        if days is None:
            return set()
        made = F.substring("payment_create_time", 1, 10).cast("date").alias("dt")
        found = self.read("dwm_payment_wide", days).select(made).distinct().collect()
        return {row["dt"] for row in found if row["dt"]}

    def products(
        self,
        favors: DataFrame,
        carts: DataFrame,
        refunds: DataFrame,
        comments: DataFrame,
        dims: dict[str, DataFrame],
        changed: Days = None,
    ) -> None:
        """Product and product keyword metrics, after ``behaviour`` and ``orders``; names are the newest ones.

        ``changed``: the days that these two have returned, and those on which the four tables differ from the last rebuild.
        """
        span = self._reach(self.settings.window)
        windows = days_around(changed, before=span)
        days = days_around(windows, after=span)
        rows = measures.product_measures(
            self.pages(days),
            self.read("dwm_order_wide", days).drop("dt"),
            # measured by their creation, not by their folder's day
            self.read("dwm_payment_wide").drop("dt"),
            favors,
            carts,
            refunds,
            comments,
        ).filter(on_days(F.col("event_time"), days))
        names = {k: current_rows(dims[k]) for k in ("sku", "spu", "category3", "trademark")}
        summed = stats.enrich_product_stats(stats.product_sums(rows, self.settings.window), **names)
        self._metrics(summed, "product_stats", windows)
        product = self.read("product_stats", windows)
        self._metrics(keywords.product_keywords(product), "keyword_stats/of=product", windows)
