"""Dashboard datasets over the metric tables.

``date`` is ``yyyyMMdd`` as text or number; ``None`` or 0 means today. The day filter compares the text ``stt`` by
prefix, which Parquet scans evaluate themselves; a ``dt`` partition column, where present, prunes folders too.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions import dur_per_sv, pv_per_sv, uj_rate
from tidemart.operators.measures import ORDER, PAID, REFUND
from tidemart.schemas import MONEY_SUM

# fixed values: the weight of each keyword source, any other source weighs 0
KEYWORD_WEIGHTS = {"SEARCH": 10, "ORDER": 3, "CART": 2, "CLICK": 1}

# fixed values: the row labels of the new-versus-returning table
NEW_OLD_LABELS = ("用户数(人)", "总访问页面(次)", "跳出率(%)", "平均在线时长(秒)", "平均访问人数(人次)")


def iso_day(date: int | str | None) -> Column:
    """The day as ``yyyy-MM-dd``; today is the session's day. Raises on text that is no date."""
    text = str(date or 0)
    if text == "0":
        return F.date_format(F.current_date(), "yyyy-MM-dd")
    if len(text) != 8:
        raise ValueError(f"not a yyyyMMdd date: {text}")
    return F.lit(datetime.strptime(text, "%Y%m%d").date().isoformat())


def of_day(stats: DataFrame, date: int | str | None) -> DataFrame:
    day = iso_day(date)
    if "dt" in stats.columns:
        stats = stats.filter(F.col("dt") == day.cast("date"))
    return stats.filter(F.col("stt").startswith(day))


def _edges(date: int | str | None, size: str) -> tuple[Column, Column]:
    """From the day's begin to the end of the last window that begins on it."""
    day = iso_day(date).cast("timestamp_ntz")
    return day, day + F.lit(timedelta(days=1)) + F.expr(f"interval '{size}'")


def _stored(edge: Column, millis: bool) -> Column:
    return F.unix_millis(edge.cast("timestamp")) if millis else edge


def until(
    time: str, date: int | str | None, size: str, after: timedelta = timedelta(0), millis: bool = False
) -> Column:
    """Rows of source tables up to the end of a day's windows of ``size``, ``after`` later at most."""
    return F.col(time) < _stored(_edges(date, size)[1] + F.lit(after), millis)


def within(
    time: str,
    date: int | str | None,
    size: str,
    before: timedelta = timedelta(0),
    after: timedelta = timedelta(0),
    millis: bool = False,
) -> Column:
    """Rows of source tables that a day's windows of ``size`` can depend on: the day pushed down to the scan.

    ``time`` is a stored column, a timestamp or (``millis``) epoch milliseconds; ``before`` and ``after`` are margins for
    joins and timeouts. The range is compared with constants, so scans skip the files and row groups outside of it.
    Windows that begin on other days come out incomplete; the day filter of the dataset removes them.
    """
    begin = _edges(date, size)[0] - F.lit(before)
    return (F.col(time) >= _stored(begin, millis)) & until(time, date, size, after, millis)


def _total(name: str, kind: str = "bigint") -> Column:
    return F.coalesce(F.sum(name), F.lit(0)).cast(kind).alias(name)


def gmv(product_stats: DataFrame, date: int | str | None = None) -> DataFrame:
    return of_day(product_stats, date).agg(_total("order_amount", MONEY_SUM))


def _top(stats: DataFrame, keys: tuple[str, str], date, limit: int, *more: Column) -> DataFrame:
    amounts = of_day(stats, date).groupBy(*keys).agg(_total("order_amount", MONEY_SUM), *more)
    # the key breaks ties, so the result is reproducible
    return (
        amounts.filter(F.col("order_amount") > 0)
        .orderBy(F.col("order_amount").desc(), *[F.col(k).asc_nulls_last() for k in keys])
        .limit(limit)
    )


def top_trademark(product_stats: DataFrame, date: int | str | None = None, limit: int = 10) -> DataFrame:
    return _top(product_stats, ("tm_id", "tm_name"), date, limit)


def top_category3(product_stats: DataFrame, date: int | str | None = None, limit: int = 10) -> DataFrame:
    return _top(product_stats, ("category3_id", "category3_name"), date, limit)


def top_spu(product_stats: DataFrame, date: int | str | None = None, limit: int = 10) -> DataFrame:
    return _top(product_stats, ("spu_id", "spu_name"), date, limit, _total("order_ct"))


def distinct_orders(order_bits: DataFrame, *keys: str | Column) -> DataFrame:
    """``keys, order_ct, paid_order_ct, refund_order_ct`` over any windows and skus, from ``stats.order_bits`` rows.

    Exact, where sums of window counts take an order of two windows or skus twice. Bitmaps of a bucket are united before
    the shuffle, so a key is at most its buckets' rows from each task. Sparse rows (bits that are numbers) count alike.
    """
    sparse = dict(order_bits.dtypes)["bits"] == "bigint"
    ids = F.bit_count(F.bit_or("bits")) if sparse else F.bitmap_count(F.bitmap_or_agg("bits"))
    names = [f"_key{n}" for n in range(len(keys))]
    titles = order_bits.select(*keys).columns
    named = [F.col(k) if isinstance(k, str) else k for k in keys]
    united = (
        order_bits.select(*[k.alias(n) for k, n in zip(named, names)], "order_kind", "bucket", "bits")
        .groupBy(*names, "order_kind", "bucket")
        .agg(ids.cast("bigint").alias("_ids"))
    )
    counts = {"order_ct": ORDER, "paid_order_ct": PAID, "refund_order_ct": REFUND}
    sums = [
        F.coalesce(F.sum(F.when(F.col("order_kind") == kind, F.col("_ids"))), F.lit(0)).alias(name)
        for name, kind in counts.items()
    ]
    return united.groupBy(*[F.col(n).alias(t) for n, t in zip(names, titles)]).agg(*sums)


def province_amount(province_stats: DataFrame, date: int | str | None = None) -> DataFrame:
    summed = of_day(province_stats, date).groupBy("province_id", "province_name")
    return summed.agg(_total("order_amount", MONEY_SUM)).select("province_name", "order_amount")


def visitor_by_new(visitor_stats: DataFrame, date: int | str | None = None) -> DataFrame:
    sums = [_total(c) for c in ("uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum")]
    return of_day(visitor_stats, date).groupBy("is_new").agg(*sums)


def visitor_by_hour(visitor_stats: DataFrame, date: int | str | None = None) -> DataFrame:
    new_uv = F.sum(F.when(F.col("is_new") == "1", F.col("uv_ct")).otherwise(F.lit(0)))
    hour = F.substring("stt", 12, 2).cast("int")
    return (
        of_day(visitor_stats, date)
        .groupBy(hour.alias("hr"))
        .agg(new_uv.cast("bigint").alias("new_uv"), _total("uv_ct"), _total("pv_ct"), _total("uj_ct"))
        .orderBy("hr")
    )


def keyword_weight(source: Column) -> Column:
    weight = F.lit(0)
    for name, value in KEYWORD_WEIGHTS.items():
        weight = F.when(source == name, F.lit(value)).otherwise(weight)
    return weight


def keyword_score(
    keyword_stats: DataFrame, date: int | str | None = None, limit: int = 20, order_by: str = "count"
) -> DataFrame:
    """Weighted score per keyword; the first ``limit`` by plain count, or by score with ``order_by='score'``."""
    if order_by not in ("count", "score"):
        raise ValueError("order_by is 'count' or 'score'")
    scored = (
        of_day(keyword_stats, date)
        .groupBy("keyword")
        .agg(F.sum(F.col("ct") * keyword_weight(F.col("source"))).alias("score"), F.sum("ct").alias("_count"))
    )
    lead = F.col("_count" if order_by == "count" else "score")
    ranked = scored.orderBy(lead.desc(), "keyword").limit(limit)
    return ranked.select("keyword", F.col("score").alias("ct"))


def with_kpis(visitors: DataFrame) -> DataFrame:
    """Bounce rate, seconds and pages per visit of summed visitor rows."""
    uv, pv, sv, uj, dur = (F.col(c) for c in ("uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum"))
    return visitors.withColumns(
        {
            "uj_rate": uj_rate(uj, sv, uv),
            "dur_per_sv": dur_per_sv(dur, sv, uv),
            "pv_per_sv": pv_per_sv(pv, sv, uv),
        }
    )


def visitor_hour_dense(visitor_stats: DataFrame, date: int | str | None = None) -> DataFrame:
    """Twenty-four rows, hours without data as zeros."""
    hours = visitor_stats.sparkSession.range(24).select(F.col("id").cast("int").alias("hr"))
    by_hour = visitor_by_hour(visitor_stats, date)
    counts = [F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in ("uv_ct", "pv_ct", "new_uv")]
    return hours.join(by_hour, "hr", "left").select(
        F.lpad(F.col("hr").cast("string"), 2, "0").alias("hr"), *counts
    ).orderBy("hr")


def visitor_new_old_table(
    visitor_stats: DataFrame, date: int | str | None = None, labels: tuple[str, ...] = NEW_OLD_LABELS
) -> DataFrame:
    """One row per figure with a column for new and one for returning visitors; a missing side shows 0."""
    names = ("uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum")
    flag = F.coalesce(F.col("is_new") == "1", F.lit(False))
    sides = {"new": flag, "old": ~flag}
    one_row = of_day(visitor_stats, date).agg(
        *[
            F.coalesce(F.sum(F.when(is_side, F.col(n))), F.lit(0)).alias(f"{side}_{n}")
            for side, is_side in sides.items()
            for n in names
        ]
    )

    def figures(side: str) -> list[Column]:
        uv, pv, sv, uj, dur = (F.col(f"{side}_{n}") for n in names)
        return [uv, pv, uj_rate(uj, sv, uv), dur_per_sv(dur, sv, uv), pv_per_sv(pv, sv, uv)]

    rows = [
        F.struct(
            F.lit(label).alias("type"),
            new.cast("decimal(20,2)").alias("new"),
            old.cast("decimal(20,2)").alias("old"),
        )
        for label, new, old in zip(labels, figures("new"), figures("old"))
    ]
    return one_row.select(F.inline(F.array(*rows)))


def name_values(df: DataFrame, name: str, value: str) -> DataFrame:
    """Rows as ``name, value``, the shape map and pie charts read."""
    return df.select(F.col(name).alias("name"), F.col(value).alias("value"))


def series(ranked: DataFrame, name: str, value: str) -> DataFrame:
    """One row with parallel arrays ``categories`` and ``data``, largest first; for already limited rankings."""
    rows = ranked.agg(F.array_sort(F.collect_list(F.struct((-F.col(value)).alias("v"), F.col(name).alias("n")))).alias("r"))
    return rows.select(
        F.transform("r", lambda x: x["n"]).alias("categories"), F.transform("r", lambda x: -x["v"]).alias("data")
    )
