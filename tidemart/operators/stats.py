"""Windowed visitor, product, province and keyword metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions import time_text
from tidemart.operators import dims
from tidemart.operators.measures import (
    ORDER,
    PAID,
    PRODUCT_AMOUNTS,
    PRODUCT_COUNTS,
    REFUND,
    VISITOR_MEASURES,
)
from tidemart.schemas import MONEY_SUM, PRODUCT_STATS_COLUMNS

WINDOW = "10 seconds"

# fixed values: the sources of keyword counts
KEYWORD_SEARCH = "SEARCH"


def window_text(edge: str, window: str = "window") -> Column:
    return time_text(F.col(f"{window}.{edge}"))


def tumbling_count(df: DataFrame, time: str, size: str = WINDOW, by: tuple[str, ...] = ()) -> DataFrame:
    counted = df.groupBy(F.window(time, size), *by).agg(F.count(F.lit(1)).alias("ct"))
    return counted.select(window_text("start").alias("stt"), window_text("end").alias("edt"), *by, "ct")


def _sums(names: tuple[str, ...]) -> list[Column]:
    return [F.sum(n).alias(n) for n in names]


def _money_sums(names: tuple[str, ...]) -> list[Column]:
    return [F.sum(n).cast(MONEY_SUM).alias(n) for n in names]


def visitor_stats(measures: DataFrame, size: str = WINDOW) -> DataFrame:
    """Five sums per window, version, channel, area and new flag; ``ts`` is the earliest record's."""
    keys = ("vc", "ch", "ar", "is_new")
    summed = measures.groupBy(F.window("event_time", size), *keys).agg(
        *_sums(VISITOR_MEASURES), F.min("ts").alias("ts")
    )
    return summed.select(
        window_text("start").alias("stt"), window_text("end").alias("edt"), *keys, *VISITOR_MEASURES, "ts"
    )


def product_sums(measures: DataFrame, size: str = WINDOW) -> DataFrame:
    """Sums and the three distinct order counts per window and sku, before enrichment.

    Distinct counting is one more grouping level (by order kind and id) instead of a set per sku: a popular sku is
    spread over its orders, both levels combine before they shuffle, and no row ever holds a growing set. The same
    two levels run on streams, where the second takes its window from the first.
    """
    by_order = measures.groupBy(F.window("event_time", size), "sku_id", "order_kind", "kind_order_id").agg(
        *_sums(PRODUCT_COUNTS), *_money_sums(PRODUCT_AMOUNTS)
    )
    if measures.isStreaming:
        window = F.window(F.window_time("window"), size)
    else:
        window = F.col("window")

    def orders_of(kind: str) -> Column:
        return F.count(F.when(F.col("order_kind") == kind, F.col("kind_order_id")))

    summed = by_order.groupBy(window.alias("window"), "sku_id").agg(
        *_sums(PRODUCT_COUNTS),
        *_money_sums(PRODUCT_AMOUNTS),
        orders_of(ORDER).alias("order_ct"),
        orders_of(PAID).alias("paid_order_ct"),
        orders_of(REFUND).alias("refund_order_ct"),
    )
    return summed.select(
        window_text("start").alias("stt"),
        window_text("end").alias("edt"),
        "sku_id",
        *PRODUCT_COUNTS,
        *PRODUCT_AMOUNTS,
        "order_ct",
        "paid_order_ct",
        "refund_order_ct",
    )


def order_bits(measures: DataFrame, size: str = WINDOW, sparse: bool = False) -> DataFrame:
    """The orders of a window and sku as bitmaps, beside the metrics: ``stt, edt, sku_id, order_kind, bucket, bits``.

    A row holds the ids of one bucket of 32,768. Counts of distinct orders can't be added over windows or skus, bitmaps
    can (:func:`tidemart.operators.serving.distinct_orders`). Rows without an order are left out. A bitmap has 4 KB
    whatever it holds, and combines before the shuffle; the ids of a hot sku lie in as many rows as they have buckets.

    Where a window and sku hold few of a bucket's ids, that is 4 KB for each order. ``sparse`` makes ``bits`` a number of
    64 bits for a bucket of 64 ids, so that rows are never more nor larger than the orders they hold.
    """
    orders = measures.filter(F.col("order_kind").isNotNull() & F.col("kind_order_id").isNotNull())
    keys = ("sku_id", "order_kind", "bucket")
    if sparse:
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("kind_order_id").bitwiseAND(63).cast("int"))
        placed = orders.withColumn("bucket", F.shiftright("kind_order_id", 6)).withColumn("_bit", bit)
        bits = F.bit_or("_bit")
    else:
        placed = orders.withColumn("bucket", F.bitmap_bucket_number("kind_order_id")).withColumn(
            "_bit", F.bitmap_bit_position("kind_order_id")
        )
        bits = F.bitmap_construct_agg("_bit")
    built = placed.groupBy(F.window("event_time", size), *keys).agg(bits.alias("bits"))
    return built.select(window_text("start").alias("stt"), window_text("end").alias("edt"), *keys, "bits")


def enrich_product_stats(
    sums: DataFrame, sku: DataFrame, spu: DataFrame, category3: DataFrame, trademark: DataFrame
) -> DataFrame:
    """Names and ids of the sku, joined after aggregation; the sink columns without the clock's ``ts``."""
    flat = dims.flat_sku(sku, spu, category3, trademark)
    rows = dims.dim_join(sums, flat, dims.flat_sku_spec(with_price=True))
    return rows.select(*[c for c in PRODUCT_STATS_COLUMNS if c != "ts"])


PROVINCE_KEYS = {
    "province_id": "province_id",
    "province_name": "province_name",
    "province_area_code": "area_code",
    "province_iso_code": "iso_code",
    "province_3166_2_code": "iso_3166_2",
}


def province_rows(orders: DataFrame) -> DataFrame:
    """The province columns of a wide order, under their metric names."""
    return orders.select(
        *[F.col(s).alias(t) for s, t in PROVINCE_KEYS.items()],
        "order_id",
        F.col("split_total_amount").alias("order_amount"),
        "create_ts",
    )


def province_stats(orders: DataFrame, size: str = WINDOW) -> DataFrame:
    """Amount and distinct orders per window and province, from wide orders with ``create_ts``."""
    keys = list(PROVINCE_KEYS.values())
    by_order = province_rows(orders).groupBy(F.window("create_ts", size), *keys, "order_id").agg(
        *_money_sums(("order_amount",))
    )
    window = F.window(F.window_time("window"), size) if orders.isStreaming else F.col("window")
    summed = by_order.groupBy(window.alias("window"), *keys).agg(
        *_money_sums(("order_amount",)), F.count("order_id").alias("order_count")
    )
    return summed.select(
        window_text("start").alias("stt"), window_text("end").alias("edt"), *keys, "order_amount", "order_count"
    )


def keyword_stats_search(keywords: DataFrame, size: str = WINDOW) -> DataFrame:
    """Searches per window and keyword, from ``keyword, rowtime``."""
    counted = keywords.groupBy(F.window("rowtime", size), "keyword").agg(F.count(F.lit(1)).alias("ct"))
    return counted.select(
        "keyword",
        "ct",
        F.lit(KEYWORD_SEARCH).alias("source"),
        window_text("start").alias("stt"),
        window_text("end").alias("edt"),
    )
