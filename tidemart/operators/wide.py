"""Wide order and payment rows: interval joins, row merges, enrichment."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions import age_years, parse_time
from tidemart.operators import dims
from tidemart.schemas import ORDER_WIDE_COLUMNS, PAYMENT_WIDE_COLUMNS
from tidemart.sources.parsing import computed_once

ORDER_BOUND = timedelta(seconds=5)
PAYMENT_BOUND = timedelta(seconds=1800)


def with_event_time(df: DataFrame, text: str, target: str) -> DataFrame:
    """Parse the event time once; a frame that already carries it is left alone."""
    return df if target in df.columns else computed_once(df, target, parse_time(F.col(text)))


def _micros(span: timedelta) -> int:
    return span // timedelta(microseconds=1)


def _shift(ts: Column, span: timedelta) -> Column:
    return ts + F.lit(span)


def interval_join(
    left: DataFrame,
    right: DataFrame,
    keys: dict[str, str],
    left_time: str,
    right_time: str,
    lower: timedelta,
    upper: timedelta,
    slot_spans: int = 8,
) -> DataFrame:
    """Inner join on ``keys`` (left column -> right column) with right time in [left + lower, left + upper].

    On streams the time range in the condition bounds the state. In batch the pair's time slot joins the equality
    keys: slots are ``slot_spans`` times as wide as the range, a right row is in one slot, a left row in one or
    two. A key with very many rows then meets only rows near in time instead of all of its group.
    """
    on = F.col(right_time).between(_shift(F.col(left_time), lower), _shift(F.col(left_time), upper))
    for left_key, right_key in keys.items():
        on = on & (F.col(left_key) == F.col(right_key))
    if left.isStreaming or right.isStreaming:
        return left.join(right, on, "inner")

    width = F.lit(max(_micros(upper - lower) * slot_spans, 1))

    def slot(micros: Column) -> Column:
        return F.call_function("div", micros - F.pmod(micros, width), width)

    at = F.unix_micros(F.col(left_time))
    slots = F.sequence(slot(at + F.lit(_micros(lower))), slot(at + F.lit(_micros(upper))))
    left = left.filter(F.col(left_time).isNotNull()).withColumn("_left_slot", F.explode(slots))
    right = right.withColumn("_right_slot", slot(F.unix_micros(F.col(right_time))))
    return left.join(right, on & (F.col("_left_slot") == F.col("_right_slot")), "inner").drop(
        "_left_slot", "_right_slot"
    )


def prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.toDF(*[f"{prefix}{c}" for c in df.columns])


# Which side of the order pair supplies each wide column; the other wide columns come from dimensions, or stay null.
FROM_ORDER = {
    "order_id": "id",
    **{
        c: c
        for c in (
            "order_status", "create_time", "create_date", "activity_reduce_amount", "coupon_reduce_amount",
            "original_total_amount", "feight_fee", "total_amount", "province_id", "user_id",
        )
    },
}
FROM_DETAIL = {
    "detail_id": "id",
    **{
        c: c
        for c in (
            "sku_id", "sku_name", "order_price", "sku_num", "split_activity_amount", "split_coupon_amount",
            "split_total_amount",
        )
    },
}
NEVER_FILLED = {
    "split_feight_fee": "decimal(18,2)", "expire_time": "string", "operate_time": "string", "create_hour": "string",
}


def order_pairs(
    orders: DataFrame,
    details: DataFrame,
    bound: timedelta = ORDER_BOUND,
    granularity: str = "second",
) -> DataFrame:
    """Order ⋈ detail on order id within ``bound``; the merged, not yet enriched row plus ``create_ts``.

    ``granularity='day'`` compares calendar days instead of the full times.
    """
    if granularity not in ("second", "day"):
        raise ValueError("granularity is 'second' or 'day'")
    left = prefixed(with_event_time(orders, "create_time", "create_ts"), "o_")
    right = prefixed(with_event_time(details, "create_time", "create_ts"), "d_")
    left_time, right_time = "o_create_ts", "d_create_ts"
    if granularity == "day":
        left = left.withColumn("o_day", F.date_trunc("day", "o_create_ts"))
        right = right.withColumn("d_day", F.date_trunc("day", "d_create_ts"))
        left_time, right_time = "o_day", "d_day"
    pairs = interval_join(left, right, {"o_id": "d_order_id"}, left_time, right_time, -bound, bound)
    return pairs.select(
        *[F.col(f"o_{s}").alias(t) for t, s in FROM_ORDER.items()],
        *[F.col(f"d_{s}").alias(t) for t, s in FROM_DETAIL.items()],
        *[F.lit(None).cast(kind).alias(t) for t, kind in NEVER_FILLED.items()],
        F.col("o_create_ts").alias("create_ts"),
    )


def enrich_user(rows: DataFrame, user: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Age in whole years at ``as_of`` (today by default) and gender."""
    as_of = F.current_date() if as_of is None else as_of
    joined = dims.dim_join(rows, user, dims.USER)
    return joined.withColumn("user_age", age_years(F.col("_birthday").cast("date"), as_of)).drop("_birthday")


def enrich_province(rows: DataFrame, province: DataFrame) -> DataFrame:
    return dims.dim_join(rows, province, dims.PROVINCE)


def enrich_sku(rows: DataFrame, sku: DataFrame) -> DataFrame:
    return dims.dim_join(rows, sku, dims.SKU)


def order_wide(
    pairs: DataFrame,
    user: DataFrame,
    province: DataFrame,
    sku: DataFrame,
    spu: DataFrame,
    category3: DataFrame,
    trademark: DataFrame,
    as_of: Column | None = None,
) -> DataFrame:
    """All wide order columns in their fixed order, plus ``create_ts``."""
    rows = enrich_province(enrich_user(pairs, user, as_of), province)
    flat = dims.flat_sku(sku, spu, category3, trademark)
    rows = dims.dim_join(rows, flat, dims.flat_sku_spec())
    return rows.select(*ORDER_WIDE_COLUMNS, "create_ts")


def order_wide_as_of(
    pairs: DataFrame,
    user: DataFrame,
    province: DataFrame,
    sku: DataFrame,
    spu: DataFrame,
    category3: DataFrame,
    trademark: DataFrame,
    as_of: Column | None = None,
    moment: str = "create_ts",
) -> DataFrame:
    """:func:`order_wide` with the dimension rows that held at each pair's ``moment``; dimensions as of
    ``dims.dim_join_as_of``, those without ``valid_from`` hold always.

    ``pairs`` are read several times, mostly two columns of them, so they should be a written table. The names that hang
    on the sku row are looked up in the slots in which that sku row held.
    """
    rows = dims.dim_join_as_of(pairs, user, dims.USER, moment)
    as_of = F.current_date() if as_of is None else as_of
    rows = rows.withColumn("user_age", age_years(F.col("_birthday").cast("date"), as_of)).drop("_birthday")
    slots = dims.slots_of(pairs, dims.PROVINCE, moment)
    rows = dims.dim_join_as_of(rows, province, dims.PROVINCE, moment, slots=slots)
    slots = dims.slots_of(pairs, dims.SKU, moment)
    rows = dims.dim_join_as_of(rows, sku, dims.SKU, moment, slots=slots)
    held = dims.versions_by_slot(sku, slots, dims.SKU)
    for dim, spec in ((spu, dims.SPU), (category3, dims.CATEGORY3), (trademark, dims.TRADEMARK)):
        keys = [F.col(f"_row.{row_col}").alias(f"_k_{k}") for k, row_col in spec.keys.items()]
        slots = held.select(*keys, "_slot").dropna().distinct()
        rows = dims.dim_join_as_of(rows, dim, spec, moment, slots=slots)
    return rows.select(*ORDER_WIDE_COLUMNS, "create_ts")


def coalesce_wide(rows: DataFrame, others: DataFrame, keys: tuple[str, ...] = ("order_id", "detail_id")) -> DataFrame:
    """Fill a wide row's nulls from the other row of the same keys.

    The three split amounts are left as they are.
    """
    fill = (
        "order_status", "create_time", "create_date", "coupon_reduce_amount", "activity_reduce_amount",
        "original_total_amount", "feight_fee", "total_amount", "user_id", "sku_id", "sku_name", "order_price",
        "sku_num",
    )
    other = prefixed(others.select(*keys, *[c for c in fill if c in others.columns and c not in keys]), "_x_")
    on = [F.col(k).eqNullSafe(F.col(f"_x_{k}")) for k in keys]
    filled = {c[3:]: F.coalesce(F.col(c[3:]), F.col(c)) for c in other.columns if c[3:] not in keys}
    return rows.join(other, on, "left").withColumns(filled).select(*rows.columns)


FROM_PAYMENT = {
    "payment_id": "id",
    "payment_create_time": "create_time",
    **{c: c for c in ("order_id", "user_id", "total_amount", "subject", "payment_type", "callback_time")},
}


def payment_wide(
    payments: DataFrame,
    orders: DataFrame,
    bound: timedelta = PAYMENT_BOUND,
) -> DataFrame:
    """Payment ⋈ wide order on order id, order created at most ``bound`` before the callback.

    Same-named columns come from the payment, nulls included. Adds ``payment_create_ts`` after the fixed columns
    when the payments carry ``create_ts``.
    """
    left = prefixed(with_event_time(payments, "callback_time", "callback_ts"), "p_")
    right = prefixed(with_event_time(orders, "create_time", "create_ts"), "w_")
    joined = interval_join(
        left, right, {"p_order_id": "w_order_id"}, "p_callback_ts", "w_create_ts", -bound, timedelta(0)
    )
    columns = []
    for name in PAYMENT_WIDE_COLUMNS:
        if name in FROM_PAYMENT:
            columns.append(F.col(f"p_{FROM_PAYMENT[name]}").alias(name))
        else:
            columns.append(F.col(f"w_{'create_time' if name == 'order_create_time' else name}").alias(name))
    if "create_ts" in payments.columns:
        columns.append(F.col("p_create_ts").alias("payment_create_ts"))
    return joined.select(*columns)
