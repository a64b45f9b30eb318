"""Facts reduced to unified measure rows, ready for a windowed sum."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.operators.logs import is_entry
from tidemart.operators.wide import with_event_time
from tidemart.schemas import MONEY

# fixed value: the code of a good review
APPRAISE_GOOD = "1201"

VISITOR_MEASURES = ("uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum")
PRODUCT_COUNTS = (
    "display_ct", "click_ct", "favor_ct", "cart_ct", "order_sku_num", "comment_ct", "good_comment_ct",
)
PRODUCT_AMOUNTS = ("order_amount", "payment_amount", "refund_amount")

ORDER, PAID, REFUND = "order", "paid", "refund"


def _visitor_rows(log: DataFrame, keep: tuple[str, ...], **measures: Column) -> DataFrame:
    zero = F.lit(0).cast("bigint")
    return log.select(
        *[F.col(f"common.{c}").alias(c) for c in ("vc", "ch", "ar", "is_new")],
        *[F.coalesce(measures.get(m, zero).cast("bigint"), zero).alias(m) for m in VISITOR_MEASURES],
        "ts",
        F.timestamp_millis("ts").alias("event_time"),
        *[F.col(k).alias(k.split(".")[-1]) for k in keep],
    )


def page_view_measures(pages: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Page views, stay time and visits (entry pages) in one pass."""
    return _visitor_rows(
        pages, keep, pv_ct=F.lit(1), sv_ct=is_entry().cast("bigint"), dur_sum=F.col("page.during_time")
    )


def unique_visit_measures(visits: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return _visitor_rows(visits, keep, uv_ct=F.lit(1))


def bounce_measures(bounced: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return _visitor_rows(bounced, keep, uj_ct=F.lit(1))


def visitor_measures(
    pages: DataFrame, visits: DataFrame, bounced: DataFrame, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Union of all visitor measures."""
    return (
        page_view_measures(pages, keep)
        .unionByName(unique_visit_measures(visits, keep))
        .unionByName(bounce_measures(bounced, keep))
    )


def _product_rows(df: DataFrame, event_time: str, order_kind: str | None = None, **measures: str) -> DataFrame:
    """The measured columns of one source, given as SQL expressions; ``unified`` adds the others."""
    typed = {"sku_id": "bigint", "kind_order_id": "bigint"}
    typed.update(dict.fromkeys(PRODUCT_COUNTS, "bigint"))
    typed.update(dict.fromkeys(PRODUCT_AMOUNTS, MONEY))
    columns = {"sku_id": "sku_id", **measures}
    if order_kind:
        columns["kind_order_id"] = "order_id"
    selected = [f"cast({value} as {typed[name]}) as {name}" for name, value in columns.items()]
    kind = [f"'{order_kind}' as order_kind"] if order_kind else []
    return df.selectExpr(*selected, *kind, f"{event_time} as event_time")


def unified(*parts: DataFrame) -> DataFrame:
    """Union of measured rows: absent or null counts and amounts are 0; at most one order id, with its kind."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    present = set(rows.columns)

    def filled(name: str, kind: str) -> str:
        return f"coalesce({name}, cast(0 as {kind})) as {name}" if name in present else f"cast(0 as {kind}) as {name}"

    def optional(name: str, kind: str) -> str:
        return name if name in present else f"cast(null as {kind}) as {name}"

    return rows.selectExpr(
        "sku_id",
        "event_time",
        *[filled(c, "bigint") for c in PRODUCT_COUNTS],
        *[filled(c, MONEY) for c in PRODUCT_AMOUNTS],
        optional("order_kind", "string"),
        optional("kind_order_id", "bigint"),
    )


def page_product_measures(pages: DataFrame) -> DataFrame:
    """Clicks on detail pages and displayed skus; one page may give several rows, read in one pass."""
    item = F.col("page.item")
    no_rows = F.array().cast("array<struct<sku:string,click_ct:int,display_ct:int>>")
    click = F.struct(item.alias("sku"), F.lit(1).alias("click_ct"), F.lit(0).alias("display_ct"))
    clicks = F.when(F.col("page.page_id") == "good_detail", F.array(click)).otherwise(no_rows)
    shown = F.transform(
        F.filter("displays", lambda d: d["item_type"] == "sku_id"),
        lambda d: F.struct(d["item"].alias("sku"), F.lit(0).alias("click_ct"), F.lit(1).alias("display_ct")),
    )
    rows = pages.select(F.explode(F.concat(clicks, F.coalesce(shown, no_rows))).alias("m"), "ts")
    return _product_rows(
        rows,
        "timestamp_millis(ts)",
        sku_id="try_cast(m.sku as bigint)",
        click_ct="m.click_ct",
        display_ct="m.display_ct",
    )


def order_product_measures(orders: DataFrame) -> DataFrame:
    rows = with_event_time(orders, "create_time", "create_ts")
    return _product_rows(rows, "create_ts", ORDER, order_sku_num="sku_num", order_amount="split_total_amount")


def favor_measures(favors: DataFrame) -> DataFrame:
    return _product_rows(with_event_time(favors, "create_time", "create_ts"), "create_ts", favor_ct="1")


def cart_measures(carts: DataFrame) -> DataFrame:
    return _product_rows(with_event_time(carts, "create_time", "create_ts"), "create_ts", cart_ct="1")


def payment_measures(payments: DataFrame) -> DataFrame:
    rows = with_event_time(payments, "payment_create_time", "payment_create_ts")
    return _product_rows(rows, "payment_create_ts", PAID, payment_amount="split_total_amount")


def refund_measures(refunds: DataFrame) -> DataFrame:
    rows = with_event_time(refunds, "create_time", "create_ts")
    return _product_rows(rows, "create_ts", REFUND, refund_amount="refund_amount")


def comment_measures(comments: DataFrame) -> DataFrame:
    rows = with_event_time(comments, "create_time", "create_ts")
    good = f"case when appraise = '{APPRAISE_GOOD}' then 1 else 0 end"
    return _product_rows(rows, "create_ts", comment_ct="1", good_comment_ct=good)


def product_measures(
    pages: DataFrame,
    orders: DataFrame,
    payments: DataFrame,
    favors: DataFrame,
    carts: DataFrame,
    refunds: DataFrame,
    comments: DataFrame,
) -> DataFrame:
    """Unified rows of the seven product sources."""
    return unified(
        page_product_measures(pages),
        order_product_measures(orders),
        cart_measures(carts),
        payment_measures(payments),
        refund_measures(refunds),
        favor_measures(favors),
        comment_measures(comments),
    )
