"""Declared row types of every dataset. Nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql.types import StructType

MONEY = "decimal(18,2)"
MONEY_SUM = "decimal(28,2)"

PAGE_LOG_DDL = (
    "common struct<mid:string,vc:string,ch:string,ar:string,is_new:string>,"
    "page struct<page_id:string,last_page_id:string,item:string,during_time:bigint>,"
    "start map<string,string>,"
    "displays array<struct<item:string,item_type:string>>,"
    "ts bigint"
)

CDC_DDL = "table string, type string, data string"

ORDER_INFO_DDL = (
    f"id bigint, province_id bigint, order_status string, user_id bigint, total_amount {MONEY},"
    f"activity_reduce_amount {MONEY}, coupon_reduce_amount {MONEY}, original_total_amount {MONEY},"
    f"feight_fee {MONEY}, expire_time string, create_time string, operate_time string,"
    "create_date string, create_hour string"
)

ORDER_DETAIL_DDL = (
    f"id bigint, order_id bigint, sku_id bigint, order_price {MONEY}, sku_num bigint, sku_name string,"
    f"create_time string, split_total_amount {MONEY}, split_activity_amount {MONEY}, split_coupon_amount {MONEY}"
)

PAYMENT_INFO_DDL = (
    f"id bigint, order_id bigint, user_id bigint, total_amount {MONEY}, subject string, payment_type string,"
    "create_time string, callback_time string"
)

SKU_EVENT_DDL = "sku_id bigint, create_time string"
REFUND_DDL = f"order_id bigint, sku_id bigint, refund_amount {MONEY}, create_time string"
COMMENT_DDL = "sku_id bigint, appraise string, create_time string"

TABLE_PROCESS_DDL = (
    "source_table string, operate_type string, sink_type string, sink_table string,"
    "sink_columns string, sink_pk string, sink_extend string"
)
# the same as a log: each row holds from its place in the change log on
TABLE_PROCESS_LOG_DDL = f"{TABLE_PROCESS_DDL}, valid_from bigint, deleted boolean"

# Column order of the two wide datasets and the four metric tables (fixed by their consumers).
ORDER_WIDE_COLUMNS = (
    "detail_id", "order_id", "sku_id", "order_price", "sku_num", "sku_name", "province_id", "order_status",
    "user_id", "total_amount", "activity_reduce_amount", "coupon_reduce_amount", "original_total_amount",
    "feight_fee", "split_feight_fee", "split_activity_amount", "split_coupon_amount", "split_total_amount",
    "expire_time", "create_time", "operate_time", "create_date", "create_hour", "province_name",
    "province_area_code", "province_iso_code", "province_3166_2_code", "user_age", "user_gender", "spu_id",
    "tm_id", "category3_id", "spu_name", "tm_name", "category3_name",
)

PAYMENT_WIDE_COLUMNS = (
    "payment_id", "subject", "payment_type", "payment_create_time", "callback_time", "detail_id", "order_id",
    "sku_id", "order_price", "sku_num", "sku_name", "province_id", "order_status", "user_id", "total_amount",
    "activity_reduce_amount", "coupon_reduce_amount", "original_total_amount", "feight_fee",
    "split_feight_fee", "split_activity_amount", "split_coupon_amount", "split_total_amount",
    "order_create_time", "province_name", "province_area_code", "province_iso_code", "province_3166_2_code",
    "user_age", "user_gender", "spu_id", "tm_id", "category3_id", "spu_name", "tm_name", "category3_name",
)

VISITOR_STATS_COLUMNS = (
    "stt", "edt", "vc", "ch", "ar", "is_new", "uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum", "ts",
)

PRODUCT_STATS_COLUMNS = (
    "stt", "edt", "sku_id", "sku_name", "sku_price", "spu_id", "spu_name", "tm_id", "tm_name", "category3_id",
    "category3_name", "display_ct", "click_ct", "favor_ct", "cart_ct", "order_sku_num", "order_amount",
    "order_ct", "payment_amount", "paid_order_ct", "refund_order_ct", "refund_amount", "comment_ct",
    "good_comment_ct", "ts",
)

PROVINCE_STATS_COLUMNS = (
    "stt", "edt", "province_id", "province_name", "area_code", "iso_code", "iso_3166_2", "order_amount",
    "order_count", "ts",
)

KEYWORD_STATS_COLUMNS = ("keyword", "ct", "source", "stt", "edt", "ts")


def struct(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)
