"""Every operator as a named query over one folder of the test tables.

Each query reads whole tables. Window sizes and bounds are parameters of the operators; the ones used here suit the
tables' sparse times (FIXTURES.md, section 5).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.functions import day_of_millis, millis_of_text, time_text
from tidemart.operators import cdc, dims, keywords, logs, measures, serving, stats, visits, wide
from tidemart.plans.pipelines import visitor_stats_from_log
from tidemart.plans.views import Views
from tidemart.schemas import ORDER_INFO_DDL, ORDER_WIDE_COLUMNS, PAGE_LOG_DDL, PAYMENT_WIDE_COLUMNS
from tidemart.session import apply_runtime_conf, shared_dir
from tidemart.sources import parse_cdc, parse_records, parse_rows
from tidemart.streaming.dim_log import DimLog

NEAR = timedelta(days=5)
FAR = timedelta(days=180)
MONTH = "30 days"
HOUR = "1 hour"
DAY = "1 day"
BOUNCE_MS = 600_000
TIE = ("event_id",)
ORDER_DAY = 19980504
VISIT_DAY = 20240101
KEYWORD_DAY = 20240118
AS_OF = "2024-01-01"
# days from the orders of ORDER_DAY to the events of KEYWORD_DAY, a multiple of MONTH
ORDERS_LATER = timedelta(days=9390)
# event times are rounded to milliseconds or cut to seconds
ROUNDING = timedelta(seconds=1)

# a Han character for each letter, for texts that a dictionary can cut
LETTERS = "abcdefghijklmnopqrstuvwxyz"
HAN_LETTERS = "天地玄黄宇宙洪荒日月盈昃辰宿列张寒来暑往秋收冬藏闰余"

QUERIES: dict[str, Callable[[Views], DataFrame]] = {}


def query(fn: Callable[[Views], DataFrame]) -> Callable[[Views], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def runner(fn: Callable[[Views], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: fn(Views(apply_runtime_conf(spark), folder))


FLAT_LOG = (
    "event_id", "common.mid", "common.vc", "common.ch", "common.ar", "common.is_new", "page.page_id",
    "page.last_page_id", "page.item", "page.during_time", "ts",
)


# --- parsing and scalar functions


@query
def json_parse_log(v: Views) -> DataFrame:
    return parse_rows(v.raw_log, PAGE_LOG_DDL, keep=TIE).select(
        *FLAT_LOG,
        F.coalesce(F.try_element_at("start", F.lit("entry")), F.lit("")).alias("start_entry"),
        F.size("displays").alias("n_displays"),
    )


@query
def json_dead_letters(v: Views) -> DataFrame:
    return parse_records(v.raw_log, PAGE_LOG_DDL, keep=TIE)[1].select("event_id")


@query
def json_parse_order(v: Views) -> DataFrame:
    return parse_rows(v.order_info.select(F.to_json(F.struct("*")).alias("value")), ORDER_INFO_DDL)


@query
def epoch_to_day(v: Views) -> DataFrame:
    return v.page_log.select(
        "event_id", day_of_millis(F.col("ts")).alias("day"), day_of_millis(F.col("ts"), "yyyyMMdd").alias("ymd")
    )


@query
def text_to_epoch(v: Views) -> DataFrame:
    return v.order_info.select("id", millis_of_text(F.col("create_time")).alias("ms"))


# --- behaviour log


@query
def new_visitor_repair(v: Views) -> DataFrame:
    return logs.repair_new_visitors(v.page_log).select("event_id", "common.mid", "common.is_new", "ts")


@query
def log_split_start(v: Views) -> DataFrame:
    return logs.start_log(v.page_log).select(*FLAT_LOG, F.col("start")["entry"].alias("start_entry"))


@query
def log_split_page(v: Views) -> DataFrame:
    return logs.page_log(v.page_log).select(*FLAT_LOG)


@query
def log_split_display(v: Views) -> DataFrame:
    return logs.display_log(v.page_log)


@query
def entry_pages(v: Views) -> DataFrame:
    return logs.entry_pages(logs.page_log(v.page_log)).select(*FLAT_LOG)


@query
def search_fullword(v: Views) -> DataFrame:
    return logs.search_fullwords(logs.page_log(v.page_log)).select(
        "fullword", time_text(F.col("rowtime")).alias("rowtime")
    )


@query
def tumbling_count(v: Views) -> DataFrame:
    pages = v.page_log.select("page.page_id", F.timestamp_millis("ts").alias("event_time"))
    return stats.tumbling_count(pages, "event_time", HOUR, ("page_id",))


# --- change records


def _key():
    return F.coalesce(F.col("data")["c_custkey"], F.col("data")["o_orderkey"]).alias("key")


@query
def cdc_valid(v: Views) -> DataFrame:
    key = F.coalesce(F.get_json_object("data", "$.c_custkey"), F.get_json_object("data", "$.o_orderkey"))
    return cdc.valid_changes(parse_cdc(v.raw_cdc)).select("table", "type", key.alias("key"))


def _routed(v: Views, prune: bool = True) -> DataFrame:
    return cdc.route(parse_cdc(v.raw_cdc), v.table_process, prune)


def _entries(df: DataFrame) -> DataFrame:
    return df.select("table", "type", "sink_table", F.col("key"), F.explode("data").alias("name", "value"))


@query
def cdc_route(v: Views) -> DataFrame:
    return _routed(v).select("table", "type", "sink_type", "sink_table", "sink_pk", _key())


@query
def cdc_prune_columns(v: Views) -> DataFrame:
    return _entries(_routed(v).withColumn("key", _key()))


@query
def cdc_route_as_of(v: Views) -> DataFrame:
    """Routes that change along the change log; a change's key stands for its place in it."""
    changes = parse_cdc(v.raw_cdc)
    place = F.coalesce(F.get_json_object("data", "$.c_custkey"), F.get_json_object("data", "$.o_orderkey"))
    routed = cdc.route_as_of(changes.withColumn("place", place.cast("bigint")), v.table_process_log, "place")
    return routed.select(
        "table", "type", "sink_type", "sink_table", F.col("place").alias("key"),
        F.array_join(F.array_sort(F.map_keys("data")), ",").alias("columns"),
    )


@query
def cdc_split_dim(v: Views) -> DataFrame:
    return _entries(cdc.dimension_changes(_routed(v)).withColumn("key", _key()))


@query
def cdc_split_fact(v: Views) -> DataFrame:
    return _entries(cdc.fact_changes(_routed(v)).withColumn("key", _key()))


@query
def dim_rows_from_config(v: Views) -> DataFrame:
    return cdc.dimension_rows(
        cdc.dimension_changes(_routed(v)), "dim_customer", "c_custkey,c_name,c_nationkey", ("type",)
    )


@query
def dim_upsert_latest(v: Views) -> DataFrame:
    """Customers as the current dimension, orders as their later changes."""
    current = v.table("customer").select(
        F.col("c_custkey").alias("id"),
        F.lit("NEW").alias("status"),
        F.col("c_mktsegment").alias("label"),
        F.lit(0).cast("timestamp").alias("ts"),
        F.lit(-1).cast("bigint").alias("offset"),
    )
    changes = v.table("orders").select(
        F.col("o_custkey").alias("id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("label"),
        F.col("o_orderdate").alias("ts"),
        F.col("o_orderkey").alias("offset"),
    )
    newest = [F.col("ts").desc(), F.col("offset").desc()]
    return cdc.latest_rows(current.unionByName(changes), ["id"], newest).select("id", "status", "label", "offset")


def _customer_changes(v: Views) -> tuple[DataFrame, DataFrame]:
    """Inserts, and updates and deletes after them."""
    entry = lambda *pairs: F.create_map(*[x for n, c in pairs for x in (F.lit(n), c)])
    current = v.table("customer").select(
        entry(("id", F.col("c_custkey").cast("string")), ("name", F.col("c_name")), ("label", F.col("c_mktsegment"))).alias("data"),
        F.lit(-1).cast("bigint").alias("_seq"),
        F.lit("insert").alias("_type"),
    )
    key, status = ("id", F.col("o_custkey").cast("string")), ("status", F.col("o_orderstatus"))
    changes = v.table("orders").select(
        F.when(F.col("o_orderkey") % 2 == 0, entry(key, status, ("label", F.col("o_orderpriority"))))
        .otherwise(entry(key, status))
        .alias("data"),
        F.col("o_orderkey").cast("bigint").alias("_seq"),
        F.when(F.col("o_orderkey") % 97 == 0, "delete").otherwise("update").alias("_type"),
    )
    return current, changes


CUSTOMER_COLUMNS = ("id", "name", "status", "label")


@query
def dim_upsert_columns(v: Views) -> DataFrame:
    """Inserts, updates that carry fewer columns, and deletes: each column keeps its newest value."""
    current, changes = _customer_changes(v)
    states = cdc.column_states(current.unionByName(changes), "id", CUSTOMER_COLUMNS)
    return cdc.rows_of_states(states, CUSTOMER_COLUMNS, apply_deletes=True)


@query
def dim_change_log(v: Views) -> DataFrame:
    """The same changes as three micro-batches of a change log, the first two brought into a snapshot, one of them again."""
    current, changes = _customer_changes(v)
    path = f"{shared_dir(v.spark)}/dims/customer-{uuid.uuid4().hex}"
    dim = DimLog(path, "id", CUSTOMER_COLUMNS, apply_deletes=True)
    odd = F.col("_seq") % 2 == 1
    dim.append(current, 0)
    dim.append(changes.filter(odd), 1)
    dim.compact(v.spark)
    dim.append(changes.filter(odd), 1)
    dim.append(changes.filter(~odd), 2)
    return dim.read(v.spark)


@query
def cdc_dead_letters(v: Views) -> DataFrame:
    """One order in fifty is no JSON, one has data that is no object."""
    key = F.col("o_orderkey").cast("string")
    broken = v.table("orders").select(
        F.when(F.col("o_orderkey") % 50 == 0, F.concat(F.lit("not json "), key))
        .when(F.col("o_orderkey") % 50 == 1, F.concat(F.lit('{"table":"orders","type":"insert","data":[100'), key, F.lit("]}")))
        .alias("value")
    )
    return cdc.dead_letters(v.raw_cdc.unionByName(broken.filter(F.col("value").isNotNull())))


# --- dimension lookups and wide rows


@query
def dim_lookup(v: Views) -> DataFrame:
    rows = measures.page_product_measures(logs.page_log(v.page_log)).select("sku_id", "click_ct", "display_ct")
    return dims.dim_join(rows, v.dim_sku, dims.SKU)


@query
def dim_lookup_multi(v: Views) -> DataFrame:
    customer = v.table("customer")
    spec = dims.DimSpec(
        {"c_nationkey": "c_nationkey", "c_mktsegment": "c_mktsegment"},
        {"first_name": "c_name"},
        prefer=("c_custkey",),
    )
    return dims.dim_join(customer.select("c_custkey", "c_nationkey", "c_mktsegment"), customer, spec)


@query
def dim_lookup_as_of(v: Views) -> DataFrame:
    """Details that were not returned meet their sku's last return by then; every tenth return ends what held."""
    lines = v.table("lineitem")
    log = lines.filter(F.col("l_returnflag") == "R").select(
        F.col("l_partkey").alias("id"),
        F.col("l_shipdate").alias("valid_from"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("return_id"),
        F.col("l_linestatus").alias("status"),
        (F.col("l_orderkey") % 10 == 0).alias("deleted"),
    )
    details = lines.filter(F.col("l_returnflag") != "R").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.col("l_partkey").alias("sku_id"),
        F.col("l_shipdate").alias("create_ts"),
        F.lit("none").alias("status"),
    )
    spec = dims.DimSpec({"id": "sku_id"}, {"return_id": "return_id", "status": "status"})
    joined = dims.dim_join_as_of(details, log, spec, "create_ts")
    return joined.select("id", "sku_id", "return_id", "status")


@query
def order_interval_join(v: Views) -> DataFrame:
    return wide.order_pairs(v.order_info, v.order_detail, NEAR).select(
        "order_id", "detail_id", "sku_id", "create_time", "split_total_amount"
    )


@query
def order_wide_user(v: Views) -> DataFrame:
    as_of = F.lit(AS_OF).cast("date")
    return wide.enrich_user(v.order_info, v.dim_user, as_of).select("id", "user_id", "user_age", "user_gender")


@query
def order_wide_province(v: Views) -> DataFrame:
    return wide.enrich_province(v.order_info, v.dim_province).select(
        "id", "province_id", "province_name", "province_area_code", "province_iso_code", "province_3166_2_code"
    )


@query
def order_wide_sku(v: Views) -> DataFrame:
    return wide.enrich_sku(v.order_detail, v.dim_sku).select(
        "id", "sku_id", "sku_name", "category3_id", "spu_id", "tm_id"
    )


def _order_wide(v: Views, bound: timedelta = NEAR) -> DataFrame:
    return wide.order_wide(
        wide.order_pairs(v.order_info, v.order_detail, bound),
        v.dim_user,
        v.dim_province,
        v.dim_sku,
        v.dim_spu,
        v.dim_category3,
        v.dim_trademark,
        F.lit(AS_OF).cast("date"),
    )


@query
def order_wide(v: Views) -> DataFrame:
    return _order_wide(v).select(*ORDER_WIDE_COLUMNS)


@query
def to_json_order_wide(v: Views) -> DataFrame:
    """To JSON text and back: the text itself is laid out differently by every engine."""
    rows = _order_wide(v).select(*ORDER_WIDE_COLUMNS)
    ddl = ",".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return parse_rows(rows.select(F.to_json(F.struct("*")).alias("value")), ddl)


@query
def order_wide_coalesce(v: Views) -> DataFrame:
    odd_line = F.when(F.col("id") % 2 == 1, F.col("create_time"))
    partial = v.order_detail.select(
        "order_id",
        F.col("id").alias("detail_id"),
        "sku_id",
        odd_line.alias("create_time"),
        F.lit(None).cast("string").alias("order_status"),
        F.lit(None).cast("bigint").alias("user_id"),
        "split_total_amount",
    )
    others = v.order_info.select(F.col("id").alias("order_id"), "create_time", "order_status", "user_id")
    return wide.coalesce_wide(partial, others, ("order_id",))


@query
def payment_interval_join(v: Views) -> DataFrame:
    near = wide.order_pairs(v.order_info, v.order_detail, NEAR)
    return _payments(v, near).select("payment_id", "order_id", "detail_id", "callback_time", "order_create_time")


@query
def payment_wide(v: Views) -> DataFrame:
    return wide.payment_wide(v.payment_info, _order_wide(v)).select(*PAYMENT_WIDE_COLUMNS)


# --- visits and visitor metrics


@query
def unique_visit(v: Views) -> DataFrame:
    return visits.unique_visits(logs.page_log(v.page_log), TIE).select("event_id", "common.mid", "ts")


@query
def bounce(v: Views) -> DataFrame:
    return visits.bounces(logs.page_log(v.page_log), BOUNCE_MS, TIE).select("event_id", "common.mid", "ts")


@query
def visitor_measures(v: Views) -> DataFrame:
    pages = logs.page_log(v.page_log)
    rows = measures.visitor_measures(pages, visits.unique_visits(pages, TIE), visits.bounces(pages, BOUNCE_MS, TIE))
    return rows.drop("event_time")


def _visitor_stats(v: Views, size: str = HOUR) -> DataFrame:
    return visitor_stats_from_log(v.page_log, size, BOUNCE_MS, TIE)


def _visitor_day(v: Views, size: str = HOUR) -> DataFrame:
    """Visitor metrics of one day: its log and a timeout more; first days come from two columns of all days before."""
    late = timedelta(milliseconds=BOUNCE_MS) + ROUNDING
    day = v.narrowed(events=serving.within("ts", VISIT_DAY, size, ROUNDING, late))
    past = v.narrowed(events=serving.until("ts", VISIT_DAY, size, ROUNDING))
    return visitor_stats_from_log(day.page_log, size, BOUNCE_MS, TIE, logs.first_days(past.page_log))


@query
def visitor_stats(v: Views) -> DataFrame:
    return _visitor_stats(v)


@query
def visitor_by_new(v: Views) -> DataFrame:
    return serving.visitor_by_new(_visitor_day(v), VISIT_DAY)


@query
def visitor_kpis(v: Views) -> DataFrame:
    return serving.with_kpis(serving.visitor_by_new(_visitor_day(v), VISIT_DAY))


@query
def visitor_by_hour(v: Views) -> DataFrame:
    return serving.visitor_by_hour(_visitor_day(v), VISIT_DAY)


@query
def visitor_hour_dense(v: Views) -> DataFrame:
    return serving.visitor_hour_dense(_visitor_day(v), VISIT_DAY)


@query
def visitor_new_old_table(v: Views) -> DataFrame:
    return serving.visitor_new_old_table(_visitor_day(v), VISIT_DAY)


# --- product measures and metrics


def _pairs(v: Views) -> DataFrame:
    return v.once("far pairs", lambda: wide.order_pairs(v.order_info, v.order_detail, FAR))


def _payments(v: Views, pairs: DataFrame) -> DataFrame:
    """Paid pairs: dimension columns are not asked for, so they stay empty and no dimension is read."""
    absent = {c: F.lit(None).cast("string") for c in ORDER_WIDE_COLUMNS if c not in pairs.columns}
    return wide.payment_wide(v.payment_info, pairs.withColumns(absent))


@query
def product_measures_page(v: Views) -> DataFrame:
    return measures.page_product_measures(logs.page_log(v.page_log)).select(
        "sku_id", "click_ct", "display_ct", F.unix_millis("event_time").alias("ts")
    )


@query
def product_measures_order(v: Views) -> DataFrame:
    return measures.order_product_measures(_pairs(v)).select(
        "sku_id", "order_kind", "kind_order_id", "order_sku_num", "order_amount", time_text(F.col("event_time")).alias("at")
    )


@query
def product_measures_favor_cart(v: Views) -> DataFrame:
    rows = measures.unified(measures.favor_measures(v.favor), measures.cart_measures(v.cart))
    return rows.select("sku_id", "favor_ct", "cart_ct", time_text(F.col("event_time")).alias("at"))


@query
def product_measures_payment(v: Views) -> DataFrame:
    return measures.payment_measures(_payments(v, _pairs(v))).select(
        "sku_id", "order_kind", "kind_order_id", "payment_amount", time_text(F.col("event_time")).alias("at")
    )


@query
def product_measures_refund(v: Views) -> DataFrame:
    return measures.refund_measures(v.refund).select(
        "sku_id", "order_kind", "kind_order_id", "refund_amount", time_text(F.col("event_time")).alias("at")
    )


@query
def product_measures_comment(v: Views) -> DataFrame:
    return measures.comment_measures(v.comment).select(
        "sku_id", "comment_ct", "good_comment_ct", time_text(F.col("event_time")).alias("at")
    )


def _product_sums(v: Views) -> DataFrame:
    """Product metrics without names, for queries that show none."""
    rows = measures.product_measures(
        logs.page_log(v.page_log), _pairs(v), _payments(v, _pairs(v)), v.favor, v.cart, v.refund, v.comment
    )
    return stats.product_sums(rows, MONTH)


def _product_stats(v: Views) -> DataFrame:
    return stats.enrich_product_stats(_product_sums(v), v.dim_sku, v.dim_spu, v.dim_category3, v.dim_trademark)


@query
def product_stats(v: Views) -> DataFrame:
    return _product_stats(v)


def _order_sums(v: Views) -> DataFrame:
    """Product metrics of orders alone, for queries that show nothing else."""
    return stats.product_sums(measures.unified(measures.order_product_measures(_pairs(v))), MONTH)


def _named_order_sums(v: Views) -> DataFrame:
    return stats.enrich_product_stats(_order_sums(v), v.dim_sku, v.dim_spu, v.dim_category3, v.dim_trademark)


def _order_day(v: Views, day: int = ORDER_DAY) -> Views:
    """The orders of one day's windows, and the lines that can belong to them."""
    return v.narrowed(
        orders=serving.within("o_orderdate", day, MONTH, ROUNDING),
        lineitem=serving.within("l_shipdate", day, MONTH, FAR + ROUNDING, FAR),
        events=serving.within("ts", day, MONTH, ROUNDING, ROUNDING),
    )


@query
def gmv(v: Views) -> DataFrame:
    return serving.gmv(_order_sums(_order_day(v)), ORDER_DAY)


@query
def top_trademark(v: Views) -> DataFrame:
    return serving.top_trademark(_named_order_sums(_order_day(v)), ORDER_DAY)


@query
def top_category3(v: Views) -> DataFrame:
    return serving.top_category3(_named_order_sums(_order_day(v)), ORDER_DAY)


@query
def top_spu(v: Views) -> DataFrame:
    return serving.top_spu(_named_order_sums(_order_day(v)), ORDER_DAY)


@query
def spu_orders_by_year(v: Views) -> DataFrame:
    """Distinct orders of each spu and year, from the bitmaps of its skus' windows."""
    pairs = _pairs(v)
    rows = measures.unified(
        measures.order_product_measures(pairs), measures.payment_measures(_payments(v, pairs)),
        measures.refund_measures(v.refund),
    )
    # a sku has few of a month's orders
    bits = stats.order_bits(rows, MONTH, sparse=True).join(v.dim_sku.select(F.col("id").alias("sku_id"), "spu_id"), "sku_id")
    return serving.distinct_orders(bits, F.substring("stt", 1, 4).alias("year"), "spu_id")


@query
def trademark_series(v: Views) -> DataFrame:
    ranked = serving.top_trademark(_named_order_sums(_order_day(v)), ORDER_DAY)
    arrays = serving.series(ranked, "tm_name", "order_amount")
    return arrays.select(F.posexplode(F.arrays_zip("categories", "data")).alias("pos", "p")).select(
        "pos", F.col("p.categories").alias("name"), F.col("p.data").alias("value")
    )


# --- province metrics


def _province_stats(v: Views) -> DataFrame:
    orders = wide.enrich_province(_pairs(v), v.dim_province)
    return stats.province_stats(orders, MONTH)


@query
def province_stats(v: Views) -> DataFrame:
    return _province_stats(v)


@query
def province_amount(v: Views) -> DataFrame:
    return serving.province_amount(_province_stats(_order_day(v)), ORDER_DAY)


@query
def province_map(v: Views) -> DataFrame:
    amounts = serving.province_amount(_province_stats(_order_day(v)), ORDER_DAY)
    return serving.name_values(amounts, "province_name", "order_amount")


# --- keywords


@query
def search_keywords(v: Views) -> DataFrame:
    found = keywords.tokenize(logs.search_fullwords(logs.page_log(v.page_log)), "fullword")
    return found.select("keyword", time_text(F.col("rowtime")).alias("rowtime"))


@query
def tokenize_documents(v: Views) -> DataFrame:
    return keywords.counts_by_key(v.table("documents").select("doc_id", "text"), "doc_id", "text")


@query
def product_keywords(v: Views) -> DataFrame:
    return keywords.tokenize(v.dim_spu, "spu_name").select("id", "keyword")


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder, so that plans know its size and repeat nothing below it."""
    path = f"{shared_dir(df.sparkSession)}/words/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _dictionary_words(v: Views, smart: bool) -> DataFrame:
    han = v.table("documents").select("doc_id", F.translate(F.lower("text"), LETTERS, HAN_LETTERS).alias("text"))
    # documents are cut into words once to count them, once to learn the distinct ones; all that follows reads those
    counted = keywords.word_counts(han, "text")
    runs = kept(keywords.long_runs(counted, "keyword"), "runs")
    known = kept(runs.filter(F.length("run").between(2, 4)).select(F.col("run").alias("word")), "known")
    cut = kept(keywords.cut_runs(runs, known, smart), "pieces")
    words = keywords.in_pieces(counted, cut, "keyword")
    return words.groupBy("doc_id", "keyword").agg(F.sum("ct").alias("ct"))


@query
def tokenize_dictionary(v: Views) -> DataFrame:
    """Documents in Han characters, one for each letter, cut by the words of two to four characters among them."""
    return _dictionary_words(v, smart=False)


@query
def tokenize_smart(v: Views) -> DataFrame:
    """The same documents and words, overlapping matches weighed against each other."""
    return _dictionary_words(v, smart=True)


def _counted_sums(v: Views, orders_later: timedelta = timedelta(0)) -> DataFrame:
    """Product metrics of the sources whose counts give keywords."""
    orders = measures.order_product_measures(_pairs(v))
    if orders_later:
        orders = orders.withColumn("event_time", F.col("event_time") + F.lit(orders_later))
    pages = measures.page_product_measures(logs.page_log(v.page_log))
    return stats.product_sums(measures.unified(pages, orders, measures.cart_measures(v.cart)), MONTH)


def _product_words(v: Views, orders_later: timedelta = timedelta(0)) -> DataFrame:
    sums = _counted_sums(v, orders_later)
    return keywords.product_keywords(
        stats.enrich_product_stats(sums, v.dim_sku, v.dim_spu, v.dim_category3, v.dim_trademark)
    )


@query
def product_keyword_sources(v: Views) -> DataFrame:
    return keywords.keyword_sources(_counted_sums(v).select("stt", "sku_id", "click_ct", "cart_ct", "order_ct"))


def _keyword_search(v: Views) -> DataFrame:
    found = keywords.tokenize(logs.search_fullwords(logs.page_log(v.page_log)), "fullword")
    return stats.keyword_stats_search(found, DAY)


@query
def keyword_stats_search(v: Views) -> DataFrame:
    return _keyword_search(v)


@query
def keyword_stats_product(v: Views) -> DataFrame:
    return _product_words(v)


@query
def keyword_score(v: Views) -> DataFrame:
    day = _order_day(v, KEYWORD_DAY)
    return serving.keyword_score(_keyword_search(day).unionByName(_product_words(day)), KEYWORD_DAY)


@query
def keyword_score_sources(v: Views) -> DataFrame:
    """All four sources on one day: the orders of ``ORDER_DAY`` count as made later."""
    day = v.narrowed(**{**_order_day(v).only, "events": _order_day(v, KEYWORD_DAY).only["events"]})
    both = _keyword_search(day).unionByName(_product_words(day, ORDERS_LATER))
    return serving.keyword_score(both, KEYWORD_DAY, limit=200, order_by="score")
