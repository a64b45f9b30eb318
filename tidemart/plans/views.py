"""The warehouse datasets as views over the generic test tables (FIXTURES.md, section 3)."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.functions import time_text
from tidemart.schemas import MONEY, TABLE_PROCESS_DDL, TABLE_PROCESS_LOG_DDL
from tidemart.sources import table


def _money(name: str) -> Column:
    return F.col(name).cast(MONEY)


# the declared columns of the test tables
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
    " l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}

ROUTES = [
    ("customer", "insert", "hbase", "dim_customer", "c_custkey,c_name,c_nationkey", "c_custkey", None),
    ("customer", "update", "HBASE", "dim_customer", "c_custkey,c_name,c_nationkey", "c_custkey", None),
    ("orders", "insert", "kafka", "dwd_order_insert", None, "o_orderkey", None),
    ("orders", "update", "clickhouse", "order_update", "", "o_orderkey", None),
    ("refund", "insert", "kafka", "dwd_refund", "", "id", None),
]

# later versions of them, by the key of the first change that meets them; the last column takes a route away
ROUTE_CHANGES = [
    ("customer", "update", "hbase", "dim_customer", "c_custkey,c_mktsegment", "c_custkey", None, 60, False),
    ("orders", "insert", "kafka", "dwd_order", "o_orderkey,o_custkey", "o_orderkey", None, 1000, False),
    ("orders", "insert", "kafka", "dwd_order_insert", None, "o_orderkey", None, 4000, False),
    ("orders", "update", None, None, None, None, None, 2000, True),
]


class Views:
    def __init__(self, spark: SparkSession, folder: str, only: dict[str, Column] | None = None):
        self.spark = spark
        self.folder = folder
        self.only = only or {}
        self._made: dict[str, DataFrame] = {}

    def once(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """A frame under a name, put together on first use."""
        if name not in self._made:
            self._made[name] = make()
        return self._made[name]

    def narrowed(self, **only: Column) -> Views:
        """The same views over the rows of the named tables that meet a condition on their stored columns."""
        return Views(self.spark, self.folder, only)

    def table(self, name: str) -> DataFrame:
        return self.once(name, lambda: table(self.spark, self.folder, name, TABLES[name], self.only.get(name)))

    @cached_property
    def page_log(self) -> DataFrame:
        """Raw behaviour log, start records included, with ``event_id`` to break ties."""
        k = F.get_json_object("props", "$.k").cast("int")
        kind = F.col("event_type")
        text = lambda prefix, number: F.concat(F.lit(prefix), number.cast("string"))
        user, event = F.col("user_id"), F.col("event_id")
        page_id = F.when(kind == "click", "good_detail").when(kind == "view", "good_list").otherwise(kind)

        def shown(i: Column) -> Column:
            item_type = F.when((event + i) % 4 == 3, "activity_id").otherwise("sku_id")
            return F.struct(((event + i) % 1000).cast("string").alias("item"), item_type.alias("item_type"))

        shown_items = F.transform(F.slice(F.array(F.lit(0), F.lit(1)), F.lit(1), k % 3), shown)
        return self.table("events").select(
            "event_id",
            F.struct(
                user.cast("string").alias("mid"),
                text("v", k % 3).alias("vc"),
                text("c", event % 4).alias("ch"),
                text("a", user % 5).alias("ar"),
                F.when(k % 2 == 0, "1").otherwise("0").alias("is_new"),
            ).alias("common"),
            F.struct(
                page_id.alias("page_id"),
                F.when(~kind.isin("view", "signup"), "home").alias("last_page_id"),
                (event % 1000).cast("string").alias("item"),
                F.round(F.col("value") * 1000).cast("bigint").alias("during_time"),
            ).alias("page"),
            F.when(kind == "signup", F.create_map(F.lit("entry"), F.lit("icon"))).alias("start"),
            shown_items.alias("displays"),
            # to the nearest millisecond, as the SQL twins convert it
            F.call_function("div", F.unix_micros("ts") + 500, F.lit(1000)).alias("ts"),
        )

    @cached_property
    def raw_log(self) -> DataFrame:
        """The log as JSON text; the records of type ``error`` are cut short and cannot be read."""
        whole = F.to_json(F.struct("common", "page", "start", "displays", "ts"))
        broken = F.col("page.page_id") == "error"
        text = F.when(broken, F.expr("left(value, length(value) - 1)")).otherwise(F.col("value"))
        return self.page_log.withColumn("value", whole).select("event_id", text.alias("value"))

    @cached_property
    def order_info(self) -> DataFrame:
        customer = self.table("customer").select("c_custkey", "c_nationkey")
        key, user = F.col("o_orderkey"), F.col("o_custkey")
        return self.table("orders").join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
            key.alias("id"),
            F.col("c_nationkey").cast("bigint").alias("province_id"),
            F.col("o_orderstatus").alias("order_status"),
            user.alias("user_id"),
            _money("o_totalprice").alias("total_amount"),
            (user % 100).cast(MONEY).alias("activity_reduce_amount"),
            (key % 50).cast(MONEY).alias("coupon_reduce_amount"),
            _money("o_totalprice").alias("original_total_amount"),
            (user % 20).cast(MONEY).alias("feight_fee"),
            time_text(F.col("o_orderdate")).alias("create_time"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("create_date"),
            F.col("o_orderdate").alias("create_ts"),
        )

    @cached_property
    def order_detail(self) -> DataFrame:
        net = _money("l_extendedprice") * (F.lit(1).cast("decimal(3,2)") - F.col("l_discount").cast("decimal(3,2)"))
        return self.table("lineitem").select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("bigint").alias("id"),
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("sku_id"),
            _money("l_extendedprice").alias("order_price"),
            F.col("l_quantity").cast("bigint").alias("sku_num"),
            F.concat(F.lit("line "), F.col("l_linenumber").cast("string")).alias("sku_name"),
            time_text(F.col("l_shipdate")).alias("create_time"),
            net.cast(MONEY).alias("split_total_amount"),
            F.col("l_linenumber").cast(MONEY).alias("split_activity_amount"),
            _money("l_tax").alias("split_coupon_amount"),
            F.col("l_shipdate").alias("create_ts"),
        )

    @cached_property
    def payment_info(self) -> DataFrame:
        late = F.col("o_orderdate") + F.make_dt_interval(mins=(F.col("o_orderkey") % 60).cast("int"))
        return self.table("orders").select(
            (F.col("o_orderkey") + 1_000_000).alias("id"),
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("user_id"),
            _money("o_totalprice").alias("total_amount"),
            F.col("o_orderpriority").alias("subject"),
            F.when(F.col("o_custkey") % 2 == 0, "1101").otherwise("1102").alias("payment_type"),
            time_text(F.col("o_orderdate")).alias("create_time"),
            time_text(late).alias("callback_time"),
            F.col("o_orderdate").alias("create_ts"),
            late.alias("callback_ts"),
        )

    @cached_property
    def dim_user(self) -> DataFrame:
        key = F.col("c_custkey")
        born = F.date_add(F.lit("1960-01-01").cast("date"), (key % 15000).cast("int"))
        gender = F.when(key % 2 == 0, "M").otherwise("F")
        return self.table("customer").select(
            key.alias("id"), F.date_format(born, "yyyy-MM-dd").alias("birthday"), gender.alias("gender")
        )

    @cached_property
    def dim_province(self) -> DataFrame:
        region = self.table("region")
        return self.table("nation").join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left").select(
            F.col("n_nationkey").cast("bigint").alias("id"),
            F.col("n_name").alias("name"),
            F.concat(F.lit("CN-"), F.col("n_nationkey").cast("string")).alias("iso_3166_2"),
            F.concat(F.lit("ISO-"), F.col("n_nationkey").cast("string")).alias("iso_code"),
            F.col("r_name").alias("area_code"),
        )

    def _brand(self) -> Column:
        return F.regexp_extract("p_brand", "([0-9]+)", 1).cast("bigint")

    def _spu(self) -> Column:
        return F.call_function("div", F.col("p_partkey"), F.lit(10))

    @cached_property
    def dim_sku(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("id"),
            F.col("p_name").alias("sku_name"),
            _money("p_retailprice").alias("price"),
            self._spu().alias("spu_id"),
            F.col("p_size").cast("bigint").alias("category3_id"),
            self._brand().alias("tm_id"),
        )

    @cached_property
    def dim_spu(self) -> DataFrame:
        return (
            self.table("part").groupBy(self._spu().alias("id")).agg(F.min_by("p_name", "p_partkey").alias("spu_name"))
        )

    @cached_property
    def dim_category3(self) -> DataFrame:
        size = F.col("p_size").cast("bigint")
        name = F.concat(F.lit("cat-"), size.cast("string"))
        return self.table("part").select(size.alias("id"), name.alias("name")).distinct()

    @cached_property
    def dim_trademark(self) -> DataFrame:
        return self.table("part").select(self._brand().alias("id"), F.col("p_brand").alias("tm_name")).distinct()

    def _sku_events(self, kind: str, *more: Column) -> DataFrame:
        return self.table("events").filter(F.col("event_type") == kind).select(
            (F.col("event_id") % 1000).alias("sku_id"),
            *more,
            time_text(F.col("ts")).alias("create_time"),
            F.date_trunc("second", "ts").alias("create_ts"),
        )

    @cached_property
    def favor(self) -> DataFrame:
        return self._sku_events("signup")

    @cached_property
    def cart(self) -> DataFrame:
        return self._sku_events("view")

    @cached_property
    def comment(self) -> DataFrame:
        k = F.get_json_object("props", "$.k").cast("int")
        return self._sku_events("purchase", F.when(k % 4 == 0, "1201").otherwise("1202").alias("appraise"))

    @cached_property
    def refund(self) -> DataFrame:
        return self.table("lineitem").filter(F.col("l_returnflag") == "R").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("sku_id"),
            _money("l_extendedprice").alias("refund_amount"),
            time_text(F.col("l_shipdate")).alias("create_time"),
            F.col("l_shipdate").alias("create_ts"),
        )

    def _envelope(self, name: str, key: Column, columns: dict[str, Column]) -> DataFrame:
        kind = F.when(key % 3 == 0, "bootstrap-insert").when(key % 3 == 1, "insert").otherwise("update")
        entries = [x for n, c in columns.items() for x in (F.lit(n), c)]
        record = F.struct(F.lit(name).alias("table"), kind.alias("type"), F.create_map(*entries).alias("data"))
        return self.table(name).select(F.to_json(record).alias("value"))

    @cached_property
    def raw_cdc(self) -> DataFrame:
        """Change records as JSON text: one per customer and order, and three invalid ones."""
        customer = self._envelope(
            "customer",
            F.col("c_custkey"),
            {
                "c_custkey": F.col("c_custkey").cast("string"),
                "c_name": F.col("c_name"),
                "c_nationkey": F.col("c_nationkey").cast("string"),
                "c_mktsegment": F.col("c_mktsegment"),
            },
        )
        orders = self._envelope(
            "orders",
            F.col("o_orderkey"),
            {
                "o_orderkey": F.col("o_orderkey").cast("string"),
                "o_custkey": F.col("o_custkey").cast("string"),
                "o_totalprice": _money("o_totalprice").cast("string"),
                "o_orderdate": time_text(F.col("o_orderdate")),
            },
        )
        invalid = self.spark.createDataFrame(
            [
                ('{"type":"insert","data":{"id":"1"}}',),
                ('{"table":"customer","type":"insert"}',),
                ('{"table":"customer","type":"insert","data":{}}',),
            ],
            "value string",
        )
        return customer.unionByName(orders).unionByName(invalid)

    @cached_property
    def table_process(self) -> DataFrame:
        return self.spark.createDataFrame(ROUTES, TABLE_PROCESS_DDL)

    @cached_property
    def table_process_log(self) -> DataFrame:
        first = [(*route, None, False) for route in ROUTES]
        return self.spark.createDataFrame(first + ROUTE_CHANGES, TABLE_PROCESS_LOG_DDL)
