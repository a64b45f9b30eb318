"""Plans and results under hot keys, and the layered rebuild."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemart.operators import cdc, dims, keywords, logs, measures, serving, stats, visits, wide
from tidemart.plans import Backfill, Settings, registry
from tidemart.plans.backfill import days_around, on_days
from tidemart.plans.views import Views
from tidemart.schemas import TABLE_PROCESS_LOG_DDL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def shuffled(spark):
    """No broadcast joins, and every partition over a few kilobytes counts as large."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    yield
    for key, value in old.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def hot(spark, rows=20_000):
    """Half of all rows belong to key 0; built by many tasks, as a scan would."""
    return spark.range(0, rows, 1, 8).select(
        F.col("id").alias("n"),
        F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id") % 97).alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )


@pytest.mark.parametrize("unique", [True, False])
def test_lookup_splits_a_hot_key(spark, shuffled, unique):
    dim = spark.range(97).select(F.col("id"), F.concat(F.lit("d"), F.col("id")).alias("name"))
    joined = dims.dim_join(hot(spark), dim, dims.DimSpec({"id": "k"}, {"name": "name"}, unique=unique))
    assert joined.filter(F.col("name") != F.concat(F.lit("d"), F.col("k"))).count() == 0
    joined.write.format("noop").mode("overwrite").save()
    rows = joined.collect()
    assert len(rows) == 20_000
    assert "skew=true" in plan(joined)


def test_lookup_as_of_splits_a_hot_key(spark, shuffled):
    """Half of all rows ask for one key in one slot, whose versions are few; the rows are split, the versions follow them."""
    log = spark.range(97 * 3).select(
        (F.col("id") % 97).alias("id"),
        F.call_function("div", F.col("id"), F.lit(97)).alias("valid_from"),
        F.concat(F.lit("d"), F.col("id")).alias("name"),
    )
    spec = dims.DimSpec({"id": "k"}, {"name": "name"})
    joined = dims.dim_join_as_of(hot(spark).withColumn("at", F.col("n") % 3), log, spec, "at", step=1_000)
    want = F.concat(F.lit("d"), F.col("k") + F.col("at") * 97)
    assert joined.filter(~F.col("name").eqNullSafe(want)).count() == 0
    assert len(joined.collect()) == 20_000
    assert "skew=true" in plan(joined)


def test_new_visitor_repair_splits_a_hot_device(spark, shuffled):
    common = F.struct(*[F.col("k").cast("string").alias(c) for c in ("mid", "vc", "ch", "ar")], F.lit("1").alias("is_new"))
    log = hot(spark).select(common.alias("common"), F.col("n").alias("ts"), "payload")
    repaired = logs.repair_new_visitors(log)
    assert len(repaired.collect()) == 20_000
    assert "skew=true" in plan(repaired)


def test_versioned_routes_split_a_hot_table(spark, shuffled):
    """Half of all changes are of one table, whose route has many versions: split, and never multiplied."""
    table = F.concat(F.lit("t"), F.col("k"))
    data = F.to_json(F.struct(F.col("n").cast("string").alias("id"), F.col("payload").alias("p")))
    changes = hot(spark).select(table.alias("table"), F.lit("insert").alias("type"), data.alias("data"), F.col("n").alias("seq"))
    later = [("t0", "insert", "kafka", f"v{n}", "", "id", None, n * 1000, False) for n in range(1, 20)]
    first = [(f"t{k}", "insert", "kafka", "v0", "", "id", None, None, False) for k in range(97)]
    routed = cdc.route_as_of(changes, spark.createDataFrame(first + later, TABLE_PROCESS_LOG_DDL), "seq")
    routed.collect()
    assert "skew=true" in plan(routed) and plan(routed).count("from_json") <= 2
    expected = F.when(F.col("table") == "t0", F.concat(F.lit("v"), F.floor(F.col("seq") / 1000))).otherwise(F.lit("v0"))
    assert routed.count() == 20_000 and routed.where(F.col("sink_table") != expected).count() == 0


def test_order_bitmaps_combine_before_the_shuffle(views):
    pairs = wide.order_pairs(views.order_info, views.order_detail, timedelta(days=180))
    bits = stats.order_bits(measures.unified(measures.order_product_measures(pairs)), "30 days")
    text = plan(serving.distinct_orders(bits, "sku_id"))
    assert "partial_bitmap_construct_agg" in text and "partial_bitmap_or_agg" in text and "collect_" not in text


def test_spu_orders_hold_no_bitmap_for_each_order(views):
    """A month's orders of one sku are few: bits in numbers, by hash, not 4 KB each."""
    text = plan(registry.QUERIES["spu_orders_by_year"](views))
    assert "partial_bit_or" in text and "bitmap" not in text and "SortAggregate" not in text


def test_interval_join_meets_only_rows_near_in_time(spark, shuffled):
    """One order id for everything: the pairs looked at grow with the pairs found, not with the square."""
    start = datetime(2024, 1, 1)
    n = 3_000
    moments = [(1, start + timedelta(minutes=i)) for i in range(n)]
    left = spark.createDataFrame(moments, "l_k int, l_t timestamp")
    right = spark.createDataFrame(moments, "r_k int, r_t timestamp")
    bound = timedelta(seconds=5)
    joined = wide.interval_join(left, right, {"l_k": "r_k"}, "l_t", "r_t", -bound, bound)
    assert joined.count() == n
    text = plan(joined)
    assert "_left_slot" in text and "CartesianProduct" not in text and "NestedLoop" not in text


def test_rankings_are_cut_before_the_shuffle(spark, views):
    for df in (
        visits.unique_visits(logs.page_log(views.page_log)),
        cdc.latest_rows(hot(spark), ["k"], [F.col("n").desc()]),
    ):
        text = plan(df)
        assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_bounces_are_one_combined_aggregate(views):
    text = plan(visits.bounces(logs.page_log(views.page_log), 600_000))
    assert text.count("Exchange") == 1 and "partial_max_by" in text and "Window" not in text


def test_distinct_orders_need_no_expand(views):
    pairs = wide.order_pairs(views.order_info, views.order_detail, timedelta(days=180))
    text = plan(stats.product_sums(measures.unified(measures.order_product_measures(pairs)), "30 days"))
    assert "Expand" not in text and "collect_set" not in text


def test_top_k_sorts_no_whole_table(views):
    assert "TakeOrderedAndProject" in plan(registry.top_spu(views))


def test_json_is_parsed_once_per_row(views):
    assert plan(registry.json_parse_log(views)).count("from_json") == 1


def test_filters_and_columns_reach_the_scan(spark, sf):
    text = plan(Views(spark, sf).refund.select("sku_id", "refund_amount"))
    assert "EqualTo(l_returnflag,R)" in text
    schema = text[text.index("ReadSchema") :]
    assert "l_extendedprice" in schema and "l_comment" not in schema and "l_tax" not in schema


@pytest.fixture
def whole_plans(spark):
    key = "spark.sql.maxMetadataStringLength"
    old = spark.conf.get(key)
    spark.conf.set(key, "5000")
    yield
    spark.conf.set(key, old)


ORDER_SCANS = {"o_orderdate": 1, "l_shipdate": 1}


@pytest.mark.parametrize(
    "name, bounded",
    [
        *[(n, ORDER_SCANS) for n in ("gmv", "top_trademark", "top_category3", "top_spu", "trademark_series")],
        *[(n, ORDER_SCANS) for n in ("province_amount", "province_map")],
        *[(n, {"ts": 3}) for n in ("visitor_by_new", "visitor_by_hour", "visitor_hour_dense", "visitor_kpis")],
        ("keyword_score", {**ORDER_SCANS, "ts": 3}),
    ],
)
def test_one_day_queries_push_their_day_to_the_scan(spark, sf, whole_plans, name, bounded):
    text = plan(registry.QUERIES[name](Views(spark, sf)))
    pushed = [line for line in text.splitlines() if "PushedFilters" in line]
    for column, least in bounded.items():
        both = [p for p in pushed if f"GreaterThanOrEqual({column}," in p and f"LessThan({column}," in p]
        assert len(both) >= least, (column, pushed)
    # no scan of a fact table without an upper bound
    facts = [p for p in pushed if any(f"({c}" in p for c in ("o_orderdate", "l_shipdate", "ts"))]
    assert all("LessThan(" in p for p in facts)


@pytest.mark.parametrize("name", ["visitor_by_new", "visitor_kpis", "visitor_hour_dense", "keyword_score_sources"])
def test_one_day_queries_have_figures_in_every_column(spark, sf, name):
    rows = [r.asDict() for r in registry.QUERIES[name](Views(spark, sf)).collect()]
    assert all(any(r[c] for r in rows) for c in rows[0])


def test_time_bounds_also_work_on_epoch_millis(spark):
    rows = spark.range(0, 200, 1).selectExpr("1704067200000 + (id - 50) * 900000 as ts")
    day = serving.within("ts", 20240101, "1 hour", millis=True)
    edge = rows.filter(day).agg(F.min("ts"), F.max("ts")).first()
    assert tuple(edge) == (1704067200000, 1704067200000 + 25 * 3_600_000 - 900_000)


def test_a_long_word_adds_one_candidate_at_each_place(spark):
    runs = spark.createDataFrame([("天地" * 300,)], "run string")
    dictionary = spark.createDataFrame([("天地",), ("玄" * 200,)], "word string")
    pieces = keywords.cut_runs(runs, dictionary).first().pieces
    assert pieces == ["天地"] * 300


def test_a_large_dictionary_and_a_hot_text_are_joined_by_shuffle(spark, shuffled):
    rows = hot(spark).select("n", F.when(F.col("k") == 0, "天地玄黄").otherwise(F.concat(F.lit("宇宙"), "payload")).alias("text"))
    dictionary = spark.createDataFrame([("天地",), ("玄黄",), ("宇宙",)], "word string")
    found = keywords.tokenize(rows, "text", dictionary=dictionary)
    assert len(found.filter("keyword in ('天地', '玄黄', '宇宙')").collect()) > 20_000
    counts = {r[0]: r[1] for r in found.groupBy("keyword").count().filter("keyword in ('天地', '玄黄', '宇宙')").collect()}
    assert counts["天地"] == counts["玄黄"] == 20_000 - counts["宇宙"]
    found.collect()
    assert "skew=true" in plan(found)


def test_backfill_equals_the_direct_plans(spark, views, tmp_path):
    settings = Settings("30 days", "1 day", 600_000, timedelta(days=180), tie=("event_id",))
    job = Backfill(spark, str(tmp_path / "warehouse"), settings)
    names = {
        "user": views.dim_user, "province": views.dim_province, "sku": views.dim_sku, "spu": views.dim_spu,
        "category3": views.dim_category3, "trademark": views.dim_trademark,
    }
    job.behaviour(views.page_log)
    job.orders(views.order_info, views.order_detail, views.payment_info, names, F.lit("2024-01-01").cast("date"))
    job.products(views.favor, views.cart, views.refund, views.comment, names)

    as_text = lambda df, cols: sorted(str(tuple(r)) for r in df.select(*cols).collect())
    for written, direct in (
        ("product_stats", registry.product_stats(views)),
        ("province_stats", registry.province_stats(views)),
        ("keyword_stats/of=search", registry.keyword_stats_search(views)),
        ("keyword_stats/of=product", registry.keyword_stats_product(views)),
    ):
        got = job.read(written)
        # product payments are dated by the payment there, by text to the second here
        assert as_text(got, direct.columns) == as_text(direct, direct.columns), written
    visitors = job.read("visitor_stats").agg(F.sum("pv_ct"), F.sum("uv_ct"), F.sum("uj_ct")).first()
    assert tuple(visitors) == (
        logs.page_log(views.page_log).count(),
        registry.unique_visit(views).count(),
        registry.bounce(views).count(),
    )

    daily = serving.gmv(job.read("product_stats"), registry.ORDER_DAY)
    assert daily.first()[0] == registry.gmv(views).first()[0]
    scan = plan(daily)
    filters = scan[scan.index("PartitionFilters") :].split("]")[0]
    assert "dt" in filters and "1998-05-04" in filters
    both = job.read("keyword_stats")
    scored = serving.keyword_score(both, registry.KEYWORD_DAY)
    assert as_text(scored, ["keyword", "ct"]) == as_text(registry.keyword_score(views), ["keyword", "ct"])


def test_backfill_finds_the_dimension_rows_of_the_time(spark, views, tmp_path):
    """A rebuild after dimension changes names orders as they were named when they were made."""
    job = Backfill(spark, str(tmp_path / "warehouse"), Settings(order_bound=timedelta(days=180)))
    turn = F.lit("1998-01-01").cast("timestamp")
    # an older and a newer state of two dimensions; the newer sku rows hang on other names
    old = views.dim_sku.withColumn("valid_from", F.lit(None).cast("timestamp"))
    new = views.dim_sku.withColumns({"tm_id": (F.col("tm_id") + 1) % 30, "valid_from": turn})
    gone = views.dim_trademark.withColumns({"valid_from": turn, "deleted": F.lit(True)}).filter("id % 2 = 0")
    marks = views.dim_trademark.withColumns({"valid_from": F.lit(None).cast("timestamp"), "deleted": F.lit(False)})
    plain = {
        "user": views.dim_user, "province": views.dim_province, "spu": views.dim_spu, "category3": views.dim_category3,
    }
    age = F.lit("2024-01-01").cast("date")
    versioned = plain | {"sku": old.unionByName(new), "trademark": marks.unionByName(gone)}
    job.orders(views.order_info, views.order_detail, views.payment_info, versioned, age)
    got = job.read("dwm_order_wide").drop("dt")

    pairs = wide.order_pairs(views.order_info, views.order_detail, timedelta(days=180))
    later = F.col("create_ts") >= turn
    left = views.dim_trademark.filter("id % 2 = 1")
    before = wide.order_wide(pairs.filter(~later), **plain, sku=views.dim_sku, trademark=views.dim_trademark, as_of=age)
    after = wide.order_wide(pairs.filter(later), **plain, sku=new.drop("valid_from"), trademark=left, as_of=age)
    want = before.unionByName(after)
    as_text = lambda df: sorted(str(tuple(r)) for r in df.select(*want.columns).collect())
    assert as_text(got) == as_text(want)
    assert before.count() and after.filter("tm_name IS NULL").count() and after.filter("tm_name IS NOT NULL").count()
    newest = dims.current_rows(versioned["sku"]).collect()
    assert sorted(newest) == sorted(new.select(*dims.current_rows(versioned["sku"]).columns).collect())
    assert dims.current_rows(versioned["trademark"]).count() == left.count()


def test_days_around_and_ranges(spark):
    day = date(2024, 3, 1)
    assert days_around(None) is None and days_around([]) == []
    assert days_around([day], timedelta(seconds=5), timedelta(days=1, seconds=1)) == [
        date(2024, 2, 29), day, date(2024, 3, 2), date(2024, 3, 3)
    ]
    times = spark.sql("SELECT timestamp'2024-02-28' + make_interval(0, 0, 0, 0, 6 * id) AS t FROM range(24)")
    for chosen in ([], [day], [date(2024, 2, 28), date(2024, 2, 29), date(2024, 3, 3)]):
        got = times.filter(on_days(F.col("t"), chosen)).collect()
        assert {r["t"].date() for r in got} == set(chosen) and len(got) == 4 * len(chosen)
        millis = times.select(F.unix_millis("t").alias("t")).filter(on_days(F.col("t"), chosen, millis=True))
        assert millis.count() == len(got)


def test_changed_days_are_rebuilt_and_others_left_alone(spark, tmp_path):
    """One day emptied, one with other records, one device whose first day moves to a day outside of them."""
    days = [datetime(2024, 1, d) for d in range(1, 13)]

    def page(n, mid, day, second, is_new="0", last=None):
        ts = int((day - datetime(1970, 1, 1)).total_seconds() * 1000) + second * 1000
        item = "handbag" if n % 2 else "sku"
        shown = [(str(n % 3), "sku_id")]
        return (n, (mid, "v", "c", "a", is_new), ("good_list", last, item, 5), None, shown, ts)

    common = [page(100 * k + m, f"m{m}", day, 40_000 + 7 * m) for k, day in enumerate(days) for m in range(3)]
    # the last second of a day and the first of the next: a bounce that the next day can prevent
    night = [page(5000, "owl", days[6], 86_399, last=""), page(5001, "first", days[2], 10, "1"), page(5002, "first", days[9], 10, "1")]
    ddl = (
        "event_id bigint, common struct<mid string, vc string, ch string, ar string, is_new string>, page struct<page_id"
        " string, last_page_id string, item string, during_time bigint>, start map<string,string>, displays"
        " array<struct<item string, item_type string>>, ts bigint"
    )
    old = spark.createDataFrame(common + night, ddl)
    # day 3 (index 2) loses everything, with it the first day of "first"; day 8 (index 7) gains a page of the owl
    empty_day = days[2].date()
    kept = [r for r in common + night if datetime(1970, 1, 1) + timedelta(milliseconds=r[5]) < days[2] or datetime(1970, 1, 1) + timedelta(milliseconds=r[5]) >= days[3]]
    new = spark.createDataFrame([*kept, page(5003, "owl", days[7], 1, last="home")], ddl)
    settings = Settings(window="10 seconds", keyword_window="1 hour", tie=("event_id",))
    job = Backfill(spark, str(tmp_path / "days"), settings)
    job.behaviour(old)
    before = {str(f) for f in (tmp_path / "days").rglob("part-*.parquet")}
    written = job.behaviour(new, [empty_day, days[7].date()])
    after = {str(f) for f in (tmp_path / "days").rglob("part-*.parquet")}
    assert written == [empty_day, days[7].date(), days[9].date()]

    whole = Backfill(spark, str(tmp_path / "whole"), settings)
    whole.behaviour(new)
    layers = ("dwd_log", "dwd_display_log", "dwm_unique_visit", "dwm_user_jump_detail", "visitor_stats", "keyword_stats", "first_days")
    for name in layers:
        want = whole.read(name)
        columns = [c for c in want.columns if c != "ts" or name == "dwd_log"]
        as_text = lambda df: sorted(str(tuple(r)) for r in df.select(*columns).collect())  # noqa: E731, B023
        assert as_text(job.read(name)) == as_text(want), name
        assert want.count(), name
    assert 5000 not in {r["event_id"] for r in job.read("dwm_user_jump_detail").collect()}
    # folders of other days keep their files
    for name in ("dwd_log", "dwd_display_log", "dwm_unique_visit", "dwm_user_jump_detail", "visitor_stats"):
        gone = {f.split("dt=")[1][:10] for f in before - after if f"/{name}/" in f}
        assert gone and gone <= {f"2024-01-{d:02}" for d in (2, 3, 7, 8, 9, 10)}, (name, gone)


def test_changed_order_days_are_rebuilt(spark, views, tmp_path):
    """Orders of one day taken away: all order layers as if built anew, folders of far days untouched."""
    names = {
        "user": views.dim_user, "province": views.dim_province, "sku": views.dim_sku, "spu": views.dim_spu,
        "category3": views.dim_category3, "trademark": views.dim_trademark,
    }
    age = F.lit("2024-01-01").cast("date")
    settings = Settings("1 hour", "1 hour", 10_000, timedelta(days=20), tie=("event_id",))
    changed = date(1998, 5, 4)
    # some months, as each day is a folder of its own
    some = F.col("create_ts").between("1998-03-15", "1998-06-30")
    made, details, paid = (df.filter(some) for df in (views.order_info, views.order_detail, views.payment_info))
    fewer = made.filter(F.col("create_ts").cast("date") != changed)
    more = views.favor.unionByName(views.favor.limit(1).withColumns({"create_ts": F.lit("2024-02-02 03:00:00").cast("timestamp_ntz"), "create_time": F.lit("2024-02-02 03:00:00")}))
    rest = (views.cart, views.refund.filter(some), views.comment)
    job, whole = Backfill(spark, str(tmp_path / "days"), settings), Backfill(spark, str(tmp_path / "whole"), settings)
    for each, orders in ((job, made), (whole, fewer)):
        each.behaviour(views.page_log)
        each.orders(orders, details, paid, names, age)
        each.products(views.favor if each is job else more, *rest, names)
    before = {str(f) for f in (tmp_path / "days").rglob("part-*.parquet")}
    touched = job.orders(fewer, details, paid, names, age, changed=[changed])
    job.products(more, *rest, names, changed=[*touched, date(2024, 2, 2)])
    after = {str(f) for f in (tmp_path / "days").rglob("part-*.parquet")}
    for name in ("dwm_order_wide", "dwm_payment_wide", "province_stats", "product_stats", "keyword_stats"):
        want = whole.read(name)
        columns = [c for c in want.columns if c != "ts"]
        as_text = lambda df: sorted(str(tuple(r)) for r in df.select(*columns).collect())  # noqa: E731, B023
        assert as_text(job.read(name)) == as_text(want), name
        kept = {f for f in before & after if f"/{name}/" in f}
        assert kept, name


def test_words_are_counted_inside_their_row(spark):
    """Only identifiers of several rows meet in a shuffle; null is one of them."""
    rows = [(1, "b a b, A"), (2, "b"), (2, "b c"), (None, "x"), (None, "x 天地 x"), (3, None), (4, " ")]
    found = keywords.counts_by_key(spark.createDataFrame(rows, "doc_id int, text string"), "doc_id", "text")
    want = {(1, "b", 2), (1, "a", 2), (2, "b", 2), (2, "c", 1), (None, "x", 3), (None, "天地", 1)}
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, want))
    # the one exchange of words is that of several rows; those of single rows meet none
    alone = keywords.word_counts(spark.createDataFrame(rows, "doc_id int, text string"), "text")
    assert "Exchange" not in plan(alone)
