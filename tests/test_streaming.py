"""Streaming forms against their batch forms, restarts, repeats and late rows."""

import random
from datetime import timedelta
from pathlib import Path

from pyspark.sql import functions as F

from tidemart.operators import logs, measures, stats, visits, wide
from tidemart.plans.views import ROUTES
from tidemart.schemas import TABLE_PROCESS_DDL, TABLE_PROCESS_LOG_DDL
from tidemart.sources import feed_rows, feeds, topic_view
from tidemart.streaming import DimLog, jobs, repair_new_visitors, stateful
from tidemart.streaming.sinks import append_batch, start_batches

NOW = {"availableNow": True}
LATER = 40 * 86_400_000


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def closing_page(log, page_id=None):
    """A page long after all others, from a device of its own: it closes every window before it."""
    last = log.agg(F.max("ts")).first()[0] + LATER
    return log.limit(1).withColumns(
        {
            "event_id": F.lit(-1).cast("bigint"),
            "ts": F.lit(last).cast("bigint"),
            "common": F.col("common").withField("mid", F.lit("closing")),
            "page": F.col("page").withField("last_page_id", F.lit("home")).withField(
                "page_id", F.lit(page_id) if page_id else F.col("page.page_id")
            ),
            "start": F.lit(None).cast("map<string,string>"),
        }
    )


def feed_log(replay, log, name="log", parts=4, shuffled=False, closing_id=None):
    source = replay(name)
    order = [F.xxhash64("event_id")] if shuffled else ["ts", "event_id"]
    source.add_sorted(log, order, parts)
    source.add(closing_page(log, closing_id))
    return source.stream(log.schema)


def test_new_visitor_repair(spark, views, replay, table_of, tmp_path):
    log = views.page_log
    got = table_of(repair_new_visitors(feed_log(replay, log)), tmp_path / "ck").filter("event_id >= 0")
    want = logs.repair_new_visitors(log)
    columns = ("event_id", "common.mid", "common.is_new", "page.page_id", "ts")
    assert rows(got, *columns) == rows(want, *columns)


def test_unique_visits(spark, views, replay, table_of, tmp_path):
    pages = logs.page_log(views.page_log)
    stream = feed_log(replay, pages)
    got = table_of(stateful.unique_visits(stream, tie=("event_id",)), tmp_path / "ck")
    want = visits.unique_visits(pages, ("event_id",))
    assert rows(got, "event_id", "common.mid", "ts") == rows(want, "event_id", "common.mid", "ts")


def test_bounces(spark, views, replay, table_of, tmp_path):
    pages = logs.page_log(views.page_log)
    stream = feed_log(replay, pages)
    got = table_of(visits.bounces(stream, 600_000, ("event_id",)), tmp_path / "ck")
    want = visits.bounces(pages, 600_000, ("event_id",))
    assert rows(got, "event_id", "common.mid", "ts") == rows(want, "event_id", "common.mid", "ts")


def test_bounces_out_of_order_within_delay(spark, views, replay, table_of, tmp_path):
    """Arrival order does not matter as long as the watermark waits for it."""
    pages = logs.page_log(views.page_log)
    stream = feed_log(replay, pages, shuffled=True)
    got = table_of(visits.bounces(stream, 600_000, ("event_id",), delay_ms=35 * 86_400_000), tmp_path / "ck")
    want = visits.bounces(pages, 600_000, ("event_id",))
    assert rows(got, "event_id", "ts") == rows(want, "event_id", "ts")


def test_bounces_by_timers(spark, views, replay, table_of, tmp_path):
    pages = logs.page_log(views.page_log)
    got = table_of(stateful.bounces(feed_log(replay, pages), 600_000, ("event_id",)), tmp_path / "ck")
    want = visits.bounces(pages, 600_000, ("event_id",))
    assert rows(got, "event_id", "common.mid", "ts") == rows(want, "event_id", "common.mid", "ts")
    # the pages come back whole
    of = lambda df: {r.event_id: str(r) for r in df.select(*pages.columns).collect()}
    assert of(got) == of(want)


def test_bounces_by_timers_out_of_order(spark, views, replay, table_of, tmp_path):
    pages = logs.page_log(views.page_log)
    stream = feed_log(replay, pages, shuffled=True)
    got = table_of(stateful.bounces(stream, 600_000, ("event_id",), "35 days"), tmp_path / "ck")
    want = visits.bounces(pages, 600_000, ("event_id",))
    assert rows(got, "event_id") == rows(want, "event_id")


def page_at(event_id, mid, ts, last_page_id=None):
    common = (mid, "v", "c", "a", "1")
    return (event_id, common, ("home", last_page_id, None, 1), None, None, ts)


PAGE_DDL = (
    "event_id bigint, common struct<mid string, vc string, ch string, ar string, is_new string>, "
    "page struct<page_id string, last_page_id string, item string, during_time bigint>, "
    "start map<string,string>, displays array<struct<item string, item_type string>>, ts bigint"
)


def test_random_bounces_by_timers_with_restarts(spark, replay, tmp_path):
    """Random logs of few devices, pages near each other and on slot edges; the job ends and goes on after each part."""
    rng = random.Random(3)
    made, ts = [], 1_000_000
    for n in range(240):
        ts += rng.choice([0, 1, 400, 999, 1_000, 1_001, 2_500])
        made.append(page_at(n, rng.choice("abc"), ts, rng.choice([None, "", "home"])))
    log = spark.createDataFrame(made, PAGE_DDL)
    source, out = replay("log"), str(tmp_path / "out")
    for part in (made[:70], made[70:71], made[71:160], made[160:], [page_at(-1, "closing", ts + 10_000, "home")], [page_at(-2, "closing", ts + 20_000, "home")]):
        source.add(spark.createDataFrame(part, PAGE_DDL))
        job = jobs.bounce(source.stream(log.schema), out, str(tmp_path / "ck"), 1_000, ("event_id",), trigger=NOW)
        job.awaitTermination()
    got = spark.read.parquet(out)
    assert rows(got, "event_id") == rows(visits.bounces(log, 1_000, ("event_id",)), "event_id")


def test_a_bounce_is_known_when_the_watermark_passes_its_timeout(spark, replay, tmp_path):
    """One page a part: the bounce of the first is out as soon as the watermark is behind its end."""
    source, seen = replay("log"), []
    first, timeout = 1_000_000, 10_000
    times = [first, first + 4_000, first + 9_000, first + 10_001, first + 10_500, first + 40_000]
    for n, ts in enumerate(times):
        source.add(spark.createDataFrame([page_at(n, f"m{n}", ts)], PAGE_DDL))
        found = stateful.bounces(source.stream(PAGE_DDL), timeout, ("event_id",))
        start_batches(found, lambda b, i, n=n: seen.extend((n, r.event_id) for r in b.collect()), str(tmp_path / "ck"), None, NOW).awaitTermination()
    # part 3 moves the watermark past first + 10 s; the run that reads it emits the page before it ends
    assert (3, 0) in seen and {e for _, e in seen} == {0, 1, 2, 3, 4}


def test_late_rows_are_dropped_and_counted(spark, views, replay, tmp_path):
    pages = logs.page_log(views.page_log).select("event_id", F.timestamp_millis("ts").alias("event_time"))
    source = replay("late")
    source.add_sorted(pages, [F.col("event_time").desc()], 4)
    timed = source.stream(pages.schema).withWatermark("event_time", "0 seconds")
    query = (
        stats.tumbling_count(timed, "event_time", "1 hour")
        .writeStream.format("memory")
        .queryName("late_counts")
        .option("checkpointLocation", str(tmp_path / "ck"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    dropped = sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)
    kept = spark.table("late_counts").agg(F.sum("ct")).first()[0] or 0
    # newest file first: Spark drops by the watermark of the batch before, so the second file still passes
    part = -(-pages.count() // 4)
    assert dropped > 0
    assert part <= kept <= 2 * part


def test_interval_join(spark, views, replay, table_of, tmp_path):
    orders, details = replay("orders"), replay("details")
    # times as text, as a JSON topic brings them
    order_rows, detail_rows = views.order_info.drop("create_ts"), views.order_detail.drop("create_ts")
    orders.add_sorted(order_rows, ["create_time", "id"], 3)
    details.add_sorted(detail_rows, ["create_time", "order_id"], 3)
    bound = timedelta(days=5)
    delay = "4000 days"  # the two folders are not replayed in step
    left = wide.with_event_time(orders.stream(order_rows.schema), "create_time", "create_ts")
    right = wide.with_event_time(details.stream(detail_rows.schema), "create_time", "create_ts")
    left, right = left.withWatermark("create_ts", delay), right.withWatermark("create_ts", delay)
    got = table_of(wide.order_pairs(left, right, bound), tmp_path / "ck")
    want = wide.order_pairs(views.order_info, views.order_detail, bound)
    assert rows(got, "order_id", "detail_id", "sku_id") == rows(want, "order_id", "detail_id", "sku_id")
    assert want.count() > 0


def test_visitor_stats(spark, views, replay, tmp_path):
    log = views.page_log
    pages = logs.page_log(log)
    unique = visits.unique_visits(pages, ("event_id",))
    bounced = visits.bounces(pages, 600_000, ("event_id",))
    streams = [feed_log(replay, df, n) for df, n in ((pages, "p"), (unique, "u"), (bounced, "b"))]
    out = str(tmp_path / "out")
    jobs.visitor_stats(*streams, out, str(tmp_path / "ck"), "1 hour", "40 days", trigger=NOW).awaitTermination()
    want = stats.visitor_stats(measures.visitor_measures(pages, unique, bounced), "1 hour")
    got = spark.read.parquet(out)
    columns = ("stt", "edt", "vc", "ch", "ar", "is_new", "uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum", "ts")
    # the watermark stands 40 days behind the closing page, at the last real page: compare the windows before it
    closed = pages.agg(F.date_format(F.date_trunc("hour", F.timestamp_millis(F.max("ts"))), "yyyy-MM-dd HH:mm:ss")).first()[0]
    assert rows(got.filter(F.col("stt") < closed), *columns) == rows(want.filter(F.col("stt") < closed), *columns)
    assert str(got.schema["dt"].dataType) == "DateType()"


def test_distinct_order_counts(spark, views, replay, table_of, tmp_path):
    """Two chained aggregates on a stream count the same orders as the batch form."""
    pairs = wide.order_pairs(views.order_info, views.order_detail, timedelta(days=180))
    closing = pairs.limit(1).withColumn("create_ts", F.lit("2010-01-01").cast("timestamp"))
    source = replay("pairs")
    source.add_sorted(pairs, ["create_ts", "order_id", "detail_id", "sku_id"], 3)
    source.add(closing)
    source.add(closing.withColumn("create_ts", F.lit("2012-01-01").cast("timestamp")))
    timed = source.stream(pairs.schema).withWatermark("create_ts", "0 seconds")

    named = wide.enrich_province(timed, views.dim_province)
    columns = ("stt", "province_id", "province_name", "order_amount", "order_count")
    want = stats.province_stats(wide.enrich_province(pairs, views.dim_province), "30 days")
    got = table_of(stats.province_stats(named, "30 days"), tmp_path / "ck1").filter("stt < '2009'")
    assert rows(got, *columns) == rows(want, *columns)

    plain = source.stream(pairs.schema)
    measured = measures.unified(measures.order_product_measures(plain)).withWatermark("event_time", "0 seconds")
    columns = ("stt", "edt", "sku_id", "order_sku_num", "order_amount", "order_ct", "paid_order_ct")
    want = stats.product_sums(measures.unified(measures.order_product_measures(pairs)), "30 days")
    got = table_of(stats.product_sums(measured, "30 days"), tmp_path / "ck2").filter("stt < '2009'")
    assert rows(got, *columns) == rows(want, *columns)


def test_product_stats_job_writes_rows_and_records(spark, views, replay, tmp_path):
    pages = logs.page_log(views.page_log)
    measured = measures.unified(measures.page_product_measures(feed_log(replay, pages, closing_id="good_detail")))
    dims = {"sku": views.dim_sku, "spu": views.dim_spu, "category3": views.dim_category3, "trademark": views.dim_trademark}
    out, topic = str(tmp_path / "out"), str(tmp_path / "topic")
    jobs.product_stats(measured, lambda: dims, out, topic, str(tmp_path / "ck"), "1 day", trigger=NOW).awaitTermination()
    want = stats.enrich_product_stats(stats.product_sums(measures.unified(measures.page_product_measures(pages)), "1 day"), **dims)
    columns = ("stt", "sku_id", "click_ct", "display_ct", "sku_name", "spu_name", "tm_name")
    got = spark.read.parquet(out)
    sort_key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, got.select(*columns).collect()), key=sort_key) == sorted(
        map(tuple, want.select(*columns).collect()), key=sort_key
    )
    records = spark.read.parquet(topic)
    assert records.count() == got.count()
    assert records.filter(F.get_json_object("value", "$.stt").isNull()).count() == 0


def test_base_log_job_survives_a_restart(spark, views, replay, tmp_path):
    log = views.page_log
    source = replay("raw")
    source.add_sorted(log, ["ts", "event_id"], 2)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "ck")
    jobs.base_log(source.stream(log.schema), out, checkpoint, NOW).awaitTermination()
    # more input, a new query on the same checkpoint: first days are remembered, nothing is written twice
    later = log.withColumns({"ts": F.col("ts") + LATER, "event_id": F.col("event_id") + 1_000_000})
    source.add(later)
    jobs.base_log(source.stream(log.schema), out, checkpoint, NOW).awaitTermination()

    whole = logs.repair_new_visitors(log.unionByName(later))
    columns = ("event_id", "common.is_new", "ts")
    assert rows(spark.read.parquet(f"{out}/page"), *columns) == rows(logs.page_log(whole), *columns)
    assert rows(spark.read.parquet(f"{out}/start"), *columns) == rows(logs.start_log(whole), *columns)
    display = ("item", "item_type", "page_id")
    assert rows(spark.read.parquet(f"{out}/display"), *display) == rows(logs.display_log(whole), *display)


def test_base_db_job(spark, replay, tmp_path):
    source = replay("cdc")
    change = lambda key, name, kind, seq: (
        f'{{"table":"customer","type":"{kind}","data":{{"c_custkey":"{key}","c_name":"{name}","c_nationkey":"1","x":"0"}}}}',
        seq,
    )
    order = lambda key, seq: (f'{{"table":"orders","type":"insert","data":{{"o_orderkey":"{key}"}}}}', seq)
    source.add(spark.createDataFrame([change(1, "a", "bootstrap-insert", 1), change(2, "b", "insert", 2), order(7, 3)], "value string, seq bigint"))
    source.add(spark.createDataFrame([change(1, "a2", "update", 4), change(1, "a3", "update", 5), order(8, 6)], "value string, seq bigint"))
    source.add(spark.createDataFrame([change(3, "c", "insert", 7)], "value string, seq bigint"))
    facts, dims = str(tmp_path / "facts"), str(tmp_path / "dims")
    jobs.base_db(
        source.stream("value string, seq bigint"),
        lambda: spark.createDataFrame(ROUTES, TABLE_PROCESS_DDL),
        facts,
        dims,
        str(tmp_path / "ck"),
        trigger=NOW,
    ).awaitTermination()
    dim = DimLog(f"{dims}/DIM_CUSTOMER", "c_custkey", ("c_custkey", "c_name", "c_nationkey"))
    assert rows(dim.read(spark), "c_custkey", "c_name") == [("1", "a3"), ("2", "b"), ("3", "c")]
    written = spark.read.parquet(facts)
    assert rows(written, "sink_table", "value") == [
        ("dwd_order_insert", '{"o_orderkey":"7"}'),
        ("dwd_order_insert", '{"o_orderkey":"8"}'),
    ]


def test_every_change_is_stored_or_a_dead_letter(spark, replay, tmp_path):
    """Routes of one dimension with different columns, and records nobody can read: good + dead = read."""
    source = replay("cdc")
    change = lambda kind, data, seq: (f'{{"table":"t","type":"{kind}","data":{data}}}', seq)
    sent = [
        change("insert", '{"id":"1","name":"a","city":"x"}', 1),
        change("insert", '{"id":"2","name":"b","city":"y"}', 2),
        change("update", '{"id":"1","name":"a2","city":"ignored"}', 3),
        change("insert", '{"name":"nobody","city":"z"}', 4),
        change("insert", "[1, 2, 3]", 5),
        ("not json", 6),
    ]
    for record in sent:
        source.add(spark.createDataFrame([record], "value string, seq bigint"))
    routes = [("t", "insert", "hbase", "dim_t", "id,name,city", "id", None), ("t", "update", "hbase", "dim_t", "id,name", "id", None)]
    facts, dims, dead = (str(tmp_path / n) for n in ("facts", "dims", "dead"))
    jobs.base_db(
        source.stream("value string, seq bigint", files_per_batch=2),
        lambda: spark.createDataFrame(routes, TABLE_PROCESS_DDL),
        facts, dims, str(tmp_path / "ck"), trigger=NOW, dead=dead,
    ).awaitTermination()
    dim = DimLog(f"{dims}/DIM_T", "id", ("id", "name", "city"))
    assert rows(dim.read(spark), "id", "name", "city") == [("1", "a2", "x"), ("2", "b", "y")]
    assert sorted(r.reason for r in spark.read.parquet(dead).collect()) == ["data", "key", "record"]


def test_routing_is_read_again_for_every_batch(spark, replay, tmp_path):
    """A route taken away stops routing at the next micro-batch, and the other way round."""
    source = replay("cdc")
    order = lambda key, seq: (f'{{"table":"orders","type":"insert","data":{{"o_orderkey":"{key}"}}}}', seq)
    for number in (1, 2, 3):
        source.add(spark.createDataFrame([order(number, number)], "value string, seq bigint"))
    calls = []

    def routing():
        calls.append(1)
        with_orders = [r for r in ROUTES if r[0] == "orders"]
        other = [("refund", "insert", "kafka", "dwd_refund", "", "id", None)]
        return spark.createDataFrame(other if len(calls) == 2 else with_orders, TABLE_PROCESS_DDL)

    facts = str(tmp_path / "facts")
    jobs.base_db(
        source.stream("value string, seq bigint"), routing, facts, str(tmp_path / "dims"), str(tmp_path / "ck"), trigger=NOW
    ).awaitTermination()
    assert len(calls) == 3
    assert rows(spark.read.parquet(facts), "value") == [('{"o_orderkey":"1"}',), ('{"o_orderkey":"3"}',)]


def test_replay_after_a_configuration_change_routes_alike(spark, replay, tmp_path):
    """With a log of routes, what was routed by an old version is routed by it again, dimension columns included."""
    source = replay("cdc")
    record = lambda table, n: (f'{{"table":"{table}","type":"insert","data":{{"id":"{n}","a":"x","b":"y"}}}}', n)
    log = [
        ("orders", "insert", "kafka", "old", "id", None, None, None, False),
        ("user", "insert", "hbase", "dim_user", "id,a", "id", None, None, False),
    ]
    later = [
        ("orders", "insert", "kafka", "new", "id,a", None, None, 5, False),
        ("user", "insert", "hbase", "dim_user", "id,b", "id", None, 5, False),
    ]

    def run(name):
        paths = [str(tmp_path / f"{name}-{part}") for part in ("facts", "dims", "ck")]
        stream = source.stream("value string, seq bigint")
        jobs.base_db(
            stream, lambda: spark.createDataFrame(log, TABLE_PROCESS_LOG_DDL), *paths, trigger=NOW
        ).awaitTermination()
        dim = DimLog(f"{paths[1]}/DIM_USER", "id", ("id", "a", "b")[: 2 + (len(log) > 2)])
        return rows(spark.read.parquet(paths[0]), "sink_table", "value"), rows(dim.read(spark), "id", "a")

    source.add(spark.createDataFrame([record("orders", 1), record("user", 2)], "value string, seq bigint"))
    first = run("first")
    assert first == ([("old", '{"id":"1"}')], [("2", "x")])
    log += later
    assert run("same") == first
    source.add(spark.createDataFrame([record("orders", 6), record("user", 7)], "value string, seq bigint"))
    assert run("all") == (
        [("new", '{"id":"6","a":"x"}'), ("old", '{"id":"1"}')], [("2", "x"), ("7", None)]
    )


def test_keyword_and_payment_jobs(spark, views, replay, tmp_path):
    pages = logs.page_log(views.page_log)
    out = str(tmp_path / "kw")
    stream = feed_log(replay, pages.withColumn("page", F.col("page").withField("page_id", F.lit("good_list"))))
    jobs.keyword_stats_search(stream, out, str(tmp_path / "ck1"), "1 day", trigger=NOW).awaitTermination()
    assert spark.read.parquet(out).agg(F.sum("ct")).first()[0] == pages.count()

    near = timedelta(days=5)
    dims = {
        "user": views.dim_user, "province": views.dim_province, "sku": views.dim_sku, "spu": views.dim_spu,
        "category3": views.dim_category3, "trademark": views.dim_trademark,
    }
    orders, details, payments = replay("o"), replay("d"), replay("p")
    orders.add(views.order_info)
    details.add(views.order_detail)
    payments.add(views.payment_info)
    wide_out, paid_out = str(tmp_path / "wide"), str(tmp_path / "paid")
    jobs.order_wide(
        orders.stream(views.order_info.schema), details.stream(views.order_detail.schema), lambda: dims, wide_out,
        str(tmp_path / "ck2"), near, trigger=NOW,
    ).awaitTermination()
    written = spark.read.parquet(wide_out)
    wide_rows = wide.order_wide(wide.order_pairs(views.order_info, views.order_detail, near), **dims)
    columns = ("order_id", "detail_id", "sku_name", "province_name", "user_gender")
    assert rows(written, *columns) == rows(wide_rows, *columns)

    # the dataset just written is the next job's stream
    stream = spark.readStream.schema(written.drop("batch_id").schema).parquet(wide_out)
    jobs.payment_wide(
        payments.stream(views.payment_info.schema), stream, paid_out, str(tmp_path / "ck3"), trigger=NOW
    ).awaitTermination()
    columns = ("payment_id", "order_id", "detail_id", "total_amount")
    assert rows(spark.read.parquet(paid_out), *columns) == rows(wide.payment_wide(views.payment_info, wide_rows), *columns)


def test_a_repeated_batch_is_published_once_to_a_reading_job(spark, tmp_path):
    out, read = str(tmp_path / "handed"), str(tmp_path / "read")
    batches = {n: spark.range(5 * n, 5 * n + 5) for n in range(3)}

    def read_on():
        stream = spark.readStream.schema("id bigint").parquet(out)
        start_batches(stream, lambda b, i: append_batch(b, read, i), str(tmp_path / "ck"), trigger=NOW).awaitTermination()
        return spark.read.parquet(read)

    append_batch(batches[0], out, 0)
    assert read_on().count() == 5
    # the writing job ends before it records the batch, starts again and repeats it
    append_batch(batches[0], out, 0)
    append_batch(batches[1], out, 1)
    assert rows(read_on(), "id") == [(n,) for n in range(10)]
    # a batch that ended halfway: its folder has no success mark
    batches[2].limit(2).write.parquet(f"{out}/batch_id=2")
    Path(f"{out}/batch_id=2/_SUCCESS").unlink()
    append_batch(batches[2], out, 2)
    assert rows(spark.read.parquet(out), "id") == [(n,) for n in range(15)]


def test_topic_view_in_sql(spark, views, replay, table_of, tmp_path):
    raw = views.page_log.orderBy("ts").select(F.to_json(F.struct("page", "ts")).alias("value"))
    source = replay("sql")
    source.add(raw)
    topic_view(
        source.stream("value string"), "page map<string,string>, ts bigint", "page_view",
        "timestamp_seconds(ts div 1000)", "2 seconds",
    )
    found = spark.sql(
        "SELECT page['item'] AS fullword, rowtime FROM page_view WHERE page['page_id'] = 'good_list' AND page['item'] IS NOT NULL"
    )
    assert table_of(found, tmp_path / "ck").count() == logs.search_fullwords(views.page_log).count() > 0


def test_unique_visits_of_one_millisecond_are_the_same_in_both_forms(spark, views, replay, table_of, tmp_path):
    """Without a tie column the content decides."""
    pages = logs.page_log(views.page_log).withColumn("ts", F.col("ts") - F.col("ts") % 86_400_000)
    source = replay("ties")
    source.add_sorted(pages, ["ts", "event_id"], 1)
    got = table_of(stateful.unique_visits(source.stream(pages.schema)), tmp_path / "ck")
    want = visits.unique_visits(pages)
    assert rows(got, "event_id", "common.mid", "ts") == rows(want, "event_id", "common.mid", "ts")
    assert rows(want, "event_id") == rows(visits.unique_visits(pages.repartition(7)), "event_id")
    one = visits.bounces(pages, 600_000)
    assert rows(one, "event_id") == rows(visits.bounces(pages.repartition(7), 600_000), "event_id")


def test_records_become_rows_or_dead_letters(spark, replay, tmp_path):
    sent = [
        ('{"id":1,"create_time":"2024-01-01 00:00:01","total_amount":"3.00"}', None),
        ("not json", "record"),
        (None, "record"),
        ('{"create_time":"2024-01-01 00:00:01"}', "key"),
        ('{"id":2,"create_time":"yesterday"}', "time"),
        ('{"id":3}', "time"),
    ]
    records = spark.createDataFrame([(v,) for v, _ in sent], "value string")
    source, dead = replay("orders"), str(tmp_path / "dead")
    source.add(records)
    stream = source.stream("value string")
    jobs.dead_letters(stream, feeds.ORDERS, dead, str(tmp_path / "ck"), NOW).awaitTermination()
    assert rows(feed_rows(records, feeds.ORDERS), "id") == [(1,)]
    found = {(r.value, r.reason) for r in spark.read.parquet(dead).collect()}
    assert found == {(v, reason) for v, reason in sent if reason}


def test_product_rows_from_records(spark, views):
    as_json = lambda df: df.select(F.to_json(F.struct("*")).alias("value"))
    pages = logs.page_log(views.page_log)
    dims = {
        "user": views.dim_user, "province": views.dim_province, "sku": views.dim_sku, "spu": views.dim_spu,
        "category3": views.dim_category3, "trademark": views.dim_trademark,
    }
    pairs = wide.order_wide(wide.order_pairs(views.order_info, views.order_detail, timedelta(days=180)), **dims)
    paid = wide.payment_wide(views.payment_info, pairs, timedelta(days=180))
    topics = [df.drop("create_ts") for df in (views.favor, views.cart, views.refund, views.comment)]
    got = jobs.product_rows(pages, pairs, paid, *map(as_json, topics))
    want = measures.product_measures(pages, pairs, paid, *topics)
    assert got.columns == want.columns and got.exceptAll(want).count() == want.exceptAll(got).count() == 0
