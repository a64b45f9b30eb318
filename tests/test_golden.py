"""Small literal cases with known answers."""

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemart.functions import age_years, millis_of_text
from tidemart.operators import cdc, dims, keywords, logs, measures, serving, stats, visits, wide
from tidemart.schemas import PAGE_LOG_DDL, TABLE_PROCESS_LOG_DDL, VISITOR_STATS_COLUMNS
from tidemart.plans import Backfill
from tidemart.plans.views import ROUTES
from tidemart.session import shared_dir
from tidemart.sources import parse_cdc, parse_records, read_routing
from tidemart.streaming import DimLog
from tidemart.streaming.sinks import append_metrics, topic_records

DAY = 86_400_000


def page_log(spark, rows):
    """``mid, page_id, last_page_id, ts`` and optionally ``is_new`` to page log rows, numbered by ``event_id``."""
    data = []
    for number, (mid, page_id, last, ts, *new) in enumerate(rows):
        common = (mid, "v", "c", "a", new[0] if new else "0")
        data.append((number, common, (page_id, last, None, 100), None, None, ts))
    return spark.createDataFrame(data, f"event_id bigint, {PAGE_LOG_DDL}")


def ids(df):
    return sorted(r[0] for r in df.select("event_id").collect())


def test_bounce_example(spark):
    log = page_log(
        spark,
        [
            ("101", "home", None, 10_000),
            ("102", "home", None, 12_000),
            ("102", "good_list", "home", 15_000),
            ("102", "good_list", "detail", 30_000),
        ],
    )
    assert ids(visits.bounces(log)) == [0]


@pytest.mark.parametrize("offset", [0, 3_333, 9_999])
@pytest.mark.parametrize("gap, bounced", [(0, False), (9_999, False), (10_000, True), (10_001, True), (25_000, True)])
def test_bounce_boundary(spark, gap, bounced, offset):
    """The slots' position in time must not matter."""
    log = page_log(spark, [("m", "home", None, offset), ("m", None, "home", offset + gap)])
    assert ids(visits.bounces(log, tie=("event_id",))) == ([0] if bounced else [])


def test_bounces_equal_brute_force(spark):
    rng = random.Random(5)
    rows = [
        (str(rng.randrange(4)), "p", rng.choice([None, "", "home"]), rng.randrange(3_000) * 100) for _ in range(400)
    ]
    by_mid = {}
    for number, (mid, _, last, ts) in enumerate(rows):
        by_mid.setdefault(mid, []).append((ts, number, not last))
    want = []
    for pages in by_mid.values():
        pages.sort()
        for (ts, number, entry), following in zip(pages, pages[1:] + [None]):
            if entry and (following is None or following[0] - ts >= 10_000):
                want.append(number)
    assert ids(visits.bounces(page_log(spark, rows), tie=("event_id",))) == sorted(want)


def test_new_visitor_repair(spark):
    log = page_log(
        spark,
        [
            ("A", "p", None, 1, "1"),
            ("A", "p", None, 2, "1"),
            ("A", "p", None, DAY + 1, "1"),
            ("B", "p", None, 1, "0"),
            ("B", "p", None, DAY + 1, "1"),
        ],
    )
    got = {r[0]: r[1] for r in logs.repair_new_visitors(log).select("event_id", "common.is_new").collect()}
    # a '0' record sets no state: B is new on its second day
    assert got == {0: "1", 1: "1", 2: "0", 3: "0", 4: "1"}


def test_unique_visits(spark):
    log = page_log(
        spark,
        [("A", "p", None, 5), ("A", "p", "", 3), ("A", "p", "home", 1), ("A", "p", None, DAY + 1)],
    )
    assert ids(visits.unique_visits(log)) == [1, 3]


def test_log_split(spark):
    ddl = f"event_id bigint, {PAGE_LOG_DDL}"
    common, page = ("m", "v", "c", "a", "1"), ("home", None, None, 1)
    shown = [("1", "sku_id"), ("2", "activity_id")]
    log = spark.createDataFrame(
        [(0, common, page, {"entry": "icon"}, shown, 1), (1, common, page, {}, shown, 2), (2, common, page, None, None, 3)],
        ddl,
    )
    assert ids(logs.start_log(log)) == [0]
    assert ids(logs.page_log(log)) == [1, 2]
    display = logs.display_log(log)
    assert display.columns == ["item", "item_type", "page_id"]
    assert sorted(map(tuple, display.collect())) == [("1", "sku_id", "home"), ("2", "activity_id", "home")]


def test_parse_keeps_bad_records_apart(spark):
    raw = spark.createDataFrame([('{"ts": 5}',), ('{"ts": ',), ("",), (None,)], "value string")
    good, dead = parse_records(raw, PAGE_LOG_DDL)
    assert [r["ts"] for r in good.collect()] == [5]
    assert sorted(str(r["value"]) for r in dead.collect()) == ["", "None", '{"ts": ']


def cdc_rows(spark, rows):
    return parse_cdc(spark.createDataFrame([(r,) for r in rows], "value string"))


ROUTING = "source_table string, operate_type string, sink_type string, sink_table string, sink_columns string, sink_pk string, sink_extend string"


def test_cdc_validity_and_pruning(spark):
    changes = cdc_rows(
        spark,
        [
            '{"table":"t","type":"insert","data":{}}',
            '{"table":"t","type":"insert"}',
            '{"type":"insert","data":{"id":"1"}}',
            '{"table":"t","type":"bootstrap-insert","data":{"id":"1","a":"x","b":null}}',
            '{"table":"t","type":"delete","data":{"id":"2"}}',
            '{"table":"u","type":"update","data":{"id":"3","a":"y"}}',
        ],
    )
    assert cdc.valid_changes(changes).count() == 3
    conf = spark.createDataFrame(
        [
            ("t", "insert", "HBase", "dim_t", "id,b", None, None),
            ("u", "update", "kafka", "dwd_u", "", None, None),
            ("u", "insert", "kafka", "dwd_u", "", None, None),
        ],
        ROUTING,
    )
    routed = cdc.route(changes, conf)
    assert [(r["sink_table"], r["data"], r["sink_pk"]) for r in cdc.dimension_changes(routed).collect()] == [
        ("DIM_T", {"id": "1", "b": None}, "id")
    ]
    assert [tuple(r) for r in cdc.fact_records(routed).collect()] == [("dwd_u", '{"id":"3","a":"y"}')]


def test_routes_hold_from_their_place_on(spark):
    changes = spark.createDataFrame(
        [(name, "insert", '{"id":"1","a":"x"}', place) for name in ("t", "gone") for place in (None, 1, 5, 9, 10)],
        "table string, type string, data string, place bigint",
    )
    log = spark.createDataFrame(
        [
            ("t", "insert", "kafka", "first", "id", None, None, None, None),
            ("t", "insert", "kafka", "second", "id,a", "k", None, 5, False),
            ("t", "insert", "kafka", "also second", "id,a", "k", None, 5, False),
            ("t", "insert", None, None, None, None, None, 9, True),
            ("t", "insert", "HBASE", "third", None, None, None, 10, None),
            ("t", "update", "kafka", "other", "", None, None, 1, None),
            ("gone", "insert", "kafka", "g", "", None, None, 5, False),
            ("gone", "insert", "kafka", "g", "", None, None, 9, True),
        ],
        TABLE_PROCESS_LOG_DDL,
    )
    routed = cdc.route_as_of(changes, log, "place").select("table", "place", "sink_type", "sink_table", "sink_pk", "data")
    both, pruned = {"id": "1", "a": "x"}, {"id": "1"}
    assert sorted((tuple(r) for r in routed.collect()), key=str) == [
        ("gone", 5, "kafka", "g", "id", both),
        ("t", 1, "kafka", "first", "id", pruned),
        ("t", 10, "hbase", "third", "id", both),
        ("t", 5, "kafka", "second", "k", both),
        ("t", None, "kafka", "first", "id", pruned),
    ]
    assert cdc.route_as_of(changes, log.limit(0), "place").count() == 0


def test_sparse_order_bits_count_alike_in_eight_bytes(spark):
    rng = random.Random(9)
    ids_ = [*range(-70, 140), 2**40, -(2**63), 2**63 - 1]
    kinds = [measures.ORDER, measures.PAID, measures.REFUND, None]
    rows = [(rng.choice([1, 2]), rng.choice(kinds), rng.choice([*ids_, None]), datetime(2024, 1, d, h)) for d in (1, 2) for h in range(24) for _ in range(20)]
    frame = spark.createDataFrame(rows, "sku_id bigint, order_kind string, kind_order_id bigint, event_time timestamp")
    bits = stats.order_bits(frame, "1 hour", sparse=True)
    assert dict(bits.dtypes)["bits"] == "bigint"
    for keys in (["sku_id"], []):
        got = serving.distinct_orders(bits, *keys)
        want = {}
        for sku, kind, number, _ in rows:
            if kind and number is not None:
                want.setdefault((sku,) if keys else (), {}).setdefault(kind, set()).add(number)
        counted = {tuple(r[k] for k in keys): (r["order_ct"], r["paid_order_ct"], r["refund_order_ct"]) for r in got.collect()}
        assert counted == {k: tuple(len(v.get(n, ())) for n in kinds[:3]) for k, v in want.items()}
    assert got.schema == serving.distinct_orders(stats.order_bits(frame, "1 hour")).schema


def test_distinct_orders_add_up_over_windows(spark):
    rng = random.Random(5)
    ids_ = [*range(-3, 40), 32_767, 32_768, 32_769, 2**40]
    rows = [
        (rng.choice([1, 2, 3]), rng.choice(["order", "paid", "refund", None]), rng.choice([*ids_, None]), day, hour)
        for day in (1, 2) for hour in range(24) for _ in range(20)
    ]
    frame = spark.createDataFrame(
        [(s, k, i, datetime(2024, 1, d, h, 30)) for s, k, i, d, h in rows],
        "sku_id bigint, order_kind string, kind_order_id bigint, event_time timestamp",
    ).replace({"order": measures.ORDER, "paid": measures.PAID, "refund": measures.REFUND}, subset=["order_kind"])
    bits = stats.order_bits(frame, "1 hour")
    got = serving.distinct_orders(bits, F.substring("stt", 1, 10).alias("day"), "sku_id")
    want = {}
    for sku, kind, number, day, _ in rows:
        if kind and number is not None:
            want.setdefault((f"2024-01-0{day}", sku), {}).setdefault(kind, set()).add(number)
    counted = {(r["day"], r["sku_id"]): (r["order_ct"], r["paid_order_ct"], r["refund_order_ct"]) for r in got.collect()}
    assert counted == {k: tuple(len(v.get(n, ())) for n in ("order", "paid", "refund")) for k, v in want.items()}
    # over everything, and over nothing
    total = serving.distinct_orders(bits).first()["order_ct"]
    assert total == len({n for _, kind, n, _, _ in rows if kind == "order" and n is not None})
    assert serving.distinct_orders(bits.limit(0), "sku_id").count() == 0


def test_dim_join_keeps_unmatched_rows_and_never_multiplies(spark):
    rows = spark.createDataFrame([(1, "own"), (2, "own"), (None, "own")], "k bigint, name string")
    dim = spark.createDataFrame([(1, "b", 2), (1, None, 1), (3, "c", 1)], "id bigint, name string, rank int")
    spec = dims.DimSpec({"id": "k"}, {"name": "name", "rank": "rank"}, prefer=("rank",))
    got = {r["k"]: (r["name"], r["rank"]) for r in dims.dim_join(rows, dim, spec).collect()}
    # a match overwrites even with null, a miss keeps the row's own value
    assert got == {1: (None, 1), 2: ("own", None), None: ("own", None)}


@pytest.mark.parametrize("step", [1, 7, 1000])
def test_versions_valid_at_a_moment_equal_brute_force(spark, step):
    """Numbers as moments, before zero too; ties, ends, versions from the beginning, null keys and moments."""
    rng = random.Random(step)
    moments = [None, *range(-30, 31)]
    log = [(rng.choice("abc"), rng.choice(moments), rng.choice("pqr"), rng.choice([True, False, None])) for _ in range(60)]
    log += [(None, 1, "p", False), ("d", 5, None, False)]
    facts = [(n, rng.choice([None, *"abcdz"]), rng.choice(moments), "own") for n in range(400)]
    dim = spark.createDataFrame(log, "id string, valid_from bigint, name string, deleted boolean")
    rows = spark.createDataFrame(facts, "n int, k string, at bigint, name string")
    spec = dims.DimSpec({"id": "k"}, {"name": "name"})
    got = {r["n"]: r["name"] for r in dims.dim_join_as_of(rows, dim, spec, "at", step=step).collect()}

    def held(k, at):
        by_then = [
            (-99 if begin is None else begin, name or "", bool(gone), name)
            for key, begin, name, gone in log
            if key == k and (begin is None or (at is not None and begin <= at))
        ]
        return max(by_then, default=None)

    want = {}
    for n, k, at, own in facts:
        version = held(k, at) if k is not None and at is not None else None
        want[n] = own if version is None or version[2] else version[3]
    assert got == want and len(got) == 400
    none = dims.dim_join_as_of(rows, dim.limit(0), spec, "at", step=step)
    assert none.filter("name = 'own'").count() == 400
    # a dimension without times holds always, one row for each key
    plain = dims.dim_join_as_of(rows, dim.drop("valid_from", "deleted"), spec, "at", step=step)
    best = {k: max((r[2] or "" for r in log if r[0] == k)) or None for k in "abcd"}
    assert {r["n"]: r["name"] for r in plain.collect()} == {n: best.get(k, own) if at is not None else own for n, k, at, own in facts}


def test_interval_join_equals_brute_force(spark):
    rng = random.Random(3)
    start = datetime(2024, 1, 1)
    moments = lambda n: [(rng.randrange(3), start + timedelta(seconds=rng.randrange(600))) for _ in range(n)]
    left, right = moments(150), moments(200)
    lower, upper = timedelta(seconds=-30), timedelta(seconds=10)
    want = sorted(
        (i, j)
        for i, (a, s) in enumerate(left)
        for j, (b, t) in enumerate(right)
        if a == b and s + lower <= t <= s + upper
    )
    frame = lambda rows, p: spark.createDataFrame(
        [(n, k, t) for n, (k, t) in enumerate(rows)], f"{p}_n int, {p}_k int, {p}_t timestamp"
    )
    for spans in (1, 3, 8):
        joined = wide.interval_join(
            frame(left, "l"), frame(right, "r"), {"l_k": "r_k"}, "l_t", "r_t", lower, upper, slot_spans=spans
        )
        assert sorted((r["l_n"], r["r_n"]) for r in joined.collect()) == want


def orders_at(spark, order_time, detail_time):
    orders = spark.createDataFrame([(1, order_time)], "id bigint, create_time string")
    details = spark.createDataFrame([(1, detail_time)], "order_id bigint, create_time string")
    none = lambda names, kind: {n: F.lit(None).cast(kind) for n in names}
    orders = orders.withColumns(none([s for s in wide.FROM_ORDER.values() if s not in orders.columns], "string"))
    return orders, details.withColumns(none([s for s in wide.FROM_DETAIL.values() if s not in details.columns], "string"))


@pytest.mark.parametrize(
    "detail_time, by_second, by_day",
    [
        ("2021-05-01 10:00:05", 1, 1),
        ("2021-05-01 10:00:06", 0, 1),
        ("2021-05-01 23:59:59", 0, 1),
        ("2021-05-02 00:00:00", 0, 0),
    ],
)
def test_order_granularity(spark, detail_time, by_second, by_day):
    orders, details = orders_at(spark, "2021-05-01 10:00:00", detail_time)
    assert wide.order_pairs(orders, details).count() == by_second
    assert wide.order_pairs(orders, details, granularity="day").count() == by_day


def test_single_order_window_counts_one(spark):
    """One record in a window is one order."""
    rows = spark.createDataFrame(
        [(7, 1, 2, Decimal("9.90"), "2021-05-01 10:00:00")],
        "sku_id bigint, order_id bigint, sku_num bigint, split_total_amount decimal(18,2), create_time string",
    )
    got = stats.product_sums(measures.unified(measures.order_product_measures(rows))).collect()
    assert [(r["stt"], r["order_ct"], r["order_sku_num"], r["order_amount"]) for r in got] == [
        ("2021-05-01 10:00:00", 1, 2, Decimal("9.90"))
    ]


def visitors(spark, rows):
    ddl = "stt string, edt string, vc string, ch string, ar string, is_new string, uv_ct bigint, pv_ct bigint, sv_ct bigint, uj_ct bigint, dur_sum bigint, ts bigint"
    data = [(stt, stt, "v", "c", "a", new, *counts, 0) for stt, new, counts in rows]
    return spark.createDataFrame(data, ddl)


def test_kpis(spark):
    rows = visitors(
        spark,
        [
            ("2024-01-01 03:00:00", "1", (3, 20, 16, 5, 12_345)),
            ("2024-01-01 03:00:00", "0", (0, 9, 4, 1, 500)),
            ("2024-01-02 03:00:00", "0", (2, 9, 0, 1, 500)),
        ],
    )
    got = [(r["uj_rate"], r["dur_per_sv"], r["pv_per_sv"]) for r in serving.with_kpis(rows).collect()]
    assert got == [(Decimal("31.25"), Decimal("0.8"), Decimal("1.25")), (0, 0, 0), (0, 0, 0)]


def test_hours_and_new_old_table(spark):
    rows = visitors(
        spark,
        [("2024-01-01 03:00:00", "1", (3, 20, 16, 5, 12_345)), ("2024-01-01 17:10:00", "1", (1, 1, 1, 1, 0))],
    )
    dense = [tuple(r) for r in serving.visitor_hour_dense(rows, 20240101).orderBy("hr").collect()]
    assert [r[0] for r in dense] == [f"{h:02d}" for h in range(24)]
    assert dense[3] == ("03", 3, 20, 3) and dense[17] == ("17", 1, 1, 1) and dense[4] == ("04", 0, 0, 0)
    new_old = {r["type"]: (r["new"], r["old"]) for r in serving.visitor_new_old_table(rows, "20240101").collect()}
    assert list(new_old.values())[0] == (4, 0) and len(new_old) == 5
    assert serving.visitor_by_hour(rows, 20240102).count() == 0


def test_gmv_of_an_empty_day(spark):
    rows = spark.createDataFrame([("2024-01-01 00:00:00", Decimal("5.00"))], "stt string, order_amount decimal(18,2)")
    assert serving.gmv(rows, 20240101).first()[0] == 5
    assert serving.gmv(rows, 20240102).first()[0] == 0
    today = spark.range(1).select(serving.iso_day(0), serving.iso_day(None), F.current_date().cast("string")).first()
    assert len(set(today)) == 1
    for bad in ("2024011", "20241301", "yesterday"):
        with pytest.raises(ValueError):
            serving.iso_day(bad)


def test_keyword_score_order(spark):
    rows = spark.createDataFrame(
        [("a", 3, "CLICK"), ("b", 1, "SEARCH"), ("c", 2, "OTHER")], "keyword string, ct bigint, source string"
    ).withColumn("stt", F.lit("2024-01-01 00:00:00"))
    assert [tuple(r) for r in serving.keyword_score(rows, 20240101).collect()] == [("a", 3), ("c", 0), ("b", 10)]
    assert [r[0] for r in serving.keyword_score(rows, 20240101, 1, order_by="score").collect()] == ["b"]


def test_series_arrays(spark):
    rows = spark.createDataFrame([("x", Decimal("1.00")), ("y", Decimal("3.00"))], "n string, v decimal(28,2)")
    got = serving.series(rows, "n", "v").first()
    assert got["categories"] == ["y", "x"] and got["data"] == [Decimal("3.00"), Decimal("1.00")]


def test_keyword_sources(spark):
    rows = spark.createDataFrame([("s", 2, 0, 1)], "spu_name string, click_ct bigint, cart_ct bigint, order_ct bigint")
    got = keywords.keyword_sources(rows).select("ct", "source").collect()
    assert sorted(map(tuple, got)) == [(1, "ORDER"), (2, "CLICK")]


TITLE = "Apple iPhoneXSMax (A2104) 256GB  深空灰色  移动联通电信 4G  手机  双卡双待"


def test_tokens_of_a_title(spark):
    rows = spark.createDataFrame([(TITLE,)], "text string")
    plain = [r[0] for r in keywords.tokenize(rows, "text").select("keyword").collect()]
    assert plain == ["apple", "iphonexsmax", "a2104", "256gb", "深空灰色", "移动联通电信", "4g", "手机", "双卡双待"]
    dictionary = spark.createDataFrame([(w,) for w in ("深空", "灰色", "移动", "联通", "电信", "手机", "双卡")], "word string")
    cut = [r[0] for r in keywords.tokenize(rows, "text", dictionary=dictionary).select("keyword").collect()]
    assert sorted(cut) == sorted(
        ["apple", "iphonexsmax", "a2104", "256gb", "深空", "灰色", "移动", "联通", "电信", "4g", "手机", "双卡", "双", "待"]
    )
    assert "apple" not in {r[0] for r in keywords.tokenize(rows, "text", stop_words=("apple",)).select("keyword").collect()}


def longest_match(run, known):
    longest, out, at = max(map(len, known)), [], 0
    while at < len(run):
        size = next((s for s in range(min(longest, len(run) - at), 1, -1) if run[at : at + s] in known), 1)
        out.append(run[at : at + size])
        at += size
    return out


def test_longest_match_equals_brute_force(spark):
    rng = random.Random(11)
    letters = "天地玄黄宇宙𠀀"
    text = lambda low, high: "".join(rng.choice(letters) for _ in range(rng.randint(low, high)))
    known = {text(2, 9) for _ in range(60)}
    # short, repeated and long runs; the long ones are longer than the stretches they are looked at in
    runs = [text(1, 40) for _ in range(80)] * 2 + [text(250, 270) for _ in range(10)] + [text(1_000, 1_500)] * 2
    rows = spark.createDataFrame([(n, f"{r}x{r}") for n, r in enumerate(runs)], "n int, text string")
    dictionary = spark.createDataFrame([(w,) for w in known], "word string")
    got = {}
    for n, word in keywords.tokenize(rows, "text", dictionary=dictionary).select("n", "keyword").collect():
        got.setdefault(n, []).append(word)
    want = {n: longest_match(r, known) * 2 + ["x"] for n, r in enumerate(runs)}
    assert {n: sorted(w) for n, w in got.items()} == {n: sorted(w) for n, w in want.items()}


def covers(run, known):
    """All ways to choose words of ``known`` in ``run`` that don't overlap, as (place, size) lists."""
    if not run:
        return [[]]
    later = lambda n: [[(at + n, s) for at, s in rest] for rest in covers(run[n:], known)]
    sizes = [n for n in range(2, len(run) + 1) if run[:n] in known]
    return later(1) + [[(0, n), *rest] for n in sizes for rest in later(n)]


def worth(cover):
    sizes = [s for _, s in cover]
    late = sum(n * s for n, s in enumerate(sizes, 1))
    # of covers alike in all else, the longer last piece, then the last but one, and so on
    last = [(at + s, s) for at, s in reversed(cover)]
    return (sum(sizes), -len(sizes), -sum(s * s for s in sizes), late), last


def pieces_of(run, cover):
    ends, out, at = dict(cover), [], 0
    while at < len(run):
        out.append(run[at : at + ends.get(at, 1)])
        at += ends.get(at, 1)
    return out


def test_smart_cut_resolves_overlaps(spark):
    """研究生命起源: the longest word first leaves characters over, the best cover doesn't."""
    dictionary = spark.createDataFrame([(w,) for w in ("研究", "研究生", "生命", "命", "起源", "中华", "华人", "人民")], "word string")
    runs = spark.createDataFrame([("研究生命起源",), ("中华人民",), ("研究生",), ("无",)], "run string")
    got = {r.run: r.pieces for r in keywords.cut_runs(runs, dictionary, smart=True).collect()}
    assert got == {
        "研究生命起源": ["研究", "生命", "起源"], "中华人民": ["中华", "人民"], "研究生": ["研究生"], "无": ["无"],
    }
    plain = {r.run: r.pieces for r in keywords.cut_runs(runs, dictionary).collect()}
    assert plain["研究生命起源"] == ["研究生", "命", "起源"]


def test_smart_cut_equals_brute_force(spark):
    rng = random.Random(7)
    text = lambda low, high: "".join(rng.choice("天地玄黄𠀀") for _ in range(rng.randint(low, high)))
    known = {text(2, 5) for _ in range(40)}
    runs = sorted({text(1, 12) for _ in range(120)})
    dictionary = spark.createDataFrame([(w,) for w in known], "word string")
    rows = spark.createDataFrame([(r,) for r in runs], "run string")
    got = {r.run: r.pieces for r in keywords.cut_runs(rows, dictionary, smart=True).collect()}
    for run in runs:
        every = covers(run, known)
        best = max(worth(c)[0] for c in every)
        allowed = [pieces_of(run, c) for c in every if worth(c)[0] == best]
        assert got[run] in allowed, run


def test_smart_cut_of_a_long_chain_is_linear(spark):
    import time

    words = ["天地", "地玄", "玄天", "天地玄", "地玄天地"]
    dictionary = spark.createDataFrame([(w,) for w in words], "word string")
    run = "天地玄" * 33_334
    start = time.perf_counter()
    (row,) = keywords.cut_runs(spark.createDataFrame([(run,)], "run string"), dictionary, smart=True).collect()
    assert "".join(row.pieces) == run and time.perf_counter() - start < 60
    # every character is covered, by as few words as that takes
    assert all(len(p) > 1 for p in row.pieces) and len(row.pieces) <= 33_334


def test_payment_overwrites_the_wide_row(spark, views):
    pairs = wide.order_pairs(views.order_info, views.order_detail, timedelta(days=5))
    names = (views.dim_user, views.dim_province, views.dim_sku, views.dim_spu, views.dim_category3, views.dim_trademark)
    rows = wide.order_wide(pairs, *names)
    payments = views.payment_info.withColumn("total_amount", F.lit(None).cast("decimal(18,2)"))
    got = wide.payment_wide(payments, rows)
    assert got.count() > 0 and got.filter(F.col("total_amount").isNotNull()).count() == 0


def test_scalar_functions(spark):
    row = spark.sql("SELECT '2021-05-01 10:11:12' AS t, 'nonsense' AS bad, date '2000-01-01' AS born")
    got = row.select(
        millis_of_text(F.col("t")), millis_of_text(F.col("bad")), age_years(F.col("born"), F.lit("2001-01-01").cast("date"))
    ).first()
    assert tuple(got) == (1_619_863_872_000, None, 1)


CHANGES = "id string, name string, _seq bigint, _type string"


def test_dim_log_and_snapshots(spark, tmp_path):
    state = lambda d: {r["id"]: r["name"] for r in d.read(spark).collect()}
    first = spark.createDataFrame([("1", "a", 1, "insert"), ("2", "b", 2, "insert"), ("1", "a2", 3, "update")], CHANGES)
    second = spark.createDataFrame([("2", "b2", 5, "delete"), ("3", "c", 4, "insert"), ("1", "old", 2, "update")], CHANGES)
    for name, removes, want in (("all", False, {"1": "a2", "2": "b2", "3": "c"}), ("alive", True, {"1": "a2", "3": "c"})):
        dim = DimLog(str(tmp_path / name), "id", ("id", "name"), removes)
        assert state(dim) == {} and dim.compact(spark) is None
        dim.append(first, 0)
        assert state(dim) == {"1": "a2", "2": "b"}
        for _ in range(2):  # a repeated micro-batch changes nothing, before and after a snapshot
            dim.append(second, 1)
            assert state(dim) == want
            assert dim.compact(spark) == 1
            assert state(dim) == want
        dim.append(spark.createDataFrame([("2", "b3", 9, "update")], CHANGES), 2)
        assert state(dim) == {**want, "2": "b3"}


def test_snapshots_equal_the_whole_log(spark, tmp_path):
    """Random changes in micro-batches with a hot key, snapshots at random places, late changes."""
    rng = random.Random(5)
    dim = DimLog(str(tmp_path / "dim"), "id", ("id", "name", "city"), apply_deletes=True)
    every = []
    for batch in range(8):
        sent = []
        for _ in range(120):
            seq = rng.randint(0, 10_000)
            key = rng.choice(["hot", "hot", str(rng.randint(0, 30))])
            data = {"id": key} | {c: f"{c}{seq}" for c in ("name", "city") if rng.random() < 0.6}
            sent.append((data, seq, rng.choices(["update", "delete"], [20, 1])[0]))
        every += sent
        dim.append(spark.createDataFrame(sent, "data map<string,string>, _seq bigint, _type string"), batch)
        if rng.random() < 0.4:
            dim.compact(spark)
    want = {}
    for key in {d["id"] for d, *_ in every}:
        gone = max((s for d, s, k in every if d["id"] == key and k == "delete"), default=-1)
        row = {c: max(((s, d[c]) for d, s, _ in every if d["id"] == key and c in d and s > gone), default=(0, None))[1]
               for c in ("id", "name", "city")}
        if any(row.values()):
            want[key] = (row["name"], row["city"])
    assert {r.id: (r.name, r.city) for r in dim.read(spark).collect()} == want


def test_an_unfinished_batch_is_not_seen(spark, tmp_path):
    dim = DimLog(str(tmp_path / "dim"), "id", ("id", "name"))
    rows = spark.createDataFrame([("1", "a", 1, "insert"), ("2", "b", 1, "insert")], CHANGES)
    dim.append(rows, 0)
    # files of a next micro-batch and a snapshot without their marks: the writers died in between
    for folder in ("log", "snapshots"):
        half = tmp_path / "dim" / folder / "batch_id=1"
        dim.states(spark).write.parquet(str(half))
        (half / "_SUCCESS").unlink()
    assert sorted(map(tuple, dim.read(spark).collect())) == [("1", "a"), ("2", "b")]


def test_routing_sources_and_shared_folder(spark, tmp_path):
    folder = str(tmp_path / "routing")
    spark.createDataFrame(ROUTES, ROUTING).write.parquet(folder)
    assert read_routing(spark, folder).count() == len(ROUTES)
    with pytest.raises(ValueError):
        read_routing(spark)
    shared = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) == shared and Backfill(spark).out == f"{shared}/warehouse"


def test_repeated_batch_overwrites_itself(spark, tmp_path):
    out = str(tmp_path / "metrics")
    rows = spark.createDataFrame([("2024-01-01 00:00:00", 1), ("2024-01-02 00:00:00", 2)], "stt string, ct bigint")
    for batch in (0, 0, 1):
        append_metrics(rows, out, batch)
    written = spark.read.parquet(out)
    assert written.count() == 4
    assert serving.of_day(written.withColumn("edt", F.col("stt")), 20240101).count() == 2


def test_topic_records(spark):
    rows = spark.createDataFrame([(1, "a")], "id bigint, name string")
    assert tuple(topic_records(rows, "t", "id").first()) == ("t", "1", '{"id":1,"name":"a"}')


def test_fixed_column_orders(spark, views):
    rows = stats.visitor_stats(
        measures.page_view_measures(logs.page_log(views.page_log)), "1 hour"
    )
    assert tuple(rows.columns) == VISITOR_STATS_COLUMNS
