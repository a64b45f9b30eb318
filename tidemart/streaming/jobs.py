"""The warehouse's streaming jobs: operators between record streams and Parquet datasets.

Each job takes streaming frames and returns a started query. ``sources.feed_rows`` makes such frames from a topic's
records; :func:`dead_letters` beside it keeps the records it leaves out. Jobs hand over through datasets, as topics would, so each
can restart alone. Frames a job reads beside its streams (dimensions, routing) come from functions called in every
micro-batch, so new versions are seen.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemart.functions import processing_time_millis
from tidemart.operators import cdc, keywords, logs, measures, stats, visits, wide
from tidemart.schemas import (
    KEYWORD_STATS_COLUMNS,
    PAYMENT_WIDE_COLUMNS,
    PRODUCT_STATS_COLUMNS,
    PROVINCE_STATS_COLUMNS,
    VISITOR_STATS_COLUMNS,
)
from tidemart.sources import Feed, feed_letters, feed_rows, feeds, parse_cdc
from tidemart.streaming import stateful
from tidemart.streaming.dim_log import DimLog
from tidemart.streaming.sinks import append_batch, append_metrics, start_batches, topic_records

Reader = Callable[[], DataFrame]


def _stamped(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """The metric columns in their fixed order, ``ts`` being the clock's where the rows bring none."""
    return (df if "ts" in df.columns else df.withColumn("ts", processing_time_millis())).select(*columns)


def dead_letters(
    records: DataFrame, feed: Feed, out: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Keep the records of a topic that ``sources.feed_rows`` leaves out, with the reason.

    A query of its own, so that jobs with state need no second output; one serves all jobs that read the topic.
    """
    letters = feed_letters(records, feed)
    return start_batches(letters, lambda b, i: append_batch(b, out, i), checkpoint, None, trigger)


def base_log(log: DataFrame, out: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Repair the new flag and split into ``start``, ``page`` and ``display`` datasets below ``out``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        append_batch(logs.start_log(batch), f"{out}/start", batch_id)
        append_batch(logs.page_log(batch), f"{out}/page", batch_id)
        append_batch(logs.display_log(batch), f"{out}/display", batch_id)
        batch.unpersist()

    return start_batches(stateful.repair_new_visitors(log), write, checkpoint, "base_log", trigger)


def base_db(
    records: DataFrame,
    routing: Reader,
    facts: str,
    dims: str,
    checkpoint: str,
    order: str = "seq",
    trigger: dict | None = None,
    dead: str | None = None,
) -> StreamingQuery:
    """Route change records (``value`` and an increasing ``order`` column).

    ``routing`` reads the configuration at the start of each micro-batch: its newest state, which holds for the whole
    batch, or a log with ``valid_from`` (as ``cdc.route_as_of``), of which each record meets the version of its own
    ``order``. Only the log makes a replay route alike; new versions must begin after the records already read.

    Facts go to ``facts`` as JSON text partitioned by ``sink_table``; each dimension's changes go to its ``DimLog`` below
    ``dims``, which ``DimLog.compact`` shortens from time to time. Records that can't be read and dimension changes without a key go to ``dead`` (default: ``facts`` with
    ``-dead`` added) with a reason.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        conf, changes = routing(), parse_cdc(batch, keep=(order,))
        if "valid_from" in conf.columns:
            conf = conf.persist()
            routed = cdc.route_as_of(changes, conf, order).persist()
            conf = conf.filter(~F.coalesce("deleted", F.lit(False)))
        else:
            conf = cdc.one_route_per_key(conf).persist()
            routed = cdc.route(changes, conf).persist()
        changed = cdc.fact_changes(routed).select("sink_table", F.to_json("data").alias("value"))
        append_batch(changed, facts, batch_id, ("sink_table",))
        letters = cdc.dead_letters(batch, keep=(order,)).drop(order)
        dimensions = cdc.dimension_changes(routed)
        # a few configuration rows; a dimension may have a route per operation, each with its own columns
        wanted: dict[str, tuple[str, list[str]]] = {}
        routes = conf.filter(F.lower("sink_type") == cdc.SINK_DIMENSION).orderBy("sink_table", "operate_type")
        for r in routes.select("sink_table", "sink_columns", "sink_pk").collect():
            pk, names = wanted.setdefault(r.sink_table.upper(), (r.sink_pk or "id", []))
            names += [c for c in r.sink_columns.split(",") if c not in names]
        for sink_table, (pk, names) in wanted.items():
            dim = DimLog(f"{dims}/{sink_table}", pk, tuple(names))
            changes = dimensions.filter(F.col("sink_table") == sink_table).select(
                "data", F.col(order).alias("_seq"), F.col("type").alias("_type")
            )
            dim.append(changes, batch_id)
            keyless = dim.without_key(changes).select(F.to_json("data").alias("value"), F.lit("key").alias("reason"))
            letters = letters.unionByName(keyless)
        append_batch(letters, dead or f"{facts}-dead", batch_id)
        routed.unpersist()
        conf.unpersist()

    return start_batches(records, write, checkpoint, "base_db", trigger)


def unique_visit(
    pages: DataFrame, out: str, checkpoint: str, tie: tuple[str, ...] = (), trigger: dict | None = None
) -> StreamingQuery:
    visits_ = stateful.unique_visits(pages, tie=tie)
    return start_batches(visits_, lambda b, i: append_batch(b, out, i), checkpoint, "unique_visit", trigger)


def bounce(
    pages: DataFrame,
    out: str,
    checkpoint: str,
    timeout_ms: int = visits.BOUNCE_TIMEOUT_MS,
    tie: tuple[str, ...] = (),
    delay: str = "0 seconds",
    trigger: dict | None = None,
) -> StreamingQuery:
    found = stateful.bounces(pages, timeout_ms, tie, delay)
    return start_batches(found, lambda b, i: append_batch(b, out, i), checkpoint, "bounce", trigger)


def order_wide(
    orders: DataFrame,
    details: DataFrame,
    dims: Callable[[], dict[str, DataFrame]],
    out: str,
    checkpoint: str,
    bound: timedelta = wide.ORDER_BOUND,
    delay: str = "0 seconds",
    as_of=None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """``dims()`` names the dimensions ``user, province, sku, spu, category3, trademark``."""
    left = wide.with_event_time(orders, "create_time", "create_ts").withWatermark("create_ts", delay)
    right = wide.with_event_time(details, "create_time", "create_ts").withWatermark("create_ts", delay)

    def write(batch: DataFrame, batch_id: int) -> None:
        append_batch(wide.order_wide(batch, **dims(), as_of=as_of), out, batch_id)

    return start_batches(wide.order_pairs(left, right, bound), write, checkpoint, "order_wide", trigger)


def payment_wide(
    payments: DataFrame,
    orders: DataFrame,
    out: str,
    checkpoint: str,
    bound: timedelta = wide.PAYMENT_BOUND,
    delay: str = "3 seconds",
    trigger: dict | None = None,
) -> StreamingQuery:
    left = wide.with_event_time(payments, "callback_time", "callback_ts").withWatermark("callback_ts", delay)
    right = wide.with_event_time(orders, "create_time", "create_ts").withWatermark("create_ts", delay)
    joined = wide.payment_wide(left, right, bound).select(*PAYMENT_WIDE_COLUMNS)
    return start_batches(joined, lambda b, i: append_batch(b, out, i), checkpoint, "payment_wide", trigger)


def visitor_stats(
    pages: DataFrame,
    unique: DataFrame,
    bounced: DataFrame,
    out: str,
    checkpoint: str,
    size: str = stats.WINDOW,
    delay: str | None = None,
    bounce_timeout_ms: int = visits.BOUNCE_TIMEOUT_MS,
    trigger: dict | None = None,
) -> StreamingQuery:
    """A bounce is known up to two timeouts after its page, so the watermark waits that long and a second more."""
    delay = delay or f"{2 * bounce_timeout_ms + 1000} milliseconds"
    rows = measures.visitor_measures(pages, unique, bounced).withWatermark("event_time", delay)

    def write(batch: DataFrame, batch_id: int) -> None:
        append_metrics(_stamped(batch, VISITOR_STATS_COLUMNS), out, batch_id)

    return start_batches(stats.visitor_stats(rows, size), write, checkpoint, "visitor_stats", trigger)


def product_rows(
    pages: DataFrame,
    orders: DataFrame,
    payments: DataFrame,
    favors: DataFrame,
    carts: DataFrame,
    refunds: DataFrame,
    comments: DataFrame,
) -> DataFrame:
    """The rows of :func:`product_stats`: page, wide order and wide payment datasets, and four topics' records."""
    return measures.product_measures(
        pages,
        orders,
        payments,
        feed_rows(favors, feeds.FAVORS),
        feed_rows(carts, feeds.CARTS),
        feed_rows(refunds, feeds.REFUNDS),
        feed_rows(comments, feeds.COMMENTS),
    )


def product_stats(
    rows: DataFrame,
    dims: Callable[[], dict[str, DataFrame]],
    out: str,
    topic_out: str,
    checkpoint: str,
    size: str = stats.WINDOW,
    delay: str = "0 seconds",
    trigger: dict | None = None,
) -> StreamingQuery:
    """``rows`` come from :func:`product_rows`; writes metric rows and the same rows as JSON records."""

    def write(batch: DataFrame, batch_id: int) -> None:
        names = {k: v for k, v in dims().items() if k in ("sku", "spu", "category3", "trademark")}
        named = _stamped(stats.enrich_product_stats(batch, **names), PRODUCT_STATS_COLUMNS).persist()
        append_metrics(named, out, batch_id)
        append_batch(topic_records(named), topic_out, batch_id)
        named.unpersist()

    sums = stats.product_sums(rows.withWatermark("event_time", delay), size)
    return start_batches(sums, write, checkpoint, "product_stats", trigger)


def province_stats(
    orders: DataFrame,
    out: str,
    checkpoint: str,
    size: str = stats.WINDOW,
    delay: str = "0 seconds",
    trigger: dict | None = None,
) -> StreamingQuery:
    timed = wide.with_event_time(orders, "create_time", "create_ts").withWatermark("create_ts", delay)

    def write(batch: DataFrame, batch_id: int) -> None:
        append_metrics(_stamped(batch, PROVINCE_STATS_COLUMNS), out, batch_id)

    return start_batches(stats.province_stats(timed, size), write, checkpoint, "province_stats", trigger)


def keyword_stats_search(
    pages: DataFrame,
    out: str,
    checkpoint: str,
    size: str = stats.WINDOW,
    delay: str = "2 seconds",
    trigger: dict | None = None,
) -> StreamingQuery:
    found = keywords.tokenize(logs.search_fullwords(pages).withWatermark("rowtime", delay), "fullword")

    def write(batch: DataFrame, batch_id: int) -> None:
        append_metrics(_stamped(batch, KEYWORD_STATS_COLUMNS), out, batch_id)

    return start_batches(stats.keyword_stats_search(found, size), write, checkpoint, "keyword_stats_search", trigger)


def keyword_stats_product(
    product_rows: DataFrame,
    out: str,
    checkpoint: str,
    dictionary: Reader | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """``product_rows`` needs ``spu_name``, the three counters and the window texts."""

    def write(batch: DataFrame, batch_id: int) -> None:
        found = keywords.product_keywords(batch, dictionary() if dictionary else None)
        append_metrics(_stamped(found, KEYWORD_STATS_COLUMNS), out, batch_id)

    return start_batches(product_rows, write, checkpoint, "keyword_stats_product", trigger)
