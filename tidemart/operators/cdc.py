"""Change records: validity, configuration-driven routing, column pruning, latest dimension rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.operators.sizing import own_exchange
from tidemart.schemas import CDC_DDL
from tidemart.sources.parsing import computed_once, parse_records

SINK_DIMENSION = "hbase"
SINK_FACT = "kafka"


def valid_changes(cdc: DataFrame) -> DataFrame:
    """Records with a table and a ``data`` object longer than three characters."""
    return cdc.filter(F.col("table").isNotNull() & F.col("data").isNotNull() & (F.length("data") > 3))


def dead_letters(records: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """``value, reason`` (and ``keep``) of change records that routing can't read: no JSON, or ``data`` no flat object."""
    good, bad = parse_records(records, CDC_DDL, value, keep)
    parsed = computed_once(valid_changes(good), "_map", F.from_json("data", "map<string,string>"))
    no_map = parsed.filter(F.col("_map").isNull())
    return bad.select(*keep, F.col(value).alias("value"), F.lit("record").alias("reason")).unionByName(
        no_map.select(*keep, F.col("data").alias("value"), F.lit("data").alias("reason"))
    )


def prune_columns(df: DataFrame, data: str = "data", columns: str = "sink_columns") -> DataFrame:
    """Keep the ``data`` entries named in the comma list; an empty list keeps all of them."""
    keep_all = F.coalesce(F.length(columns), F.lit(0)) == 0
    split = df.withColumn("_names", F.split(columns, ","))
    kept = F.map_filter(F.col(data), lambda name, _: F.array_contains("_names", name))
    return split.withColumn(data, F.when(keep_all, F.col(data)).otherwise(kept)).drop("_names")


def one_route_per_key(routing: DataFrame) -> DataFrame:
    """One configuration row per (table, operation)."""
    key = ["source_table", "operate_type"]
    rest = [c for c in routing.columns if c not in key]
    return routing.groupBy(*key).agg(F.max(F.struct(*rest)).alias("_conf")).select(*key, "_conf.*")


def versions(log: DataFrame, keys: list[str], at: str = "valid_from") -> DataFrame:
    """One row per key of a log of versions: ``keys`` and ``_versions``, an array of structs that begin with ``at``.

    For logs of few versions a key, such as configuration. A row without ``at`` holds from the beginning.
    """
    rest = [c for c in log.columns if c not in (*keys, at)]
    return log.groupBy(*keys).agg(F.collect_set(F.struct(at, *rest)).alias("_versions"))


def version_at(moment: Column, at: str = "valid_from", versions_: str = "_versions") -> Column:
    """The version that holds at ``moment``: the last that began by then, of several at one time the greatest."""
    begun = F.filter(versions_, lambda v: v[at].isNull() | (v[at] <= moment))
    return F.array_max(begun)


def _changes(cdc: DataFrame) -> DataFrame:
    kind = F.when(F.col("type") == "bootstrap-insert", F.lit("insert")).otherwise(F.col("type"))
    return computed_once(
        valid_changes(cdc).withColumn("type", kind), "data", F.from_json("data", "map<string,string>")
    ).filter(F.col("data").isNotNull())


def _route_columns(prefix: str = "") -> list[Column]:
    return [
        F.lower(f"{prefix}sink_type").alias("sink_type"),
        F.col(f"{prefix}sink_table").alias("sink_table"),
        F.col(f"{prefix}sink_columns").alias("sink_columns"),
        F.coalesce(f"{prefix}sink_pk", F.lit("id")).alias("sink_pk"),
    ]


def _route_key() -> list[Column]:
    return [F.col("source_table").alias("table"), F.col("operate_type").alias("type")]


def route(cdc: DataFrame, routing: DataFrame, prune: bool = True) -> DataFrame:
    """Attach sink table and sink type to valid changes; changes without a route are dropped.

    Adds ``sink_type`` (lower case), ``sink_table``, ``sink_columns``, ``sink_pk``; ``data`` becomes a map.
    """
    conf = own_exchange(one_route_per_key(routing), "source_table", "operate_type").select(*_route_key(), *_route_columns())
    routed = _changes(cdc).join(conf, ["table", "type"], "inner")
    return prune_columns(routed) if prune else routed


def route_as_of(cdc: DataFrame, routing_log: DataFrame, order: str, prune: bool = True) -> DataFrame:
    """:func:`route` with the configuration that held at each change, so that a replay routes as the first run did.

    ``routing_log`` is the configuration with two columns more: ``valid_from``, comparable with the changes' column
    ``order`` (null: from the beginning), and ``deleted``. A row holds until the next of its table and operation begins;
    a deleted one ends the route. Changes without ``order`` meet only routes from the beginning.

    The versions of a route are one row of the join, so a change is compared with its own route only and never
    multiplied, and a hot table is split or its configuration broadcast as in :func:`route`.
    """
    log = routing_log.withColumn("deleted", F.coalesce("deleted", F.lit(False)))
    every = versions(log, ["source_table", "operate_type"])
    conf = own_exchange(every, "source_table", "operate_type").select(*_route_key(), "_versions")
    changes = _changes(cdc)
    found = changes.join(conf, ["table", "type"], "inner").withColumn("_route", version_at(F.col(order)))
    kept = found.filter(~F.col("_route.deleted"))
    routed = kept.select(*[F.col(f"`{c}`") for c in changes.columns], *_route_columns("_route."))
    return prune_columns(routed) if prune else routed


def dimension_changes(routed: DataFrame) -> DataFrame:
    return routed.filter(F.col("sink_type") == SINK_DIMENSION).withColumn("sink_table", F.upper("sink_table"))


def fact_changes(routed: DataFrame) -> DataFrame:
    return routed.filter(F.col("sink_type") == SINK_FACT)


def fact_records(routed: DataFrame) -> DataFrame:
    """``topic, value`` of fact changes: the topic differs by record."""
    return fact_changes(routed).select(F.col("sink_table").alias("topic"), F.to_json("data").alias("value"))


def dimension_rows(
    changes: DataFrame, sink_table: str, sink_columns: str, extra: tuple[str, ...] = ()
) -> DataFrame:
    """Text columns of one dimension table, as its configuration row lists them."""
    columns = [F.try_element_at("data", F.lit(name)).alias(name) for name in sink_columns.split(",")]
    return changes.filter(F.col("sink_table") == sink_table.upper()).select(*columns, *extra)


def column_states(
    changes: DataFrame, pk: str, columns: tuple[str, ...], data: str = "data", order: str = "_seq", kind: str = "_type"
) -> DataFrame:
    """One row per key: for each column ``struct<seq, value>`` of the newest change that carries it, and ``_deleted``,
    the newest delete. States of two sets of changes combine by the maximum of each column (:func:`merged_states`).

    A change carries the columns its map holds; others keep what they had. Maxima combine before the shuffle, so a key
    that is changed very often stays cheap.
    """
    key = F.try_element_at(data, F.lit(pk))

    def newest(name: str) -> Column:
        state = F.struct(F.col(order).cast("bigint").alias("seq"), F.try_element_at(data, F.lit(name)).alias("value"))
        return F.max(F.when(F.map_contains_key(data, F.lit(name)), state)).alias(name)

    deleted = F.max(F.when(F.col(kind) == "delete", F.col(order).cast("bigint"))).alias("_deleted")
    keyed = changes.withColumn("_key", key).filter(F.col("_key").isNotNull())
    return keyed.groupBy("_key").agg(*[newest(c) for c in columns], deleted)


def merged_states(states: DataFrame, columns: tuple[str, ...], *more: str) -> DataFrame:
    return states.groupBy("_key", *more).agg(*[F.max(c).alias(c) for c in columns], F.max("_deleted").alias("_deleted"))


def rows_of_states(states: DataFrame, columns: tuple[str, ...], apply_deletes: bool = False) -> DataFrame:
    """The dimension rows; with ``apply_deletes`` only what came after a key's newest delete."""
    if not apply_deletes:
        return states.select(*[F.col(f"{c}.value").alias(c) for c in columns])
    gone = F.coalesce(F.col("_deleted"), F.lit(-(1 << 63)).cast("bigint"))
    alive = {c: F.coalesce(F.col(f"{c}.seq") > gone, F.lit(False)) for c in columns}
    some = F.lit(False)
    for live in alive.values():
        some = some | live
    return states.filter(some).select(*[F.when(live, F.col(f"{c}.value")).alias(c) for c, live in alive.items()])


def latest_rows(changes: DataFrame, keys: list[str], newest_first: list[Column]) -> DataFrame:
    """The newest row per key.

    ``row_number() = 1`` lets Spark cut every task's rows to one per key before the shuffle, so a key that is
    changed very often stays cheap.
    """
    ranked = changes.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*newest_first)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")
