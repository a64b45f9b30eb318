"""Dimension lookups as set-based left joins."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from tidemart.operators.sizing import own_exchange


@dataclass(frozen=True)
class DimSpec:
    """How to enrich a row from a dimension.

    ``keys`` maps dimension column -> row column, ``fields`` maps row column to write -> dimension column.
    ``unique`` says the dimension holds one row per key (a table kept by latest-row upserts does); otherwise it is
    reduced to one row per key first, the smallest by ``prefer``, so a lookup can never multiply rows.
    """

    keys: dict[str, str]
    fields: dict[str, str]
    unique: bool = False
    prefer: tuple[str, ...] = field(default=())


def one_row_per_key(dim: DataFrame, spec: DimSpec) -> DataFrame:
    sources = sorted(set(spec.fields.values()))
    prefer = spec.prefer or tuple(sources)
    row = F.min_by(F.struct(*sources), F.struct(*prefer)).alias("_row")
    keys = list(spec.keys)
    # a column may be key and field at once
    grouped = dim.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], *dict.fromkeys(sources + list(prefer))
    ).groupBy(*[f"_k_{k}" for k in keys])
    return own_exchange(grouped.agg(row), *[f"_k_{k}" for k in keys])


def dim_join(rows: DataFrame, dim: DataFrame, spec: DimSpec) -> DataFrame:
    """Left join ``dim``; rows without a match stay, and keep what they had in the target columns.

    No broadcast hint: the optimizer broadcasts a dimension whose size it knows to be small, and otherwise joins by
    shuffle, where adaptive execution splits the row side of a hot key.
    """
    if spec.unique:
        row = F.struct(*sorted(set(spec.fields.values()))).alias("_row")
        one = dim.select(*[F.col(k).alias(f"_k_{k}") for k in spec.keys], row)
    else:
        one = one_row_per_key(dim, spec)
    on = None
    for dim_col, row_col in spec.keys.items():
        same = F.col(row_col) == F.col(f"_k_{dim_col}")
        on = same if on is None else on & same
    joined = rows.join(one, on, "left")
    return joined.withColumns(_written(rows, spec)).drop("_row", *[f"_k_{k}" for k in spec.keys])


def _written(rows: DataFrame, spec: DimSpec) -> dict[str, Column]:
    """The target columns, from the dimension's ``_row`` where there is one."""
    written = {}
    for target, source in spec.fields.items():
        value = F.col(f"_row.{source}")
        if target in rows.columns:
            value = F.when(F.col("_row").isNotNull(), value).otherwise(F.col(target))
        written[target] = value
    return written


VALID_FROM = "valid_from"
STEP = timedelta(days=1)
# before every moment, and far enough from the least bigint for sums
_BEGINNING = -(1 << 62)


def _ticks(df: DataFrame, name: str) -> Column:
    """A moment as a number: microseconds of a timestamp, other numbers as they are."""
    timed = isinstance(df.schema[name].dataType, (TimestampType, TimestampNTZType))
    return F.unix_micros(F.col(name)) if timed else F.col(name).cast("bigint")


def _width(step: timedelta | int) -> Column:
    return F.lit(step // timedelta(microseconds=1) if isinstance(step, timedelta) else step).cast("bigint")


def _slot(ticks: Column, step: timedelta | int) -> Column:
    width = _width(step)
    return F.call_function("div", ticks - F.pmod(ticks, width), width)


def slots_of(rows: DataFrame, spec: DimSpec, moment: str, step: timedelta | int = STEP) -> DataFrame:
    """The keys of ``rows`` and the time slots they occur in, once each."""
    keys = [F.col(row_col).alias(f"_k_{k}") for k, row_col in spec.keys.items()]
    return rows.select(*keys, _slot(_ticks(rows, moment), step).alias("_slot")).dropna().distinct()


def versions_by_slot(
    log: DataFrame, slots: DataFrame, spec: DimSpec, at: str = VALID_FROM, step: timedelta | int = STEP
) -> DataFrame:
    """What held when: key, ``_slot``, ``_from`` and ``_to`` (exclusive) and the ``_row`` that holds between them.

    Each piece lies in the slot it begins in: a version begins a piece, and each of ``slots`` begins one that carries the
    version then in force. So a moment of one of ``slots`` finds its piece in its own slot, however old the version is.
    """
    keys = [f"_k_{k}" for k in spec.keys]
    if at not in log.columns:
        log = log.withColumn(at, F.lit(None).cast("bigint"))
    gone = F.coalesce(F.col("deleted"), F.lit(False)) if "deleted" in log.columns else F.lit(False)
    version = F.struct(*sorted(set(spec.fields.values())), gone.alias("_gone"))
    begun = (
        log.select(
            *[F.col(k).alias(f"_k_{k}") for k in spec.keys],
            F.coalesce(_ticks(log, at), F.lit(_BEGINNING)).alias("_from"),
            version.alias("_row"),
        )
        .dropna(subset=keys)
        .groupBy(*keys, "_from")
        .agg(F.max("_row").alias("_row"))
        .withColumn("_second", F.lit(False))
    )
    carried = slots.select(
        *keys,
        (F.col("_slot") * _width(step)).alias("_from"),
        F.lit(None).cast(begun.schema["_row"].dataType).alias("_row"),
        F.lit(True).alias("_second"),
    )
    in_order = Window.partitionBy(*keys).orderBy("_from", "_second")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    pieces = begun.unionByName(carried).select(
        *keys,
        _slot(F.col("_from"), step).alias("_slot"),
        "_from",
        F.coalesce(F.lead("_from").over(in_order), F.lit((1 << 63) - 1)).alias("_to"),
        F.last("_row", ignorenulls=True).over(so_far).alias("_row"),
    )
    return pieces.filter(F.col("_row").isNotNull() & ~F.col("_row._gone") & (F.col("_from") < F.col("_to")))


def dim_join_as_of(
    rows: DataFrame,
    log: DataFrame,
    spec: DimSpec,
    moment: str,
    at: str = VALID_FROM,
    step: timedelta | int = STEP,
    slots: DataFrame | None = None,
) -> DataFrame:
    """:func:`dim_join` with the dimension row that held at each row's ``moment``, so that a rebuild finds what was valid then.

    ``log`` holds whole rows of the dimension with ``at``, comparable with ``moment`` (null or no such column: from the
    beginning), and perhaps ``deleted``. A row holds until the next of its key begins; a deleted one ends it. Of several
    that begin at once the greatest holds, by its fields in order of their names. Rows without a key or ``moment``, or
    before the first version, find none.

    Only the distinct keys and slots of ``rows`` are ordered together with the versions. The rows themselves then meet, by
    equality of key and slot, the versions of their slot, so a hot key is split by slots and, within one, by adaptive
    execution. ``step`` is the width of a slot: with numbers as moments a number, else a time span in which a key has few
    versions. ``rows`` are read twice unless ``slots`` (as of :func:`slots_of`, more do no harm) is given.
    """
    keys = [f"_k_{k}" for k in spec.keys]
    slots = slots_of(rows, spec, moment, step) if slots is None else slots
    pieces = own_exchange(versions_by_slot(log, slots, spec, at, step), *keys, "_slot")
    timed = rows.withColumn("_at", _ticks(rows, moment)).withColumn("_at_slot", _slot(F.col("_at"), step))
    on = (F.col("_at_slot") == F.col("_slot")) & (F.col("_at") >= F.col("_from")) & (F.col("_at") < F.col("_to"))
    for dim_col, row_col in spec.keys.items():
        on = on & (F.col(row_col) == F.col(f"_k_{dim_col}"))
    joined = timed.join(pieces, on, "left").withColumns(_written(rows, spec))
    return joined.drop("_row", "_at", "_at_slot", "_slot", "_from", "_to", *keys)


def current_rows(log: DataFrame, key: str = "id", at: str = VALID_FROM) -> DataFrame:
    """The newest row of each key of a log of versions; a dimension without ``at`` is left alone."""
    if at not in log.columns:
        return log
    fields = [c for c in log.columns if c not in (key, at, "deleted")]
    gone = F.coalesce(F.col("deleted"), F.lit(False)) if "deleted" in log.columns else F.lit(False)
    newest = F.max(F.struct(at, *sorted(fields), gone.alias("_gone"))).alias("_row")
    rows = log.groupBy(key).agg(newest).filter(~F.col("_row._gone"))
    return rows.select(key, *[F.col(f"_row.{c}").alias(c) for c in fields])


USER = DimSpec({"id": "user_id"}, {"_birthday": "birthday", "user_gender": "gender"})
PROVINCE = DimSpec(
    {"id": "province_id"},
    {
        "province_name": "name",
        "province_3166_2_code": "iso_3166_2",
        "province_iso_code": "iso_code",
        "province_area_code": "area_code",
    },
)
SKU = DimSpec(
    {"id": "sku_id"},
    {"sku_name": "sku_name", "category3_id": "category3_id", "spu_id": "spu_id", "tm_id": "tm_id"},
)
SPU = DimSpec({"id": "spu_id"}, {"spu_name": "spu_name"})
CATEGORY3 = DimSpec({"id": "category3_id"}, {"category3_name": "name"})
TRADEMARK = DimSpec({"id": "tm_id"}, {"tm_name": "tm_name"})

SKU_FIELDS = (
    "sku_name", "sku_price", "category3_id", "spu_id", "tm_id", "spu_name", "category3_name", "tm_name",
)


def flat_sku(sku: DataFrame, spu: DataFrame, category3: DataFrame, trademark: DataFrame) -> DataFrame:
    """The sku dimension with its spu, category and trademark names.

    The four lookups form a chain whose later keys come from the sku row alone, so they are joined once at the
    size of the sku table; facts then need a single lookup by sku.
    """
    flat = sku.withColumnRenamed("price", "sku_price")
    for dim, spec in ((spu, SPU), (category3, CATEGORY3), (trademark, TRADEMARK)):
        flat = dim_join(flat, dim, spec)
    return flat.select("id", *SKU_FIELDS)


def flat_sku_spec(with_price: bool = False) -> DimSpec:
    names = SKU_FIELDS if with_price else [n for n in SKU_FIELDS if n != "sku_price"]
    return DimSpec({"id": "sku_id"}, {n: n for n in names})
