"""The topics' records: what each must hold to be used, and the dead letters of those that don't.

A record is either a row of its feed or a dead letter with the first reason that applies: ``record`` (no readable JSON),
``key`` (a key is absent), ``time`` (no readable event time, so no window or join could place it).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions import parse_time
from tidemart.schemas import (
    COMMENT_DDL,
    ORDER_DETAIL_DDL,
    ORDER_INFO_DDL,
    PAGE_LOG_DDL,
    PAYMENT_INFO_DDL,
    REFUND_DDL,
    SKU_EVENT_DDL,
)
from tidemart.sources.parsing import CORRUPT, parsed


@dataclass(frozen=True)
class Feed:
    """Columns, keys that must be there, and the event time: text, or epoch millis where ``millis`` is set."""

    ddl: str
    keys: tuple[str, ...]
    time: str = "create_time"
    millis: bool = False

    def reason(self) -> Column:
        no_record = F.col("_row").isNull() | F.col(f"_row.{CORRUPT}").isNotNull()
        time = F.col(f"_row.{self.time}")
        found = F.when(no_record, "record")
        for key in self.keys:
            found = found.when(F.col(f"_row.{key}").isNull(), "key")
        return found.when((time if self.millis else parse_time(time)).isNull(), "time")


LOG = Feed(PAGE_LOG_DDL, ("common.mid",), "ts", millis=True)
ORDERS = Feed(ORDER_INFO_DDL, ("id",))
DETAILS = Feed(ORDER_DETAIL_DDL, ("id", "order_id"))
PAYMENTS = Feed(PAYMENT_INFO_DDL, ("id", "order_id"), "callback_time")
FAVORS = CARTS = Feed(SKU_EVENT_DDL, ("sku_id",))
REFUNDS = Feed(REFUND_DDL, ("sku_id", "order_id"))
COMMENTS = Feed(COMMENT_DDL, ("sku_id",))


def feed_rows(records: DataFrame, feed: Feed, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """The usable rows of ``records`` as the feed's columns (plus the ``keep`` columns of the input)."""
    good = parsed(records, feed.ddl, value).filter(feed.reason().isNull())
    return good.select(*keep, "_row.*").drop(CORRUPT)


def feed_letters(records: DataFrame, feed: Feed, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """``value, reason`` (and ``keep``) of exactly the records that :func:`feed_rows` leaves out."""
    marked = parsed(records, feed.ddl, value).withColumn("reason", feed.reason())
    return marked.filter(F.col("reason").isNotNull()).select(*keep, F.col(value).alias("value"), "reason")
