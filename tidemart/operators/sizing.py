"""Sides of a join, shaped so that adaptive execution can broadcast small ones and split hot keys of others."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def own_exchange(df: DataFrame, *keys: str) -> DataFrame:
    """Prepare an aggregate on ``keys`` for a join on the same keys.

    An aggregate leaves its rows where the join wants them, so the join adds no exchange on that side, and adaptive
    execution, which splits a hot key only between two plain exchanges, cannot help the other side. Moving the (one row
    per key) aggregate once more restores that shape.
    """
    return df.repartition(F.xxhash64(*keys))
