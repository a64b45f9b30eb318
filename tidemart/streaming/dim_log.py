"""A dimension kept up to date by micro-batches: a log of changes and, from time to time, a snapshot."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.operators import cdc
from tidemart.streaming.sinks import append_batch, published_batches


@dataclass(frozen=True)
class DimLog:
    """One row per key, in Parquet under ``path``, on storage all executors share.

    A micro-batch's changes are combined to one state per key and appended to the log, in a folder of their own. The
    dimension is the maximum, column by column, of the newest snapshot's states and those of the micro-batches after it;
    :meth:`compact` writes a next snapshot. Log and snapshots are published once and not changed, so repeats are harmless
    and readers never see half a batch.

    ``columns`` are text columns, as the routing configuration lists them. A change writes only the columns it carries;
    each column keeps its newest value. ``apply_deletes`` removes what is older than a key's newest delete; by default a
    delete is stored like any other change.
    """

    path: str
    pk: str
    columns: tuple[str, ...]
    apply_deletes: bool = False

    @property
    def _state_ddl(self) -> str:
        states = ", ".join(f"`{c}` struct<seq:bigint,value:string>" for c in self.columns)
        return f"_key string, {states}, _deleted bigint"

    def append(self, changes: DataFrame, batch_id: int) -> None:
        """Log ``changes``: ``_seq``, ``_type`` and either a map ``data`` of what each carries, or the columns.

        Ids must increase, repeats are harmless. Changes without a key are not stored; :meth:`without_key` has them.
        """
        states = cdc.column_states(self._with_map(changes), self.pk, self.columns)
        append_batch(states, f"{self.path}/log", batch_id)

    def states(self, spark: SparkSession) -> DataFrame:
        """One row per key: the newest snapshot and the micro-batches after it, combined."""
        read = spark.read.schema(self._state_ddl)
        upto, later = self._parts(spark)
        folders = [f"{self.path}/log/batch_id={n}" for n in later]
        if upto is not None:
            folders.append(f"{self.path}/snapshots/batch_id={upto}")
        if not folders:
            return spark.createDataFrame([], self._state_ddl)
        return cdc.merged_states(read.parquet(*folders), self.columns)

    def read(self, spark: SparkSession) -> DataFrame:
        """The dimension as of the last micro-batch published; call it per micro-batch to see new changes."""
        return cdc.rows_of_states(self.states(spark), self.columns, self.apply_deletes)

    def compact(self, spark: SparkSession) -> int | None:
        """Write the states up to the last micro-batch published as a snapshot; returns that micro-batch's id.

        May run beside the job that appends. Readers that have begun go on with the older parts, which stay in place.
        """
        upto, later = self._parts(spark)
        if not later:
            return upto
        append_batch(self.states(spark), f"{self.path}/snapshots", later[-1])
        return later[-1]

    def without_key(self, changes: DataFrame) -> DataFrame:
        return self._with_map(changes).filter(F.try_element_at("data", F.lit(self.pk)).isNull())

    def _parts(self, spark: SparkSession) -> tuple[int | None, list[int]]:
        """The newest snapshot's id and the ids of the micro-batches after it."""
        upto = max(published_batches(spark, f"{self.path}/snapshots"), default=None)
        logged = published_batches(spark, f"{self.path}/log")
        return upto, [n for n in logged if upto is None or n > upto]

    def _with_map(self, changes: DataFrame) -> DataFrame:
        if "data" in changes.columns:
            return changes
        entries = [x for c in self.columns for x in (F.lit(c), F.col(c))]
        return changes.withColumn("data", F.create_map(*entries))
