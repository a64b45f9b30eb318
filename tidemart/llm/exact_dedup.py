"""Exact deduplication as a stream with keyed state that never expires.

Each run stages ``doc_id, digest, feed, row, locator`` of its rows in an inbox folder; a stream over the inbox keeps, per
digest, the stable identifier of the row that stays, its content locator and the number of rows. The state lives in
RocksDB on the executors' disks, is checkpointed below the shared folder and outlives the run: a later ``feed`` on the
same folder meets everything seen before. Rows of one digest are combined before the shuffle, so a group that holds a
third of all rows reaches its state as one row for each task. On hits the texts themselves are compared; rows whose
bytes differ from the kept row's (a digest collision) are grouped by their text instead.

Defined cases: null text is the empty text; texts are equal when identical after lower-casing A-Z; of equal texts the
row with the largest ``doc_id`` stays (null is smallest), among rows that repeat one ``doc_id`` the last read; a table
without rows gives none; other columns are not read.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemart.llm.work import content_hash, lower_ascii, staged, text_of, work_path
from tidemart.session import ROCKSDB

# rows of a group that one task compares with the kept text
HITS_PER_SALT = 1000
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    # many small stores: space set aside for their logs would be larger than they are
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


class ExactDedup:
    """Groups of equal texts over all rows ever fed to ``folder`` (new below the shared folder by default)."""

    def __init__(self, spark: SparkSession, folder: str | None = None, digest: Callable[[Column], Column] = sha256):
        self.spark, self.digest = spark, digest
        self.folder = folder or work_path(spark, "dedup")

    def feed(self, docs: DataFrame) -> None:
        """Stage the rows of ``docs`` and bring the state up to date."""
        rows = docs.select(
            "doc_id",
            self.digest(lower_ascii(text_of())).alias("digest"),
            F.lit(time.time_ns()).alias("feed"),
            F.monotonically_increasing_id().alias("row"),
            F.input_file_name().alias("locator"),
        )
        rows.write.mode("append").parquet(f"{self.folder}/inbox")
        conf = self.spark.conf
        before = {key: conf.get(key, None) for key in STATE_CONF}
        for key, value in STATE_CONF.items():
            conf.set(key, value)
        try:
            self._state(rows.schema).awaitTermination()
        finally:
            for key, value in before.items():
                if value is None:
                    conf.unset(key)
                else:
                    conf.set(key, value)

    def _state(self, schema):
        folder = self.folder
        arriving = self.spark.readStream.schema(schema).parquet(f"{folder}/inbox")
        groups = arriving.groupBy("digest").agg(
            F.max(F.struct("doc_id", "feed", "row", "locator")).alias("keep"), F.count("*").alias("group_size")
        )

        def publish(batch: DataFrame, number: int) -> None:
            # a repeated batch replaces its own folder
            batch.write.mode("overwrite").parquet(f"{folder}/groups/batch={number}")

        return (
            groups.writeStream.outputMode("update")
            .option("checkpointLocation", f"{folder}/state")
            .trigger(availableNow=True)
            .foreachBatch(publish)
            .start()
        )

    def rows(self) -> DataFrame:
        """Every row fed so far: ``doc_id, digest, feed, row, locator``; ``feed`` and ``row`` together tell rows apart."""
        return self.spark.read.parquet(f"{self.folder}/inbox")

    def groups(self) -> DataFrame:
        """``digest, keep, group_size`` as of the newest batch that touched the digest."""
        seen = self.spark.read.option("basePath", f"{self.folder}/groups").parquet(f"{self.folder}/groups")
        return seen.groupBy("digest").agg(
            F.max_by("keep", "group_size").alias("keep"), F.max("group_size").alias("group_size")
        )

    def decisions(self, docs: DataFrame) -> DataFrame:
        """``doc_id, feed, row, keep_id, group_size, kept, digest`` for every row fed; ``docs`` gives the texts of hits."""
        rows = self.rows()
        # a table of its own, so that a digest of very many rows can be split over tasks in the join
        groups = staged(self.groups(), "groups")
        chosen = (F.col("feed") == F.col("keep.feed")) & (F.col("row") == F.col("keep.row"))
        decided = rows.join(groups, "digest").select(
            "doc_id", "feed", "row", F.col("keep.doc_id").alias("keep_id"), "group_size", chosen.alias("kept"), "digest"
        )
        decided = staged(decided, "decided")
        hits = staged(self._hits(docs, decided.where("group_size > 1")), "hits")
        collided = self._collided(hits)
        plain = decided.join(collided, "digest", "left_anti")
        return plain.unionByName(_regrouped(decided, hits, collided).select(plain.columns))

    def _hits(self, docs: DataFrame, rows: DataFrame) -> DataFrame:
        """The normalised texts of all rows that share their digest."""
        keys = rows.groupBy("doc_id", "digest").agg(F.max("keep_id").alias("keep_id"), F.max("group_size").alias("n"))
        texts = docs.select(
            F.col("doc_id").alias("_id"),
            self.digest(lower_ascii(text_of())).alias("_digest"),
            lower_ascii(text_of()).alias("text"),
        )
        same = keys["doc_id"].eqNullSafe(texts["_id"]) & (keys["digest"] == texts["_digest"])
        return keys.join(texts, same).select("doc_id", "digest", "keep_id", "n", "text")

    def _collided(self, hits: DataFrame) -> DataFrame:
        """Digests of more than one text. The kept text of a large group is copied, so that its hits spread over tasks."""
        salts = F.ceil(F.col("n") / HITS_PER_SALT).cast("int")
        kept = (
            hits.where(F.col("doc_id").eqNullSafe(F.col("keep_id")))
            .groupBy("digest")
            .agg(F.min("text").alias("kept"), F.max("n").alias("n"))
            .select("digest", "kept", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"))
        )
        salted = hits.withColumn("salt", F.pmod(F.xxhash64("doc_id"), salts).cast("int"))
        return salted.join(kept, ["digest", "salt"]).where("text != kept").select("digest").distinct()


def _regrouped(decided: DataFrame, hits: DataFrame, collided: DataFrame) -> DataFrame:
    """Decisions for the rows of collided digests, by their texts."""
    own = hits.join(collided, "digest")
    by_text = own.groupBy("digest", "text").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    # rows that repeat an identifier and have one digest count as one document
    one = own.groupBy("doc_id", "digest").agg(F.min("text").alias("text"))
    found = one.join(by_text, ["digest", "text"])
    rows = decided.select("doc_id", "feed", "row", "digest").join(collided, "digest")
    same = rows["doc_id"].eqNullSafe(found["doc_id"]) & (rows["digest"] == found["digest"])
    joined = rows.join(found, same).select(rows["doc_id"], "feed", "row", rows["digest"], "keep_id", "group_size", "text")
    place = F.struct("feed", "row")
    last = F.max(F.when(F.col("doc_id").eqNullSafe(F.col("keep_id")), place))
    return joined.withColumn("kept", place.eqNullSafe(last.over(Window.partitionBy("digest", "text")))).drop("text")


def kept_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text no other row repeats, and one row of each group of equal texts."""
    dedup = ExactDedup(docs.sparkSession)
    dedup.feed(docs)
    stay = dedup.decisions(docs).where("kept").select("doc_id", "digest")
    text = F.sha2(lower_ascii(text_of()), 256)
    marked = docs.select(
        F.struct("*").alias("_row"), F.col("doc_id").alias("_id"), text.alias("_digest"), content_hash(docs).alias("_content")
    )
    # of rows that repeat identifier and text one stays: by content, not by place
    first = Window.partitionBy("_id", "_digest").orderBy("_content")
    once = marked.withColumn("_nth", F.row_number().over(first)).where("_nth = 1")
    same = once["_id"].eqNullSafe(stay["doc_id"]) & (once["_digest"] == stay["digest"])
    return once.join(stay, same, "left_semi").select("_row.*")
