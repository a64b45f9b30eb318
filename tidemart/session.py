"""Session settings the operators are designed for."""

from __future__ import annotations

import tempfile
from functools import cache

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

BASE_CONF = {
    # one business time zone for every text <-> time conversion
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join side even when that costs one more exchange downstream
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
}


def build_session(app: str = "tidemart", master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    """A session with :data:`BASE_CONF`; ``conf`` wins over it, cluster settings are left alone."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**BASE_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_runtime_conf(spark: SparkSession) -> SparkSession:
    """Set :data:`BASE_CONF` on a session somebody else created, where that session has no value of its own."""
    own = dict(spark.sparkContext.getConf().getAll())
    for key, value in BASE_CONF.items():
        if key not in own:
            spark.conf.set(key, value)
    return spark


@cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="tidemart-")


def shared_dir(spark: SparkSession) -> str:
    """The work folder that driver and executors share, from ``spark.checkpoint.dir``.

    Without that setting a local session gets a temporary folder; on a cluster it is an error, as every executor would
    write to its own disk.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or "local-cluster" in spark.sparkContext.master:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_dir()
