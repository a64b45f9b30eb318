import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from tidemart.session import build_session  # noqa: E402

DATA = Path(os.environ.get("TIDEMART_TESTDATA", "/root/testdata"))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    conf = {
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "6g",
        "spark.sql.streaming.metricsEnabled": "false",
    }
    session = build_session("tests", "local[4]", conf)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return str(DATA / "sf0.001")


@pytest.fixture(scope="session")
def views(spark, sf):
    from tidemart.plans.views import Views

    return Views(spark, sf)


class Replay:
    """Writes frames as an ordered folder of files: one file per part, later parts newer."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.clock = spark, folder, 1_600_000_000

    def add(self, df):
        before = set(self.folder.rglob("*.parquet")) if self.folder.exists() else set()
        df.coalesce(1).write.mode("append").parquet(str(self.folder))
        for file in sorted(set(self.folder.rglob("*.parquet")) - before):
            self.clock += 10
            os.utime(file, (self.clock, self.clock))

    def add_sorted(self, df, order, parts):
        """The rows of ``df`` in ``parts`` files, consecutive by ``order``."""
        rows = df.orderBy(*order).collect()
        size = -(-len(rows) // parts)
        for at in range(0, len(rows), size):
            self.add(self.spark.createDataFrame(rows[at : at + size], df.schema))

    def stream(self, schema, files_per_batch=1):
        from tidemart.sources import replay_files

        return replay_files(self.spark, str(self.folder), schema, files_per_batch=files_per_batch)


@pytest.fixture
def replay(spark, tmp_path):
    made = []

    def make(name):
        made.append(name)
        return Replay(spark, tmp_path / name)

    return make


@pytest.fixture
def table_of(spark):
    """Run a streaming frame to the end of its input and return the rows it emitted."""

    def run(df, checkpoint):
        name = f"out_{abs(hash(str(checkpoint)))}"
        query = (
            df.writeStream.format("memory")
            .queryName(name)
            .option("checkpointLocation", str(checkpoint))
            .outputMode("append")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        return spark.table(name)

    return run
