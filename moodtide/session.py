"""Session settings and the shared working folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def local_session(
    cores: int | str = "*", shuffle_partitions: int = 8, app: str = "moodtide", checkpoint_dir: str | None = None
) -> SparkSession:
    """A ``local[N]`` session for tests and ``bench.py``; cluster jobs bring their own. The folder for
    ``work_dir`` is what the session's defaults set unless given here."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if checkpoint_dir:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir``, which every executor can reach. An unset
    ``spark.checkpoint.dir`` is an error on every master."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by driver and executors")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


_ROCKSDB_STATE = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB and upload only its changes at each commit
    (W5). A query takes these settings along when it starts; the session gets its own back."""
    before = {name: spark.conf.get(name, None) for name in _ROCKSDB_STATE}
    try:
        for name, value in _ROCKSDB_STATE.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
