"""Session settings the operators rely on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Set once per session, and only where the session was not started with its own value.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # geometry tests are CPU-bound: do not squeeze small shuffles into one task
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


_DONE = "wayfield.configured"


def configure(spark: SparkSession) -> SparkSession:
    if spark.conf.get(_DONE, None):
        return spark
    spark.conf.set(_DONE, "true")
    given = spark.sparkContext.getConf()
    for key, value in RUNTIME_CONF.items():
        if not given.contains(key):
            spark.conf.set(key, value)
    # a local session with the general default would keep 200 tiny state stores
    if spark.sparkContext.master.startswith("local") and \
            spark.conf.get("spark.sql.shuffle.partitions") == "200":
        spark.conf.set("spark.sql.shuffle.partitions", str(spark.sparkContext.defaultParallelism))
    return spark


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared folder named by ``spark.checkpoint.dir``.

    Streaming checkpoints and written intermediate tables go here, because every
    executor must see them. Only a session without that setting (a local test)
    falls back to a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="wayfield-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
