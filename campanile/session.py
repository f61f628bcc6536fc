"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

#: What the library expects of a session.  Adaptive execution sizes and splits
#: shuffle partitions at run time, so the initial number may be generous.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app: str = "campanile", master: str | None = None, **conf: str) -> SparkSession:
    """A session with :data:`SESSION_CONF`; keyword keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings that results depend on, and those of the streams' state, to a session made elsewhere."""
    for key, value in SESSION_CONF.items():
        if key == "spark.sql.session.timeZone" or key.startswith("spark.sql.streaming."):
            spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder path all executors can reach.

    The cluster names its shared folder in ``spark.checkpoint.dir``.  Only a
    local session, whose executors share the machine, may fall back to a
    temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="campanile-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
