"""Session construction and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "aerometer", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on.

    Shuffle width is left to adaptive execution: start wide, let it coalesce. The state store
    keeps its rows in RocksDB so streaming state is not bounded by the heap.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_LOCAL_BASE: list[str] = []


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the cluster's shared checkpoint folder.

    A local master without one gets a temporary folder; on a cluster that is an error, as executors
    do not share their disks.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if not _LOCAL_BASE:
            _LOCAL_BASE.append(tempfile.mkdtemp(prefix="aerometer-"))
        base = _LOCAL_BASE[0]
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """df written once to the shared folder, for plans that read it several times."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
