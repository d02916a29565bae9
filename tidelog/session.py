"""Session settings the library is designed for."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that only steer the optimizer; a cluster's own values win when already set.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Keyed state on local disk, its changes in the checkpoint: the number of keys is not bound by the heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """Session for tests and benchmarks; on a cluster pass the submitted session instead."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidelog")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for name, value in {**SQL_SETTINGS, **conf}.items():
        builder = builder.config(name, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a temporary one only where none is named."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if configured:
        return configured
    if spark.sparkContext.master.startswith("local"):
        return tempfile.mkdtemp(prefix="run-", dir="/tmp")
    raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")


def cut_lineage(rows: DataFrame) -> DataFrame:
    """Rows written once to the shared folder and read from there, for plans that use them many times."""
    spark = rows.sparkSession
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return rows.checkpoint()


def written_once(rows: DataFrame) -> DataFrame:
    """As ``cut_lineage``, in Parquet: later reads take the columns they need. For rows that cost much to compute."""
    path = f"{shared_folder(rows.sparkSession).rstrip('/')}/rows-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
