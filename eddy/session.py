"""Session helpers: a local builder for tests/bench and the shared
checkpoint folder used for stream sinks and lineage cuts."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Settings every eddy job relies on. AQE re-plans joins (runtime broadcast of
# sides that turn out small, skew-join splitting) and coalesces partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "eddy") -> SparkSession:
    """A local session for tests and the bench (never used on a cluster)."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "16g"))
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this must be a shared file system (HDFS/S3/...). Only when it
    is unset *and* the master is local do we pick a folder ourselves, as tests
    do; a cluster job without the setting fails loudly instead of writing to a
    machine-local temporary folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder")
        import tempfile
        d = tempfile.mkdtemp(prefix="eddy-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the checkpoint folder for one run of one job."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/eddy/{name}-{uuid.uuid4().hex[:12]}"


def default_parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


__all__ = ["local_session", "ensure_checkpoint_dir", "scratch_path",
           "default_parallelism", "DEFAULT_CONF"]
