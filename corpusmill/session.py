"""Session helpers: building a session, the shared scratch folder, parallelism."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(
    app: str = "corpusmill",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    driver_memory: str = "16g",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session for tests, the bench and local runs. On a cluster the caller's
    own session (spark-submit) is used instead and nothing here is needed."""
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    master = master or f"local[{cores}]"
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a folder of its own."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a folder every executor can reach"
        )
    root = tempfile.mkdtemp(prefix="corpusmill-ckpt-")
    spark.sparkContext.setCheckpointDir(root)
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh, never reused folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/corpusmill/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet under the shared checkpoint folder and read
    it back: lineage is cut (a lost executor does not recompute the source),
    later passes read only the columns they need, and nondeterministic
    columns are fixed. One job, unlike an eager ``checkpoint()``, which
    computes the plan and then saves it in a second job."""
    path = scratch_dir(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
