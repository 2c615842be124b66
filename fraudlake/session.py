"""Session helpers: a local session for tests/bench and the shared scratch folder.

On a cluster the session comes from the caller; nothing here overrides
shuffle sizing or memory that a cluster operator has set.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. Applied only when the key is still unset,
# so a cluster's own spark-defaults win.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "fraudlake") -> SparkSession:
    """Local session used by tests and ``bench.py`` (UI off, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("FRAUDLAKE_DRIVER_MEMORY", "4g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> None:
    """Set recommended SQL options that the session has not set itself."""
    for k, v in RECOMMENDED_CONF.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)


def _conf(spark: SparkSession, key: str) -> str | None:
    try:
        value = spark.sparkContext.getConf().get(key, None)
    except Exception:  # noqa: BLE001 - no SparkContext on a Connect session
        value = None
    return value or spark.conf.get(key, None)


def default_parallelism(spark: SparkSession) -> int:
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001 - Connect session
        return int(spark.conf.get("spark.default.parallelism", None) or spark.conf.get("spark.sql.shuffle.partitions"))


def _is_local(spark: SparkSession) -> bool:
    try:
        return spark.sparkContext.master.startswith("local")
    except Exception:  # noqa: BLE001
        return (spark.conf.get("spark.master", "") or "").startswith("local")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by the operator (a shared filesystem);
    only a local-mode session (tests) gets a private temporary folder.
    """
    conf_dir = _conf(spark, "spark.checkpoint.dir")
    if not conf_dir:
        if not _is_local(spark):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        conf_dir = tempfile.mkdtemp(prefix="fraudlake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    try:
        spark.sparkContext.setCheckpointDir(conf_dir)
    except Exception:  # noqa: BLE001 - Connect sessions take the directory from the conf
        pass
    return conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint root for written intermediates."""
    return os.path.join(checkpoint_root(spark), "fraudlake", f"{name}-{uuid.uuid4().hex[:12]}")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write a frame once into the shared folder of spark.checkpoint.dir and read it back.

    Later steps, and retries after a lost executor, read the files instead of the lineage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
