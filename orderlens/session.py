"""Spark session helpers.

The library never creates a session on its own: analyses take DataFrames.
``local_session`` is for tests, the bench and the driver contract.
"""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

# Settings every session should carry for deterministic, comparable results.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "orderlens", extra: dict | None = None) -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "8g")
               .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for k, v in {**BASE_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    for k, v in BASE_CONF.items():
        if k != "spark.ui.enabled":
            spark.conf.set(k, v)
    return spark


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the package to the Python workers (once per application), wherever they start."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="orderlens-"), "orderlens.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, files in os.walk(package):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    sc.addPyFile(path)                    # Spark's own file server carries it to the executors
    _shipped.add(sc.applicationId)


def free(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of frames that are no longer used.

    It does so when the driver collects garbage, which may be never while a loop of jobs fills the disk."""
    spark.sparkContext._jvm.System.gc()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, configuring it only when unset.

    On a cluster the folder must come from ``spark.checkpoint.dir`` (a shared
    file system).  Only a local-mode session (tests, bench) may fall back to a
    fresh scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS/S3/ABFS) before running operators that cut lineage")
    path = tempfile.mkdtemp(prefix="orderlens-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A folder for intermediate tables next to the checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, name) if "://" not in base else f"{base.rstrip('/')}/{name}"
