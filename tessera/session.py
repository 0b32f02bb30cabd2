"""Spark session helpers.

The library never creates a session behind the caller's back: every operator
takes DataFrames. ``get_spark`` is for scripts, tests and the bench; it sets
the knobs the operators are designed around (AQE with skew-join splitting,
Arrow for the few pandas-backed steps, UI off).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # checkpoint files of released DataFrames are removed by Spark's cleaner
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "tessera", extra: dict | None = None) -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.appName(app_name).master(master or f"local[{cpus}]")
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or int(cpus))
    conf["spark.driver.memory"] = os.environ.get("TESSERA_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared (distributed) folder and is used
    as is. Only when it is unset -- local runs and tests -- a fresh scratch
    folder is created and registered.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="tessera-ckpt-")
    try:  # some deployments reject runtime changes of core settings
        spark.conf.set("spark.checkpoint.dir", local)
    except Exception:
        pass
    sc.setCheckpointDir(local)
    return local


def cut_lineage(df):
    """Reliable checkpoint into the shared checkpoint folder (never local)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df):
    """At least one partition per core: iterative fits run every job over all
    partitions, so idle cores would cost each round. A frame that already has
    as many (any table of cluster size) is returned as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def load_tables(spark: SparkSession, sf_dir: str, names=None) -> dict:
    names = names or ["region", "nation", "customer", "supplier", "part", "orders",
                      "lineitem", "events", "documents", "embeddings", "pages",
                      "benchmark", "labels", "conversations"]
    return {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names}
