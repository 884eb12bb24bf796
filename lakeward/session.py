"""Session and shared-workspace helpers.

Everything that writes (staged tables, quarantine, streaming checkpoints,
lineage-cutting tables) goes below the shared folder the cluster names in
``spark.checkpoint.dir``.  The library never invents a machine-local folder
on a cluster: when the setting is missing it only falls back to a fresh temp
folder for ``local[...]`` masters (tests, bench).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every session of ours needs for deterministic results.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Task output goes straight to the output folder at task commit (one
    # rename instead of two).  Every in-place change of ours writes to a
    # staging folder first, so a failed job never exposes partial output.
    "spark.hadoop.mapreduce.fileoutputcommitter.algorithm.version": "2",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "lakeward", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    for k, v in {**BASE_CONF, "spark.sql.shuffle.partitions": str(shuffle_partitions),
                 **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """All timestamp logic assumes UTC wall time (the driver data is naive)."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only in local mode."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="lakeward-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def workspace(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    leaf = "-".join(p for p in parts if p) or "ws"
    return f"{root}/lakeward/{leaf}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (survives executor loss); never localCheckpoint."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
