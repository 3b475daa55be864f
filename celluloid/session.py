"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that make the plans hold at cluster scale. AQE picks shuffle sizes, turns a join into a
# broadcast only after it has measured the side, and splits skewed partitions.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(app: str = "celluloid", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**CLUSTER_CONF, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder that ``spark.checkpoint.dir`` names, or else ``celluloid.scratch``; without
    either nothing is written."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("celluloid.scratch", None)
    if not root:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    return root.rstrip("/")


def own_scratch(spark: SparkSession) -> None:
    """For runs on one machine, such as tests: names a new folder where the session names none."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("celluloid.scratch", None)
    if not named and spark.sparkContext.master.split("[")[0] == "local":
        spark.conf.set("celluloid.scratch", tempfile.mkdtemp(prefix="celluloid-"))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; never reused, so that a rerun cannot read old files."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
