"""Spark session and the shared work folder.

The work folder (layered tables, checkpoints, stream state) is the folder the
cluster names in ``spark.checkpoint.dir``.  A session that has none (local
tests) gets a fresh folder of its own; a cluster session is never redirected
to machine-local storage.
"""
from __future__ import annotations

import os
import tempfile

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

BLOOM_SCAN = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"

# Work folders created for sessions that had none, keyed by application id.
_LOCAL_WORK: dict[str, str] = {}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "stride", extra: dict | None = None) -> SparkSession:
    """Local/test session builder; on a cluster use the provided session."""
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("STRIDE_DRIVER_MEMORY", "8g"))
    conf.setdefault("spark.checkpoint.dir", tempfile.mkdtemp(prefix="stride-work-"))
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_work_dir(spark)
    return spark


def submitted_session(app_name: str = "stride") -> SparkSession:
    """The session as submitted (``spark-submit``, ``PYSPARK_SUBMIT_ARGS``, defaults
    file): whatever is set there stays, and only what is unset gets a default."""
    SparkContext._ensure_initialized()  # the launcher's settings are read with the JVM
    given = SparkConf()
    b = SparkSession.builder
    if not given.contains("spark.app.name"):
        b = b.appName(app_name)
    if not given.contains("spark.master"):
        b = b.master("local[*]")
    for k, v in DEFAULT_CONF.items():
        if not given.contains(k):
            b = b.config(k, v)
    spark = b.getOrCreate()
    ensure_work_dir(spark)  # a cluster without a shared folder is refused here
    return spark


def _conf_checkpoint_dir(spark: SparkSession) -> str | None:
    try:
        value = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    except Exception:  # pragma: no cover - connect sessions
        value = None
    if not value:
        try:
            value = spark.conf.get("spark.checkpoint.dir", None)
        except Exception:  # pragma: no cover
            value = None
    return value or None


def ensure_work_dir(spark: SparkSession) -> str:
    """Return the shared work folder; create a private one only when unset."""
    existing = _conf_checkpoint_dir(spark)
    sc = spark.sparkContext
    if existing:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(existing)
        return existing.rstrip("/")
    if not sc.master.startswith("local"):
        # a cluster needs a folder every executor and the driver share
        raise RuntimeError("spark.checkpoint.dir is not set: name a shared folder "
                           "(e.g. on HDFS or an object store) for tables, checkpoints and stream state")
    app = sc.applicationId
    if app not in _LOCAL_WORK:
        local = tempfile.mkdtemp(prefix="stride-work-")
        sc.setCheckpointDir(local)
        _LOCAL_WORK[app] = local
    return _LOCAL_WORK[app]


def work_path(spark: SparkSession, *parts: str) -> str:
    """Path under the shared work folder."""
    root = ensure_work_dir(spark)
    return "/".join([root, *[p.strip("/") for p in parts]])


def configure(spark: SparkSession) -> None:
    """Session settings the operators rely on (runtime-modifiable only)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    # a lookup's requests filter the scan of a large table by a Bloom filter (JON-8); Spark's own
    # threshold of 10 GB is above the caches and dimension tables that this pays for
    spark.conf.set("spark.sql.optimizer.runtime.bloomFilter.enabled", "true")
    if not spark.conf.get(BLOOM_SCAN, None) or spark.conf.get(BLOOM_SCAN) == "10GB":
        spark.conf.set(BLOOM_SCAN, "256MB")
