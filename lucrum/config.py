"""Session settings and shared scratch space.

Operators never configure the session themselves; the caller (a job, a
test, ``bench.py``) does, through :func:`build_session` or its own builder. The one
exception lasts as long as a write of the library: :func:`shuffles_released`.
Scratch tables live under the cluster's shared checkpoint folder
(``spark.checkpoint.dir``); only when that is unset, as in local tests, is a
private folder created and registered as the checkpoint dir.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job of the library expects; the caller may override them.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "lucrum", extra: dict | None = None) -> SparkSession:
    """Session for tests and the benchmark. Clusters pass their own conf."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Set on the session only where it is unset and the master is ``local[...]``,
    whose executor is this process; on a cluster it must be set."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="lucrum-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused location under the shared checkpoint folder."""
    root = checkpoint_root(spark)
    if "://" not in root:
        os.makedirs(root, exist_ok=True)
    return f"{root}/lucrum/{name}-{uuid.uuid4().hex[:12]}"


RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a write in the block are removed as it ends, not when the driver
    next collects garbage, so that a job of several writes needs the disk of its largest
    step. The session's setting is put back."""
    before = spark.conf.get(RELEASE, None)
    spark.conf.set(RELEASE, "true")
    try:
        yield
    finally:
        spark.conf.unset(RELEASE) if before is None else spark.conf.set(RELEASE, before)
