"""Session helpers: a local session for tests/bench and a shared scratch folder.

Library code never builds its own session; callers pass one in. The scratch
folder is always derived from ``spark.checkpoint.dir`` (the shared folder a
cluster names) and is only invented locally when that setting is unset.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf) -> SparkSession:
    """Local session used by tests and ``bench.py`` (never by the library)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("daybook")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    for k, v in conf.items():
        builder = builder.config(k.replace("_", "."), v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    Only when the session has none *and runs in local mode* (local runs,
    tests) is a fresh temporary folder created and registered as the
    checkpoint dir; on a cluster a machine-local folder would not be shared,
    so an unset dir is an error there.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):  # local-cluster has executors of its own
            raise RuntimeError(
                "spark.checkpoint.dir is not set: name a folder on shared storage "
                "(reliable checkpoints and scratch tables are written there)"
            )
        root = tempfile.mkdtemp(prefix="daybook-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared folder (nothing is created)."""
    return os.path.join(shared_root(spark), "daybook", f"{name}-{uuid.uuid4().hex[:12]}")


def clear_scratch(spark: SparkSession) -> None:
    """Delete every scratch table and store that this application wrote.

    For the end of a job: results that still read from them can't be read after.
    """
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(os.path.join(shared_root(spark), "daybook"))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
