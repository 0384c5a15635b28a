"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks. On a cluster the submitter's settings apply."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("seqtables")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_local_root: list[str] = []


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder every executor can reach, below the one the cluster names for checkpoints.

    Where ``spark.checkpoint.dir`` is unset a temporary folder is used, in local mode only.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        if not _local_root:
            _local_root.append(tempfile.mkdtemp(prefix="seqtables-"))
        root = _local_root[0]
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
