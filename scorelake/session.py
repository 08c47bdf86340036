"""Session helpers for tests, the bench and local runs.

Library code never creates a session; it takes the caller's.  On a cluster
the checkpoint folder comes from ``spark.checkpoint.dir`` as configured
there; ``checkpoint_dir`` only fills it in when it is unset (tests).
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "scorelake",
                  extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder, as configured.

    Only a local session, whose one process reads what it writes, gets a scratch folder where none is
    set; on any other master an unset folder is an error.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = f"file://{tempfile.mkdtemp(prefix='scorelake-ckpt-')}"
    spark.conf.set("spark.checkpoint.dir", path)
    return path
