"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", app: str = "barlake", **conf: str) -> SparkSession:
    """A session for tests and benches; on a cluster use the session you are given."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4m")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh path for written intermediate tables.

    Lives under the folder named by ``spark.checkpoint.dir``, which every executor
    can reach. Only a local master may fall back to a machine-local folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        shared = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return os.path.join(shared, f"{name}-{uuid.uuid4().hex}")
