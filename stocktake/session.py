"""Session helpers shared by tests, the benchmark and scripts."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, memory: str = "6g") -> SparkSession:
    """A local session with the settings every operator here relies on (UTC, ANSI, AQE)."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("stocktake")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.driver.host", "127.0.0.1")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table; works for any path Spark's readers can open."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder's URI, in the one that all executors share (spark.checkpoint.dir); a temporary one where that is unset, in a single process."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir is not set: it has to name a folder that the driver and all executors share")
        own = tempfile.mkdtemp(prefix="stocktake-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        shared = f"file://{own}"
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df, written to a scratch_dir() and read back: lineage is cut, and a lost executor costs no recomputation."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def data_dir(default: str = "/root/testdata/sf0.01") -> str:
    return os.environ.get("STOCKTAKE_SF_DIR", default)
