"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and the bench; on a cluster use the session spark-submit gives."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("postlens")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; where that is unset, one under the warehouse.

    On a cluster an unset folder is an error if the warehouse lies on a local disk, as it does by default:
    what one executor wrote there no other would find.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    local = warehouse.startswith(("file:", "/"))
    if local and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
    return f"{warehouse}/_scratch"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; every call gives another one."""
    return f"{shared_dir(spark)}/postlens/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write a frame once to the shared folder and read it back.

    Used where a frame feeds several jobs and must not be computed again (model features, labels
    from a costly labeler). The written table outlives lost executors.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
