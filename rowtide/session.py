"""Session defaults and the shared scratch folder."""

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def session(app="rowtide", cores="*", shuffle_partitions=8, **conf):
    """A local session with the settings tests and the benchmark use.

    A cluster brings its own session; nothing in the library needs more than
    adaptive execution (on by default) and a UTC session time zone.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("ROWTIDE_DRIVER_MEMORY", "8g"))
    )
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark):
    """A new folder below the one the cluster names in spark.checkpoint.dir.

    Only a local session without that setting gets a temporary folder; on a
    cluster a machine-local folder would not outlive its executor.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if spark.sparkContext.master.startswith("local-cluster") or not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="rowtide-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def written(spark, df, *folders):
    """The frame as a table in the shared folder: computed once, read by column,
    and still there when an executor is lost. Rows lie in a folder per value of
    the last columns, if these are named."""
    path = shared_folder(spark)
    df.write.partitionBy(*folders).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
