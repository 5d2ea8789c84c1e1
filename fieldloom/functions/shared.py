"""Tables between the steps of one operator, in the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; in local mode, where none is named, one of our own."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        named = "file://" + tempfile.mkdtemp(prefix="fieldloom-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def settled(df: DataFrame, name: str) -> DataFrame:
    """df written down and read again: the plan starts anew from files that outlive an executor. They go when the session ends."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(at)
    fs.deleteOnExit(at)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, times: int = 4) -> DataFrame:
    """df dealt evenly over the cores, before work that costs far more than reading: a file of one row group is read by one task."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism * times)
