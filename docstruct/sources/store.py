"""Tables that cut lineage: written to the folder that driver and executors share, and read back."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Tables that this process has written.
_written: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session. Where it is unset, a single-process session gets a folder of its own, once.

    On a cluster there must be one: a folder of one machine is no place that others could read.
    """
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir is not set: it must name a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="docstruct-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def materialize(df: DataFrame) -> DataFrame:
    """df as a table in the shared folder.

    Unlike a cache, the table outlives the executors that wrote it. Columns keep their order and types.
    """
    spark = df.sparkSession
    path = os.path.join(shared_dir(spark), f"docstruct-{uuid.uuid4().hex}.parquet")
    df.write.parquet(path)
    _written.append(path)
    return spark.read.schema(df.schema).parquet(path)


def clean(spark: SparkSession) -> int:
    """Removes the tables that this process has written, once what was built on them is stored elsewhere. How many they were."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    n = len(_written)
    while _written:
        where = jvm.org.apache.hadoop.fs.Path(_written.pop())
        where.getFileSystem(conf).delete(where, True)
    return n
