"""Cut the lineage of a frame that several jobs will read."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def settle(frame: DataFrame) -> DataFrame:
    """Write the frame once to the shared checkpoint folder and read it back.

    A written table outlives lost executors and lets later jobs read only the
    columns they need. The table goes when the application ends.
    """
    spark = frame.sparkSession
    path = new_folder(spark, "settled")
    frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder that driver and executors share and that goes when the application ends.

    It lies under the session's `spark.checkpoint.dir`, or its warehouse where that is unset.
    """
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.sql.warehouse.dir")
    path = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    written, files = on_files(spark, path)
    files.deleteOnExit(written)
    return path


def on_files(spark: SparkSession, path: str) -> tuple:
    """A path and its file system, as Hadoop has them."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
