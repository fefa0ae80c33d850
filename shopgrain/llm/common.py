"""What several operators need: white space, intermediate tables, fixed-size ids."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of all word rules: the characters [\x20\x09-\x0D]. Fixed values.
SPACE = r"[\x20\x09-\x0D]"
SPACE_CHARACTERS = " \t\n\x0b\x0c\r"

#: Bits of a sieve (1 MB).
SIEVE_BITS = 1 << 23


def whole(column: str | Column) -> Column:
    """The text as it is; null counts as empty."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("string"), F.lit(""))


def shared_folder(spark: SparkSession) -> str:
    """A new folder that driver and executors share.

    It lies under spark.checkpoint.dir; where that is unset, as in tests, under the
    session's warehouse. The folder goes when the application ends.
    """
    conf = spark.sparkContext.getConf()
    root = conf.get("spark.checkpoint.dir") or spark.conf.get("spark.sql.warehouse.dir")
    folder = f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def settled(df: DataFrame, folder: str | None = None) -> DataFrame:
    """df, written once as Parquet and read again, so that a lost executor costs nothing."""
    folder = folder or shared_folder(df.sparkSession)
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def sieve(ids: DataFrame, id_column: str) -> DataFrame:
    """A bitmap of hashed ids, in 256 rows of 4 KB, whatever the number of ids.

    It spares rows that surely have no match a shuffle; the others are joined as usual.
    """
    bit = F.pmod(F.xxhash64(id_column), F.lit(SIEVE_BITS)) + 1  # bit positions count from 1
    return ids.groupBy(F.bitmap_bucket_number(bit).alias("_sieve_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("_sieve_bits")
    )


def through(rows: DataFrame, bits: DataFrame, id_column: str) -> DataFrame:
    """rows with `_sieve_hit`: false for those whose id is surely not in the sieve."""
    bit = F.pmod(F.xxhash64(id_column), F.lit(SIEVE_BITS)) + 1
    position = F.bitmap_bit_position(bit)
    byte = F.hex(F.substring("_sieve_bits", (position / 8).cast("int") + 1, F.lit(1)))
    value = F.conv(byte, 16, 10).cast("long")
    hit = F.getbit(value, (position % 8).cast("int")) == 1
    return (
        rows.withColumn("_sieve_bucket", F.bitmap_bucket_number(bit))
        .join(F.broadcast(bits), "_sieve_bucket", "left")
        .withColumn("_sieve_hit", F.coalesce(hit, F.lit(False)))
        .drop("_sieve_bucket", "_sieve_bits")
    )
