"""Big tables stored so that they join without a shuffle.

Tables that share a key are written in the same number of buckets of that key, sorted by
it. A join on the key, and every fold by it, then reads bucket by bucket: neither side is
dealt again. Rows are brought together by bucket once, while they are written, so that a
bucket is one file.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def write_together(tables: Mapping[str, tuple[DataFrame, str]], path: str, buckets: int) -> dict[str, DataFrame]:
    """Write tables, each given with its key, and return them as they are read back.

    A second write to the same path replaces the tables. Choose the buckets so that one of
    the largest table fits into a task; one key stays in one bucket.
    """
    found = {}
    for name, (frame, key) in tables.items():
        spark, place = frame.sparkSession, f"{path}/{name}"
        frame.repartition(buckets, key).sortWithinPartitions(key).write.mode("overwrite").option("path", place).format(
            "parquet"
        ).bucketBy(buckets, key).sortBy(key).saveAsTable(_table_name(place))
        found[name] = spark.table(_table_name(place))
    return found


def read_together(
    spark: SparkSession, path: str, tables: Mapping[str, tuple[T.StructType, str]], buckets: int
) -> dict[str, DataFrame]:
    """Tables that an earlier session wrote, each given with its schema and key.

    Only the catalog knows of buckets, so the tables are registered again, over the files
    that are there.
    """
    for name, (schema, key) in tables.items():
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        place = f"{path}/{name}"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {_table_name(place)} ({columns}) USING parquet "
            f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{place}'"
        )
    return {name: spark.table(_table_name(f"{path}/{name}")) for name in tables}


def _table_name(place: str) -> str:
    return "together_" + "".join(c if c.isalnum() else "_" for c in place).strip("_").lower()
