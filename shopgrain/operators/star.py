"""Joins of facts to dimensions that stay whole and stay spread out."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import vocabulary as words

NULL_KEY_BUCKETS = 1024


class DuplicateKeyError(ValueError):
    """A dimension holds a key more than once, so a join would repeat facts."""


def duplicate_keys(dim: DataFrame, key: str) -> DataFrame:
    """Keys that a dimension holds more than once, with their row counts."""
    counts = dim.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    return counts.filter(F.col("rows") > 1)


def check_keys(dims: Mapping[str, DataFrame], relationships: Mapping[str, tuple[str, Mapping[str, str]]]) -> None:
    """Refuse dimensions with a repeated key; one job per dimension, apart from the join."""
    for name, (key, _) in relationships.items():
        if not duplicate_keys(dims[name], key).isEmpty():
            raise DuplicateKeyError(f"{key} is not unique in {name}")


def guarded(dim: DataFrame, key: str, columns: Mapping[str, str]) -> DataFrame:
    """Attributes by key, as `_dim_key` and `_d_…`; a job that meets a repeated key fails.

    The dimension is folded by its key. The refusal is part of the key, so no plan can join
    without it. `_dim_bucket` is zero; it is taken from the row, as Spark folds a literal
    into the condition and would then deal the join by the key alone.
    """
    rows = dim.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.any_value(c).alias(f"_d_{n}") for c, n in columns.items()]
    )
    message = F.concat(F.lit(f"{key} is not unique in its dimension: "), F.col(key).cast("string"))
    refused = F.raise_error(message).cast(dim.schema[key].dataType)
    return rows.select(
        F.when(F.col("_rows") == 1, F.col(key)).otherwise(refused).alias("_dim_key"),
        (F.col("_rows") - 1).cast("int").alias("_dim_bucket"),
        *rows.columns[2:],
    )


def dimension_join(
    fact: DataFrame, dim: DataFrame, key: str, columns: Mapping[str, str], row_id: list[str]
) -> DataFrame:
    """Left join that keeps every fact row and repeats none: a repeated key stops the job.

    `columns` maps dimension columns to their names in the result. Facts without a
    partner get the unknown member in text columns. Nothing runs here: Spark chooses
    the join by its own statistics, and adaptive execution splits hot keys.

    Absent keys would all meet in one task of a shuffled join, so they are spread over
    buckets by `row_id`. The bucket is a second key: zero on the dimension and on present
    keys, so those meet as before; an absent key matches nothing whatever its bucket.
    """
    bucket = F.when(fact[key].isNull(), F.pmod(F.xxhash64(*row_id), F.lit(NULL_KEY_BUCKETS))).otherwise(0)
    left = fact.withColumn("_bucket", bucket.cast("int"))
    right = guarded(dim, key, columns)
    joined = left.join(
        right, (left[key] == right["_dim_key"]) & (left["_bucket"] == right["_dim_bucket"]), "left"
    )
    named = []
    for name in columns.values():
        found = F.col(f"_d_{name}")
        if isinstance(right.schema[f"_d_{name}"].dataType, T.StringType):
            found = F.coalesce(found, F.lit(words.UNKNOWN_MEMBER))
        named.append(found.alias(name))
    return joined.select(*fact.columns, *named)


def star_join(
    fact: DataFrame,
    dims: Mapping[str, DataFrame],
    relationships: Mapping[str, tuple[str, Mapping[str, str]]],
    row_id: list[str],
) -> DataFrame:
    """Fact rows with attributes of their dimensions; see `dimension_join`.

    `check_keys` refuses repeated keys before a job over the facts is started.
    """
    for name, (key, columns) in relationships.items():
        fact = dimension_join(fact, dims[name], key, columns, row_id)
    return fact


# Relationships of the facts: dimension, shared key, attributes and their names.
SALES_RELATIONSHIPS = {
    "dim_date": ("DateKey", {"YearQuarter": "YearQuarter"}),
    "dim_product": ("SKUCode", {"CategoryName": "CategoryName"}),
    "dim_store": ("StoreID", {"RegionName": "RegionName"}),
    "dim_employee": ("EmpID", {"Role": "EmployeeRole"}),
    "dim_customer": ("CustomerID", {"New_Gender": "CustomerGender"}),
}
TARGET_RELATIONSHIPS = {
    "dim_date": ("DateKey", {"YearQuarter": "YearQuarter"}),
    "dim_store": ("StoreID", {"RegionName": "RegionName", "OwnershipType": "OwnershipType"}),
}
