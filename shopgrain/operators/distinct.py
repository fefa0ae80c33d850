"""Distinct counts that can be stored and added up: exact bitmaps and sketches.

A state stands for the keys of a group of rows. States of days or channels are merged to
months, groups of channels or everything without another look at the rows.

* Bitmaps are exact. Integer keys, also as text, are bits in runs of 32,768 numbers; other
  keys stay as they are. Keys travel as numbers and meet by run, so that each bitmap is
  built in one place; merging is OR.
* Sketches have a bounded size and a known error: HyperLogLog for counts of unions, theta
  for counts of intersections and differences too.

Null keys are no keys. Empty groups have no state.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Binary logarithms of the sizes of sketches, and the error that nearly no estimate exceeds:
#: five and a half standard errors of an HLL state of that size.
LG_HLL, LG_THETA = 13, 14
HLL_BOUND = 0.05


# -- exact ---------------------------------------------------------------------


def key_bits(rows: DataFrame, key: str, by: Sequence[str]) -> DataFrame:
    """Exact states: (by, run, bits, other), one row per group and run, or per other key."""
    text = F.col(key).cast("string")
    number = text.try_cast("bigint")
    plain = number.isNotNull() & (number.cast("string") == text)
    keys = (
        rows.where(F.col(key).isNotNull())
        .select(*by, F.when(plain, number).alias("_number"), F.when(~plain, text).alias("other"))
        .distinct()  # first of all in each task, so a key that most rows have travels once per task
        .withColumn("run", F.bitmap_bucket_number("_number"))
    )
    # Keys of a run come together as numbers; a bitmap per task and run would be far larger.
    return (
        keys.repartition("run", "other")
        .groupBy("run", "other", *by)
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_number")).alias("bits"))
        .select(*by, "run", F.when(F.col("other").isNull(), F.col("bits")).alias("bits"), "other")
    )


def merged_bits(states: DataFrame, by: Sequence[str]) -> DataFrame:
    """States of larger groups."""
    return states.groupBy("run", "other", *by).agg(F.bitmap_or_agg("bits").alias("bits")).select(*by, "run", "bits", "other")


def counted(states: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """Exact distinct counts per group of `by`, from states of these or smaller groups."""
    keys = F.when(F.col("other").isNull(), F.bitmap_count("bits")).otherwise(1)
    return merged_bits(states, by).groupBy(*by).agg(F.sum(keys).alias(name))


# -- sketches -------------------------------------------------------------------


def hll_states(rows: DataFrame, keys: Mapping[str, str], by: Sequence[str], lg: int = LG_HLL) -> DataFrame:
    """HyperLogLog states of several keys per group; `keys` maps names to columns."""
    return rows.groupBy(*by).agg(*[F.hll_sketch_agg(_text(column), lg).alias(name) for name, column in keys.items()])


def hll_merged(states: DataFrame, names: Sequence[str], by: Sequence[str]) -> DataFrame:
    """States of larger groups."""
    return states.groupBy(*by).agg(*[F.hll_union_agg(name).alias(name) for name in names])


def hll_counted(states: DataFrame, names: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Estimated distinct counts per group of `by`."""
    merged = hll_merged(states, names, by)
    return merged.select(*by, *[F.hll_sketch_estimate(name).alias(name) for name in names])


def theta_states(rows: DataFrame, key: str, by: Sequence[str], name: str, lg: int = LG_THETA) -> DataFrame:
    """Theta states per group: these can be intersected and subtracted."""
    return rows.groupBy(*by).agg(F.theta_sketch_agg(_text(key), lg).alias(name))


def kept(before: Column, now: Column) -> Column:
    """Estimated number of keys that both states hold."""
    return F.theta_sketch_estimate(F.theta_intersection(before, now))


def gained(before: Column, now: Column) -> Column:
    """Estimated number of keys that only the second state holds."""
    return F.theta_sketch_estimate(F.theta_difference(now, before))


def within(estimate: Column, exact: Column, bound: float = HLL_BOUND) -> Column:
    """Whether an estimate is as near as it should be; by one at least."""
    return F.abs(estimate - exact) <= F.greatest(F.lit(1.0), exact * bound)


def _text(column: str) -> Column:
    return F.col(column).cast("string")
