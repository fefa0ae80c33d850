"""NTILE over a whole frame without bringing its rows into one task.

A window ordered without a partition sorts every row in a single task. A tile
number only needs the last row of each tile, and those few rows can be found by
counting:

1. bounds from a sample cut the order into buckets (`ordering`);
2. one pass counts the rows per bucket, exactly;
3. the ends of the tiles fall into a few buckets; only their rows are numbered,
   each bucket on its own;
4. a row's tile is one plus the number of tile ends before it.

The sample only decides how even the buckets are; the result is exact, by the same
steps for any number of rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordering import Order, Place, bucket_count, sample_bounds


def tile_ends(rows: int, tiles: int) -> list[int]:
    """Number of the last row of each tile but the last; larger tiles come first."""
    size, larger = divmod(rows, tiles)
    return [tile * size + min(tile, larger) for tile in range(1, tiles)]


def add_tiles(
    frame: DataFrame, tiles: int, ident: str, scores: Mapping[str, str], buckets: int | None = None
) -> DataFrame:
    """Add one tile column per entry of `scores` (new column -> value column).

    `frame` is read several times and should be settled; its ids must be unique.
    The added columns are plain expressions: the result has no shuffle of its own.
    """
    rows = frame.count()
    if not rows:
        return frame.withColumns({name: F.lit(1) for name in scores})
    orders = {name: Order(frame, [value], ident) for name, value in scores.items()}
    last_rows = _rows_at(frame, rows, ident, tile_ends(rows, tiles), orders, buckets)
    return frame.withColumns(
        {name: F.lit(1) + order.places_before(ends) for (name, order), ends in zip(orders.items(), last_rows)}
    )


def _rows_at(
    frame: DataFrame, rows: int, ident: str, numbers: Sequence[int], orders: Mapping[str, Order], buckets: int | None
) -> list[list[Place]]:
    """The rows with the given numbers, from 1, in each order."""
    bounds = sample_bounds(frame, rows, [ident], list(orders.values()), buckets or bucket_count(rows))
    bucket_of = {
        name: order.places_before(cuts).cast("int") for (name, order), cuts in zip(orders.items(), bounds)
    }
    sizes = _bucket_sizes(frame, bucket_of)
    spots = {name: _within_buckets(numbers, sizes[name]) for name in orders}
    found = _rows_in_buckets(frame, spots, orders, bucket_of)
    return [[found[(name, *spot)] for spot in spots[name]] for name in orders]


def _bucket_sizes(frame: DataFrame, bucket_of: Mapping[str, Column]) -> dict[str, dict[int, int]]:
    """Exact number of rows per order and bucket, from one pass."""
    memberships = F.array(
        *[F.struct(F.lit(name).alias("name"), bucket.alias("bucket")) for name, bucket in bucket_of.items()]
    )
    counted = frame.select(F.explode(memberships).alias("m")).groupBy("m.name", "m.bucket").count().collect()
    sizes: dict[str, dict[int, int]] = {name: {} for name in bucket_of}
    for name, bucket, rows in counted:
        sizes[name][bucket] = rows
    return sizes


def _rows_in_buckets(
    frame: DataFrame,
    spots: Mapping[str, Sequence[tuple[int, int]]],
    orders: Mapping[str, Order],
    bucket_of: Mapping[str, Column],
) -> dict[tuple[str, int, int], Place]:
    """The rows at the wanted spots; only buckets that hold one are numbered."""
    branches = []
    for name, order in orders.items():
        window = Window.partitionBy("bucket").orderBy("position")
        numbered = (
            frame.select(bucket_of[name].alias("bucket"), order.position.alias("position"))
            .filter(F.col("bucket").isin({bucket for bucket, _ in spots[name]}))
            .withColumn("number", F.row_number().over(window))
        )
        hits = [(F.col("bucket") == bucket) & (F.col("number") == number) for bucket, number in set(spots[name])]
        branches.append(
            numbered.filter(reduce(Column.__or__, hits)).select(
                F.lit(name).alias("name"), "bucket", "number", order.as_text(F.col("position")).alias("place")
            )
        )
    return {
        (row["name"], row["bucket"], row["number"]): tuple(row["place"])
        for row in reduce(DataFrame.union, branches).collect()
    }


def _within_buckets(numbers: Sequence[int], sizes: Mapping[int, int]) -> list[tuple[int, int]]:
    """Bucket and number within it, for each number in the whole order."""
    buckets = sorted(sizes)
    through = list(accumulate(sizes[bucket] for bucket in buckets))
    spots = []
    for number in numbers:
        at = next(i for i, total in enumerate(through) if total >= number)
        spots.append((buckets[at], number - through[at] + sizes[buckets[at]]))
    return spots
