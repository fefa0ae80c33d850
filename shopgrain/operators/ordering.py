"""A total order of rows, cut into buckets of similar size.

Rows are ordered by some values, absent ones first, then by a unique id. Bounds
between buckets come from a sample chosen by a hash of the id; the bucket of a
row then depends on the row alone, so a task that runs again gives the same
answer. Bounds include the id: a value that half of the rows share is cut like
any other stretch of the order.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS_PER_BUCKET = 500_000
MIN_BUCKETS = 4
SAMPLE_ROWS = 20_000
#: At most one row in so many is sampled, also of small frames.
LEAST_RATE = 8
FEW = 8

# The values and id of a row as text; Spark casts them back.
Place = tuple[str | None, ...]


def bucket_count(rows: int) -> int:
    return max(MIN_BUCKETS, -(-rows // ROWS_PER_BUCKET))


class Order:
    """Rows of a frame by `values`, then `ident`, all ascending."""

    def __init__(self, frame: DataFrame, values: Sequence[str], ident: str):
        self.columns = [*values, ident]
        self.types = [frame.schema[name].dataType for name in self.columns]

    @cached_property
    def position(self) -> Column:
        """What rows are compared by."""
        return F.struct(*[F.col(name).alias(f"p{at}") for at, name in enumerate(self.columns)])

    def literal(self, place: Place) -> Column:
        typed = [F.lit(value).cast(kind) for value, kind in zip(place, self.types)]
        return F.struct(*typed)

    def as_text(self, position: Column) -> Column:
        return F.struct(*[position[f"p{at}"].cast("string").alias(f"p{at}") for at in range(len(self.columns))])

    def places_before(self, places: Sequence[Place]) -> Column:
        """How many of `places`, which are sorted, come before the row.

        Many are searched in two steps, first among every n-th, then within one stretch.
        """
        if not places:
            return F.lit(0)
        if len(places) <= FEW:
            return reduce(Column.__add__, [(self.position > self.literal(p)).cast("int") for p in places])
        step = math.isqrt(len(places) - 1) + 1
        every = F.array(*map(self.literal, places[step - 1 :: step]))
        passed = F.size(F.filter(every, lambda place: place < self.position)) * step
        stretch = F.slice(F.array(*map(self.literal, places)), passed + 1, F.lit(step))
        return passed + F.size(F.filter(stretch, lambda place: place < self.position))


def sampled_rate(rows: int) -> int:
    """One row in how many is sampled, so that a sample is bounded."""
    return max(LEAST_RATE, -(-rows // SAMPLE_ROWS))


def sample_bounds(
    frame: DataFrame, rows: int, key: Sequence[str], orders: Sequence[Order], buckets: int
) -> list[list[Place]]:
    """Bounds between buckets for each order, from one sample of bounded size.

    `key` names the columns that tell rows apart.
    """
    expected = rows // sampled_rate(rows)
    cuts = sorted({expected * cut // buckets for cut in range(1, buckets)})
    return rows_of_sample(frame, rows, key, orders, cuts)


def rows_of_sample(
    frame: DataFrame, rows: int, key: Sequence[str], orders: Sequence[Order], numbers: Sequence[int]
) -> list[list[Place]]:
    """Rows of the sorted sample by number from 0, for each order.

    Spark sorts the sample, so that bounds and comparisons share one order.
    Numbers past the end of the sample are left out.
    """
    sampled = frame.filter(F.pmod(F.xxhash64(*key), F.lit(sampled_rate(rows))) == 0)
    sorted_sample = sampled.agg(
        *[F.sort_array(F.collect_list(order.position)).alias(f"o{at}") for at, order in enumerate(orders)]
    )
    wanted = F.array(*map(F.lit, numbers))

    def picked(at: int, order: Order) -> Column:
        return F.transform(wanted, lambda number: order.as_text(F.get(f"o{at}", number))).alias(f"o{at}")

    picks = sorted_sample.select(*[picked(at, order) for at, order in enumerate(orders)]).first()
    return [[tuple(place) for place in places if place[-1] is not None] for places in picks]
