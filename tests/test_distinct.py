"""States of distinct counts: exact bitmaps, and sketches within their bounds."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from shopgrain.operators import distinct
from shopgrain.operators.settle import settle
from shopgrain.plans import reports

from .test_plans import plan_of

KEYS = ["1", "32768", "32769", "0", "-5", "007", "abc", "", "99999999999", "9" * 30, None, "1", "abc", "1.0", "é"]


def as_dict(frame, *by):
    return {tuple(row[b] for b in by): row[-1] for row in frame.collect()}


def test_bitmaps_count_every_kind_of_key(spark):
    rows = [(key, shop, day) for i, key in enumerate(KEYS) for shop in ("a", "b")[: 1 + i % 2] for day in range(1 + i % 3)]
    df = spark.createDataFrame(rows, "key string, shop string, day int")
    states = settle(distinct.key_bits(df, "key", ["shop", "day"]))
    for by in (["shop", "day"], ["shop"], ["day"], []):
        expected = df.groupBy(*by).agg(F.countDistinct("key").alias("n"))
        assert as_dict(distinct.counted(states, by, "n"), *by) == {k: n for k, n in as_dict(expected, *by).items() if n}
    merged = distinct.merged_bits(states, ["shop"])
    assert as_dict(distinct.counted(merged, [], "n")) == as_dict(df.agg(F.countDistinct("key")))
    numbers = df.select(F.length("key").alias("key"), "shop")
    assert distinct.counted(distinct.key_bits(numbers, "key", []), [], "n").first()[0] == numbers.agg(F.countDistinct("key")).first()[0]
    assert distinct.key_bits(df.limit(0), "key", ["shop"]).count() == 0


def test_bitmaps_are_built_where_their_run_lies(spark):
    plan = plan_of(distinct.key_bits(spark.range(10).select("id", F.lit(1).alias("g")), "id", ["g"]))
    assert plan.count("Exchange hashpartitioning") == 2  # different keys, then keys by run; no bitmaps
    assert plan.index("bitmap_construct_agg") < plan.index("Exchange hashpartitioning")


@pytest.fixture(scope="module")
def visits(spark):
    """Days with visitors; visitor 7 makes a third of all visits."""
    day, who = (F.col("id") % 30).cast("int"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.xxhash64("id") % 40_000)
    return spark.range(120_000).select(day.alias("day"), who.cast("string").alias("who"), F.lit(None).cast("string").alias("none"))


def test_sketches_of_days_give_those_of_months(visits):
    days = settle(distinct.hll_states(visits, {"w": "who", "x": "none"}, ["day"]))
    assert days.count() == 30
    for by in (["third"], []):
        dated = days.withColumn("third", (F.col("day") / 10).cast("int"))
        exact = visits.withColumn("third", (F.col("day") / 10).cast("int")).groupBy(*by).agg(F.countDistinct("who").alias("n"))
        near = as_dict(distinct.hll_counted(dated, ["w"], by), *by)
        for key, n in as_dict(exact, *by).items():
            assert abs(near[key] - n) <= distinct.HLL_BOUND * n
    assert distinct.hll_counted(days, ["x"], []).first()[0] == 0
    again = distinct.hll_merged(distinct.hll_merged(days.withColumn("half", F.col("day") % 2), ["w"], ["half"]), ["w"], [])
    assert again.select(F.hll_sketch_estimate("w")).first()[0] == distinct.hll_counted(days, ["w"], []).first()[0]


def test_theta_states_can_be_intersected(visits):
    week = visits.withColumn("week", (F.col("day") / 15).cast("int"))
    states = {r["week"]: r["s"] for r in distinct.theta_states(week, "who", ["week"], "s").collect()}
    pair = visits.sparkSession.createDataFrame([(states[0], states[1])], "a binary, b binary")
    kept, gained = pair.select(distinct.kept(F.col("a"), F.col("b")), distinct.gained(F.col("a"), F.col("b"))).first()
    one, two = (week.where(F.col("week") == w).select("who").distinct() for w in (0, 1))
    both, new = one.intersect(two).count(), two.exceptAll(one.intersect(two)).count()
    assert abs(kept - both) <= 0.05 * (both + new) and abs(gained - new) <= 0.05 * (both + new)


@pytest.mark.parametrize(("report", "exchanges"), [(reports.channel_breakdown, 3), (reports.total_revenue, 2)])
def test_orders_are_counted_where_they_were_joined(model, report, exchanges):
    """After the join by order, orders are not dealt again to be counted."""
    plan = plan_of(report(model))
    assert plan.count("Exchange hashpartitioning") == exchanges  # two for the join, one per channel
    assert "count(distinct" not in plan
