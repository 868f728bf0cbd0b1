"""Exact sums and averages against rational arithmetic."""

import math
import random
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tierline.functions import exact


def half_up(value: Fraction, digits: int) -> float:
    scaled = value * 10**digits
    sign = -1 if scaled < 0 else 1
    whole = int(abs(scaled) + Fraction(1, 2))
    return float(Decimal(sign * whole).scaleb(-digits))


def aggregate(spark, groups, digits=2):
    rows = [(g, v) for g, values in groups.items() for v in values]
    df = spark.createDataFrame(rows, "g string, x double").repartition(7)
    partial = df.groupBy("g").agg(*exact.partials(["x"]))
    result = partial.select(
        "g", exact.total("x", digits).alias("s"), exact.average("x", digits).alias("a")
    )
    return {r["g"]: (r["s"], r["a"]) for r in result.collect()}


@pytest.mark.parametrize("digits", [0, 1, 2, 4])
def test_random_groups(spark, digits):
    rng = random.Random(11)
    groups = {
        f"g{i}": [rng.randint(-(10**7), 10**7) / rng.choice([1, 10, 100, 10000]) for _ in range(40)]
        for i in range(60)
    }
    got = aggregate(spark, groups, digits)
    for name, values in groups.items():
        total = sum((Fraction(str(v)) for v in values), Fraction(0))
        assert got[name] == (half_up(total, digits), half_up(total / len(values), digits))


def test_half_cents_round_away_from_zero(spark):
    got = aggregate(spark, {"up": [1.0, 1.01], "down": [-1.0, -1.01], "tie": [0.125, 0.125]})
    assert got["up"] == (2.01, 1.01)
    assert got["down"] == (-2.01, -1.01)
    assert got["tie"] == (0.25, 0.13)


def test_nulls_do_not_count(spark):
    got = aggregate(spark, {"some": [None, 2.0, 4.0], "none": [None, None]})
    assert got["some"] == (6.0, 3.0)
    assert got["none"] == (None, None)


def test_values_without_exact_form_use_double_sums(spark):
    got = aggregate(
        spark,
        {
            "nan": [1.0, math.nan],
            "inf": [1.0, math.inf],
            "huge": [1e300, 1.0],
            "past_bigint": [9.0e14] * 3,
        },
    )
    assert math.isnan(got["nan"][0]) and math.isnan(got["nan"][1])
    assert got["inf"] == (math.inf, math.inf)
    assert got["huge"] == (1e300, 5e299)
    assert got["past_bigint"] == (2.7e15, 9.0e14)


def test_no_digit_is_dropped(spark):
    rows = spark.range(1_000_000).select(F.lit("g").alias("g"), F.lit(0.00004).alias("x"))
    partial = rows.groupBy("g").agg(*exact.partials(["x"]))
    assert partial.select(exact.total("x")).first()[0] == 40.0
    got = aggregate(spark, {"twice": [1.00496, 1.00496], "tie": [0.00125] * 4, "tiny": [1e-20] * 3})
    assert got["twice"] == (2.01, 1.0)
    assert got["tie"] == (0.01, 0.0)
    assert got["tiny"] == (0.0, 0.0)


@pytest.mark.parametrize("decimals", [0, 2, 4])
def test_many_decimals_and_any_unit(spark, decimals):
    rng = random.Random(5)
    groups = {f"g{i}": [rng.randint(-(10**9), 10**9) / 10**6 for _ in range(30)] for i in range(40)}
    rows = [(g, v) for g, values in groups.items() for v in values]
    df = spark.createDataFrame(rows, "g string, x double").repartition(5)
    partial = df.groupBy("g").agg(*exact.partials(["x"], decimals))
    result = partial.select(
        "g", exact.total("x", 3, decimals).alias("s"), exact.average("x", 3, decimals).alias("a")
    )
    for r in result.collect():
        total = sum((Fraction(str(v)) for v in groups[r["g"]]), Fraction(0))
        assert (r["s"], r["a"]) == (half_up(total, 3), half_up(total / 30, 3))


def test_large_values_add_up_the_same_in_any_order(spark):
    values = [9.0e10, -9.0e10, 9.0e10, 0.01, 9.9e10] * 50
    orders = [sorted(values), sorted(values, reverse=True), values]
    results = {aggregate(spark, {"g": order})["g"] for order in orders}
    total = sum((Fraction(str(v)) for v in values), Fraction(0))
    assert results == {(half_up(total, 2), half_up(total / len(values), 2))}


def test_digits_out_of_range():
    with pytest.raises(ValueError):
        exact.total("x", 15)


def test_large_and_long_values_add_up_the_same_in_any_order(spark):
    values = [1e16, 3e11 + 0.25, -1e16, 7e12 + 0.5]
    orders = [values, values[::-1], sorted(values), sorted(values, key=abs)]
    assert {aggregate(spark, {"g": order})["g"] for order in orders} == {
        (7300000000000.75, 1825000000000.19)
    }
    rng = random.Random(3)
    wild = [rng.choice([-1, 1]) * rng.random() * 10 ** rng.randint(-12, 21) for _ in range(300)]
    wild += [9.9e21, -9.9e21, 0.1, 1 / 3, -0.0]
    results = set()
    for seed in range(4):
        random.Random(seed).shuffle(wild)
        results.add(aggregate(spark, {"g": wild}, 6)["g"])
    assert len(results) == 1
    assert results.pop()[0] == pytest.approx(float(sum(map(Fraction, wild))), rel=1e-12)


def test_arbitrary_doubles_are_near_their_exact_sum(spark):
    rng = random.Random(8)
    groups = {f"g{i}": [rng.uniform(-1000, 1000) for _ in range(200)] for i in range(20)}
    for name, (total, mean) in aggregate(spark, groups, 6).items():
        want = sum(map(Fraction, groups[name]))
        assert abs(Fraction(total) - want) < Fraction(1, 10**6)
        assert abs(Fraction(mean) - want / 200) < Fraction(1, 10**6)
