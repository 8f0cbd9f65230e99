"""Exact quantiles and gaps from counts of value ranges, against sorted lists."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendframe.functions import radix
from lendframe.functions.radix import Distributions

NAN, INF = float("nan"), float("inf")
PROBS = [0.0, 0.01, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99, 1.0]


def columns(n=1200):
    rng = np.random.default_rng(1)
    out = {
        "uniform": rng.random(n),
        "amounts": np.exp(rng.normal(8, 2, n)),
        "magnitudes": np.exp(rng.normal(0, 150, n)) * rng.choice([-1, 1], n),
        "hot": np.where(rng.random(n) < 0.5, 7.0, rng.normal(7, 1e-9, n)),
        "few": rng.integers(0, 3, n).astype(float),
        "constant": np.full(n, -4.5),
        "close": 1e15 + rng.integers(0, 50, n) * 0.125,
        "denormal": rng.integers(-5, 5, n) * 5e-324,
        "zeros": np.where(rng.random(n) < 0.5, 0.0, -0.0),
        "extremes": rng.choice([1.7e308, -1.7e308, 0.0, INF, -INF], n),
        "nulls": np.where(rng.random(n) < 0.3, np.nan, rng.normal(size=n)),
    }
    return {k: v.tolist() for k, v in out.items()}


@pytest.fixture(scope="module")
def both(spark):
    data = columns()
    rows = [tuple(None if x != x else x for x in r) for r in zip(*data.values())]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in data)).withColumn("id", F.monotonically_increasing_id()).cache()
    side = (F.xxhash64("id") % 3 == 0).cast("int")
    return df.withColumns({"a": side, "b": 1 - side}).cache(), data


@pytest.mark.parametrize("digits,parts,open_", [(1 << 18, 2048, 4096), (64, 16, 60)])
def test_quantiles_equal_a_sort(both, monkeypatch, digits, parts, open_):
    monkeypatch.setattr(radix, "DIGITS", digits)
    monkeypatch.setattr(radix, "PARTS", parts)
    monkeypatch.setattr(radix, "OPEN", open_)
    df, data = both
    got = Distributions(df, data, ["a", "b"]).quantiles("a", PROBS)
    rows = df.where("a = 1").collect()
    for c in data:
        values = sorted(r[c] + 0.0 for r in rows if r[c] is not None)
        for p, x in zip(PROBS, got[c]):
            spot = (len(values) - 1) * p
            i = math.floor(spot)
            want = radix.interpolated(values[i], values[min(i + 1, len(values) - 1)], spot - i)
            assert x == want or math.isnan(x) and math.isnan(want), (c, p, x, want)


@pytest.mark.parametrize("digits,parts,open_", [(1 << 18, 2048, 4096), (64, 16, 60)])
def test_largest_gap_equals_a_scan(both, monkeypatch, digits, parts, open_):
    monkeypatch.setattr(radix, "DIGITS", digits)
    monkeypatch.setattr(radix, "PARTS", parts)
    monkeypatch.setattr(radix, "OPEN", open_)
    df, data = both
    got = Distributions(df, data, ["a", "b"]).largest_gaps("a", "b")
    rows = df.collect()
    for c in data:
        a, b = (np.sort([r[c] for r in rows if r[c] is not None and r[s] == 1]) for s in "ab")
        every = np.unique(np.concatenate([a, b]))
        want = np.abs(np.searchsorted(a, every, "right") / len(a) - np.searchsorted(b, every, "right") / len(b)).max()
        assert got[c] == pytest.approx(want, abs=1e-15)


def test_nan_is_the_largest_value_and_empty_columns_are_left_out(spark):
    df = spark.createDataFrame([(1, 1.0, None), (1, NAN, None), (1, 2.0, None)], "n int, x double, y double")
    got = Distributions(df, ["x", "y"], ["n"]).quantiles("n", [0.0, 0.5, 1.0])
    assert set(got) == {"x"} and got["x"][:2] == [1.0, 2.0] and math.isnan(got["x"][2])


def test_only_deciding_cells_are_shuffled(spark):
    """Of 60,000 different values a few thousand counts reach the exchange, not the cells."""
    df = spark.range(60_000, numPartitions=3).select((F.xxhash64("id") / 1e6).alias("x"), F.lit(1).alias("n"))
    d = Distributions(df, ["x"], ["n"])
    assert d.first.count() < 6000
    seen = []
    real = d._looked_into
    d._looked_into = lambda known, parts: seen.append((parts, sum(sum(r.counts) for x in known.values() for r in x))) or real(known, parts)
    d.quantiles("n", [0.1, 0.5, 0.9])
    assert seen and all(rows < 6000 for parts, rows in seen)
