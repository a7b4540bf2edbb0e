"""Mergeable partial results against numpy: moments, bins, curves, ranks and whiskers, with few groups and many."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from skylag.operators import distributions as D
from skylag.operators import quantiles as Q
from skylag.operators import relations as R
from skylag.operators.partials import Part, _Curves, merged, moments, ordered_keys, sweep, wide

from .conftest import plan


def grouped_rows(groups, n=3000, seed=1):
    rng = random.Random(seed)
    keys = [f"g{k}" for k in range(groups)]
    rows = []
    for _ in range(n):
        hot = rng.random() < 0.34  # a third of the rows in one group
        value = None if rng.random() < 0.1 else rng.choice([rng.gauss(1e6, 3), float(rng.randint(0, 9)), 5.0])
        rows.append(("hot" if hot else rng.choice(keys), value))
    return rows + [("one", 2.0), ("none", None)]


def known(rows):
    out = {}
    for g, v in rows:
        if v is not None:
            out.setdefault(g, []).append(v)
    return out


@pytest.fixture(params=["few", "many"])
def held_rows(request, monkeypatch):
    """With no row to be held, settings are joined as a table, and states are handed out early."""
    if request.param == "many":
        monkeypatch.setattr(Q, "HELD_ROWS", 0)
    return request.param


def test_boxes_of_groups(spark, held_rows):
    rows = grouped_rows(300)
    df = spark.createDataFrame(rows, "g string, v double").repartition(3)
    got = {r["g"]: r for r in D.box_stats(df, ["v"], {}, by="g").collect()}
    wanted = known(rows)
    assert set(got) == set(wanted)
    for g, values in wanted.items():
        q1, q2, q3 = np.quantile(values, (0.25, 0.5, 0.75))
        low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        r = got[g]
        assert (r["q1"], r["median"], r["q3"]) == pytest.approx((q1, q2, q3))
        assert r["whisker_low"] == min(v for v in values if v >= low - 1e-9)
        assert r["whisker_high"] == max(v for v in values if v <= high + 1e-9)
        assert r["n"] == len(values)


def test_densities_of_groups(spark, held_rows):
    rows = [(g, v) for g, v in grouped_rows(6, 1500) if v is None or v < 1e5]
    rows += [("x", float(k)) for k in range(30)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(3)
    got = {}
    for r in D.density(df, "v", by="g", grid=40, cut=1.0).orderBy("point").collect():
        got.setdefault(r["g"], []).append((r["x"], r["density"]))
    wanted = {g: v for g, v in known(rows).items() if len(set(v)) > 1}
    assert set(got) == set(wanted)
    for g, values in wanted.items():
        x, y = np.array(got[g]).T
        bw = np.std(values, ddof=1) * len(values) ** -0.2
        assert (x[0], x[-1]) == pytest.approx((min(values) - bw, max(values) + bw))
        direct = np.exp(-0.5 * ((x[:, None] - np.array(values)) / bw) ** 2).sum(1) / (len(values) * bw * math.sqrt(2 * math.pi))
        assert y == pytest.approx(direct, rel=1e-9, abs=1e-14)


@pytest.mark.parametrize("spacing", [1e-3, 0.3, 1.0, 1.9, 2.1, 9.0, 80.0])
def test_curve_sums_on_fine_and_coarse_grids(spacing):
    rng = np.random.default_rng(3)
    values = rng.gamma(2, 3, (900, 1))
    low, step = values.min(), (values.max() - values.min()) / 99
    state = _Curves([(0, low, step, step / spacing)], 1, 100)
    for part in np.array_split(values, 4):
        state.add(part, np.ones(part.shape, bool))
    found, got = state.rows(), np.zeros(100)
    got[found["j"]] = found["x"]
    points = low + step * np.arange(100)
    direct = np.exp(-0.5 * ((points[:, None] - values[:, 0]) * spacing / step) ** 2).sum(1)
    assert got == pytest.approx(direct, rel=1e-9, abs=1e-12)


def test_moments_lose_nothing_far_from_zero(spark):
    rng = random.Random(4)
    rows = [(1e9 + rng.random(), rng.gauss(-1e8, 1e-3), None if rng.random() < 0.4 else 1.0) for _ in range(4000)]
    df = spark.createDataFrame(rows, "a double, b double, c double").repartition(7)
    found = R.pair_moments(df, ["a", "b", "c"])
    data = np.array([[np.nan if v is None else v for v in r] for r in rows])
    assert found.counts[0, 2] == found.counts[2, 2] == (~np.isnan(data[:, 2])).sum()
    exact = np.cov((data[:, :2] - data[0, :2]).T)
    for i in range(2):
        for j in range(2):
            assert found.covariance(i, j) == pytest.approx(exact[i, j], rel=1e-5, abs=1e-8)
    assert found.correlation(0, 2) is None and found.correlation(0, 0) == 1.0


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,), (None,), (3.0,)], "v double")
    (s,) = Q.summarise(df, ["v"])
    assert (s.count, s.mean, s.low, s.high, s.quantiles) == (2, 2.0, 1.0, 3.0, [1.5, 2.0, 2.5])


def test_keys_keep_the_order_of_doubles():
    values = np.array([-np.inf, -1e308, -1.5, -1e-320, -0.0, 0.0, 1e-320, 1.5, 1e308, np.inf])
    keys = ordered_keys(values)
    assert (np.diff(keys) >= 0).all() and (np.diff(keys) == 0).sum() == 1


def test_at_most_six_passes(spark, monkeypatch):
    passes = []
    monkeypatch.setattr(Q, "sweep", lambda rows, *parts, **more: passes.append(1) or sweep(rows, *parts, **more))
    rng = random.Random(6)
    values = [rng.choice([-1, 1]) * math.exp(rng.uniform(-700, 700)) for _ in range(4000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    (s,) = Q.summarise(df, ["v"], (0.1, 0.5), count_singly=0)
    assert s.quantiles == pytest.approx(list(np.quantile(values, (0.1, 0.5))))
    assert len(passes) <= 6


def test_one_scan_feeds_several_kinds(spark):
    df = spark.range(1000).select((F.col("id") % 10).cast("double").alias("v"))
    rows = wide(df, ["v"])
    both = sweep(rows, moments(), Part("bins", {"bins": 10}, [(0, 0.0, 1.0)]))
    assert {r["j"]: r["n"] for r in merged(both, "bins").collect()} == {k: 100 for k in range(10)}
    assert plan(both).count("MapInArrow") == 1
    assert sweep(rows.limit(0), moments()).count() == 0


def test_resampled_band(spark):
    rng = random.Random(8)
    rows = [(f"r{i}", x := rng.uniform(0, 10), 2 + 3 * x + rng.gauss(0, 4)) for i in range(400)] + [("gap", None, 1.0), ("gap2", 1.0, None)]
    df = spark.createDataFrame(rows, "FLIGHT_ID string, x double, y double")
    band = R.resampled_band(df, "x", "y", 20, None, replicates=300).orderBy("point").collect()
    again = R.resampled_band(df.repartition(5), "x", "y", 20, None, replicates=300).orderBy("point").collect()
    x, y = np.array([r[1:] for r in rows[:400]]).T
    slope, intercept = np.polyfit(x, y, 1)
    analytic = {r["point"]: r for r in R.line_band(df, "x", "y", 20, None).collect()}
    for r, other in zip(band, again):
        assert r["fit"] == pytest.approx(intercept + slope * r["x"])
        assert (r["low"], r["high"]) == pytest.approx((other["low"], other["high"]))
        wide_ = analytic[r["point"]]["high"] - analytic[r["point"]]["low"]
        assert r["low"] < r["fit"] < r["high"] and 0.75 * wide_ < r["high"] - r["low"] < 1.25 * wide_
    assert R.resampled_band(df.limit(0), "x", "y", 20, None).count() == 0
    flat = df.withColumn("x", F.lit(1.0))
    assert R.resampled_band(flat, "x", "y", 20, None).count() == 0


def test_full_summary(spark):
    from skylag.operators.profiles import full_summary

    rows = [(1, "b", None, True), (2, "a", 2.0, None), (4, "a", None, True), (None, None, None, None)]
    got = {r["column"]: r for r in full_summary(spark.createDataFrame(rows, "k int, s string, v double, f boolean")).collect()}
    assert [(got[c]["missing"], got[c]["count"]) for c in "ksvf"] == [(1, 3), (1, 3), (3, 1), (2, 2)]
    assert (got["s"]["unique"], got["s"]["top"], got["s"]["freq"]) == (2, "a", 2) and got["k"]["unique"] is None
    assert (got["k"]["q50"], got["v"]["mean"], got["f"]["mean"]) == (2.0, 2.0, None)
    assert {(r["rows"], r["columns"]) for r in got.values()} == {(4, 4)}
    empty = full_summary(spark.createDataFrame([], "k int, s string"))
    assert [(r["rows"], r["count"], r["unique"]) for r in empty.orderBy("position").collect()] == [(0, 0, None), (0, 0, 0)]
