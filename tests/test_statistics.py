"""Aggregates, distributions, relations and tests against plain formulas."""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from skylag.functions.student_t import greater_p, two_sided_p, upper_critical
from skylag.operators import aggregates as A
from skylag.operators import distributions as D
from skylag.operators import hypothesis as H
from skylag.operators import profiles as P
from skylag.operators import relations as R
from skylag.operators.quantiles import summarise

from .conftest import plan

PROBABILITIES = (0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0)


def sample(kind: str, n: int = 3000) -> list[float]:
    rng = random.Random(7)
    if kind == "hot":  # a third of all rows share one value
        return [0.0 if rng.random() < 0.34 else rng.gauss(0, 1) for _ in range(n)]
    if kind == "spread":  # many orders of magnitude
        return [math.exp(rng.uniform(-40, 40)) for _ in range(n)]
    if kind == "outlier":
        return [rng.random() for _ in range(n - 1)] + [1e300]
    if kind == "constant":
        return [3.5] * n
    return [float(rng.randint(-50, 200)) for _ in range(n)]


@pytest.mark.parametrize("kind", ["hot", "spread", "outlier", "constant", "integer"])
@pytest.mark.parametrize("count_singly", [20_000, 40])
def test_exact_quantiles(spark, kind, count_singly):
    values = sample(kind)
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    (s,) = summarise(df, ["v"], PROBABILITIES, buckets=16, count_singly=count_singly)
    assert s.count == len(values)
    assert s.quantiles == pytest.approx(list(np.quantile(values, PROBABILITIES)), rel=1e-12, abs=1e-300)


def test_exact_quantiles_by_group(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", None]), rng.gauss(0, 5), float(rng.randint(0, 9))) for _ in range(2000)]
    df = spark.createDataFrame(rows, "g string, x double, y double")
    found = {(s.group, s.column): s for s in summarise(df, ["x", "y"], by="g", count_singly=10)}
    assert len(found) == 6
    for (group, name), s in found.items():
        values = [r[1 if name == "x" else 2] for r in rows if r[0] == group]
        assert s.quantiles == pytest.approx(list(np.quantile(values, (0.25, 0.5, 0.75))))


def test_describe_lists_empty_columns(spark):
    df = spark.createDataFrame([(None, 1.0)], "a double, b double")
    rows = {r["column"]: r for r in P.describe_numeric(df).collect()}
    assert rows["a"]["count"] == 0 and rows["a"]["q50"] is None
    assert rows["b"]["q50"] == 1.0 and rows["b"]["std"] is None


def test_describe_text_ties(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), ("b",), (None,)], "s string")
    assert tuple(P.describe_text(df).first()) == ("s", 4, 2, "a", 2)


def test_group_keys_and_missing_delays(spark):
    df = spark.createDataFrame([(1, 10.0), (1, None), (None, 5.0), (2, -1.0)], "FL_MONTH int, ARR_DELAY double")
    assert {r["FL_MONTH"]: (r["avg_delay"], r["flights"]) for r in A.delay_by_month(df).collect()} == {1: (10.0, 2), 2: (-1.0, 1)}
    assert {r["FL_MONTH"]: r["delay_rate"] for r in A.delay_rate(df, ["FL_MONTH"]).collect()} == {1: 50.0, 2: 0.0}


def test_top_ties_follow_the_key(spark):
    df = spark.createDataFrame([(k, 1.0) for k in "dbcae" for _ in range(3)], "ROUTE string, ARR_DELAY double")
    assert [r["ROUTE"] for r in A.route_delay_rate(df, 3, 2).collect()] == ["a", "b", "c"]
    assert A.route_delay_rate(df, 3, 4).count() == 0


def test_missing_column_raises(spark):
    with pytest.raises(ValueError):
        A.delay_by_month(spark.range(1))


def test_top_k_plan(clean):
    text = plan(A.route_delay_rate(clean))
    assert "TakeOrderedAndProject" in text and "partial_avg" in text


def test_wide_matrix_needs_no_extra_job(clean):
    assert len(A.delay_month_matrix(clean).columns) == 13


def test_histogram_is_complete(clean):
    rows = D.delay_histogram(clean).collect()
    assert len(rows) == 80 and sum(r["n"] for r in rows) == clean.count()


def test_histogram_of_a_constant(spark):
    rows = D.histogram(spark.createDataFrame([(2.0,)] * 5, "v double"), ["v"], 4).orderBy("bin").collect()
    assert [r["n"] for r in rows] == [0, 0, 5, 0]


@pytest.mark.parametrize("rule", ["scott", "nrd0"])
def test_density_matches_formula_and_integrates(spark, rule):
    rng = random.Random(1)
    values = [float(rng.randint(0, 60)) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    rows = D.density(df, "v", grid=200, cut=6.0, rule=rule).orderBy("point").collect()
    x, y = np.array([r["x"] for r in rows]), np.array([r["density"] for r in rows])
    assert float(((y[1:] + y[:-1]) / 2 * np.diff(x)).sum()) == pytest.approx(1, abs=1e-3)
    sd = np.std(values, ddof=1)
    q1, q3 = np.quantile(values, (0.25, 0.75))
    bw = sd * 500**-0.2 if rule == "scott" else 0.9 * min(sd, (q3 - q1) / 1.34) * 500**-0.2
    direct = np.exp(-0.5 * ((x[:, None] - np.array(values)) / bw) ** 2).sum(1) / (500 * bw * math.sqrt(2 * math.pi))
    assert y == pytest.approx(direct, rel=1e-9, abs=1e-15)


def test_density_far_values_are_zero_not_missing(spark):
    df = spark.createDataFrame([(0.0,)] * 5000 + [(1.0,)] * 5000 + [(1e6,)], "v double")
    rows = D.density(df.where("v < 2"), "v", grid=50, cut=500.0).collect()
    assert len(rows) == 50 and min(r["density"] for r in rows) == 0.0


def test_box_stats(spark):
    values = [1.0, 2.0, 3.0, 4.0, 5.0, 100.0]
    row = D.box_stats(spark.createDataFrame([(v,) for v in values], "v double"), ["v"], {}).first()
    assert (row["q1"], row["median"], row["q3"]) == (2.25, 3.5, 4.75)
    assert (row["whisker_low"], row["whisker_high"], row["outliers"], row["n"]) == (1.0, 5.0, 1, 6)


def test_box_stats_sketch_is_close(clean):
    exact = D.box_stats(clean, ["DISTANCE"]).first()
    sketch = D.box_stats(clean, ["DISTANCE"], approximate=True).first()
    assert sketch["median"] == pytest.approx(exact["median"], rel=0.01)


def test_season_box_groups(clean):
    assert {r["SEASON"] for r in D.season_box(clean).collect()} == {1, 2, 3, 4}


def test_cyclical_points_are_few(clean):
    rows = D.cyclical_points(clean).collect()
    assert len(rows) <= 2880 and sum(r["n"] for r in rows) == 2 * clean.count()


def matrix(df):
    return {(r["var1"], r["var2"]): r[2] for r in df.collect()}


def test_correlations_with_gaps(spark):
    rng = random.Random(5)
    rows = []
    for _ in range(400):
        x = rng.gauss(1000, 2)
        rows.append((x, None if rng.random() < 0.2 else x + rng.gauss(0, 1), None if rng.random() < 0.3 else -x + rng.gauss(0, 5), 7.1))
    got = matrix(R.correlation_matrix(spark.createDataFrame(rows, "a double, b double, c double, k double"), ["a", "b", "c", "k"]))
    data = np.array([[np.nan if v is None else v for v in r] for r in rows])
    for i, p in enumerate("abc"):
        for j, q in enumerate("abc"):
            both = ~np.isnan(data[:, i]) & ~np.isnan(data[:, j])
            assert got[p, q] == pytest.approx(np.corrcoef(data[both, i], data[both, j])[0, 1], abs=1e-12)
    assert all(got[p, "k"] is None and got["k", p] is None for p in "abck")


def test_correlation_is_symmetric(clean):
    got = matrix(R.correlation_matrix(clean))
    assert all(got[a, b] == got[b, a] for a, b in got)
    assert all(v == 1.0 for (a, b), v in got.items() if a == b)


def test_fit_line(spark):
    rng = random.Random(9)
    x = [rng.uniform(0, 10) for _ in range(50)]
    y = [2 + 3 * v + rng.gauss(0, 1) for v in x]
    df = spark.createDataFrame(list(zip(x, y)), "x double, y double")
    row = R.fit_line(df, "x", "y", None).first()
    slope, intercept = np.polyfit(x, y, 1)
    residual = math.sqrt(((np.array(y) - intercept - slope * np.array(x)) ** 2).sum() / 48)
    sxx = ((np.array(x) - np.mean(x)) ** 2).sum()
    assert (row["slope"], row["intercept"]) == pytest.approx((slope, intercept))
    assert row["residual_se"] == pytest.approx(residual)
    assert row["slope_se"] == pytest.approx(residual / math.sqrt(sxx))
    band = R.line_band(df, "x", "y", 80, None).collect()
    assert len(band) == 80 and all(r["low"] < r["fit"] < r["high"] for r in band)


def test_fit_on_a_constant_column(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (1.0, 4.0)], "x double, y double")
    assert R.fit_line(df, "x", "y", None).first()["slope"] is None


@pytest.mark.parametrize(
    ("t", "df", "p"),
    [(12.70620474, 1, 0.05), (2.228138852, 10, 0.05), (4.604094871, 4, 0.01), (1.959963985, 1e9, 0.05), (0.0, 7, 1.0), (1000.0, 1e6, 0.0)],
)
def test_p_values(spark, t, df, p):
    row = spark.range(1).select(
        two_sided_p(F.lit(t), F.lit(float(df))).alias("two"),
        two_sided_p(F.lit(-t), F.lit(float(df))).alias("mirror"),
        greater_p(F.lit(t), F.lit(float(df))).alias("up"),
        greater_p(F.lit(-t), F.lit(float(df))).alias("down"),
    ).first()
    assert row["two"] == pytest.approx(p, abs=1e-7) and row["mirror"] == pytest.approx(p, abs=1e-7)
    assert row["up"] == pytest.approx(p / 2 if t > 0 else 0.5, abs=1e-7)
    assert row["up"] + row["down"] == pytest.approx(1.0)


def test_upper_critical(spark):
    row = spark.range(1).select(upper_critical(F.lit(30)).alias("a"), upper_critical(F.lit(1000)).alias("b")).first()
    assert (row["a"], row["b"]) == pytest.approx((2.042272, 1.962339), abs=1e-5)


def test_upper_critical_of_few(spark):
    # textbook values
    wanted = {1: 12.706205, 2: 4.302653, 3: 3.182446, 5: 2.570582, 10: 2.228139, 20: 2.085963, 30: 2.042272}
    row = spark.range(1).select(*[upper_critical(F.lit(k)).alias(str(k)) for k in wanted]).first()
    assert {k: row[str(k)] for k in wanted} == pytest.approx(wanted, abs=2e-6)


@pytest.mark.parametrize("extra", [[float("inf")], [float("-inf")], [1.7e308, -1.7e308], [2.0**k for k in range(-1000, 1000, 7)]])
def test_quantiles_end_for_any_double(spark, extra):
    values = [float(i) for i in range(20_001)] + extra
    df = spark.createDataFrame([(v,) for v in values], "v double")
    (found,) = summarise(df, ["v"], count_singly=50)
    ordered = sorted(values)
    for p, q in zip((0.25, 0.5, 0.75), found.quantiles):
        at = p * (len(ordered) - 1)
        low = ordered[int(at)]
        assert q == pytest.approx(low + (ordered[min(int(at) + 1, len(ordered) - 1)] - low) * (at - int(at)))


def test_welch_by_hand(spark):
    a, b = [1.0, 2.0, 3.0, 4.0], [2.0, 4.0, 9.0]
    rows = [(1, v) for v in a] + [(0, v) for v in b] + [(1, None)]
    row = H.welch_weekend(spark.createDataFrame(rows, "IS_WEEKEND int, ARR_DELAY double")).first()
    va, vb = np.var(a, ddof=1) / 4, np.var(b, ddof=1) / 3
    assert row["t"] == pytest.approx((np.mean(a) - np.mean(b)) / math.sqrt(va + vb))
    assert row["df"] == pytest.approx((va + vb) ** 2 / (va**2 / 3 + vb**2 / 2))
    assert (row["n_first"], row["n_second"], row["decision"]) == (4, 3, "FAIL TO REJECT")


def test_empty_era_is_flagged(spark):
    df = spark.createDataFrame([(2022, 1.0), (2023, 2.0)], "FL_YEAR int, ARR_DELAY double")
    row = H.welch_era(df).first()
    assert (row["decision"], row["t"], row["p_value"]) == ("NOT ENOUGH DATA", None, None)
    with pytest.raises(ValueError):
        H.welch_era(df.drop("FL_YEAR"))


def test_clear_difference_is_rejected(spark):
    rows = [(2019, float(i % 5)) for i in range(100)] + [(2022, float(i % 5 + 3)) for i in range(100)]
    row = H.welch_era(spark.createDataFrame(rows, "FL_YEAR int, ARR_DELAY double")).first()
    assert (row["decision"], row["direction"]) == ("REJECT", "higher") and row["p_value"] < 1e-9


def test_era_filter_reaches_the_scan(spark, clean, tmp_path):
    from skylag.sources.files import write_parquet

    path = write_parquet(clean, str(tmp_path / "clean"))
    text = plan(H.welch_era(spark.read.parquet(path)))
    assert re.search(r"PartitionFilters: \[[^\]]*FL_YEAR", text)
