"""The report from shared scans against every table made by itself."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from skylag.operators.sampling import balance_by_delay
from skylag.plans import report
from skylag.plans.report import Floors, report_tables, write_report

FLOORS = Floors(3, 40, 60, 7)


@pytest.fixture(scope="module")
def gappy(clean):
    """Rows with missing and negative delays, missing keys and distances, and a flag."""
    k = F.crc32(F.col("FLIGHT_ID").cast("binary"))
    return clean.withColumns(
        {
            "ARR_DELAY": F.when(k % 11 == 0, None).when(k % 13 == 0, -5.0).otherwise(F.col("ARR_DELAY")),
            "DISTANCE": F.when(k % 17 != 0, F.col("DISTANCE")),
            "ORIGIN_CITY": F.when(k % 19 != 0, F.col("ORIGIN_CITY")),
            "FL_MONTH": F.when(k % 23 != 0, F.col("FL_MONTH")),
            "SEASON": F.when(k % 7 != 0, F.col("SEASON")),
            "CRS_DEP_TIME_sin": F.when(k % 29 != 0, F.col("CRS_DEP_TIME_sin")),
            "CANCELLED": (k % 31 == 0).cast("double"),
        }
    )


def rounded(df):
    def cell(v):
        return float(f"{v:.9g}") if isinstance(v, float) else v

    columns = sorted(df.columns)
    return sorted((tuple(cell(r[c]) for c in columns) for r in df.collect()), key=repr), columns


def compare(spark, source, wanted_source, folder, **more):
    write_report(source, folder, FLOORS, **more)
    for name, build in report_tables(FLOORS).items():
        got, columns = rounded(spark.read.parquet(f"{folder}/{name}"))
        wanted, expected = rounded(build(wanted_source))
        assert columns == expected, name
        assert len(got) == len(wanted), name
        for a, b in zip(got, wanted):
            for x, y in zip(a, b):
                assert x == (pytest.approx(y, rel=1e-6, abs=1e-9) if isinstance(y, float) else y), (name, a, b)


def test_shared_scans_give_the_same_tables(spark, gappy, tmp_path):
    compare(spark, gappy, gappy, str(tmp_path / "report"))


def test_balanced_report(spark, clean, tmp_path):
    minor = clean.withColumn("ARR_DELAY", F.when(F.col("ARR_DELAY") <= 15, 0.0).otherwise(F.col("ARR_DELAY")))
    wanted = balance_by_delay(minor)
    assert 0 < wanted.count() < minor.count()
    compare(spark, minor, wanted, str(tmp_path / "report"), balanced=True)


def test_five_scans(spark, clean, tmp_path, monkeypatch):
    """The numeric tables sweep the rows four times, all delay tables come from one aggregate."""
    sweeps = []
    real = report.sweep
    counting = lambda rows, *parts, **more: sweeps.append(len(parts)) or real(rows, *parts, **more)
    monkeypatch.setattr(report, "sweep", counting)
    monkeypatch.setattr(report.Q, "sweep", counting)
    tallies = []
    real_tally = report.tally
    monkeypatch.setattr(report, "tally", lambda df: tallies.append(1) or real_tally(df))
    write_report(clean, str(tmp_path / "report"), Floors(1, 1, 1))
    assert len(sweeps) <= 4 and len(tallies) == 1


def test_identifiers_do_not_fill_the_tally(spark, clean, tmp_path, monkeypatch):
    """Tasks add up their rows by key, and the identifiers, each its own key, are counted apart."""
    stored, keep = {}, report.materialise
    monkeypatch.setattr(report, "materialise", lambda df, name: stored.setdefault(name, keep(df, name)))
    write_report(clean, str(tmp_path / "report"), FLOORS)
    assert 0 < stored["tally"].count() < clean.count()
    text = {r["column"]: r for r in spark.read.parquet(str(tmp_path / "report" / "describe_text")).collect()}
    assert text["FLIGHT_ID"]["unique"] == clean.count() and len(text) == 6


def test_tally_hands_out_many_keys(clean, monkeypatch):
    """A task that holds too many keys hands them out, and nothing is lost or counted twice."""
    whole = rounded(report.tally(clean))
    monkeypatch.setattr(report, "HELD_KEYS", 50)
    assert rounded(report.tally(clean)) == whole


def test_charts_are_derived_within_the_tasks(spark):
    """Clipped, seasonal and known-only columns do not leave the JVM; they have the values of the SQL expressions."""
    from pyspark.sql import functions as F

    from skylag.functions import columns as C
    from skylag.operators.partials import moments, sweep
    from skylag.plans import report

    rows = [("a", 10.0, 500.0, 1, 70.0, 2.0, None), ("b", None, 3.0, 2, 80.0, 0.5, "x"), ("c", -90.0, None, 1, None, 9.0, "y"), (None, 400.0, 4000.0, None, 500.0, None, "z"), ("d", -1.0, 7.0, 4, float("nan"), 1.5, "x")]
    few = spark.createDataFrame(rows, "name string, ARR_DELAY double, DISTANCE double, SEASON int, CRS_ELAPSED_TIME double, AVG_SPEED double, ROUTE string")
    swept = report._Swept(few)
    assert len(swept.rows.rows.columns) == 6 and len(swept.names) == 21
    one = report.Derived(swept.rows.rows.coalesce(1), swept.rows.made)
    found = {swept.names[r["i"]]: r for r in sweep(one, moments()).collect()}
    delay = C.clip(F.col("ARR_DELAY"), -60.0, 180.0)
    want = {
        "clipped delay": delay, "season 1": F.when(F.col("SEASON") == 1, delay), "season 4": F.when(F.col("SEASON") == 4, delay),
        "box CRS_ELAPSED_TIME": C.clip(F.col("CRS_ELAPSED_TIME"), 0.0, 400.0), "box AVG_SPEED": C.clip(F.col("AVG_SPEED"), 1.0, 6.0),
        "line DISTANCE": F.when(F.col("ARR_DELAY").isNotNull(), F.col("DISTANCE")), "all rows": F.lit(1.0), "negative": F.when(F.col("ARR_DELAY") < 0, 1.0),
        "known name": F.when(F.col("name").isNotNull(), 1.0), "known ROUTE": F.when(F.col("ROUTE").isNotNull(), 1.0),
        "incomplete": F.when(F.col("name").isNull() | F.col("ARR_DELAY").isNull() | F.col("DISTANCE").isNull() | F.col("SEASON").isNull() | F.col("CRS_ELAPSED_TIME").isNull() | F.col("AVG_SPEED").isNull() | F.col("ROUTE").isNull(), 1.0),
    }
    state = few.coalesce(1).select(*[w.alias(n) for n, w in want.items()]).toPandas()
    for name in want:
        known = state[name].dropna()
        assert (found[name]["n"], found[name]["low"], found[name]["high"]) == (len(known), known.min(), known.max()), name
