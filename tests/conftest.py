from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from skylag.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 4, "4g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def raw(spark):
    from skylag.sources import star

    return star.flights(spark, SMALL).persist()


@pytest.fixture(scope="session")
def clean(raw):
    from skylag.plans.cleaning import clean_flights

    return clean_flights(raw).persist()


def plan(df) -> str:
    """The physical plan as text."""
    return df._jdf.queryExecution().executedPlan().toString()


def column(df, name: str) -> list:
    return [r[name] for r in df.collect()]
