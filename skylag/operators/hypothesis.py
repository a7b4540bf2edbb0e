"""Welch t-tests whose statistic, p-value and verdict are columns of one row."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.student_t import greater_p, two_sided_p
from ..schema import require

ALPHA = 0.05

# Years compared by the era test.
PRE_YEARS = (2019,)
POST_YEARS = (2022, 2023)


@dataclass(frozen=True)
class Comparison:
    """Two conditions over one value column, compared as first - second."""

    name: str
    value: str
    first: Column
    second: Column
    alternative: str = "two-sided"


def _sides(k: int, test: Comparison) -> list[Column]:
    measured = F.col(test.value).cast("double")
    out = []
    for side, condition in (("first", test.first), ("second", test.second)):
        value = F.when(condition, measured)
        out += [F.count(value).alias(f"n_{side}_{k}"), F.avg(value).alias(f"mean_{side}_{k}"), F.var_samp(value).alias(f"var_{side}_{k}")]
    return out


def compare(df: DataFrame, tests: Sequence[Comparison], alpha: float = ALPHA) -> DataFrame:
    """One row per comparison; both sides of all of them are measured in one aggregate.

    When a side has fewer than two values the statistic is NULL and the
    decision says so.
    """
    if any(t.alternative not in ("two-sided", "greater") for t in tests):
        raise ValueError("alternative must be 'two-sided' or 'greater'")
    either = reduce(lambda a, b: a | b, [t.first | t.second for t in tests])
    wide = df.where(either).agg(*[m for k, t in enumerate(tests) for m in _sides(k, t)])
    names = [f"{what}_{side}" for what in ("n", "mean", "var") for side in ("first", "second")]
    rows = [
        F.struct(F.lit(t.name).alias("test"), F.lit(t.alternative).alias("alternative"), *[F.col(f"{n}_{k}").alias(n) for n in names])
        for k, t in enumerate(tests)
    ]
    sums = wide.select(F.inline(F.array(*rows)))
    sums = sums.withColumns(
        {
            "e1": F.try_divide(F.col("var_first"), F.col("n_first")),
            "e2": F.try_divide(F.col("var_second"), F.col("n_second")),
        }
    )
    error = F.col("e1") + F.col("e2")
    freedom = F.try_divide(
        error * error,
        F.try_divide(F.col("e1") * F.col("e1"), F.col("n_first") - 1)
        + F.try_divide(F.col("e2") * F.col("e2"), F.col("n_second") - 1),
    )
    tested = sums.withColumns(
        {"t": F.try_divide(F.col("mean_first") - F.col("mean_second"), F.sqrt(error)), "df": freedom}
    )
    two, greater = two_sided_p(F.col("t"), F.col("df")), greater_p(F.col("t"), F.col("df"))
    tested = tested.withColumn("p_value", F.when(F.col("alternative") == "greater", greater).otherwise(two))
    decision = (
        F.when(F.col("p_value").isNull(), "NOT ENOUGH DATA")
        .when(F.col("p_value") < alpha, "REJECT")
        .otherwise("FAIL TO REJECT")
    )
    higher = F.col("mean_first") > F.col("mean_second")
    direction = F.when(F.col("p_value") < alpha, F.when(higher, "higher").otherwise("lower")).when(
        F.col("p_value").isNotNull(), "no significant difference"
    )
    return tested.select(
        "test", "alternative", "n_first", "n_second", "mean_first", "mean_second", "t", "df", "p_value",
        decision.alias("decision"), direction.alias("direction"),
    )


def welch(
    df: DataFrame,
    name: str,
    value: str,
    first: Column,
    second: Column,
    alternative: str = "two-sided",
    alpha: float = ALPHA,
) -> DataFrame:
    """Difference first - second of two conditions over one value column."""
    return compare(df, [Comparison(name, value, first, second, alternative)], alpha)


def _weekend(df: DataFrame) -> Comparison:
    require(df, ["ARR_DELAY", "IS_WEEKEND"])
    flag = F.col("IS_WEEKEND")
    return Comparison("weekend_vs_weekday", "ARR_DELAY", flag == 1, flag == 0)


def _era(df: DataFrame) -> Comparison:
    require(df, ["ARR_DELAY", "FL_YEAR"])
    year = F.col("FL_YEAR")
    return Comparison("post_vs_pre_pandemic", "ARR_DELAY", year.isin(*POST_YEARS), year.isin(*PRE_YEARS), "greater")


def welch_weekend(df: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """Weekend against weekday delays, two-sided."""
    return compare(df, [_weekend(df)], alpha)


def welch_era(df: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """Post- against pre-pandemic delays, one-sided; years reach the scan as a filter."""
    return compare(df, [_era(df)], alpha)


def era(year: Column) -> Column:
    return F.when(year.isin(*PRE_YEARS), "Pre").when(year.isin(*POST_YEARS), "Post")


def run_all_tests(df: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """Both tests from one scan."""
    return compare(df, [_weekend(df), _era(df)], alpha)
