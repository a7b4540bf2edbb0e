"""The whole chart report: one table per chart, one Parquet folder per table.

``write_report`` makes the 25 tables from six scans of the stored table (more
only where quartiles take more than three passes, six at most): one sweep that counts
by all keys, one count of the identifiers, and sweeps of partial results over the numeric columns and
what the charts derive from them. ``report_tables`` has every table by itself.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import aggregates as A
from ..operators import distributions as D
from ..operators import profiles as P
from ..operators import quantiles as Q
from ..operators import relations as R
from ..operators.cleaning import missing_report
from ..operators.partials import Derived, Part, moments, moments_among, sweep
from ..operators.sampling import balance_by_delay
from ..schema import CORRELATED_COLUMNS, is_known, numeric_columns, present, text_columns
from ..session import cut_lineage, materialise

QUARTILES = (0.25, 0.5, 0.75)
SEASONS = (1, 2, 3, 4)
FLAGS = 24  # yes or no, in one number


@dataclass(frozen=True)
class Floors:
    """Least traffic for a route, place or airline to be ranked."""

    route: int = 3000
    city: int = 2000
    airline: int = 5000
    top_n: int = 15


def report_tables(floors: Floors = Floors()) -> dict[str, Callable[[DataFrame], DataFrame]]:
    f = floors
    return {
        "missing_values": missing_report,
        "describe_numeric": P.describe_numeric,
        "describe_text": P.describe_text,
        "delay_histogram": D.delay_histogram,
        "delay_density": D.delay_density,
        "numeric_histograms": D.numeric_histograms,
        "numeric_densities": D.numeric_densities,
        "box_stats": D.box_stats,
        "cyclical_points": D.cyclical_points,
        "correlation_matrix": R.correlation_matrix,
        "delay_by_weekday": A.delay_by_weekday,
        "delay_rate_by_weekday": A.delay_rate_by_weekday,
        "delay_by_month": A.delay_by_month,
        "delay_vs_distance": lambda df: R.fit_line(df, "DISTANCE"),
        "delay_vs_elapsed": lambda df: R.fit_line(df, "CRS_ELAPSED_TIME"),
        "delay_by_weekday_and_month": A.delay_by_weekday_and_month,
        "delay_by_time_and_month": A.delay_by_time_and_month,
        "delay_by_time_of_day": A.delay_by_time_of_day,
        "route_delay_rate": lambda df: A.route_delay_rate(df, f.top_n, f.route),
        "season_box": D.season_box,
        "season_density": D.season_density,
        "origin_volume": lambda df: A.volume_and_delay(df, "ORIGIN_CITY", f.city),
        "top_airlines": lambda df: A.top_airlines(df, f.top_n, f.airline),
        "top_origins": lambda df: A.top_origins(df, f.top_n, f.city),
        "top_destinations": lambda df: A.top_destinations(df, f.top_n, f.city),
    }


# Tables of counts and delay sums


def tally(clean: DataFrame) -> DataFrame:
    """Rows, known delays, their sum and late rows per (what, key, month), from one scan over all keys.

    ``what`` is a text column, DOT_CODE, weekday, or a clock time; the month
    goes with weekdays and departure times. A task adds up its rows by key before they travel,
    and hands out what it holds whenever that is more than ``HELD_KEYS``.
    """
    delay = F.col(A.DELAY)
    none = F.lit(None).cast("int")
    keys: list[tuple[str, Column, Column]] = [(c, F.col(c), none) for c in text_columns(clean)]
    keys.append(("DOT_CODE", F.col("DOT_CODE"), none))
    keys.append(("FL_DAY_OF_WEEK", F.col("FL_DAY_OF_WEEK"), F.col("FL_MONTH")))
    for clock, month in (("CRS_DEP_TIME", F.col("FL_MONTH")), ("CRS_ARR_TIME", none)):
        keys.append((clock, C.clock_minute(F.col(f"{clock}_sin"), F.col(f"{clock}_cos")), month))
    kinds = dict(clean.select(*[k.alias(f"k{i}") for i, (_, k, _) in enumerate(keys)]).dtypes)
    columns = [(k if kinds[f"k{i}"] in ("int", "bigint", "smallint", "tinyint") else k.cast("string")).alias(f"k{i}") for i, (_, k, _) in enumerate(keys)]
    months = [m.cast("int").alias(f"m{i}") for i, (_, _, m) in enumerate(keys)]
    rows = clean.select(delay.cast("double").alias("delay"), C.delayed(delay).cast("int").alias("late"), *columns, *[m for m, k in zip(months, keys) if k[2] is not none])
    names = [w for w, _, _ in keys]
    partial = rows.mapInArrow(_tallied(names), "what string, key string, month int, n bigint, known bigint, total double, late bigint")
    return partial.groupBy("what", "key", "month").agg(
        F.sum("n").alias("n"), F.sum("known").alias("known"), F.sum("total").alias("total"), F.sum("late").alias("late")
    )


HELD_KEYS = 100_000


def _tallied(names: Sequence[str]):
    """Counts and sums of every batch by each key, merged within the task."""

    def counted(batch: pa.RecordBatch) -> Iterator[pa.Table]:
        delay = batch["delay"].to_numpy(zero_copy_only=False)
        known = ~batch["delay"].is_null().to_numpy(zero_copy_only=False)
        delay, late = np.where(known, delay, 0.0), batch["late"].to_numpy(zero_copy_only=False)
        for i, name in enumerate(names):
            key = batch[f"k{i}"].dictionary_encode(null_encoding="encode")
            code, size = key.indices.to_numpy().astype(np.int64), len(key.dictionary)
            month = None
            if f"m{i}" in batch.schema.names:
                month = batch[f"m{i}"].dictionary_encode(null_encoding="encode")
                code += size * month.indices.to_numpy()
            # only codes that occur: there may be many keys in many months
            there, code = np.unique(code, return_inverse=True)
            n = np.bincount(code, minlength=len(there))
            seen = np.bincount(code, known, len(there)).astype(np.int64)
            yield pa.table(
                {
                    "what": pa.repeat(pa.scalar(name), len(there)),
                    "key": key.dictionary.cast(pa.string()).take(pa.array(there % size)),
                    "month": pa.nulls(len(there), pa.int32()) if month is None else month.dictionary.take(pa.array(there // size)),
                    "n": pa.array(n), "known": pa.array(seen),
                    "total": pa.array(np.bincount(code, delay, len(there)), mask=seen == 0),
                    "late": pa.array(np.bincount(code, late, len(there)).astype(np.int64)),
                }
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            new = list(counted(batch))
            held, size = held + new, size + sum(t.num_rows for t in new)
            if size > 2 * HELD_KEYS:
                held = [_added(held)]
                size = held[0].num_rows
                if size > HELD_KEYS:
                    yield from held[0].to_batches()
                    held, size = [], 0
        if held:
            yield from _added(held).to_batches()

    return run


def _added(parts: list[pa.Table]) -> pa.Table:
    sums = ["n", "known", "total", "late"]
    out = pa.concat_tables(parts).group_by(["what", "key", "month"]).aggregate([(c, "sum") for c in sums])
    return out.select(["what", "key", "month", *[f"{c}_sum" for c in sums]]).rename_columns(["what", "key", "month", *sums])


def _of(counted: DataFrame, what: str, kind: str | None = None, name: str | None = None) -> DataFrame:
    key = F.col("key").cast(kind) if kind else F.col("key")
    return counted.where(F.col("what") == what).withColumn(name or what, key)


def _mean(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    mean = F.try_divide(F.sum("total"), F.sum("known"))
    return rows.where(is_known(keys)).groupBy(*keys).agg(mean.alias("avg_delay"), F.sum("n").alias("flights"))


def _rate(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    rate = F.try_divide(F.sum("late") * F.lit(100.0), F.sum("n"))
    return rows.where(is_known(keys)).groupBy(*keys).agg(rate.alias("delay_rate"), F.sum("n").alias("flights"))


def _clock_tables(counted: DataFrame, bins: int = 24) -> dict[str, DataFrame]:
    times = _of(counted, "CRS_DEP_TIME", "int", "minute").where("minute IS NOT NULL")
    known = times.where("known > 0").withColumn("bin", C.time_bin(F.col("minute"), bins)).withColumn("n", F.col("known"))
    by_month = _mean(known.withColumnRenamed("month", "FL_MONTH"), ["bin", "FL_MONTH"])
    by_bin = _mean(known, ["bin"]).withColumnRenamed("bin", "time_bin")
    every = counted.sparkSession.range(bins).select(F.col("id").cast("int").alias("time_bin"))
    points = times.unionByName(_of(counted, "CRS_ARR_TIME", "int", "minute").where("minute IS NOT NULL"))
    points = points.groupBy(F.col("what").alias("time_column"), "minute").agg(F.sum("n").alias("n"))
    return {
        "delay_by_time_and_month": by_month.select(C.bin_label(F.col("bin")).alias("time_bin"), "FL_MONTH", "avg_delay", "flights"),
        "delay_by_time_of_day": every.join(by_bin, "time_bin", "left").select("time_bin", "avg_delay", F.coalesce("flights", F.lit(0)).alias("flights")),
        "cyclical_points": points.select(
            "time_column", "minute", C.clock_sin(F.col("minute")).alias("sin"), C.clock_cos(F.col("minute")).alias("cos"), "n"
        ),
    }


def _text_summary(counted: DataFrame, columns: Sequence[str]) -> DataFrame:
    values = counted.where(F.col("what").isin(list(columns)) & F.col("key").isNotNull())
    best = F.min(F.struct((-F.col("n")).alias("negated"), F.col("key").alias("value")))
    found = values.groupBy(F.col("what").alias("column")).agg(F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"), best.alias("best"))
    return found.select("column", "count", "unique", F.col("best.value").alias("top"), (-F.col("best.negated")).alias("freq"))


def delay_tables(counted: DataFrame, clean: DataFrame, floors: Floors, id_column: str) -> dict[str, DataFrame]:
    """Everything that follows from the stored :func:`tally`, and a count of the identifiers, which would fill it."""
    days = _of(counted, "FL_DAY_OF_WEEK", "int").withColumnRenamed("month", "FL_MONTH")

    def ranked(column: str, floor: int, kind: str | None = None) -> DataFrame:
        busy = _mean(_of(counted, column, kind), [column]).where(F.col("flights") >= floor)
        return busy.orderBy(F.desc("avg_delay"), column).limit(floors.top_n).withColumn(column, F.col(column).cast("string"))

    words = [c for c in text_columns(clean) if c != id_column]
    described = _text_summary(counted, words)
    if id_column in text_columns(clean):
        described = described.unionByName(P.describe_text(clean, [id_column]))
    routes = _rate(_of(counted, "ROUTE"), ["ROUTE"]).where(F.col("flights") >= floors.route)
    return {
        "describe_text": described,
        "delay_by_weekday": _mean(days, ["FL_DAY_OF_WEEK"]),
        "delay_rate_by_weekday": _rate(days, ["FL_DAY_OF_WEEK"]),
        "delay_by_month": _mean(days, ["FL_MONTH"]),
        "delay_by_weekday_and_month": _mean(days, ["FL_DAY_OF_WEEK", "FL_MONTH"]),
        "route_delay_rate": routes.orderBy(F.desc("flights"), "ROUTE").limit(floors.top_n),
        "origin_volume": _mean(_of(counted, "ORIGIN_CITY"), ["ORIGIN_CITY"]).where(F.col("flights") >= floors.city),
        "top_airlines": ranked("DOT_CODE", floors.airline, "bigint"),
        "top_origins": ranked("ORIGIN_CITY", floors.city),
        "top_destinations": ranked("DEST_CITY", floors.city),
        **_clock_tables(counted),
    }


# Tables of numeric columns


def _clipped(low: float, high: float, season: int | None = None):
    """Bounded values, of one season if given; what is not a number is above all numbers, as in SQL."""

    def make(_, values, seasons=None):
        value, null = values
        out = np.clip(np.where(np.isnan(value) & ~null, high, value), low, high)
        return out if season is None else np.where(seasons[0] == season, out, np.nan)

    return make


def _bit(place: int):
    return lambda _, flags: np.where(flags[0].astype(np.int64) >> place & 1, 1.0, np.nan)


def _where_known(_, values, other):
    return np.where(other[1], np.nan, values[0])


class _Swept:
    """The numeric columns of a table and what the charts derive from them, by name and number.

    Only the numeric columns and flags for what is known of the others leave the JVM.
    """

    def __init__(self, clean: DataFrame):
        self.clean = clean
        self.numeric = numeric_columns(clean)
        self.boxed = present(clean, D.BOX_RANGES)
        self.others = [c for c in clean.columns if c not in self.numeric]
        at = {c: f"c{i}" for i, c in enumerate(self.numeric)}
        delay = at[A.DELAY]
        flags = ["incomplete", *[f"known {c}" for c in self.others]]
        tests = [~is_known(clean.columns), *[F.col(c).isNotNull() for c in self.others]]
        made: dict[str, tuple] = {"clipped delay": ((delay,), _clipped(*D.DELAY_RANGE))}
        made |= {f"season {s}": ((delay, at["SEASON"]), _clipped(*D.DELAY_RANGE, s)) for s in SEASONS}
        made |= {f"box {c}": ((at[c],), _clipped(*D.BOX_RANGES[c])) for c in self.boxed}
        made |= {f"line {x}": ((at[x], delay), _where_known) for x in ("DISTANCE", "CRS_ELAPSED_TIME")}
        made["all rows"] = ((), np.ones)
        made["negative"] = ((delay,), lambda _, v: np.where(v[0] < 0, 1.0, np.nan))
        made |= {f: ((f"f{i // FLAGS}",), _bit(i % FLAGS)) for i, f in enumerate(flags)}
        self.names = [*self.numeric, *made]
        words = [
            reduce(Column.__add__, [F.when(t, 1 << i).otherwise(0).cast("bigint") for i, t in enumerate(tests[w : w + FLAGS])]).cast("double")
            for w in range(0, len(tests), FLAGS)
        ]
        rows = clean.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(self.numeric)], *[w.alias(f"f{i}") for i, w in enumerate(words)])
        self.rows = Derived(rows, {len(self.numeric) + i: m for i, m in enumerate(made.values())})

    def at(self, *names: str) -> list[int]:
        return [self.names.index(n) for n in names]

    def only(self, table: DataFrame, names: Sequence[str]) -> DataFrame:
        return table.where(F.col("i").isin(self.at(*names)))


def _missing_values(swept: _Swept, by_number: dict[int, Row]) -> DataFrame:
    def count(name: str) -> float:
        found = by_number.get(swept.at(name)[0])
        return float(found["n"]) if found else 0.0

    rows = count("all rows")
    out = [("rows", rows)]
    out += [(f"missing {c}", rows - count(c if c in swept.numeric else f"known {c}")) for c in swept.clean.columns]
    out.append(("rows with missing", count("incomplete")))
    for flag, label in (("CANCELLED", "cancelled"), ("DIVERTED", "diverted")):
        if flag in swept.numeric:
            mean = by_number[swept.at(flag)[0]]["mean"] if count(flag) else None
            out.append((label, None if mean is None else float(round(mean * count(flag)))))
    out.append(("negative delays", count("negative")))
    out.append(("percent with missing", 100 * count("incomplete") / rows if rows else None))
    return swept.clean.sparkSession.createDataFrame(out, "metric string, value double")


def numeric_tables(clean: DataFrame) -> dict[str, DataFrame]:
    """Four sweeps: moments with the first rank buckets; bins, curves and ranks; the last ranks; whiskers."""
    swept = _Swept(clean)
    spark, rows, names = clean.sparkSession, swept.rows, swept.names
    seasons, boxes = [f"season {s}" for s in SEASONS], [f"box {c}" for c in swept.boxed]
    ranked = swept.at(*swept.numeric, *seasons, *boxes)
    everything = [(i, float("-inf"), float("inf")) for i in ranked]
    options = {"buckets": Q.BUCKETS, "singly": False}
    correlated = present(clean, CORRELATED_COLUMNS)
    lined = [n for n in names if n.startswith("line ")]
    paired = swept.at(*dict.fromkeys([*correlated, "clipped delay", *lined]))
    first = cut_lineage(sweep(rows, moments(), moments_among(paired, "pairs"), Part("ranks", options, everything)))
    totals = Q.held(Q.totals_of(first))
    by_number = {r["i"]: r for r in totals.rows}
    pairs = R.comoments(first.where("kind = 'pairs'").withColumn("kind", F.lit("moments")), names)
    state = Q.held(Q.narrowed(Q.open_ranks(totals.table.where(F.col("i").isin(ranked)), QUARTILES), first))

    charted = ["clipped delay" if c == A.DELAY else c for c in present(clean, D.NUMERIC)]
    titles = [A.DELAY if n == "clipped delay" else n for n in names]
    wide_edges = Q.held(D.bin_edges(swept.only(totals.table, ["clipped delay"]), 80))
    edges = Q.held(D.bin_edges(swept.only(totals.table, charted), 40))
    fits = Q.held(D.curve_fits(swept.only(totals.table, charted), 200, 0.0, "scott"))
    season_fits = Q.held(D.curve_fits(swept.only(totals.table, seasons), 100, 2.0, "scott"))
    parts = [
        Part("bins", {"bins": 80}, wide_edges.settings("bins", "lo", "width")[0], "wide bins"),
        Part("bins", {"bins": 40}, edges.settings("bins", "lo", "width")[0]),
        Part("curves", {"grid": 200}, fits.settings("curves", "lo", "step", "bw")[0]),
        Part("curves", {"grid": 100}, season_fits.settings("curves", "lo", "step", "bw")[0], "season curves"),
        Q.rank_part(state, Q.BUCKETS, state.left() <= Q.COUNT_SINGLY)[0],
    ]
    second = cut_lineage(sweep(rows, *parts))
    settled = Q.settled(rows, Q.held(Q.narrowed(state.table, second)))
    quartiles = Q.held(Q.interpolated(totals.table.where(F.col("i").isin(ranked)), settled, QUARTILES))
    fenced = Q.held(D.fences(swept.only(quartiles.table, [*seasons, *boxes]).where("n > 0")))
    last = cut_lineage(sweep(rows, Part("whiskers", {}, fenced.settings("whiskers", "fence_low", "fence_high")[0])))
    boxed = D.whiskers(fenced.table, last, names)

    described = [
        (r["mean"], r["std"], r["low"], *r["quantiles"], r["high"], r["n"], names[r["i"]]) for r in quartiles.rows if r["i"] < len(swept.numeric)
    ]
    described = [(name, n, mean, std, low, a, b, c, high) for mean, std, low, a, b, c, high, n, name in described]
    described += [(c, 0, *[None] * 7) for c in swept.numeric if swept.at(c)[0] not in by_number]
    schema = "column string, count bigint, mean double, std double, min double, q25 double, q50 double, q75 double, max double"
    curves, season = D.curve_points(fits.table, second, 200), F.regexp_extract("column", r"season (\d)", 1).cast("int").alias("SEASON")
    season_curves = D.curve_points(season_fits.table, second, 100, "season curves")
    delay = swept.at("clipped delay")[0]
    lines = {}
    for table, x in (("delay_vs_distance", "DISTANCE"), ("delay_vs_elapsed", "CRS_ELAPSED_TIME")):
        i = swept.at(f"line {x}")[0]
        low, high = (by_number[i]["low"], by_number[i]["high"]) if i in by_number else (None, None)
        lines[table] = R.line_of(clean, pairs, i, delay, low, high)
    kept = swept.at(*correlated)
    part = R.CoMoments(correlated, *[m[kept][:, kept] for m in (pairs.counts, pairs.means, pairs.squares, pairs.products)])
    return {
        "missing_values": _missing_values(swept, by_number),
        "describe_numeric": spark.createDataFrame(described, schema),
        "delay_histogram": D.binned(wide_edges.table, second, titles, 80, "wide bins"),
        "delay_density": curves.where(F.col("i") == delay).select("point", "x", "density"),
        "numeric_histograms": D.binned(edges.table, second, titles, 40),
        "numeric_densities": curves.select(D.named(titles).alias("column"), "point", "x", "density"),
        "box_stats": boxed.where(F.col("column").startswith("box ")).withColumn("column", F.substr("column", F.lit(5))),
        "season_box": boxed.where(F.col("column").startswith("season ")).select(
            season, F.lit(A.DELAY).alias("column"), *[c for c in boxed.columns if c != "column"]
        ),
        "season_density": season_curves.withColumn("column", D.named(names)).select(season, "point", "x", "density"),
        "correlation_matrix": R.correlation_table(clean, part),
        **lines,
    }


def write_report(
    clean: DataFrame, folder: str, floors: Floors = Floors(), balanced: bool = False, id_column: str = "FLIGHT_ID", mode: str = "errorifexists"
) -> DataFrame:
    """Write every table below ``folder``; returns ``(table_name, rows)``.

    ``clean`` should be a stored table: every scan then reads only the columns
    it needs. ``balanced`` reports on the zero-balanced sample, which
    is a filter, instead of on all rows.
    """
    source = balance_by_delay(clean, id_column) if balanced else clean
    spark = clean.sparkSession
    counted = materialise(tally(source.drop(id_column)), "tally")
    tables = {**numeric_tables(source), **delay_tables(counted, source, floors, id_column)}
    for name in report_tables(floors):
        tables[name].write.mode(mode).parquet(f"{folder}/{name}")
    counts = [
        spark.read.parquet(f"{folder}/{name}").agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("rows"))
        for name in report_tables(floors)
    ]
    return reduce(DataFrame.unionByName, [c.select("table_name", "rows") for c in counts])
