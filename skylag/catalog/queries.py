"""Registered queries: every operator over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import aggregates as A
from ..operators import cleaning as K
from ..operators import distributions as D
from ..operators import encoding as E
from ..operators import features as X
from ..operators import hypothesis as H
from ..operators import profiles as P
from ..operators import reduction as G
from ..operators import relations as R
from ..operators import sampling as S
from ..operators.neighbours import knn_graph
from ..operators.projections import knn_approximate
from ..operators.scaling import fit_scaler
from ..plans.cleaning import clean_flights
from ..plans.job import run as run_job
from ..plans.modelling import model_matrix
from ..plans.report import Floors, write_report
from ..schema import COMPONENT_DEFAULTS, COMPONENT_FEATURES, NEIGHBOUR_FEATURES
from ..session import fresh_path, materialise
from ..sources import star
from ..sources.files import load_flights_csv, read_flights_csv, write_csv
from .shapes import REPORT

Query = Callable[[SparkSession, str], DataFrame]

ROUTE_FLOOR, CITY_FLOOR, AIRLINE_FLOOR, CAPPED = 230, 2000, 3200, 20_000
CLOCK = ("CRS_DEP_TIME_sin", "CRS_DEP_TIME_cos", "CRS_ARR_TIME_sin", "CRS_ARR_TIME_cos")
CATEGORIES = ("ORIGIN_CITY", "DEST_CITY", "ORIGIN_STATE", "DEST_STATE", "ROUTE")
SCALED = ("DISTANCE", "CRS_ELAPSED_TIME", "AVG_SPEED", "DEP_HOUR", "ARR_HOUR")


def _shape(df: DataFrame, /, *keep: str, **digits: int) -> DataFrame:
    """The named columns, then doubles rounded for comparison."""
    rounded = [F.round(F.col(c).cast("double"), d).alias(c) for c, d in digits.items()]
    return df.select(*keep, *rounded)


def _rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def _raw(run: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: run(star.flights(spark, folder))


def _clean(run: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: run(clean_flights(star.flights(spark, folder)))


def _stored(run: Callable[[DataFrame], DataFrame], *columns: str) -> Query:
    """For steps of several passes: the clean columns they need are stored first."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        clean = clean_flights(star.flights(spark, folder))
        return run(materialise(clean.select(*columns) if columns else clean, "clean"))

    return query


def _leaky(df: DataFrame) -> DataFrame:
    """The raw table with some after-the-fact columns for the drop to remove."""
    return df.withColumns(
        {
            "AIRLINE": F.concat(F.lit("Carrier "), F.col("DOT_CODE")),
            "DEP_DELAY": F.col("ARR_DELAY") - 5,
            "ELAPSED_TIME": F.col("CRS_ELAPSED_TIME") + F.col("ARR_DELAY"),
            "FL_NUMBER": F.col("DOT_CODE") * 100,
        }
    )


def _hours(column: str) -> Callable[[DataFrame], DataFrame]:
    def run(df: DataFrame) -> DataFrame:
        code = F.col(column)
        return df.select(
            "FLIGHT_ID", C.hour(code, "hhmm").alias("hhmm_hour"), C.hour(code, "minutes").alias("minutes_hour")
        )

    return run


def _peaks(df: DataFrame) -> DataFrame:
    """Both readings of the clock, side by side from one scan."""
    for encoding in ("hhmm", "minutes"):
        df = X.add_peak_evening(X.add_peak_morning(X.add_dep_hour(df, encoding)))
        names = {"PEAK_MORNING": f"{encoding}_morning", "PEAK_EVENING": f"{encoding}_evening"}
        df = df.withColumnsRenamed(names).drop("DEP_HOUR")
    return df.select("FLIGHT_ID", "hhmm_morning", "hhmm_evening", "minutes_morning", "minutes_evening")


def _export_roundtrip(df: DataFrame) -> DataFrame:
    spark = df.sparkSession
    back = read_flights_csv(spark, write_csv(df, fresh_path(spark, "clean-csv")))
    return _shape(
        back.groupBy("FL_YEAR").agg(
            F.count(F.lit(1)).alias("flights"),
            F.sum("ARR_DELAY").alias("total_delay"),
            F.sum("AVG_SPEED").alias("total_speed"),
            F.count_distinct("ROUTE").alias("routes"),
            F.min("ORIGIN_STATE").alias("first_state"),
        ),
        "FL_YEAR", "flights", "routes", "first_state", total_delay=6, total_speed=4,
    )


def _lexicon(df: DataFrame) -> E.Lexicon:
    train, _ = S.train_test_split(df)
    return E.fit_codes(train)


def _encode_test(df: DataFrame) -> DataFrame:
    train, test = S.train_test_split(df)
    return E.apply_codes(test, E.fit_codes(train))


def _scale(df: DataFrame) -> DataFrame:
    rows = S.mark_split(df)
    scaler = fit_scaler(rows.where(F.col("part") == "train"), SCALED)
    return _shape(scaler.apply(rows), "FLIGHT_ID", "part", **dict.fromkeys(SCALED, 6))


def _matrix(df: DataFrame) -> DataFrame:
    out = model_matrix(df).rows
    real = dict.fromkeys((*SCALED, *CLOCK), 6)
    return _shape(out, *[c for c in out.columns if c not in real], **real)


def _standard_scores(df: DataFrame) -> DataFrame:
    return fit_scaler(df, COMPONENT_DEFAULTS).apply(df)


def _pca_variance(df: DataFrame) -> DataFrame:
    fitted = G.fit_components(_standard_scores(df))
    return _rounded(G.variance_table(df, fitted))


def _pca_loadings(df: DataFrame) -> DataFrame:
    fitted = G.fit_components(_standard_scores(df))
    return _rounded(G.loading_table(df, fitted))


def _pca_scores(df: DataFrame) -> DataFrame:
    scored = _standard_scores(df)
    return _shape(G.component_scores(scored, G.fit_components(scored)), "FLIGHT_ID", PC1=6, PC2=6)


def _pca_by_label(df: DataFrame) -> DataFrame:
    scored = _standard_scores(df)
    return _rounded(G.label_summary(G.component_scores(scored, G.fit_components(scored))))


def _pca_delay_points(df: DataFrame) -> DataFrame:
    """Score points with the delay itself as label."""
    scored = _standard_scores(df)
    points = G.labelled_scores(G.component_scores(scored, G.fit_components(scored)), "ARR_DELAY", "continuous")
    return _shape(points, "label", PC1=6, PC2=6)


def _pca_train(df: DataFrame) -> DataFrame:
    """Components of all seven numeric features, fitted on the training part."""
    train = model_matrix(df).train
    return _rounded(G.variance_table(train, G.fit_components(train, COMPONENT_FEATURES)))


def _knn_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(knn_graph(star.table(spark, folder, "embeddings"), "vec_id", "embedding"))


def _knn_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """The same graph through many small blocks, so that routing, chunks and merging all run."""
    rows = star.table(spark, folder, "embeddings")
    return _rounded(knn_graph(rows, "vec_id", "embedding", block_rows=64, chunk_rows=64))


def _minor_as_zero(df: DataFrame) -> DataFrame:
    """Delays of up to a quarter of an hour count as none, so zeros outnumber the rest."""
    return S.balance_by_delay(_minor(df))


def _knn_flights(df: DataFrame) -> DataFrame:
    """Neighbour graph of the training features, over the whole training part."""
    return _rounded(knn_graph(model_matrix(df).train, "FLIGHT_ID", list(NEIGHBOUR_FEATURES)))


def _knn_approximate(df: DataFrame) -> DataFrame:
    """Approximate neighbours of the training features, over the whole training part."""
    return _rounded(knn_approximate(model_matrix(df).train, "FLIGHT_ID", list(NEIGHBOUR_FEATURES)))


def _knn_recall(df: DataFrame) -> DataFrame:
    """How many links the approximate graph of the routes has, and whether 90 % of the exact graph's are among them."""
    routes = materialise(_route_means(df), "routes")
    exact = knn_graph(routes, "ROUTE", list(NEIGHBOUR_FEATURES)).select("src", "dst", F.lit(1).alias("exact"))
    found = knn_approximate(routes, "ROUTE", list(NEIGHBOUR_FEATURES), bucket_rows=64).select("src", "dst", F.lit(1).alias("found"))
    both = exact.join(found, ["src", "dst"], "full")
    hits = F.count(F.when(F.col("exact").isNotNull() & F.col("found").isNotNull(), 1))
    return both.agg(F.count("exact").alias("links"), (hits >= 0.9 * F.count("exact")).cast("int").alias("reached"))


FLOORS = Floors(ROUTE_FLOOR, CITY_FLOOR, AIRLINE_FLOOR)


def _route_means(df: DataFrame) -> DataFrame:
    return df.groupBy("ROUTE").agg(*[F.round(F.avg(c), 6).alias(c) for c in NEIGHBOUR_FEATURES])


def _knn_routes(df: DataFrame) -> DataFrame:
    """Neighbours of the routes by the means of their flights' features, through small blocks and parts."""
    return _rounded(knn_graph(_route_means(df), "ROUTE", list(NEIGHBOUR_FEATURES), block_rows=16, chunk_rows=32))


def _report_index(df: DataFrame) -> DataFrame:
    return write_report(df, fresh_path(df.sparkSession, "report"), FLOORS)


def _report_contents(df: DataFrame, balanced: bool = False) -> DataFrame:
    """Every value of the written tables: (table_name, place, measure, value)."""
    spark, folder = df.sparkSession, fresh_path(df.sparkSession, "report")
    write_report(df, folder, FLOORS, balanced=balanced)
    tables = []
    for name, (keys, digits) in REPORT.items():
        table = spark.read.parquet(f"{folder}/{name}")
        place = F.concat_ws("|", *[F.col(k).cast("string") for k in keys]).alias("place")
        values = [F.round(F.col(c).cast("double"), d).alias(c) for c, d in digits.items()]
        tables.append(table.select(F.lit(name).alias("table_name"), place, *values).unpivot(["table_name", "place"], list(digits), "measure", "value"))
    return reduce(DataFrame.unionByName, tables)


def _job_index(spark: SparkSession, folder: str) -> DataFrame:
    """Every table of the end-to-end job with its rows."""
    raw, target = star.flights(spark, folder), fresh_path(spark, "job")
    return run_job(raw, target, floors=FLOORS)


def _malformed(spark: SparkSession, folder: str) -> DataFrame:
    """The raw table exported with some fields spoilt, and what the scan keeps and sets aside."""
    raw = star.flights(spark, folder).select(*[F.col(c).cast("string").alias(c) for c in ("FLIGHT_ID", "FL_DATE", "CRS_DEP_TIME", "DISTANCE")], "DOT_CODE")
    spoilt = raw.withColumns(
        {
            "FL_DATE": F.when(F.col("DOT_CODE") == 3, "someday").otherwise(F.col("FL_DATE")),
            "DISTANCE": F.when(F.col("DOT_CODE") == 5, "far").otherwise(F.col("DISTANCE")),
        }
    )
    source = write_csv(spoilt, fresh_path(spark, "spoilt-csv"))
    return load_flights_csv(spark, source, fresh_path(spark, "kept"), fresh_path(spark, "quarantine"))


def _minor(df: DataFrame) -> DataFrame:
    return df.withColumn("ARR_DELAY", F.when(F.col("ARR_DELAY") <= 15, 0.0).otherwise(F.col("ARR_DELAY")))


def _encode_unseen(df: DataFrame) -> DataFrame:
    """Codes fitted on the first four months' routes, applied to all rows: later places are unseen."""
    early = df.where((F.col("FL_MONTH") <= 4) & (F.col("DOT_CODE") < 2) & (F.col("FL_DAY_OF_WEEK") == 1))
    return E.apply_codes(df.select("FLIGHT_ID", *CATEGORIES), E.fit_codes(early.select(*CATEGORIES)))


def _resampled(x: str) -> Query:
    return _clean(lambda df: _rounded(R.resampled_band(df, x)))


def _line(x: str) -> Query:
    return _clean(
        lambda df: _shape(
            R.fit_line(df, x), "n", slope=9, intercept=6, r2=9, residual_se=6, slope_se=9, intercept_se=6
        )
    )


def _test(run: Callable[[DataFrame], DataFrame]) -> Query:
    keep = ("test", "alternative", "n_first", "n_second", "decision", "direction")
    return _clean(lambda df: _shape(run(df), *keep, mean_first=6, mean_second=6, t=8, df=6, p_value=8))


def _codes(name: str) -> Query:
    return _stored(lambda df: _lexicon(df).codes(name), "FLIGHT_ID", *CATEGORIES)


def _events_box(spark: SparkSession, folder: str) -> DataFrame:
    events = star.table(spark, folder, "events")
    return _rounded(D.box_stats(events, ["value"], {}, by="event_type").drop("column"))


def _events_mean(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(A.mean_delay(star.table(spark, folder, "events"), ["event_type"], "value"))


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    """Mean arrival delay per weekday."""
    return queries()["delay_by_dow"](spark, folder)


def queries() -> dict[str, Query]:
    return {
        # scans and sinks
        "scan_flights": _raw(lambda df: df),
        "preview": _raw(lambda df: P.preview(df, ["FLIGHT_ID"])),
        "describe_numeric": _raw(lambda df: _rounded(P.describe_numeric(df))),
        "describe_clean": _clean(lambda df: _rounded(P.describe_numeric(df))),
        "export_roundtrip": _clean(_export_roundtrip),
        "encoding_mappings": _stored(lambda df: E.encoding_mappings(_lexicon(df)), "FLIGHT_ID", *CATEGORIES),
        # projections and filters
        "drop_leakage": _raw(lambda df: K.drop_columns(_leaky(df))),
        "filter_completed": _raw(K.filter_completed),
        "clean_na": _raw(K.clean_na),
        "fix_negative_delays": _raw(lambda df: K.fix_negative_delays(df).select("FLIGHT_ID", "ARR_DELAY")),
        "clip_columns": _raw(
            lambda df: K.clip_columns(
                df, {"ARR_DELAY": (-20, 30), "CRS_ELAPSED_TIME": (100, 300), "DISTANCE": (0, 1000)}
            ).select("FLIGHT_ID", "ARR_DELAY", "CRS_ELAPSED_TIME", "DISTANCE")
        ),
        # derived columns
        "date_features": _raw(
            lambda df: X.add_date_features(df).select("FLIGHT_ID", "FL_YEAR", "FL_MONTH", "FL_DAY_OF_WEEK")
        ),
        "cyclical_time": _raw(lambda df: _shape(X.add_cyclical_times(df), "FLIGHT_ID", **dict.fromkeys(CLOCK, 6))),
        "season": _raw(lambda df: X.add_season(X.add_date_features(df)).select("FLIGHT_ID", "FL_MONTH", "SEASON")),
        "weekend_flag": _raw(
            lambda df: X.add_weekend(X.add_date_features(df)).select("FLIGHT_ID", "FL_DAY_OF_WEEK", "IS_WEEKEND")
        ),
        "route": _raw(lambda df: X.add_route(df).select("FLIGHT_ID", "ROUTE")),
        "avg_speed": _raw(lambda df: _shape(X.add_avg_speed(df), "FLIGHT_ID", AVG_SPEED=6)),
        "dep_hour": _raw(_hours("CRS_DEP_TIME")),
        "arr_hour": _raw(_hours("CRS_ARR_TIME")),
        "peak_flags": _raw(_peaks),
        "states": _raw(
            lambda df: X.add_dest_state(X.add_origin_state(df)).select("FLIGHT_ID", "ORIGIN_STATE", "DEST_STATE")
        ),
        "delay_category": _raw(lambda df: X.add_delay_category(df).select("FLIGHT_ID", "DELAY_CATEGORY")),
        "canonical_route": _raw(
            lambda df: X.add_route(df).select("FLIGHT_ID", C.canonical_route(F.col("ROUTE")).alias("ROUTE"))
        ),
        # reports and grouped tables
        "missing_report": _raw(lambda df: _rounded(K.missing_report(df))),
        "summary_categorical": _clean(P.describe_text),
        "summary_full": _raw(lambda df: _rounded(P.full_summary(df))),
        "delay_by_dow": _clean(lambda df: _rounded(A.delay_by_weekday(df))),
        "delay_rate_by_dow": _clean(lambda df: _rounded(A.delay_rate_by_weekday(df))),
        "delay_by_month": _clean(lambda df: _rounded(A.delay_by_month(df))),
        "delay_month_dow": _clean(lambda df: _rounded(A.delay_by_weekday_and_month(df))),
        "delay_month_dow_wide": _clean(lambda df: _rounded(A.delay_month_matrix(df))),
        "delay_grouping_sets": _clean(lambda df: _rounded(A.delay_grouping_sets(df))),
        "delay_timebin_month": _clean(lambda df: _rounded(A.delay_by_time_and_month(df))),
        "delay_by_timebin": _clean(lambda df: _rounded(A.delay_by_time_of_day(df))),
        "route_delay_rate": _clean(lambda df: _rounded(A.route_delay_rate(df, min_flights=ROUTE_FLOOR))),
        "origin_volume_delay": _clean(lambda df: _rounded(A.volume_and_delay(df, min_flights=CITY_FLOOR))),
        "top_airlines": _clean(lambda df: _rounded(A.top_airlines(df, min_flights=AIRLINE_FLOOR))),
        "top_origins": _clean(lambda df: _rounded(A.top_origins(df, min_flights=CITY_FLOOR))),
        "top_dests": _clean(lambda df: _rounded(A.top_destinations(df, min_flights=CITY_FLOOR))),
        # distributions and relations
        "correlation_matrix": _clean(lambda df: _rounded(R.correlation_matrix(df))),
        "delay_histogram": _clean(lambda df: _rounded(D.delay_histogram(df))),
        "numeric_histograms": _clean(lambda df: _rounded(D.numeric_histograms(df))),
        "delay_kde": _clean(lambda df: _shape(D.delay_density(df), "point", x=6, density=9)),
        "numeric_kde": _clean(lambda df: _shape(D.numeric_densities(df), "column", "point", x=6, density=9)),
        "box_stats": _clean(lambda df: _rounded(D.box_stats(df))),
        "season_box": _clean(lambda df: _rounded(D.season_box(df))),
        "delay_kde_nrd0": _clean(lambda df: _shape(D.delay_density(df, rule="nrd0"), "point", x=6, density=9)),
        "season_kde_nrd0": _clean(
            lambda df: _shape(D.density(df, "ARR_DELAY", "SEASON", 100, 2.0, "nrd0", D.DELAY_RANGE), "SEASON", "point", x=6, density=9)
        ),
        "season_kde": _clean(lambda df: _shape(D.season_density(df), "SEASON", "point", x=6, density=9)),
        "fit_delay_distance": _line("DISTANCE"),
        "fit_delay_elapsed": _line("CRS_ELAPSED_TIME"),
        "band_delay_distance": _clean(lambda df: _rounded(R.line_band(df, "DISTANCE"))),
        "band_delay_elapsed": _clean(lambda df: _rounded(R.line_band(df, "CRS_ELAPSED_TIME"))),
        "resampled_band_distance": _resampled("DISTANCE"),
        "resampled_band_elapsed": _resampled("CRS_ELAPSED_TIME"),
        "points_delay_elapsed": _clean(lambda df: R.point_counts(df, "CRS_ELAPSED_TIME")),
        "points_delay_distance": _clean(lambda df: R.point_counts(df, "DISTANCE")),
        "cyclical_points": _clean(lambda df: _rounded(D.cyclical_points(df))),
        # sampling, encoding, scaling
        "train_test_split": _stored(S.mark_split, "FLIGHT_ID"),
        "state_codes": _codes(E.STATE),
        "route_codes": _codes(E.ROUTE),
        "city_codes": _stored(
            lambda df: _lexicon(df).table.where(F.col("Column").isin("ORIGIN_CITY", "DEST_CITY")),
            "FLIGHT_ID", *CATEGORIES,
        ),
        "encode_test": _stored(_encode_test, "FLIGHT_ID", *CATEGORIES),
        "encode_unseen": _stored(_encode_unseen, "FLIGHT_ID", "FL_MONTH", "DOT_CODE", "FL_DAY_OF_WEEK", *CATEGORIES),
        "scale_numeric": _stored(_scale, "FLIGHT_ID", *SCALED),
        "balanced_sample": _stored(S.balance_by_delay, "FLIGHT_ID", "ARR_DELAY"),
        "balanced_minor": _stored(_minor_as_zero, "FLIGHT_ID", "ARR_DELAY"),
        "capped_sample": _stored(lambda df: S.capped_sample(df, max_rows=CAPPED), "FLIGHT_ID"),
        # statistical tests
        "welch_weekend": _test(H.welch_weekend),
        "welch_pandemic": _test(H.welch_era),
        "welch_all": _test(H.run_all_tests),
        "era_delays": _clean(
            lambda df: _rounded(A.mean_delay(df.withColumn("era", H.era(F.col("FL_YEAR"))), ["era"]))
        ),
        # components and neighbours
        "covariance_matrix": _clean(lambda df: _rounded(R.covariance_matrix(df, COMPONENT_DEFAULTS))),
        "pca_variance": _stored(_pca_variance, *COMPONENT_DEFAULTS),
        "pca_loadings": _stored(_pca_loadings, *COMPONENT_DEFAULTS),
        "pca_scores": _stored(_pca_scores, "FLIGHT_ID", *COMPONENT_DEFAULTS),
        "pca_by_label": _stored(_pca_by_label, "FLIGHT_ID", *COMPONENT_DEFAULTS, *G.LABEL_VIEWS.values()),
        "pca_delay_points": _stored(_pca_delay_points, "ARR_DELAY", *COMPONENT_DEFAULTS),
        "pca_train_features": _stored(_pca_train),
        "knn_graph": _knn_embeddings,
        "knn_blocks": _knn_blocks,
        "knn_routes": _clean(_knn_routes),
        "knn_flights": _stored(_knn_flights),
        "knn_approximate": _stored(_knn_approximate),
        "knn_recall": _clean(_knn_recall),
        # pipelines
        "clean_pipeline": _clean(lambda df: _shape(df, *[c for c, t in df.dtypes if c not in (*CLOCK, "AVG_SPEED")], **dict.fromkeys((*CLOCK, "AVG_SPEED"), 6))),
        "model_matrix": _stored(_matrix),
        "report_index": _stored(_report_index),
        "report_contents": _stored(_report_contents),
        "report_balanced": _stored(lambda df: _report_contents(_minor(df), balanced=True)),
        "job_index": _job_index,
        "malformed_rows": _malformed,
        # the same operators on a table with other column names
        "events_mean": _events_mean,
        "events_box": _events_box,
    }
