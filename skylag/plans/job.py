"""The end-to-end job: load, clean, split, report, reduce and test.

Run with ``spark-submit`` or ``python -m skylag.plans.job INPUT OUTPUT``. Every
stage after cleaning reads the stored clean table, which is split by year, and
a job that was broken off goes on where it stopped.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import reduction as G
from ..operators.cleaning import missing_report, observed_missing
from ..operators.encoding import encoding_mappings
from ..operators.hypothesis import run_all_tests
from ..operators.neighbours import knn_graph
from ..operators.sampling import capped_sample
from ..schema import COMPONENT_FEATURES, NEIGHBOUR_FEATURES, present
from ..sources.files import read_flights_csv, read_flights_parquet, read_with_row_id, write_csv, write_parquet
from .cleaning import clean_flights
from .modelling import model_matrix
from .report import Floors, write_report


def load(spark: SparkSession, path: str, kind: str) -> DataFrame:
    return read_flights_csv(spark, path) if kind == "csv" else read_flights_parquet(spark, path)


class Stages:
    """Stored stages of a job below one folder, with a manifest entry for each finished one.

    A stage that has its entry is not made again; one that was broken off is
    written anew. Rows are observed while a stage is written, and the index is
    read from the manifest.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.made: list[str] = []

    def _entry(self, name: str) -> str:
        return f"{self.folder}/_manifest/{name}"

    def finished(self, name: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self._entry(name)}/_SUCCESS")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def enter(self, name: str, rows: DataFrame) -> None:
        """``rows`` is (table_name, rows) of what the stage stored."""
        rows.coalesce(1).write.mode("overwrite").parquet(self._entry(name))
        self.made.append(name)

    def once(self, name: str, make: Callable[[], DataFrame], write: Callable[[DataFrame, str], object] | None = None) -> str:
        """The folder of the stage, made by ``make`` unless it is finished."""
        path = f"{self.folder}/{name}"
        if not self.finished(name):
            seen = Observation()
            rows = make().observe(seen, F.count(F.lit(1)).alias("rows"))
            (write or (lambda df, at: df.write.mode("overwrite").parquet(at)))(rows, path)
            self.enter(name, self.spark.createDataFrame([(name, seen.get["rows"])], "table_name string, rows bigint"))
        return path

    def index(self, names: list[str]) -> DataFrame:
        return self.spark.read.schema("table_name string, rows bigint").parquet(*[self._entry(n) for n in names])


def run(
    raw: DataFrame,
    folder: str,
    time_encoding: str = "hhmm",
    floors: Floors = Floors(),
    balanced: bool = False,
    neighbours: bool = True,
    neighbour_rows: int | None = None,
    export_csv: bool = False,
) -> DataFrame:
    """Write all results below ``folder``; returns ``(table_name, rows)``.

    May be started again with the same arguments after it was broken off:
    finished stages are read, not made. Missing values of the raw table are
    counted by the scan that stores the clean one.
    """
    spark = raw.sparkSession
    stages = Stages(spark, folder)
    read = spark.read.parquet

    watched, observed = observed_missing(raw)
    fresh = not stages.finished("clean")
    source = stages.once(
        "clean", lambda: clean_flights(watched, time_encoding), lambda df, at: write_parquet(df, at, mode="overwrite")
    )
    stages.once("missing_before", observed if fresh else lambda: missing_report(raw))
    clean = read_with_row_id(spark, source)
    if export_csv:
        stages.once("clean_csv", lambda: clean, lambda df, at: write_csv(df, at, mode="overwrite"))

    if not all(stages.finished(name) for name in ("train", "test", "encoding_mappings_csv")):
        parts = model_matrix(clean)
        stages.once("train", lambda: parts.train)
        stages.once("test", lambda: parts.test)
        stages.once("encoding_mappings_csv", lambda: encoding_mappings(parts.lexicon), lambda df, at: write_csv(df, at, mode="overwrite"))
    if not stages.finished("report"):
        stages.enter("report", write_report(clean, f"{folder}/report", floors, balanced, mode="overwrite"))

    train = read(f"{folder}/train")
    tables = ["component_variance", "component_loadings", "component_scores"]
    if not all(stages.finished(name) for name in tables):
        fitted = G.fit_components(train, present(train, COMPONENT_FEATURES))
        stages.once("component_variance", lambda: G.variance_table(train, fitted))
        stages.once("component_loadings", lambda: G.loading_table(train, fitted))
        stages.once("component_scores", lambda: G.component_scores(train, fitted))
    stages.once("component_labels", lambda: G.label_summary(read(f"{folder}/component_scores")))
    if neighbours:
        rows = train if neighbour_rows is None else capped_sample(train, max_rows=neighbour_rows)
        stages.once("neighbours", lambda: knn_graph(rows, "FLIGHT_ID", present(train, NEIGHBOUR_FEATURES)))
    stages.once("hypothesis_tests", lambda: run_all_tests(clean))
    listed = ["missing_before", "train", "test", "report", *tables, "component_labels", *(["neighbours"] if neighbours else []), "hypothesis_tests"]
    return stages.index(listed)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Clean flights, report on them and prepare model tables.")
    parser.add_argument("input")
    parser.add_argument("output")
    parser.add_argument("--kind", choices=("csv", "parquet"), default="csv")
    parser.add_argument("--time-encoding", choices=("hhmm", "minutes"), default="hhmm")
    parser.add_argument("--balanced", action="store_true")
    parser.add_argument("--no-neighbours", action="store_true")
    parser.add_argument("--neighbour-rows", type=int, help="search a sample of so many rows; all rows if not given")
    parser.add_argument("--export-csv", action="store_true")
    options = parser.parse_args(argv)
    spark = SparkSession.builder.appName("skylag").getOrCreate()
    index = run(
        load(spark, options.input, options.kind),
        options.output,
        options.time_encoding,
        balanced=options.balanced,
        neighbours=not options.no_neighbours,
        neighbour_rows=options.neighbour_rows,
        export_csv=options.export_csv,
    )
    index.orderBy("table_name").show(100, truncate=False)


if __name__ == "__main__":
    main()
