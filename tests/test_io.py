"""Scans, sinks, the end-to-end job and the stream."""

from __future__ import annotations

from types import SimpleNamespace

import datetime as dt

import pytest

from skylag.operators.cleaning import missing_report
from skylag.operators.encoding import fit_codes
from skylag.plans import job
from skylag.plans.cleaning import clean_flights
from skylag.plans.report import Floors, report_tables, write_report
from skylag.session import cut_lineage, materialise, shared_dir
from skylag.sources.files import load_flights_csv, read_flights_csv, read_flights_parquet, read_with_row_id, write_csv, write_parquet
from skylag.sources.star import table
from skylag.streaming.cleaning import clean_stream, read_arrivals, write_available

from .conftest import SMALL, plan

HEADER = "FL_DATE,AIRLINE,DOT_CODE,ORIGIN_CITY,DEST_CITY,CRS_DEP_TIME,CRS_ARR_TIME,ARR_DELAY,CANCELLED,DIVERTED,CRS_ELAPSED_TIME,DISTANCE,EXTRA\n"


def test_csv_is_typed_by_name(spark, tmp_path):
    path = tmp_path / "flights.csv"
    path.write_bytes(
        (
            HEADER
            + '2019-01-09,Águia,19977,"Fort Lauderdale, FL","Newark, NJ",1155,1501.0,-14.0,0.0,0.0,186.0,1065.0,x\n'
            + 'not a date,Áb,1,"A, B","C, D",oops,100,NaN,0.0,0.0,,5,y\n'
        ).encode("latin-1")
    )
    df = read_flights_csv(spark, str(path))
    kinds = dict(df.dtypes)
    assert (kinds["FL_DATE"], kinds["CRS_ARR_TIME"], kinds["ARR_DELAY"], kinds["EXTRA"]) == ("date", "bigint", "double", "string")
    good, bad = df.orderBy("DOT_CODE", ascending=False).collect()
    assert good["FL_DATE"] == dt.date(2019, 1, 9) and good["AIRLINE"] == "Águia"
    assert (good["CRS_DEP_TIME"], good["CRS_ARR_TIME"]) == (1155, 1501)
    assert (bad["FL_DATE"], bad["CRS_DEP_TIME"], bad["ARR_DELAY"], bad["CRS_ELAPSED_TIME"]) == (None, None, None, None)


def test_missing_file_raises(spark, tmp_path):
    with pytest.raises(Exception):
        read_flights_csv(spark, str(tmp_path / "absent.csv"))


def test_export_round_trip(spark, clean, tmp_path):
    back = read_flights_csv(spark, write_csv(clean, str(tmp_path / "csv")))
    assert dict(back.dtypes) == dict(clean.dtypes)
    assert back.exceptAll(clean.select(*back.columns)).count() == 0
    assert back.count() == clean.count()


def test_parquet_is_split_by_year(spark, clean, tmp_path):
    path = write_parquet(clean, str(tmp_path / "parquet"))
    assert len(list((tmp_path / "parquet").glob("FL_YEAR=*"))) == clean.select("FL_YEAR").distinct().count()
    assert read_flights_parquet(spark, path).count() == clean.count()


def test_row_identifiers_are_unique_and_stable(spark, clean, tmp_path):
    path = write_parquet(clean.drop("FLIGHT_ID"), str(tmp_path / "noid"))
    first, second = (read_with_row_id(spark, path) for _ in range(2))
    assert first.select("FLIGHT_ID").distinct().count() == clean.count()
    assert first.select("FLIGHT_ID").exceptAll(second.select("FLIGHT_ID")).count() == 0
    assert "FLIGHT_ID" in read_with_row_id(spark, write_parquet(clean, str(tmp_path / "withid"))).columns


def test_mappings_export(spark, clean, tmp_path):
    lexicon = fit_codes(clean)
    path = write_csv(lexicon.table, str(tmp_path / "codes"))
    back = spark.read.option("header", True).csv(path)
    assert back.columns == ["Column", "Original_Value", "Encoded_Code"]
    assert back.count() == sum(lexicon.sizes.values())


def test_report(spark, clean, tmp_path):
    index = write_report(clean, str(tmp_path / "report"), Floors(1, 1, 1), balanced=True)
    rows = {r["table_name"]: r["rows"] for r in index.collect()}
    assert set(rows) == set(report_tables()) and all(n > 0 for n in rows.values())


def test_job_without_identifiers(spark, raw, tmp_path):
    source = str(tmp_path / "raw.csv")
    write_csv(raw.drop("FLIGHT_ID"), source)
    index = job.run(job.load(spark, source, "csv"), str(tmp_path / "out"), floors=Floors(1, 1, 1), export_csv=True)
    rows = {r["table_name"]: r["rows"] for r in index.collect()}
    clean = clean_flights(raw).count()
    assert rows["train"] + rows["test"] == clean and rows["hypothesis_tests"] == 2
    assert rows["neighbours"] == 15 * rows["train"] and rows["component_scores"] == rows["train"]
    assert read_flights_csv(spark, str(tmp_path / "out" / "clean_csv")).count() == clean


def test_the_registered_job_searches_neighbours_of_the_whole_training_part(raw, monkeypatch):
    from skylag.catalog import queries as Q

    few = raw.orderBy("FLIGHT_ID").limit(400).localCheckpoint()
    monkeypatch.setattr(Q.star, "flights", lambda spark, folder: few)
    rows = {r["table_name"]: r["rows"] for r in Q.queries()["job_index"](few.sparkSession, "").collect()}
    assert rows["train"] > 100 and rows["neighbours"] == 15 * rows["train"]


def test_stream_equals_batch(spark, raw, clean, tmp_path):
    arrivals, sink = str(tmp_path / "in"), str(tmp_path / "out")
    raw.repartition(3).write.parquet(arrivals)
    stream = clean_stream(read_arrivals(spark, arrivals, raw.schema, 1))
    query = write_available(stream, sink, str(tmp_path / "ckpt"))
    assert query.awaitTermination(120)
    done = spark.read.schema(clean.schema).parquet(sink)
    assert done.exceptAll(clean).count() == 0 and done.count() == clean.count()


def test_shared_folder(spark):
    assert shared_dir(spark) == shared_dir(spark)
    df = cut_lineage(spark.range(5).selectExpr("id * 2 AS x"))
    assert "Range" not in plan(df) and df.count() == 5
    assert materialise(df, "t").count() == 5


def test_a_cluster_needs_a_shared_folder():
    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(SimpleNamespace(conf={}, sparkContext=context))


def test_malformed_rows_are_set_aside(spark, tmp_path):
    path = tmp_path / "flights.csv"
    good = '2019-01-09,Águia,19977,"Fort Lauderdale, FL","Newark, NJ",1155,1501.0,-14.0,0.0,0.0,186.0,1065.0,x\n'
    bad = [good.replace("2019-01-09", "someday"), good.replace("1155", "oops"), "2019-01-09,too,1,short\n", good.replace(",x\n", ",x,y,z\n")]
    path.write_bytes((HEADER + good + bad[0] + good.replace("-14.0", "") + "".join(bad[1:])).encode("latin-1"))
    counts = load_flights_csv(spark, str(path), str(tmp_path / "kept"), str(tmp_path / "bad"))
    assert {r["part"]: r["rows"] for r in counts.collect()} == {"kept": 2, "set aside": 4}
    kept = spark.read.parquet(str(tmp_path / "kept"))
    assert dict(kept.dtypes)["CRS_DEP_TIME"] == "bigint" and kept.where("ARR_DELAY IS NULL").count() == 1
    aside = spark.read.parquet(str(tmp_path / "bad")).collect()
    assert sorted(r["line"] + "\n" for r in aside) == sorted(bad)
    assert {tuple(r["null_columns"]) for r in aside if "someday" in r["line"] or "oops" in r["line"]} == {("FL_DATE",), ("CRS_DEP_TIME",)}
    inferred = dict(read_flights_csv(spark, str(path), infer=True).dtypes)
    assert inferred["DISTANCE"] == "double" and inferred["FL_DATE"] == "string"


def test_a_broken_job_goes_on_where_it_stopped(spark, raw, tmp_path, monkeypatch):
    folder = str(tmp_path / "out")

    def broken(*args, **more):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(job, "write_report", broken)
        with pytest.raises(RuntimeError):
            job.run(raw, folder, floors=Floors(1, 1, 1), neighbours=False)
    stages = job.Stages(spark, folder)
    assert all(stages.finished(n) for n in ("clean", "missing_before", "train", "test")) and not stages.finished("report")
    # half a stage without its entry is written anew, finished ones are not made again
    (tmp_path / "out" / "component_variance").mkdir()
    with monkeypatch.context() as patch:
        for name in ("clean_flights", "model_matrix", "missing_report"):
            patch.setattr(job, name, broken)
        index = {r["table_name"]: r["rows"] for r in job.run(raw, folder, floors=Floors(1, 1, 1), neighbours=False).collect()}
        patch.setattr(job, "write_report", broken)
        again = {r["table_name"]: r["rows"] for r in job.run(raw, folder, floors=Floors(1, 1, 1), neighbours=False).collect()}
    assert index == again and set(report_tables()) <= set(index)
    assert index["train"] + index["test"] == clean_flights(raw).count() and index["component_variance"] == 7
    observed = {r["metric"]: r["value"] for r in spark.read.parquet(f"{folder}/missing_before").collect()}
    assert observed == {r["metric"]: r["value"] for r in missing_report(raw).collect()}
