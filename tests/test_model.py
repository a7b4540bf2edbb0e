"""Sampling, encoding, scaling, components and neighbours."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from skylag.operators import encoding as E
from skylag.operators import reduction as G
from skylag.operators import relations as R
from skylag.operators import sampling as S
from skylag.operators.neighbours import knn_graph
from skylag.operators.scaling import fit_scaler
from skylag.plans.modelling import model_matrix

from .conftest import column, plan


def ranked(ids, seed):
    return sorted(ids, key=lambda i: (hashlib.md5(f"{i}|{seed}".encode()).hexdigest(), i))


@pytest.mark.parametrize("size", [0, 1, 2, 77, 4999, 5000, 9999])
def test_sample_is_exact(spark, size):
    df = spark.range(5000)
    got = set(column(S.capped_sample(df, "id", size, 42), "id"))
    assert got == set(ranked(range(5000), 42)[:size])


def test_sample_narrows_in_several_passes(spark, monkeypatch):
    monkeypatch.setattr(S, "COUNT_SINGLY", 1)
    got = set(column(S.capped_sample(spark.range(3000), "id", 1234, 7), "id"))
    assert got == set(ranked(range(3000), 7)[:1234])


def test_sample_does_not_depend_on_partitions(spark):
    one = S.capped_sample(spark.range(0, 900, 1, 1), "id", 100)
    many = S.capped_sample(spark.range(0, 900, 1, 13), "id", 100)
    assert set(column(one, "id")) == set(column(many, "id"))


def test_sample_refuses_repeated_identifiers(spark):
    df = spark.range(300).select(F.lit("same").alias("id"))
    with pytest.raises(ValueError, match="unique"):
        S.capped_sample(df, "id", 100)
    with pytest.raises(ValueError, match="NULL"):
        S.capped_sample(spark.range(5).select(F.lit(None).cast("string").alias("id")), "id", 2)


def test_split_sizes(spark):
    train, test = S.train_test_split(spark.range(1001), "id")
    assert test.count() == math.ceil(0.2 * 1001)
    assert train.union(test).distinct().count() == 1001
    assert set(column(test, "id")) == set(ranked(range(1001), 48)[:201])


def test_sample_is_a_plain_filter(spark):
    text = plan(S.capped_sample(spark.range(5000), "id", 100))
    assert "Exchange" not in text and "Join" not in text and "Window" not in text


@pytest.mark.parametrize(("zeros", "others"), [(700, 300), (300, 700), (500, 500), (9, 0), (0, 9), (100, 1)])
def test_balanced_sample(spark, zeros, others):
    rows = [(i, 0.0 if i < zeros else float(i + 1)) for i in range(zeros + others)]
    df = spark.createDataFrame(rows, "id bigint, ARR_DELAY double")
    got = S.balance_by_delay(df, "id").collect()
    kept = {r["id"] for r in got if r["ARR_DELAY"] == 0}
    assert sum(r["ARR_DELAY"] != 0 for r in got) == others
    assert kept == set(ranked(range(zeros), 48)[: min(zeros, others)])


def test_missing_delay_counts_as_non_zero(spark):
    df = spark.createDataFrame([(1, None), (2, 0.0), (3, 0.0)], "id bigint, ARR_DELAY double")
    assert S.balance_by_delay(df, "id").count() == 2


CITIES = ["Boston, MA", "Austin, TX", "Miami, FL", "Reno, NV"]


def trips(spark, pairs):
    rows = [(o, d, o.split(", ")[1], d.split(", ")[1], f"{o}_{d}") for o, d in pairs]
    return spark.createDataFrame(rows, "ORIGIN_CITY string, DEST_CITY string, ORIGIN_STATE string, DEST_STATE string, ROUTE string")


@pytest.mark.parametrize("window_rows", [1_000_000, 1])
@pytest.mark.parametrize("broadcast_rows", [200_000, 0])
def test_encoding(spark, window_rows, broadcast_rows):
    train = trips(spark, [(CITIES[0], CITIES[1]), (CITIES[1], CITIES[0]), (CITIES[1], CITIES[2])])
    test = trips(spark, [(CITIES[2], CITIES[1]), (CITIES[3], CITIES[0])])
    lexicon = E.fit_codes(train, window_rows=window_rows)
    states = {r["Original_Value"]: r["Encoded_Code"] for r in lexicon.codes(E.STATE).collect()}
    assert states == {"FL": 0, "MA": 1, "TX": 2}
    assert {r["Original_Value"] for r in lexicon.codes(E.ROUTE).collect()} == {"Austin, TX_Boston, MA", "Austin, TX_Miami, FL"}
    coded = E.apply_codes(test, lexicon, broadcast_rows)
    assert coded.columns == test.columns
    assert sorted(tuple(r) for r in coded.collect()) == [(-1, 0, 0, 2, 1), (-1, 1, -1, 1, -1)]


def test_both_numberings_agree(clean):
    by_window = E.fit_codes(clean)
    by_range = E.fit_codes(clean, window_rows=1)
    assert sorted(map(tuple, by_window.table.collect())) == sorted(map(tuple, by_range.table.collect()))
    for name, size in by_window.sizes.items():
        assert sorted(column(by_window.codes(name), "Encoded_Code")) == list(range(size))


def test_small_dictionaries_are_broadcast(clean):
    text = plan(E.apply_codes(clean, E.fit_codes(clean)))
    assert text.count("BroadcastHashJoin") >= 5 and "SortMergeJoin" not in text


def test_a_table_without_categories_is_left_alone(spark):
    rows = spark.range(3)
    lexicon = E.fit_codes(rows)
    assert lexicon.table.count() == 0 and E.apply_codes(rows, lexicon).collect() == rows.collect()


def test_scaler(spark):
    df = spark.createDataFrame([(1.0, 4.0), (3.0, 4.0)], "DISTANCE double, AVG_SPEED double")
    scaled = fit_scaler(df).apply(df).orderBy("DISTANCE").collect()
    assert [tuple(r) for r in scaled] == [(-1.0, 0.0), (1.0, 0.0)]
    sample = fit_scaler(df, ddof=1)
    assert sample.scales["DISTANCE"] == pytest.approx(math.sqrt(2))


def test_model_matrix(clean):
    fitted = model_matrix(clean)
    n, test = clean.count(), fitted.test.count()
    assert test == math.ceil(0.2 * n) and fitted.train.count() == n - test
    assert dict(fitted.train.dtypes)["ROUTE"] == "int" and "part" not in fitted.train.columns
    row = fitted.train.agg(F.avg("DISTANCE").alias("m"), F.stddev_pop("DISTANCE").alias("s")).first()
    assert row["m"] == pytest.approx(0, abs=1e-9) and row["s"] == pytest.approx(1)
    assert "ORIGIN_CITY" in fitted.train_raw.columns and dict(fitted.test_raw.dtypes)["ORIGIN_CITY"] == "string"


def test_components_match_the_library(clean):
    from pyspark.ml.feature import PCA, VectorAssembler

    columns = ["AVG_SPEED", "DISTANCE", "CRS_ELAPSED_TIME", "CRS_DEP_TIME_sin"]
    scored = fit_scaler(clean, columns).apply(clean)
    fitted = G.fit_components(scored, columns)
    vectors = VectorAssembler(inputCols=columns, outputCol="v").transform(scored)
    model = PCA(k=4, inputCol="v", outputCol="p").fit(vectors)
    assert fitted.ratios == pytest.approx(list(model.explainedVariance), abs=1e-9)
    assert np.abs(np.array(fitted.loadings)) == pytest.approx(np.abs(model.pc.toArray().T), abs=1e-6)
    trace = sum(r["cov"] for r in R.covariance_matrix(scored, columns).collect() if r["var1"] == r["var2"])
    assert sum(fitted.variances) == pytest.approx(trace)
    scores = G.component_scores(scored, fitted)
    row = scores.agg(F.avg("PC1").alias("m"), F.var_samp("PC1").alias("v1"), F.var_samp("PC2").alias("v2"), F.corr("PC1", "PC2").alias("c")).first()
    assert row["m"] == pytest.approx(0, abs=1e-9) and row["c"] == pytest.approx(0, abs=1e-9)
    assert (row["v1"], row["v2"]) == pytest.approx(tuple(fitted.variances[:2]))


def test_components_need_two_columns(spark):
    with pytest.raises(ValueError):
        G.fit_components(spark.createDataFrame([(1.0,)], "DISTANCE double"))


def test_label_modes(clean):
    scores = G.component_scores(clean, G.fit_components(clean))
    assert dict(G.labelled_scores(scores, "ARR_DELAY", "continuous").dtypes)["label"] == "double"
    assert dict(G.labelled_scores(scores, "SEASON", "generic_categorical").dtypes)["label"] == "string"
    with pytest.raises(ValueError):
        G.labelled_scores(scores, "SEASON", "other")
    summary = G.label_summary(scores).groupBy("view").agg(F.sum("n").alias("n")).collect()
    assert {r["n"] for r in summary} == {clean.count()} and len(summary) == 6


def brute(points: dict[int, tuple], k: int):
    ids = sorted(points)
    out = {}
    for a in ids:
        far = []
        for b in ids:
            if a != b:
                total = 0.0
                for x, y in zip(points[a], points[b]):
                    total += (x - y) * (x - y)
                far.append((math.sqrt(total), b))
        out[a] = sorted(far)[:k]
    return out


@pytest.mark.parametrize("shape", ["plain", "copies", "grid", "one_point", "few"])
@pytest.mark.parametrize("block_rows", [4096, 25])
def test_neighbours_match_brute_force(spark, shape, block_rows):
    rng = random.Random(11)
    if shape == "plain":
        points = {i: tuple(rng.gauss(0, 1) for _ in range(3)) for i in range(300)}
    elif shape == "copies":  # a third of all rows are copies of one point
        points = {i: (0.5, 0.5) if i % 3 == 0 else (rng.random(), rng.random()) for i in range(300)}
    elif shape == "grid":  # many equal distances
        points = {i: (float(i % 15), float(i // 15)) for i in range(225)}
    elif shape == "one_point":
        points = {i: (1.0, 2.0) for i in range(60)}
    else:
        points = {i: (float(i), 0.0) for i in range(4)}
    df = spark.createDataFrame([(i, *p) for i, p in points.items()], "id bigint, " + ", ".join(f"f{j} double" for j in range(len(points[0]))))
    got: dict[int, list] = {}
    for r in knn_graph(df, "id", df.columns[1:], 5, block_rows, 40).orderBy("src", "rank").collect():
        got.setdefault(r["src"], []).append((r["distance"], r["dst"]))
    assert got == brute(points, 5)


def test_split_hot_cells(spark, monkeypatch):
    from skylag.operators import neighbours as N

    monkeypatch.setattr(N, "MAX_PIVOTS", 2)  # two cells, each cut into many blocks
    rng = random.Random(4)
    points = {i: (rng.random(), rng.random()) for i in range(240)}
    df = spark.createDataFrame([(i, *p) for i, p in points.items()], "id bigint, x double, y double")
    got: dict[int, list] = {}
    for r in N.knn_graph(df, "id", ["x", "y"], 4, 20, 15).orderBy("src", "rank").collect():
        got.setdefault(r["src"], []).append((r["distance"], r["dst"]))
    assert got == brute(points, 4)


def test_flight_neighbours_take_the_whole_training_part(clean, monkeypatch):
    from skylag.catalog import queries as Q

    few = clean.limit(300).localCheckpoint()
    want = column(model_matrix(few).train.select("FLIGHT_ID"), "FLIGHT_ID")
    cap = S.capped_sample
    monkeypatch.setattr(S, "capped_sample", lambda df, *a, **b: cap(df, max_rows=20))  # a cap at once, not at 100,000 rows
    graph = Q._knn_flights(few)
    assert sorted({r["src"] for r in graph.collect()}) == sorted(want)


def test_neighbours_skip_missing_features(spark):
    df = spark.createDataFrame([(1, 0.0), (2, None), (3, 1.0)], "id bigint, x double")
    assert {(r["src"], r["dst"]) for r in knn_graph(df, "id", ["x"]).collect()} == {(1, 3), (3, 1)}
    assert knn_graph(df.where("id = 2"), "id", ["x"]).count() == 0


def test_unseen_categories_in_the_registered_query(spark):
    from skylag.catalog.queries import queries

    coded = queries()["encode_unseen"](spark, "/root/testdata/sf0.01")
    assert coded.where("ROUTE = -1").count() > 0 < coded.where("ROUTE >= 0").count()
    assert plan(coded).count("BroadcastHashJoin") == 1


@pytest.mark.parametrize("pivot_bytes", [64 << 20, 200])
def test_large_cells_have_pivots_of_their_own(spark, monkeypatch, pivot_bytes):
    from skylag.operators import neighbours as N

    monkeypatch.setattr(N, "MAX_PIVOTS", 3)
    monkeypatch.setattr(N, "PIVOT_BYTES", pivot_bytes)
    rng = np.random.default_rng(5)
    data = np.round(np.concatenate([rng.normal(size=(500, 3)), rng.normal(size=(200, 3)) / 50 + 4, np.ones((40, 3))]), 3)
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(data)], "id long, v array<double>").repartition(3)
    points = N._merged_points(df.select("id", F.col("v").alias("vec")), 5)
    tree = N._tree(points, points.count(), "bigint", 25, 42)
    assert len(tree.top) == 3 and (len(tree.parts) > 15) == (pivot_bytes > 200)
    got = {}
    for r in knn_graph(df, "id", "v", k=5, block_rows=25, chunk_rows=40).collect():
        got.setdefault(r["src"], []).append((r["rank"], r["dst"], r["distance"]))
    for i, v in enumerate(data):
        away = np.sqrt(((data - v) ** 2).sum(1))
        order = [j for j in np.lexsort((np.arange(len(data)), away)).tolist() if j != i][:5]
        found = sorted(got[i])
        assert [j for _, j, _ in found] == order and [d for _, _, d in found] == pytest.approx([away[j] for j in order])


def test_lists_are_cut_before_they_travel(spark):
    from skylag.operators.neighbours import _merged_lists

    lists = spark.createDataFrame([(1, [5, 6], [0.5, 0.7]), (1, [4, 9], [0.5, 0.1]), (2, [], [])], "uid long, dsts array<long>, distances array<double>")
    merged = _merged_lists(lists, 2)
    assert [[(e["distance"], e["dst"]) for e in r["list"]] for r in merged.collect()] == [[(0.1, 9), (0.5, 4), (0.5, 5)]]
    assert "WindowGroupLimit" in plan(merged)


def _points(n, seed=3):
    """Clustered points in five dimensions; a third of them is one vector, some lack a feature."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, 5)) * 8
    own = centres[rng.integers(0, 12, n)] + rng.normal(size=(n, 5))
    own[: n // 3] = own[0]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(own)]
    return [*rows, (n, None), (n + 1, [1.0, None, 1.0, 1.0, 1.0]), (n + 2, [1.0, float("nan"), 1.0, 1.0, 1.0])]


def test_approximate_neighbours(spark):
    from skylag.operators.projections import _bucketed, knn_approximate

    df = spark.createDataFrame(_points(3000), "id long, v array<double>")
    exact = {(r["src"], r["dst"]): r["distance"] for r in knn_graph(df, "id", "v", k=5).collect()}
    got = knn_approximate(df, "id", "v", k=5, bucket_rows=100).collect()
    links = {(r["src"], r["dst"]): r["distance"] for r in got}
    assert len(links) == len(got) == 15000  # five each, none twice
    assert len(links.keys() & exact.keys()) >= 0.9 * len(exact)
    assert all(abs(exact[e] - d) < 1e-9 for e, d in links.items() if e in exact)
    # at most two bounded buckets meet in a task, also where points cannot be parted
    flat = spark.createDataFrame([(i, [0.0, 0.0]) for i in range(900)], "uid long, vec array<double>")
    for points, n in ((df.where("id < 3000").selectExpr("id AS uid", "v AS vec"), 3000), (flat, 900)):
        sizes = [r["count"] for r in _bucketed(points, n, "bigint", 3, 100, 1).groupBy("band", "code", "piece").count().collect()]
        assert sum(sizes) == 3 * n and max(sizes) <= 300


def test_approximate_neighbours_of_few_rows_are_exact(spark):
    from skylag.operators.projections import knn_approximate

    df = spark.createDataFrame(_points(200), "id long, v array<double>")
    rows = lambda g: sorted((r["src"], r["rank"], r["dst"], r["distance"]) for r in g.collect())
    assert rows(knn_approximate(df, "id", "v", k=4)) == rows(knn_graph(df, "id", "v", k=4))
    assert knn_approximate(df.where("v IS NULL"), "id", "v").count() == 0
    two = df.where("id IN (0, 199)")
    assert {(r["src"], r["dst"]) for r in knn_approximate(two, "id", "v").collect()} == {(0, 199), (199, 0)}


def test_points_travel_to_groups_not_to_blocks(spark, monkeypatch):
    """Where no block can be ruled out a point still goes to few groups, however small the blocks are."""
    from skylag.operators import neighbours as N

    stored, keep = {}, N.materialise
    monkeypatch.setattr(N, "materialise", lambda df, name: stored.setdefault(name, keep(df, name)))
    data = np.random.default_rng(8).normal(size=(1500, 24))
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(data)], "id long, v array<double>")
    got = {}
    for r in N.knn_graph(df, "id", "v", k=3, block_rows=8, chunk_rows=8).collect():
        got.setdefault(r["src"], []).append((r["rank"], r["dst"]))
    away = ((data[:, None, :] - data[None, :, :]) ** 2).sum(2)
    np.fill_diagonal(away, np.inf)
    order = np.argsort(away, axis=1)[:, :3]
    assert all([d for _, d in sorted(got[i])] == order[i].tolist() for i in range(len(data)))
    sent = [r["n"] for r in stored["routes"].select(F.size("groups").alias("n")).collect()]
    assert len(sent) == 1500 and 8 < max(sent) <= 2 * N.SIDE


def test_far_leaves_are_skipped():
    """Only the leaves within the radius of a leaf of queries are compared, here less than a tenth of all pairs."""
    import pyarrow as pa

    from skylag.operators import neighbours as N

    data = np.random.default_rng(9).random((20_000, 2))
    asked, cloud = data[N._halved(data, N._LEAF)[0]], N._Leaves(data)
    met = []
    members = cloud.members
    cloud.members = lambda leaves: met.append(members(leaves)) or met[-1]
    q, p = N._close_pairs(asked, np.full(len(asked), np.inf), cloud, 1e-9, 16)
    assert len(met) == 2 and len(met[1]) < 2_000 and len(set(q.tolist())) == len(asked)
    counts, dst, _ = N.nearest_lists(asked, np.full(len(asked), np.inf), data, pa.array([[i] for i in range(len(data))]), 16)
    away = ((asked[:, None, :] - data[None, :, :]) ** 2).sum(2)
    assert (counts == 16).all() and (np.sort(dst.reshape(-1, 16)) == np.sort(np.argsort(away, axis=1)[:, :16])).all()


def test_text_identifiers_are_numbered_in_their_order(spark):
    from skylag.operators.projections import knn_approximate

    df = spark.createDataFrame([(f"{i}", float(i % 4)) for i in range(40)], "id string, x double")
    for graph in (knn_graph, knn_approximate):
        got = {}
        for r in graph(df, "id", ["x"], k=3).collect():
            got.setdefault(r["src"], []).append((r["rank"], r["dst"], r["distance"]))
        for i in range(40):
            copies = sorted(str(j) for j in range(i % 4, 40, 4) if j != i)[:3]
            assert sorted(got[str(i)]) == [(n + 1, c, 0.0) for n, c in enumerate(copies)]


def test_only_leaves_that_some_query_needs_are_compared():
    """A leaf of queries is wide in many dimensions: its box is near many leaves that lie beyond the radius of each query."""
    from skylag.operators import neighbours as N

    rng, n = np.random.default_rng(11), 30_000
    a, b = rng.random((2, n)) * 2 * np.pi
    data = np.column_stack([rng.normal(size=(n, 2)), np.sin(a), np.cos(a), np.sin(b), np.cos(b), rng.integers(1, 13, n), rng.integers(1, 8, n)])
    asked, cloud = data[N._halved(data, N._LEAF)[40]], N._Leaves(data)
    met = []
    members = cloud.members
    cloud.members = lambda leaves: met.append(members(leaves)) or met[-1]
    q, p = N._close_pairs(asked, np.full(len(asked), np.inf), cloud, 1e-9, 16)
    assert len(met[-1]) < 15_000
    away = ((asked[:, None, :] - cloud.vectors[None, :, :]) ** 2).sum(2)
    for i in range(len(asked)):
        assert set(np.argsort(away[i])[:16].tolist()) <= set(p[q == i].tolist())


def test_names_meet_the_edges_once(spark):
    """The source of an edge keeps its name from its row; only the other end is looked up."""
    from skylag.operators.projections import knn_approximate

    df = spark.createDataFrame([(f"{i}", float(i % 7)) for i in range(60)], "id string, x double")
    for graph in (knn_graph, knn_approximate):
        logical = graph(df, "id", ["x"], k=3)._jdf.queryExecution().optimizedPlan().toString()
        assert logical.count("Relation [number") == 1


def test_leaves_part_at_whole_values():
    """Columns of few values are cut between them, so the boxes of two months do not touch and few leaves are compared."""
    from skylag.operators import neighbours as N

    rng, n = np.random.default_rng(12), 30_000
    data = np.column_stack([rng.integers(1, 13, n), rng.integers(1, 8, n), rng.integers(1, 5, n), rng.normal(size=(n, 3))])
    cloud, met = N._Leaves(data, N._LEAF // 2), []
    members = cloud.members
    cloud.members = lambda leaves: met.append(members(leaves)) or met[-1]
    leaves = N._halved(data, N._LEAF)
    assert sorted(np.concatenate(leaves).tolist()) == list(range(n))
    for leaf in leaves[::40]:
        met.clear()
        asked = data[leaf]
        q, p = N._close_pairs(asked, np.full(len(asked), np.inf), cloud, 1e-9, 16)
        assert sum(map(len, met)) < 6_000
        away = ((asked[:, None, :] - cloud.vectors[None, :, :]) ** 2).sum(2)
        for i in range(len(asked)):
            assert set(np.argsort(away[i])[:16].tolist()) <= set(p[q == i].tolist())


def test_only_the_last_band_of_approximate_neighbours_stays_on_disk(spark, monkeypatch):
    """Each band's points and lists are stored and its predecessor is removed; links are those of all bands merged at once."""
    import os

    from skylag.operators import neighbours as N
    from skylag.operators import projections as J

    names, folders, keep, drop = [], [], J.materialise, J.discard
    for module in (J, N):
        monkeypatch.setattr(module, "materialise", lambda df, name: names.append(name) or keep(df, name))
    monkeypatch.setattr(J, "discard", lambda df: folders.extend({os.path.dirname(f).removeprefix("file:") for f in df.inputFiles()}) or drop(df))
    monkeypatch.setattr(J, "ACCURACY", 100_000)  # exact cuts, whatever the partitions are
    data = np.random.default_rng(13).normal(size=(1200, 4))
    text = spark.createDataFrame([(f"{i:04}", [float(x) for x in v]) for i, v in enumerate(data)], "id string, v array<double>")
    assert J.knn_approximate(text, "id", "v", k=4, bands=3, bucket_rows=60).count() == 4800
    assert names.count("lists") == 3
    assert len(folders) == len(set(folders)) == 5 and not any(os.path.exists(f) for f in folders)  # vectors, numbers, points, two bands
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(data)], "id long, v array<double>")
    got: dict[int, list] = {}
    for r in J.knn_approximate(df, "id", "v", k=4, bands=3, bucket_rows=60).orderBy("src", "rank").collect():
        got.setdefault(r["src"], []).append(r["dst"])
    buckets: dict[tuple, list] = {}
    for r in J._bucketed(df.selectExpr("id AS uid", "v AS vec"), 1200, "bigint", 3, 60, 42).collect():
        buckets.setdefault((r["band"], r["code"], r["piece"]), []).append(r["uid"])
    near: dict[int, set] = {}
    for members in buckets.values():
        for i in members:
            near.setdefault(i, set()).update(members)
    for i, met in near.items():
        assert got[i] == sorted(met - {i}, key=lambda j: math.dist(data[i], data[j]))[:4]
