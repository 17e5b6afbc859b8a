"""Clusters and forests on planted data."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from xoutcome.operators import cluster as C
from xoutcome.operators import models as M
from xoutcome.operators.models import fit_forest, predict, random_search
from xoutcome.operators.scaling import Components, Scaler, SoftClusters
from xoutcome.plans.clusters import ClusterModel, score_clusters

X = ["a", "b", "c", "d"]
CENTRES = np.array([[0, 0, 0, 0], [5, 5, 0, 0], [0, 5, 5, 5]], dtype=float)


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(1)
    rows = [(i, i % 3, *map(float, CENTRES[i % 3] + rng.normal(0, 0.3, 4))) for i in range(300)]
    return spark.createDataFrame(rows, "id long, label int, a double, b double, c double, d double").cache()


def matrix(df):
    return df.orderBy("id").select(*X).toPandas().to_numpy()


def near_planted(found):
    found = np.asarray(found)
    assert len(found) == 3
    for c in CENTRES:
        assert np.abs(found - c).sum(1).min() < 0.4


def test_components_match_the_eigenvectors(blobs):
    x = matrix(blobs)
    model = Components.fit(blobs, X, 0.95)
    values, vectors = np.linalg.eigh(np.cov(x.T))
    shares = values[::-1] / values.sum()
    assert len(model.loadings) == int(np.searchsorted(np.cumsum(shares), 0.95, side="right")) + 1
    for got, want in zip(model.loadings, vectors[:, ::-1].T):
        assert abs(np.dot(got, want)) == pytest.approx(1, abs=1e-8)
        assert got[int(np.argmax(np.abs(got)))] > 0
    scores = model.apply(blobs).orderBy("id").select(*model.features).toPandas().to_numpy()
    assert scores == pytest.approx((x - x.mean(0)) @ np.array(model.loadings).T, abs=1e-9)


def test_scaler_uses_population_deviation(blobs):
    scaled = matrix(Scaler.fit(blobs, X).apply(blobs))
    assert scaled.std(0) == pytest.approx(np.ones(4))


def test_planted_clusters_are_chosen(blobs):
    points = blobs.select(F.lit(0).cast("long").alias("gid"), *X)
    score, k, restarts, centres = C.choose_k(points, X, {0: range(2, 6)}, (3, 5))[0]
    assert k == 3 and 3 <= restarts <= 5 and score > 0.8
    near_planted(centres)
    hashes = np.array([r[0] for r in blobs.orderBy("id").select(C.row_hash(X)).collect()])
    in_task = C.choose_in_group(matrix(blobs), hashes, range(2, 6), (3, 5))
    assert in_task[:3] == (pytest.approx(score, abs=1e-9), k, restarts)
    assert np.array(sorted(map(tuple, in_task[3]))) == pytest.approx(np.array(sorted(map(tuple, centres))), abs=1e-9)


@pytest.fixture(scope="module")
def groups(spark):
    """Groups of several shapes: blurred clusters, many equal rows, few rows, one row, a null key."""
    rng = np.random.default_rng(9)
    rows = [(1, "abc"[i % 3], *map(float, CENTRES[i % 3] + rng.normal(0, 1.5, 4))) for i in range(260)]
    rows += [(2, "ab"[i % 2], *map(float, CENTRES[i % 2])) for i in range(40)] + [(3, "a", *map(float, rng.normal(0, 1, 4))) for _ in range(7)]
    rows += [(None, "a", *map(float, rng.normal(0, 1, 4))) for _ in range(50)] + [(4, "a", 1.0, 2.0, 3.0, 4.0)]
    return spark.createDataFrame(rows, "g int, kind string, a double, b double, c double, d double")


def by_group(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["g"], []).append((r["k"], r["restarts"], round(r["score"], 7), *(round(r[x], 7) for x in X)))
    return {g: sorted(v) for g, v in out.items()}


@pytest.mark.parametrize("squared", [False, True])
def test_one_result_at_every_size(groups, squared):
    """In tasks, as jobs, half and half, and for shuffled rows in other partitions."""
    args = (["g"], X, "kind", 2, 3, (3, 6), squared)
    want = by_group(C.entity_kmeans(groups, *args))
    assert set(want) == {1, 2, 3, 4, None} and want[4][0][0] == 1
    for limit in (0, 45):
        assert by_group(C.entity_kmeans(groups, *args, rows_in_task=limit)) == want
    assert by_group(C.entity_kmeans(groups.orderBy(F.rand(5)).repartition(7), *args)) == want
    assert by_group(C.entity_kmeans(groups.orderBy(F.rand(6)).repartition(3), *args, rows_in_task=0)) == want


def test_candidates_cover_all_different_rows(spark):
    x = np.repeat(np.arange(12.0), 5)[:, None] + np.zeros((1, 4))
    found, weights = C.candidates_of(x, np.arange(len(x)) % 12, 30)
    assert found[:, 0].tolist() == list(range(12)) and weights.tolist() == [5] * 12


def test_fuzzy_centres_match_a_plain_loop(blobs):
    soft, _, _ = C.fuzzy_cmeans_fit(blobs, X, 3, 3, (3, 4))
    near_planted(soft.centers)
    assert soft.state.converged and soft.state.shift <= 1e-5 and soft.state.rounds > 1
    with pytest.warns(RuntimeWarning, match="still moved"):
        early, _, _ = C.fuzzy_cmeans_fit(blobs, X, 3, 3, (3, 4), rounds=2)
    assert not early.state.converged and early.state.rounds == 2 and early.state.objective >= soft.state.objective
    late, score, _ = C.fuzzy_cmeans_fit(blobs, X, start=early)
    assert late.state.converged and late.state.rounds > 2 and score is None
    assert np.array(late.centers) == pytest.approx(np.array(soft.centers), abs=1e-4)
    x, c = matrix(blobs), CENTRES.copy()
    for _ in range(200):
        d = ((x[:, None] - c[None]) ** 2).sum(2)
        u = (1 / d) / (1 / d).sum(1, keepdims=True)
        c = (u ** 2).T @ x / (u ** 2).sum(0)[:, None]
    got = np.array(sorted(map(tuple, soft.centers)))
    assert got == pytest.approx(np.array(sorted(map(tuple, c))), abs=1e-3)


def test_fuzzy_centres_that_move_slowly_come_to_rest(spark):
    """84 points without clear clusters: plain steps go on beyond 150 rounds, to the same centres."""
    x = np.random.default_rng(4).normal(0, 1, (84, 4))
    c, plain = x[:3].copy(), 0
    for plain in range(1, 2001):
        d = ((x[:, None] - c[None]) ** 2).sum(2)
        u = np.where(d == 0, 1e12, 1 / np.where(d == 0, 1, d))
        u = (u / u.sum(1, keepdims=True)) ** 2
        last, c = c, u.T @ x / u.sum(0)[:, None]
        if plain > 1 and np.abs(c - last).max() <= 1e-8:
            break
    points = spark.createDataFrame([(0, 0, *map(float, r)) for r in x], "gid long, _hash long, a double, b double, c double, d double").repartition(2)
    models, _, states = C.fit_centers(points.cache(), X, {0: [x[:3].copy()]}, True, 150, 1e-8)
    assert plain > 150 and states[0][0].converged and states[0][0].rounds < 150
    assert models[0][0] == pytest.approx(c, abs=1e-5)


def test_memberships(spark, blobs):
    soft = SoftClusters(X, CENTRES.tolist())
    rows = soft.membership(blobs).select("label", *soft.columns).collect()
    for r in rows:
        u = list(r)[1:]
        assert sum(u) == pytest.approx(1) and int(np.argmax(u)) == r["label"]
    on = spark.createDataFrame([tuple(CENTRES[1].tolist())], "a double, b double, c double, d double")
    assert list(soft.membership(on).select(*soft.columns).first()) == [0.0, 1.0, 0.0]


def brute_silhouette(x, labels, squared):
    d = ((x[:, None] - x[None]) ** 2).sum(2)
    d = d if squared else np.sqrt(d)
    out = []
    for i in range(len(x)):
        mean = {c: d[i, (labels == c) & (np.arange(len(x)) != i)].mean() for c in set(labels)}
        a, b = mean[labels[i]], min(v for c, v in mean.items() if c != labels[i])
        out.append((b - a) / max(a, b))
    return float(np.mean(out))


@pytest.mark.parametrize("squared", [True, False])
def test_silhouette_over_many_tiles(blobs, squared):
    labels = np.array([r["label"] for r in blobs.orderBy("id").collect()])
    want = brute_silhouette(matrix(blobs), labels, squared)
    got = C.silhouette_score(blobs, "id", X, "label", squared, tile_rows=40).first()[0]
    assert got == pytest.approx(want, abs=1e-9)
    if not squared:
        assert C.group_silhouettes(matrix(blobs), [labels])[0] == pytest.approx(want, abs=1e-9)


def test_distances_of_equal_rows_far_from_zero():
    """Equal rows are at distance 0 exactly, others as by differences, also where squares cancel."""
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(0, 1, (300, 4)), np.repeat(rng.normal(0, 1, (3, 4)), 50, axis=0)]) + 1000
    onehot = np.eye(2)[np.arange(len(x)) % 2]
    sums = np.zeros((len(x), 2))
    C.add_distances(x - 1000, x - 1000, onehot, sums)
    want = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2)) @ onehot
    assert sums == pytest.approx(want, abs=1e-7)
    same = np.zeros((50, 1))
    C.add_distances(x[-50:], x[-50:], np.ones((50, 1)), same)
    assert not same.any()


def test_scores_write_the_points_once(spark):
    """What a choice of k writes does not grow with the number of its models."""
    import os
    from xoutcome.session import shared_dir
    size = lambda: sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(shared_dir(spark).removeprefix("file:")) for f in fs)
    x = np.random.default_rng(8).normal(0, 1, (4000, 4))
    points = spark.createDataFrame([(0, *map(float, r)) for r in x], "gid long, a double, b double, c double, d double").cache()
    before = size()
    score, k, _, centres = C.choose_k(points, X, {0: range(2, 5)}, (2, 3))[0]
    assert size() - before < 3 * x.nbytes
    labels = C.squared_distances(x, centres).argmin(1)
    assert score == pytest.approx(brute_silhouette(x, labels, False), abs=1e-9) and k == len(centres)


def test_keys_that_repeat_are_one_point(spark, blobs):
    """Rows of one key add up their distances, whichever shares and clusters they are in, as they did."""
    twice = blobs.union(blobs.where("id < 20"))
    whole = C.silhouette_score(twice, "id", X, "label").first()[0]
    assert C.silhouette_score(twice, "id", X, "label", tile_rows=30).first()[0] == pytest.approx(whole, abs=1e-9)


@pytest.mark.parametrize("squared", [True, False])
def test_silhouette_of_blurred_clusters(spark, squared):
    """Clusters of one row, equal points, overlapping clusters; far clusters are ruled out."""
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(0, 1, (80, 4)), rng.normal(1, 2, (60, 4)), np.ones((20, 4)), rng.normal(30, 1, (50, 4)), [[9.0, 9, 9, 9]]])
    labels = np.array([0] * 80 + [1] * 60 + [2] * 20 + [3] * 50 + [7])
    rows = spark.createDataFrame([(i, int(c), *map(float, r)) for i, (r, c) in enumerate(zip(x, labels))], "id long, label int, a double, b double, c double, d double")
    d = ((x[:, None] - x[None]) ** 2).sum(2)
    d = d if squared else np.sqrt(d)
    want = []
    for i, own in enumerate(labels):
        mean = {c: d[i, labels == c].sum() / max(1, (labels == c).sum() - (c == own)) for c in set(labels)}
        a, b = mean[own], min(v for c, v in mean.items() if c != own)
        want.append(0 if (labels == own).sum() == 1 else (b - a) / max(a, b))
    for tile in (17, 2048):
        assert C.silhouette_score(rows, "id", X, "label", squared, tile).first()[0] == pytest.approx(np.mean(want), abs=1e-9)
    one = rows.withColumn("label", F.lit(1))
    assert C.silhouette_score(one, "id", X, "label", squared).first()[0] == 0


def test_incomplete_rows_keep_their_values(spark, blobs, tmp_path):
    scaler = Scaler.fit(blobs, X)
    parts = Components.fit(scaler.apply(blobs), X, 0.9)
    near = parts.apply(scaler.apply(blobs)).limit(2).select(*parts.features).collect()
    model = ClusterModel(scaler, parts, SoftClusters(parts.features, [list(r) for r in near]))
    model.save(spark, str(tmp_path / "m"))
    assert ClusterModel.load(spark, str(tmp_path / "m")) == model
    holed = blobs.withColumn("b", F.when(F.col("id") != 7, F.col("b")))
    row = score_clusters(holed, model).filter("id = 7").first()
    assert row["a"] == blobs.filter("id = 7").first()["a"]
    assert row["b"] is None and row["attribute_0"] is None and row["cluster_attribute_0"] is None
    assert score_clusters(holed, model).filter("cluster_attribute_0 IS NULL").count() == 1


@pytest.fixture(scope="module")
def planted(spark):
    rng = np.random.default_rng(5)
    x = rng.uniform(-1, 1, (800, 3))
    y = 2 * x[:, 0] - x[:, 1] ** 2 + rng.normal(0, 0.05, 800)
    return spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)], "p double, q double, r double, y double")


def test_forest_beats_the_mean(planted):
    model = fit_forest(planted, ["p", "q", "r"], "y", numTrees=10, maxDepth=6)
    scored = predict(model, planted)
    error, spread = scored.agg(F.avg((F.col("y") - F.col("pred")) ** 2), F.var_pop("y")).first()
    assert error < spread / 3


def test_search_finds_deeper_trees(planted):
    few = {"numTrees": [5], "maxDepth": [1, 6], "featureSubsetStrategy": ["all"], "minInstancesPerNode": [1],
           "bootstrap": [True]}
    _, table = random_search(planted, ["p", "q", "r"], "y", n=2, folds=3, settings=few)
    scores = {r["maxDepth"]: r["r2"] for r in table.collect()}
    assert scores["6"] > scores["1"]


def test_a_forest_of_batches_is_one_forest(spark, planted, tmp_path):
    """Its prediction is the mean of all trees, also after saving, and its rows keep their columns."""
    from pyspark.ml import PipelineModel
    model = fit_forest(planted, ["p", "q", "r"], "y", numTrees=25, trees_per_fit=10, maxDepth=4)
    batches = model.stages[1:-1]
    assert [m.getNumTrees for m in batches] == [10, 10, 5]
    scored = predict(model, planted, "guess")
    assert scored.columns == [*planted.columns, "guess"]
    for r in scored.limit(5).collect():
        from pyspark.ml.linalg import Vectors
        x = Vectors.dense(r["p"], r["q"], r["r"])
        trees = [t.predict(x) for m in batches for t in m.trees]
        assert len(trees) == 25 and r["guess"] == pytest.approx(np.mean(trees), abs=1e-9)
    model.write().overwrite().save(str(tmp_path / "m"))
    again = predict(PipelineModel.load(str(tmp_path / "m")), scored, "after")
    assert again.where("guess <> after").count() == 0 and sum(M.importances(model)) == pytest.approx(1)


def test_settings_by_number():
    """All combinations, each once, and equal chances for all twelve depths."""
    import itertools
    grid = M.param_grid()
    assert [tuple(s.values()) for s in grid] == list(itertools.product(*M.SEARCH.values())) and len(grid) == M.grid_size() == 1440
    counts = {d: 0 for d in M.SEARCH["maxDepth"]}
    for seed in range(300):
        drawn = M.drawn_settings(100, seed)
        assert len({i for i, _ in drawn}) == 100
        for _, s in drawn:
            counts[s["maxDepth"]] += 1
    assert all(abs(n - 2500) < 250 for n in counts.values())
