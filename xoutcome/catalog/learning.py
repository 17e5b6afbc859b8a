"""Scaling, components, clusters, forests."""

from __future__ import annotations

from pyspark.sql import functions as F

from xoutcome import schema as S
from xoutcome.catalog.base import Tables, query, r6, r6s
from xoutcome.operators import cluster as C
from xoutcome.operators import models as M
from xoutcome.operators.scaling import Components, Scaler, SoftClusters
from xoutcome.plans import modelling
from xoutcome.plans.clusters import learn_clusters, score_clusters
from xoutcome.plans.features import batter_features, pitcher_features
from xoutcome.catalog.whole import features_sql
from xoutcome.operators.filters import drop_null_rows, group_size_filter
from xoutcome.session import stored

POINT = ("point_fx",)


_MEAN_DEV = ", ".join(f"AVG({m}) AS a_{m}, STDDEV_POP({m}) AS d_{m}" for m in S.METRICS)


@query("standardize", f"WITH f AS (SELECT {_MEAN_DEV} FROM point_fx) SELECT vec_id, "
       + ", ".join(r6(f"({m} - a_{m}) / d_{m}", m) for m in S.METRICS) + " FROM point_fx, f", POINT)
def _(t: Tables):
    points = t.point_fx.drop("label")
    return Scaler.fit(points, S.METRICS).apply(points)


@query("standardize_inverse", f"SELECT vec_id, {r6s(*S.METRICS)} FROM point_fx", POINT)
def _(t: Tables):
    points = t.point_fx.drop("label")
    scaler = Scaler.fit(points, S.METRICS)
    return scaler.inverse(scaler.apply(points))


def _scaled(t: Tables):
    points = t.point_fx
    return Scaler.fit(points, S.METRICS).apply(points)


_NORM = " + ".join(f"(({m} - a_{m}) / d_{m}) * (({m} - a_{m}) / d_{m})" for m in S.METRICS)


@query("pca", f"WITH f AS (SELECT {_MEAN_DEV} FROM point_fx) SELECT vec_id, label, {r6(_NORM, 'norm')}, TRUE AS falling FROM point_fx, f", POINT)
def _(t: Tables):
    """All components of each point: their squares sum to those of its scaled metrics, and their variances fall."""
    scaled = _scaled(t)
    parts = Components.fit(scaled, S.METRICS, 1.1)
    rows = parts.apply(scaled)
    spread = list(rows.agg(*[F.var_pop(f) for f in parts.features]).first())
    falling = all(a >= b - 1e-9 for a, b in zip(spread, spread[1:]))
    norm = sum((F.col(f) * F.col(f) for f in parts.features[1:]), F.col(parts.features[0]) * F.col(parts.features[0]))
    return rows.select("vec_id", "label", norm.alias("norm"), F.lit(falling).alias("falling"))


def _reduced(t: Tables):
    scaled = _scaled(t)
    parts = Components.fit(scaled, S.METRICS)
    return parts.apply(scaled).select("vec_id", "label", *parts.features), parts.features


def _balance(points, centers, keys: list[str], features: list[str]):
    """Per group the rows nearest to each of its centres, and the centres' mean weighted by them: that of the rows, if the centres rest."""
    held = centers.groupBy(*keys).agg(F.collect_list(F.struct(*features)).alias("_c"))
    both = points.join(held, keys)
    gap = lambda c: sum((((c[f] - F.col(f)) * (c[f] - F.col(f))) for f in features[1:]), (c[features[0]] - F.col(features[0])) * (c[features[0]] - F.col(features[0])))
    near = both.select(*keys, F.array_min(F.transform("_c", lambda c: F.struct(gap(c).alias("d"), c.alias("c")))).alias("n"))
    return near.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *[F.avg(F.col("n.c").getField(f)).alias(f) for f in features])


_MEANS = ", ".join(r6(f"AVG({m})", m) for m in S.METRICS)


@query("entity_kmeans", f"SELECT label, COUNT(*) AS n, {_MEANS} FROM point_fx GROUP BY label", POINT)
def _(t: Tables):
    """Each label's own best clustering; what is told of it is what its resting centres keep of the points."""
    points = t.point_fx.withColumn("kind", F.col("vec_id") % 2)
    centers = stored(C.entity_kmeans(points, ["label"], S.METRICS, "kind"), "centres")
    return _balance(points, centers, ["label"], S.METRICS)


@query("choose_k", f"SELECT COUNT(*) AS n, {_MEANS}, TRUE AS chosen FROM point_fx", POINT)
def _(t: Tables):
    points = stored(t.point_fx.select(F.lit(0).cast("long").alias("gid"), *S.METRICS), "points")
    score, k, restarts, centers = C.choose_for_table(points, S.METRICS, range(2, 13))
    table = t.spark.createDataFrame([(0, *map(float, c)) for c in centers], "gid long, " + ", ".join(f"{m} double" for m in S.METRICS))
    chosen = 2 <= k <= 12 and 3 <= restarts <= 20 and -1 <= score <= 1 and len(centers) == k
    return _balance(points, table, ["gid"], S.METRICS).drop("gid").withColumn("chosen", F.lit(chosen))


def _silhouette_sql(distance: str) -> str:
    return f"""
WITH d AS (SELECT a.vec_id, a.label AS own, b.label AS other, {distance} AS gap FROM point_fx a JOIN point_fx b ON a.vec_id <> b.vec_id),
m AS (SELECT vec_id, own, other, AVG(gap) AS gap FROM d GROUP BY ALL),
s AS (SELECT vec_id, MIN(CASE WHEN own = other THEN gap END) AS a, MIN(CASE WHEN own <> other THEN gap END) AS b FROM m GROUP BY vec_id)
SELECT {r6('AVG(COALESCE((b - a) / GREATEST(a, b), 0))', 'silhouette')} FROM s"""


_GAP = " + ".join(f"(a.{m} - b.{m}) * (a.{m} - b.{m})" for m in S.METRICS)


@query("silhouette_score", _silhouette_sql(f"sqrt({_GAP})"), POINT)
def _(t: Tables):
    return C.silhouette_score(t.point_fx, "vec_id", S.METRICS, "label")


@query("silhouette_score_squared", _silhouette_sql(_GAP), POINT)
def _(t: Tables):
    return C.silhouette_score(t.point_fx, "vec_id", S.METRICS, "label", squared=True)


@query("fuzzy_cmeans_fit", "SELECT vec_id, 1.0::DOUBLE AS total, TRUE AS rests FROM point_fx", POINT)
def _(t: Tables):
    """Memberships in clusters that rest: they sum to 1, and the fit says that it ended."""
    rows, features = _reduced(t)
    soft, _, _ = C.fuzzy_cmeans_fit(rows, features, 3, 12)
    total = sum((F.col(c) for c in soft.columns[1:]), F.col(soft.columns[0]))
    return soft.membership(rows).select("vec_id", total.alias("total"), F.lit(soft.state.converged).alias("rests"))


_USED = S.METRICS
_NEAR = " + ".join(f"(p.{m} - c.{m}) * (p.{m} - c.{m})" for m in _USED)
_LABELS = range(10)


@query("fuzzy_membership", f"""
WITH c AS (SELECT label AS at, {', '.join(f'AVG({m}) AS {m}' for m in _USED)} FROM point_fx GROUP BY label),
w AS (SELECT p.vec_id, c.at, 1 / ({_NEAR}) AS w FROM point_fx p, c),
s AS (SELECT vec_id, SUM(w) AS total FROM w GROUP BY vec_id)
SELECT w.vec_id, {', '.join(r6(f'MAX(CASE WHEN w.at = {i} THEN w.w / s.total END)', f'cluster_attribute_{i}') for i in _LABELS)}
FROM w JOIN s ON s.vec_id = w.vec_id GROUP BY w.vec_id""", POINT)
def _(t: Tables):
    means = t.point_fx.groupBy("label").agg(*[F.avg(m).alias(m) for m in _USED]).orderBy("label").collect()
    soft = SoftClusters(_USED, [[r[m] for m in _USED] for r in means])
    return soft.membership(t.point_fx.select("vec_id", *_USED)).drop(*_USED)


def _seasons(t: Tables):
    return t.raw_fx.withColumns({"spin_x": F.col("vx0") + F.col("ax"), "spin_z": F.col("vy0") - F.col("az")}).select(
        *S.METRICS, "pitcher", "game_year", "pitch_type", "at_bat_number")


_COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in [*S.METRICS, "pitcher", "game_year", "pitch_type"])
_SEASONS = f"""seasons AS (SELECT * FROM (SELECT *, vx0 + ax AS spin_x, vy0 - az AS spin_z FROM raw_fx))"""


@query("learn_clusters", f"""WITH {_SEASONS} SELECT pitcher, game_year, COUNT(*) AS n, TRUE AS rests FROM seasons WHERE {_COMPLETE}
GROUP BY pitcher, game_year HAVING COUNT(*) >= 10""", ("raw_fx",))
def _(t: Tables):
    """Each season of an entity, whether the centres rest on its rows, and whether the soft clusters rest on the centres."""
    rows = stored(_seasons(t), "seasons")
    model, centers = learn_clusters(rows, min_rows=10, mini=3, maxi=8, restarts=(3, 5))
    features = model.components.features
    reduced = stored(model.components.apply(model.scaler.apply(drop_null_rows(rows.select(*S.METRICS, "pitcher", "game_year", "pitch_type")))), "reduced")
    keys = ["pitcher", "game_year"]
    means = group_size_filter(reduced, keys, 10).groupBy(*keys).agg(*[F.avg(f).alias(f"_{f}") for f in features])
    found = _balance(reduced, centers, keys, features).join(means, keys)
    rests = F.lit(model.soft.state.converged)
    for f in features:
        rests &= F.abs(F.col(f) - F.col(f"_{f}")) < 1e-6
    return found.select(*keys, "n", rests.alias("rests"))


@query("score_clusters", f"""WITH {_SEASONS} SELECT at_bat_number, CASE WHEN at_bat_number % 17 <> 0 AND {' AND '.join(f'{m} IS NOT NULL' for m in S.METRICS)}
THEN 1.0::DOUBLE END AS total FROM seasons""", ("raw_fx",))
def _(t: Tables):
    rows = _seasons(t)
    holed = rows.withColumn("ax", F.when(F.col("at_bat_number") % 17 != 0, F.col("ax")))
    model, _ = learn_clusters(rows, min_rows=10, mini=3, maxi=8, restarts=(3, 5))
    total = sum((F.col(c) for c in model.soft.columns[1:]), F.col(model.soft.columns[0]))
    return score_clusters(holed, model).select("at_bat_number", total.alias("total"))


# ---- forests; SQL can't grow them, but it knows the rows that they are asked about and the range of every prediction ----

def _days(t: Tables, entity: str):
    """Days of an entity with a segment-ending event, as ``day_fx`` for either side of the pairs."""
    event = lambda name: F.sum((F.col("events") == name).cast("long"))
    return t.pitch_fx.where("events IS NOT NULL").groupBy(entity, "game_date").agg(
        F.count(F.lit(1)).alias("pa"), event("walk").alias("bb"), event("strikeout").alias("k"), F.avg("xba").alias(S.TARGET))


def _prepared(t: Tables):
    """Features of batters and pitchers, and the pairs of both with their days."""
    batters = stored(batter_features(_days(t, "batter")), "batter-features")
    pitchers = stored(pitcher_features(_days(t, "pitcher")), "pitcher-features")
    return batters, pitchers, _pairs(t)


def _pairs(t: Tables):
    pairs = t.pitch_fx.filter("events IS NOT NULL").groupBy("pitcher", "batter", "game_date").agg(
        F.count("*").alias("pa"), F.avg("xba").alias(S.TARGET), F.avg(F.col("spin_axis") / 360).alias("cluster_attribute_0"),
        F.avg(F.col("release_spin_rate") / 5000).alias("cluster_attribute_1"))
    return stored(pairs.dropna(), "pairs")


def _told(scored, keys: list[str]):
    """Scored rows: what was asked, and whether the prediction lies in the target's range, as means of targets do."""
    low, high = scored.agg(F.min("y"), F.max("y")).first()
    return scored.select(*keys, "y", "w", (F.col("pred").between(low - 1e-9, high + 1e-9)).alias("inside"))


def _entity_sql(entity: str) -> str:
    """The feature rows of one side, by its days among the events."""
    days = f"""(SELECT {entity} AS pitcher, game_date, COUNT(*) AS pa, CAST(SUM(CASE WHEN events = 'walk' THEN 1 ELSE 0 END) AS BIGINT) AS bb,
  CAST(SUM(CASE WHEN events = 'strikeout' THEN 1 ELSE 0 END) AS BIGINT) AS k, AVG(xba) AS xba FROM pitch_fx WHERE events IS NOT NULL GROUP BY {entity}, game_date)"""
    if entity == "batter":
        text = features_sql("batter", ["bb", "k", "pa", "next_play"], ["next_xba"], S.BATTER_WINDOWS, 15, True, True)
    else:
        text = features_sql("pitcher", ["bb", "k", "pa"], [], S.PITCHER_WINDOWS, 22, False, False)
    return text.replace("FROM day_fx", f"FROM {days}")


SMALL = {"numTrees": 30}  # README has the times of the full sizes
_PITCH = ("pitch_fx",)
_PAIRS = f"""b AS (SELECT batter, game_date FROM ({_entity_sql('batter')}) x), p AS (SELECT pitcher, game_date FROM ({_entity_sql('pitcher')}) x),
pairs AS (SELECT pitcher, batter, game_date, COUNT(*) AS pa, AVG(xba) AS y FROM pitch_fx WHERE events IS NOT NULL GROUP BY pitcher, batter, game_date
  HAVING AVG(xba) IS NOT NULL AND AVG(spin_axis) IS NOT NULL AND AVG(release_spin_rate) IS NOT NULL)"""
_ASKED = (f"WITH {_PAIRS} SELECT pairs.pitcher, pairs.batter, pairs.game_date, {r6('y', 'y')}, pa AS w, TRUE AS inside FROM pairs "
          "JOIN b ON b.batter = pairs.batter AND b.game_date = pairs.game_date JOIN p ON p.pitcher = pairs.pitcher AND p.game_date = pairs.game_date")


@query("fit_forest", f"SELECT COUNT(*) AS rows, 1.0::DOUBLE AS total FROM ({_entity_sql('pitcher')}) x", _PITCH)
def _(t: Tables):
    """The importances of a pitcher forest of two batches of trees sum to 1."""
    pitchers = stored(pitcher_features(_days(t, "pitcher")), "pitcher-features")
    model = modelling.fit_model(pitchers, "pitcher", numTrees=60, trees_per_fit=30)
    return pitchers.agg(F.count(F.lit(1)).alias("rows")).withColumn("total", F.lit(float(sum(M.importances(model)))))


@query("predict", f"SELECT batter, game_date, {r6('next_xba', 'y')}, pa AS w, TRUE AS inside FROM ({_entity_sql('batter')}) x", _PITCH)
def _(t: Tables):
    batters = stored(batter_features(_days(t, "batter")), "batter-features")
    return _told(modelling.scored_rows(modelling.fit_model(batters, "batter", **SMALL), batters, "batter"), ["batter", "game_date"])


FEW = {"numTrees": [10, 20], "maxDepth": [3, 6, None], "featureSubsetStrategy": ["all", "sqrt"], "minInstancesPerNode": [1, 4]}
_LISTS = {**M.SEARCH, **FEW}
_DIGITS, _below = [], 1
for _name, _values in reversed(_LISTS.items()):
    _DIGITS.append(f"list_extract([{', '.join(repr(str(v)) for v in _values)}], CAST(number // {_below} % {len(_values)} + 1 AS INTEGER)) AS \"{_name}\"")
    _below *= len(_values)


@query("random_search", f"SELECT CAST(number AS INTEGER) AS number, {', '.join(_DIGITS)}, TRUE AS scored FROM range({_below}) r(number) "
       f"ORDER BY md5('{M.SEARCH_SEED}:' || number) LIMIT 4")
def _(t: Tables):
    pairs = _pairs(t)
    features, y = modelling.model_columns(pairs, "matchup")
    _, table = M.random_search(pairs, features, y, n=4, settings=FEW)
    return table.withColumn("scored", F.col("r2") <= 1).drop("r2")


def _three(t: Tables):
    batters, pitchers, pairs = _prepared(t)
    models = {kind: modelling.fit_model(df, kind, **SMALL) for kind, df in (("batter", batters), ("pitcher", pitchers), ("matchup", pairs))}
    return batters, pitchers, pairs, models


@query("stacked_model", _ASKED, _PITCH)
def _(t: Tables):
    batters, pitchers, pairs, models = _three(t)
    rows = stored(modelling.stacked_rows(pairs, batters, pitchers, models), "stacked")
    return _told(modelling.scored_rows(modelling.fit_model(rows, "stacked", **SMALL), rows, "stacked"), ["pitcher", "batter", "game_date"])


@query("combined_model", _ASKED, _PITCH)
def _(t: Tables):
    batters, pitchers, pairs, models = _three(t)
    rows = stored(modelling.combined_rows(pairs, batters, pitchers, models), "combined")
    return _told(modelling.scored_rows(modelling.fit_model(rows, "combined", **SMALL), rows, "combined"), ["pitcher", "batter", "game_date"])
