"""Forests on prepared feature tables.

A forest is grown in batches of ``TREES_PER_FIT`` trees with seeds of their own, so that a thousand trees never share a pass
over the rows, and a batch that is lost is grown again alone. The batches' models and the weighted mean of their predictions
are stages of one pipeline model, which is saved, loaded and applied as any other.
"""

from __future__ import annotations

import hashlib
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from xoutcome.session import stored

# ---- fixed values: settings of the five models and of their search ----

FORESTS = {
    "batter": {"numTrees": 200, "featureSubsetStrategy": "all"},
    "pitcher": {"numTrees": 1600, "featureSubsetStrategy": "sqrt"},
    "matchup": {"numTrees": 1600, "featureSubsetStrategy": "sqrt"},
    "stacked": {"numTrees": 1600, "featureSubsetStrategy": "sqrt"},
    "combined": {"numTrees": 1600, "featureSubsetStrategy": "sqrt"},
}
COMMON = {"maxDepth": 10, "minInstancesPerNode": 4, "bootstrap": True, "seed": 42}

SEARCH = {
    "numTrees": [200, 400, 600, 800, 1000, 1200, 1400, 1600, 1800, 2000],
    "featureSubsetStrategy": ["all", "sqrt"],
    "maxDepth": [10, 20, 30, 40, 50, 60, 70, 80, 90, 100, 110, None],
    "minInstancesPerNode": [1, 2, 4],
    "bootstrap": [True, False],
}
SEARCH_SETTINGS = 100
SEARCH_FOLDS = 5
SEARCH_SEED = 42

# ---- end of fixed values ----

DEPTH_LIMIT = 30  # the deepest tree Spark grows; stands for "no limit"
TREES_PER_FIT = 100


def _grown(rows: DataFrame, target: str, numTrees: int, seed: int, trees_per_fit: int = TREES_PER_FIT, **settings) -> list[RandomForestRegressionModel]:
    """The batches of a forest over assembled ``rows``."""
    batches = [min(trees_per_fit, numTrees - done) for done in range(0, numTrees, trees_per_fit)]
    if settings.get("maxDepth") is None or settings["maxDepth"] > DEPTH_LIMIT:
        settings["maxDepth"] = DEPTH_LIMIT
    return [RandomForestRegressor(featuresCol="_features", labelCol=target, predictionCol=f"_p{i}", numTrees=n, seed=seed + i, **settings).fit(rows)
            for i, n in enumerate(batches)]


def _mean(batches: list[RandomForestRegressionModel]) -> SQLTransformer:
    parts = " + ".join(f"{m.getNumTrees} * _p{i}" for i, m in enumerate(batches))
    gone = ", ".join(["_features", *(f"_p{i}" for i in range(len(batches)))])
    return SQLTransformer(statement=f"SELECT * EXCEPT ({gone}), ({parts}) / {sum(m.getNumTrees for m in batches)}D AS pred FROM __THIS__")


def _model(vector: VectorAssembler, batches: list[RandomForestRegressionModel]) -> PipelineModel:
    return PipelineModel([vector, *batches, _mean(batches)])


def fit_forest(df: DataFrame, features: list[str], target: str, kind: str = "matchup", **settings) -> PipelineModel:
    """Fit one of the five models (M11); ``settings`` override its defaults. The assembled rows are stored once for all batches."""
    vector = VectorAssembler(inputCols=features, outputCol="_features")
    rows = vector.transform(df.select(*features, F.col(target).cast("double").alias(target))).select("_features", target)
    return _model(vector, _grown(stored(rows, "forest-rows"), target, **{**FORESTS[kind], **COMMON, **settings}))


def importances(model: PipelineModel) -> list[float]:
    """The share of each feature in what the splits gain, over all trees; they sum to 1."""
    batches = [m for m in model.stages if isinstance(m, RandomForestRegressionModel)]
    total = sum(m.getNumTrees * m.featureImportances.toArray() for m in batches)
    return (total / max(total.sum(), 1e-300)).tolist()


def predict(model: PipelineModel, df: DataFrame, out: str = "pred") -> DataFrame:
    """Rows with their prediction; keys and weights stay."""
    scored = model.transform(df)
    return scored.withColumnRenamed("pred", out) if out != "pred" else scored


# ---- search ----

def grid_size(settings: dict[str, list] | None = None) -> int:
    """The number of all combinations of the search's lists."""
    n = 1
    for values in {**SEARCH, **(settings or {})}.values():
        n *= len(values)
    return n


def setting(number: int, settings: dict[str, list] | None = None) -> dict:
    """The combination of that number: its digits to the bases of the lists' lengths, the last list's first."""
    lists = {**SEARCH, **(settings or {})}
    out = {}
    for name, values in reversed(lists.items()):
        number, digit = divmod(number, len(values))
        out[name] = values[digit]
    return {name: out[name] for name in lists}


def param_grid(settings: dict[str, list] | None = None) -> list[dict]:
    """All settings of the search (M13), each depth for itself."""
    return [setting(i, settings) for i in range(grid_size(settings))]


def drawn_settings(n: int, seed: int = SEARCH_SEED, settings: dict[str, list] | None = None) -> list[tuple[int, dict]]:
    """(number, setting) of ``n`` different combinations: those whose number has the least md5 with the seed."""
    numbers = sorted(range(grid_size(settings)), key=lambda i: hashlib.md5(f"{seed}:{i}".encode()).hexdigest())
    return [(i, setting(i, settings)) for i in numbers[:n]]


def random_search(df: DataFrame, features: list[str], target: str, n: int = SEARCH_SETTINGS, folds: int = SEARCH_FOLDS,
                  seed: int = SEARCH_SEED, parallelism: int = 4, settings: dict[str, list] | None = None) -> tuple[PipelineModel, DataFrame]:
    """Best model of ``n`` random settings by cross-validated R2 (M12), and a table of all scores.

    Every combination has the same chance, whatever its depth; Spark's depth limit applies to the growing only. Rows are
    assembled and dealt to folds by a hash of their values once, and stored.
    """
    vector = VectorAssembler(inputCols=features, outputCol="_features")
    own = df.select(*features, F.col(target).cast("double").alias(target))
    fold = F.pmod(F.xxhash64(F.lit(seed), *features, target), F.lit(folds)).cast("int")
    rows = stored(vector.transform(own).select("_features", target, fold.alias("_fold")), "folds")
    tried = drawn_settings(n, seed, settings)

    def score(job: tuple[int, int]) -> float | None:
        place, k = job
        batches = _grown(rows.where(F.col("_fold") != k).drop("_fold"), target, seed=COMMON["seed"], **tried[place][1])
        held = rows.where(F.col("_fold") == k)
        for m in batches:
            held = m.transform(held)
        found = _mean(batches).transform(held)
        y = F.col(target)
        error, spread = found.agg(F.sum((y - F.col("pred")) ** 2), F.var_pop(target) * F.count(target)).first()
        return 1 - error / spread if spread else None
    jobs = [(place, k) for place in range(len(tried)) for k in range(folds)]
    with ThreadPoolExecutor(parallelism) as pool:
        scores = list(pool.map(inheritable_thread_target(rows.sparkSession)(score), jobs))
    means = []
    for place in range(len(tried)):
        own_scores = [s for (p, _), s in zip(jobs, scores) if p == place and s is not None]
        means.append(sum(own_scores) / len(own_scores) if own_scores else float("-inf"))
    best = max(range(len(tried)), key=lambda i: (means[i], -i))
    model = _model(vector, _grown(rows.drop("_fold"), target, seed=COMMON["seed"], **tried[best][1]))
    table = [(number, *map(str, s.values()), mean) for (number, s), mean in zip(tried, means)]
    return model, df.sparkSession.createDataFrame(table, "number int, " + ", ".join(f"{name} string" for name in tried[0][1]) + ", r2 double")
