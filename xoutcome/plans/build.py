"""The whole run: raw events to fitted models."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from xoutcome import schema as S
from xoutcome.operators.rank import temporal_split
from xoutcome.plans import modelling
from xoutcome.plans.clean import clean_events
from xoutcome.plans.clusters import learn_clusters, score_clusters
from xoutcome.plans.features import batter_features, matchup_features, pitcher_features
from xoutcome.plans.rollup import at_bats, day_table, segments, with_hard_clusters
from xoutcome.schema import FeatureFamily
from xoutcome.sources.tables import load_model, save_model, write_eval, write_tables


@dataclass
class BuildSettings:
    """Sizes of a run; the defaults are the full ones."""

    min_games: int = 1000
    min_rows: int = 100
    goal: float = 0.95
    clusters: tuple[int, int] = (10, 60)
    restarts: tuple[int, int] = (3, 20)
    fuzzy_rounds: int = 150
    forests: dict[str, dict] = field(default_factory=dict)
    order: list[str] = field(default_factory=lambda: list(S.EVENT_ORDER))
    target: str = S.TARGET


def _written(spark: SparkSession, folder: str, name: str, df: DataFrame, *partition: str) -> DataFrame:
    write_tables(folder, {name: df}, *partition)
    return spark.read.parquet(f"{folder}/{name}")


def fresh_build(raw: DataFrame, folder: str, settings: BuildSettings | None = None) -> dict[str, DataFrame]:
    """Clean, split, learn clusters on the earlier seasons, roll up, fit the five models and evaluate them.

    Each stage is written to ``folder``, so a later stage never recomputes an earlier one.
    """
    s = settings or BuildSettings()
    spark = raw.sparkSession
    clean = _written(spark, folder, "events_clean", clean_events(raw, s.order), "game_year")  # for the split by year
    train, test = temporal_split(clean, s.min_games)
    model, _ = learn_clusters(train, goal=s.goal, min_rows=s.min_rows, mini=s.clusters[0], maxi=s.clusters[1],
                              restarts=s.restarts, fuzzy_rounds=s.fuzzy_rounds)
    model.save(spark, f"{folder}/models")
    soft = model.soft.columns
    hard = FeatureFamily("cluster", len(soft)).columns
    attributes = model.components.features
    features: dict[tuple[str, str], DataFrame] = {}
    for part, events in (("train", train), ("test", test)):
        needed = ["game_date", "pitcher", "batter", "events", "home_team", "away_team", s.target, *attributes, *soft]
        rows = _written(spark, folder, f"segments_{part}",
                        with_hard_clusters(segments(score_clusters(events, model), needed, order=s.order), soft))
        batters = _written(spark, folder, f"batters_{part}", day_table(rows, "batter"))
        pitchers = _written(spark, folder, f"pitchers_{part}", day_table(rows, "pitcher", soft, hard, attributes))
        matchups = _written(spark, folder, f"matchups_{part}", day_table(rows, "both", soft, hard, attributes))
        features["batter", part] = batter_features(batters, target=s.target)
        features["pitcher", part] = pitcher_features(pitchers, target=s.target)
        features["matchup", part] = matchup_features(
            matchups, at_bats(rows, soft, hard, s.target), hard, soft, target=s.target,
            spread=[f"{c}_{end}" for c in soft for end in ("max", "min")])
    for (kind, part), df in list(features.items()):
        features[kind, part] = _written(spark, folder, f"{kind}_features_{part}", df)
    fit = lambda kind, df: modelling.fit_model(df, kind, s.target, **s.forests.get(kind, {}))
    models = {}
    for kind in ("batter", "pitcher", "matchup"):
        save_model(fit(kind, features[kind, "train"]), folder, kind)
        models[kind] = load_model(folder, kind)
    for part in ("train", "test"):
        singles = [features[kind, part] for kind in ("matchup", "batter", "pitcher")]
        stacked = modelling.stacked_rows(*singles, models, s.target)
        features["stacked", part] = _written(spark, folder, f"stacked_features_{part}", stacked)
        combined = modelling.combined_rows(*singles, models)
        features["combined", part] = _written(spark, folder, f"combined_features_{part}", combined)
    for kind in ("stacked", "combined"):
        save_model(fit(kind, features[kind, "train"]), folder, kind)
        models[kind] = load_model(folder, kind)
    scored = {key: modelling.scored_rows(models[key[0]], df, key[0], s.target) for key, df in features.items()}
    results = modelling.evaluate_all(scored)
    write_eval(folder, results)
    return {name: spark.read.parquet(f"{folder}/evaluation/{name}") for name in results}
