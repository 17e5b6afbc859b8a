"""Edge cases of single operators on small literal frames."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from xoutcome import schema as S
from xoutcome.catalog import registered
from xoutcome.catalog.base import Tables
from xoutcome.functions import text, values
from xoutcome.operators import evaluate, filters, profile
from xoutcome.operators import windows as W
from xoutcome.operators.aggregates import day_keys, segment_rollup
from xoutcome.operators.models import DEPTH_LIMIT, fit_forest, param_grid
from xoutcome.operators.rank import latest_season, temporal_split, top_n_per_cluster
from xoutcome.plans.features import batter_features, pitcher_features

D = dt.date


def test_null_event_survives_the_advisory_filter(spark):
    df = spark.createDataFrame([("game_advisory",), (None,), ("walk",)], "events string")
    assert [r[0] for r in filters.drop_advisory(df).collect()] == [None, "walk"]
    assert filters.filter_game_type(spark.createDataFrame([(None,), ("R",)], "game_type string")).count() == 1


def test_hard_assign_ties_and_nulls(spark):
    df = spark.createDataFrame([(0.5, 0.5), (0.1, 0.9), (None, None), (None, 0.2)], "a double, b double")
    rows = [tuple(r) for r in df.select(*values.hard_assign(["a", "b"])).collect()]
    assert rows == [(1, 1), (0, 1), (0, 0), (0, 1)]


def test_rates_of_every_day(spark):
    """The first day and days without earlier appearances stay, with no rate."""
    rows = [(1, D(2024, 1, 1), 0, 0, 0), (1, D(2024, 1, 2), 2, 3, 1), (1, D(2024, 1, 3), 1, 4, 0), (2, D(2024, 1, 3), 1, 1, 0)]
    days = spark.createDataFrame(rows, "pitcher int, game_date date, k long, pa long, bb long")
    got = W.hard_per_pa(days, ["k"]).orderBy("pitcher", "game_date").collect()
    assert [tuple(r) for r in got] == [(1, D(2024, 1, 1), None), (1, D(2024, 1, 2), None), (1, D(2024, 1, 3), 0.5), (2, D(2024, 1, 3), None)]
    query = registered()["cluster_rate_per_pa"].run(spark, "/root/testdata/sf0.001")
    assert query.count() == Tables(spark, "/root/testdata/sf0.001").day_fx.count()


def test_duplicate_pair_repeats_rows(spark):
    df = spark.createDataFrame([(1, 2020, "x"), (2, 2020, "y")], "pitcher int, game_year int, v string")
    pairs = spark.createDataFrame([(1, 2020), (1, 2020)], "a int, b int")
    assert filters.entity_season_select(df, pairs).count() == 2


def test_lowest_edge_is_left_out(spark):
    df = spark.createDataFrame([(float(i),) for i in range(0, 31)], "v double")
    rows = profile.histogram(df, "v").collect()
    assert [r["n"] for r in rows] == [3] * 10 and sum(r["n"] for r in rows) == 30


def test_window_edges(spark):
    df = spark.createDataFrame([(1, D(2024, 1, d), 1.0, 1) for d in range(1, 11)], "e int, game_date date, v double, play int")
    days = W.with_day_number(df)
    before, up_to = W.days_before("e", 3), W.days_up_to("e", 3)
    row = days.select("game_date", F.count("v").over(before).alias("a"), F.count("v").over(up_to).alias("b"),
                      W.rolling_rate("v", before, 2).alias("r")).orderBy("game_date").collect()
    assert [r["a"] for r in row] == [0, 1, 2] + [3] * 7
    assert [r["b"] for r in row] == [1, 2] + [3] * 8
    assert [r["r"] for r in row][:3] == [None, None, 1.0]


def test_calendar_rows_and_zeros(spark):
    df = spark.createDataFrame([(1, D(2024, 2, 27), 3, None), (1, D(2024, 3, 1), 4, 0.5), (2, D(2024, 1, 1), 1, 0.1)],
                               "e int, game_date date, pa int, v double")
    rows = W.calendar_fill(df, "e").orderBy("e", "game_date").collect()
    assert [(r["game_date"].day, r["pa"], r["v"]) for r in rows if r["e"] == 1] == [
        (27, 3, 0.0), (28, 0, 0.0), (29, 0, 0.0), (1, 4, 0.5)]
    assert len(rows) == 5


def test_segments_lose_no_row(spark):
    df = spark.createDataFrame([(1, i, "walk" if i % 4 == 3 else None) for i in range(10)], "g int, n int, events string")
    seg = W.segment_ids(df, ["g"], ["n"])
    rolled = segment_rollup(seg, ["g", "segment_id"], ["n"], columns=["events"])
    assert rolled.agg(F.sum("pitch_count")).first()[0] == 10
    assert {r["segment_id"]: r["events"] for r in rolled.collect()} == {0: None, 1: "walk", 2: "walk"}


def test_bad_mode():
    with pytest.raises(ValueError):
        day_keys("umpire")


def test_names(spark):
    one = spark.range(1)
    show = lambda c: one.select(c).first()[0]
    assert show(text.orient_name(F.lit("Doe, Jo"))) == "Jo Doe"
    assert show(text.orient_name(F.lit("Doe"))) is None
    assert show(text.actor_name(F.lit("Call upheld: Jo Doe singles home."), F.lit("single"))) == "Jo Doe "
    assert show(text.actor_name(F.lit("Jo Doe walks."), F.lit("wild_pitch"))) is None
    assert show(text.parse_date(F.lit("2024-13-40"))) is None
    assert show(text.parse_list(F.lit("[0.5, nan, 2]"))) == [0.5, None, 2.0]


def test_weighted_error(spark):
    df = spark.createDataFrame([("m", 1, D(2024, 1, 1), 1.0, 0.0, 9.0), ("m", 1, D(2024, 1, 2), 0.0, 0.5, 1.0),
                                ("m", 2, D(2024, 1, 1), 1.0, 1.0, 5.0)],
                               "model string, e int, game_date date, y double, pred double, w double")
    assert evaluate.errors(df, ["model"]).first()["wmae"] == pytest.approx(9.5 / 15)
    assert evaluate.wmae_next_weight(df, ["model"], ["e"]).first()["wmae"] == pytest.approx(1.0)
    none = df.withColumn("w", F.lit(0.0))
    assert evaluate.errors(none, ["model"]).first()["wmae"] is None


def test_seasons(spark):
    df = spark.createDataFrame([(y, g) for y, n in ((2020, 5), (2021, 5), (2022, 2)) for g in range(n)],
                               "game_year int, game_pk int")
    assert latest_season(df, 5).first()[0] == 2021
    train, test = temporal_split(df, 5)
    assert (train.count(), test.count()) == (5, 5)
    with pytest.raises(ValueError):
        temporal_split(df, 99)


def test_top_n_skips_nulls(spark):
    df = spark.createDataFrame([(1, 0.5, None), (2, 0.7, 0.1)], "id int, cluster_0 double, cluster_1 double")
    rows = top_n_per_cluster(df, ["cluster_0", "cluster_1"], ["id"], 1).collect()
    assert {(r["cluster"], r["id"]) for r in rows} == {("cluster_0", 2), ("cluster_1", 2)}


def test_depth_limit_applies_to_the_growing_only(spark):
    """All twelve depths stay apart in the grid; a tree of more than Spark grows gets the limit."""
    grid = param_grid()
    assert len(grid) == 10 * 2 * 12 * 3 * 2 and {s["maxDepth"] for s in grid} >= {10, 110, None}
    rows = spark.createDataFrame([(float(i), float(i % 3)) for i in range(30)], "x double, y double")
    for depth in (110, None, 7):
        model = fit_forest(rows, ["x"], "y", numTrees=1, maxDepth=depth)
        assert model.stages[1].getMaxDepth() == min(depth or DEPTH_LIMIT, DEPTH_LIMIT)


def _days(spark, n=60, late=None):
    rows = []
    for e in (1, 2):
        for i in range(n):
            if i % (e + 1) == 0:
                v = 0.1 * (i % 7)
                if late is not None and i >= late:
                    v = 9.0
                rows.append((e, D(2024, 1, 1) + dt.timedelta(days=i), v, i % 2, i % 3, 3 + i % 2))
    return spark.createDataFrame(rows, f"e int, game_date date, {S.TARGET} double, bb int, k int, pa int")


def test_pitcher_rates_do_not_see_their_own_day(spark):
    """Rates and lags of day t stay when rows on or after t change."""
    a = pitcher_features(_days(spark).withColumnRenamed("e", "pitcher"), exclude_same_day=True)
    b = pitcher_features(_days(spark, late=50).withColumnRenamed("e", "pitcher"), exclude_same_day=True)
    cut = F.col("game_date") <= F.lit(D(2024, 1, 1) + dt.timedelta(days=50))
    pick = lambda df: sorted(map(str, df.filter(cut).drop(S.TARGET).collect()))
    assert pick(a) == pick(b) and pick(a)


def test_batter_target_is_the_next_day(spark):
    rows = batter_features(_days(spark).withColumnRenamed("e", "batter"))
    assert rows.count() > 0
    assert not [c for c in rows.columns if "play" in c and c != "next_play"]
    assert rows.filter("next_play = 0").count() == 0
