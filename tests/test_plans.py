"""The physical plans: what reaches the scan, and how often the rows are shuffled."""

import re

import pytest
from pyspark.sql import functions as F

from xoutcome.catalog.base import Tables
from xoutcome.operators.rank import top_n_per_cluster
from xoutcome.operators.windows import depth_features, segment_ids
from xoutcome.plans.clean import clean_events
from xoutcome.plans.features import batter_features, pitcher_features, rate_per_pa, filled_days

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df) -> list[str]:
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan(df))


@pytest.fixture(scope="module")
def days(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("days") / "day")
    Tables(spark, SF).day_fx.write.parquet(path)
    return spark.read.parquet(path)


def test_one_shuffle_for_all_features(days):
    """Calendar, lead, rolling rates and lags share one exchange on the entity."""
    assert len(exchanges(pitcher_features(days, target="xba"))) == 1
    assert len(exchanges(batter_features(days.withColumnRenamed("pitcher", "batter"), target="xba"))) == 1


def test_rates_and_lags_share_their_window(days):
    rates = rate_per_pa(filled_days(days, "pitcher", "xba"))
    deep = depth_features(rates, "pitcher", 5, {7: 1}, False, ["xba"], ["k_per_pa", "xba"])
    assert plan(deep).count("Window [") <= 3


def test_no_python_and_no_product(days, spark):
    for df in (pitcher_features(days, target="xba"), clean_events(Tables(spark, SF).raw_fx)):
        text = plan(df)
        assert "Python" not in text and "Pandas" not in text
        assert "CartesianProduct" not in text


def test_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "raw")
    Tables(spark, SF).raw_fx.write.parquet(path)
    text = plan(clean_events(spark.read.parquet(path)).select("pitcher", "events"))
    pushed = re.search(r"PushedFilters: \[([^\]]*)", text).group(1)
    for part in ("IsNotNull(game_type)", "IsNotNull(game_date)", "Not(EqualNullSafe(game_date,game_date))"):
        assert part in pushed
    assert len(exchanges(clean_events(spark.read.parquet(path)))) == 1


def test_best_rows_are_cut_before_the_shuffle(spark):
    rows = Tables(spark, SF).pitch_fx.select("seq", "xba", F.col("spin_axis"))
    assert "WindowGroupLimit" in plan(top_n_per_cluster(rows, ["xba", "spin_axis"], ["seq"], 10))


def test_segments_use_one_shuffle(spark):
    df = segment_ids(Tables(spark, SF).pitch_fx, ["pitcher"], ["ts", "seq"])
    assert len(exchanges(df)) == 1
