"""Oversized keys: the cut form gives what the plain window gives, without a large window partition."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from xoutcome.operators import aggregates as A
from xoutcome.operators import hot
from xoutcome.operators import windows as W
from xoutcome.operators.cluster import entity_kmeans
from xoutcome.operators.filters import group_size_filter

CAP = 25


@pytest.fixture(scope="module")
def rows(spark):
    """One key with a third of the rows, one day with most of that key's rows, a null key."""
    rng = random.Random(7)
    data = []
    for i in range(900):
        key = 1 if i % 3 == 0 else rng.choice([2, 3, 4, None])
        day = dt.date(2024, 1, 5) if key == 1 and i % 2 else dt.date(2024, 1, 1) + dt.timedelta(days=rng.randrange(20))
        event = rng.choice(["single", "walk", None, None])
        data.append((i, key, day, event, float(rng.randrange(50)) if rng.random() > 0.3 else None))
    rng.shuffle(data)
    return spark.createDataFrame(data, "seq long, key int, day date, events string, v double").repartition(5).cache()


def same(a, b):
    order = lambda df: sorted(map(str, df.select(*sorted(df.columns)).collect()))
    assert order(a) == order(b)


@pytest.mark.parametrize("descending", [True, False])
def test_segment_ids(rows, descending):
    cut = W.segment_ids(rows, ["key"], ["day", "seq"], descending=descending, max_rows=CAP)
    same(cut, W.segment_ids(rows, ["key"], ["day", "seq"], descending=descending, max_rows=None))


@pytest.mark.parametrize("descending", [True, False])
@pytest.mark.parametrize("same_day", [True, False])
def test_fill(rows, descending, same_day):
    args = (["v"], ["key"], ["day", "seq"], descending, same_day, "day")
    same(W.fill_backward_forward(rows, *args, max_rows=CAP), W.fill_backward_forward(rows, *args, max_rows=None))


def test_pieces_stay_small_and_keep_the_order(rows):
    cut, pieces = hot.with_chunks(rows, ["key"], ["day", "seq"], CAP)
    assert pieces == [hot.PIECE] and cut.count() == rows.count()
    assert cut.groupBy("key", *pieces).count().agg(F.max("count")).first()[0] <= 2 * CAP
    placed = [(r["key"], r[hot.PIECE]) for r in cut.orderBy("key", "day", "seq").collect()]
    assert placed == sorted(placed, key=lambda p: (p[0] is not None, p[0] or 0, p[1]))


def test_short_pieces_share_a_task(spark):
    """The number of tasks depends on the rows, not on the length of the pieces; equal places in several pieces keep the lists' order."""
    df = spark.range(6000).select(F.lit(1).alias("key"), (F.col("id") % 1500).alias("place"), (F.col("id") * 7919 % 6007).alias("v")).repartition(3)
    cut, pieces = hot.with_chunks(df, ["key"], ["place"], 3, ["v"])
    assert len(cut.inputFiles()) <= max(spark.sparkContext.defaultParallelism, 4)
    assert cut.groupBy(*pieces).count().agg(F.max("count")).first()[0] <= 3 and cut.count() == 6000
    parts = A.group_spread_and_list(df, ["key"], ["place"], ["v"], ["v"], max_rows=3)
    got = [v for r in sorted(parts.collect(), key=lambda r: r["list_part"]) for v in r["v_list"]]
    assert got == [r["v"] for r in df.orderBy("place", "v").collect()]


def test_text_orders_and_null_places(spark):
    """A hot key whose order is a text, and one with many nulls in its leading order column."""
    data = [(1, f"t{i * 37 % 400:03d}", None if i % 3 else i % 7, i, ["single", None][i % 2], float(i) if i % 5 == 0 else None) for i in range(400)]
    df = spark.createDataFrame(data, "key int, name string, place int, seq int, events string, v double").repartition(4)
    for order in (["name", "seq"], ["place", "name"], ["place", "seq"]):
        for descending in (True, False):
            same(W.segment_ids(df, ["key"], order, descending=descending, max_rows=CAP), W.segment_ids(df, ["key"], order, descending=descending, max_rows=None))
            same(W.fill_backward_forward(df, ["v"], ["key"], order, descending, max_rows=CAP), W.fill_backward_forward(df, ["v"], ["key"], order, descending, max_rows=None))


def test_median_of_many_values(spark, rows):
    cut = A.exact_median(rows, ["key"], "v", max_rows=5)
    whole = rows.groupBy("key").agg(F.median("v").alias("median"))
    same(cut, whole)


def test_lists_come_in_parts(rows):
    parts = A.group_spread_and_list(rows, ["key"], ["day", "seq"], ["v"], ["seq", "v"], max_rows=CAP)
    whole = A.group_spread_and_list(rows, ["key"], ["day", "seq"], ["v"], ["seq", "v"], max_rows=None)
    assert parts.filter("key = 1").count() > 5
    joined = {}
    for r in sorted(parts.collect(), key=lambda r: (str(r["key"]), r["list_part"])):
        joined.setdefault(r["key"], []).extend(r["seq_list"])
    assert joined == {r["key"]: r["seq_list"] for r in whole.collect()}
    assert {(r["key"], r["v_max"], r["v_min"]) for r in parts.collect()} == {
        (r["key"], r["v_max"], r["v_min"]) for r in whole.collect()}


def test_group_size_filter_keeps_null_keys(rows):
    kept = group_size_filter(rows, ["key"], 100)
    counts = {r["key"]: r["count"] for r in rows.groupBy("key").count().collect()}
    assert kept.count() == sum(n for n in counts.values() if n >= 100)


def test_kmeans_of_an_oversized_group(spark):
    rng = random.Random(3)
    data = [(g, rng.choice("ab"), c + rng.gauss(0, 0.05), -c + rng.gauss(0, 0.05))
            for g, n in ((1, 400), (2, 60)) for c in (0.0, 4.0, 9.0) for _ in range(n)]
    df = spark.createDataFrame(data, "g int, kind string, x double, y double")
    found = entity_kmeans(df, ["g"], ["x", "y"], "kind", restarts=(3, 5), rows_in_task=500).collect()
    for g in (1, 2):
        centres = sorted(r["x"] for r in found if r["g"] == g)
        assert centres == pytest.approx([0, 4, 9], abs=0.1), g


def test_broadcast_is_checked(spark):
    small, large = spark.range(5), spark.range(50)
    plan = lambda df: spark.range(10).join(df, "id")._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in plan(hot.bounded_broadcast(small, 10))
    assert "broadcast" not in plan(hot.bounded_broadcast(large, 10))
    wide = spark.range(5).select("id", F.expr("repeat('x', 20 << 20)").alias("text"))
    assert "broadcast" not in plan(hot.bounded_broadcast(wide, 10))


def test_many_top_rows(spark):
    """More rows a cluster than Spark's own limit: ties, memberships outside of [0, 1], few rows in one cluster."""
    from xoutcome.operators.rank import top_n_per_cluster
    rows = spark.range(6000).select("id", (F.col("id") * 7919 % 1000 / 1000).alias("c0"), F.when(F.col("id") % 5 == 0, F.lit(0.5)).alias("c1"),
                                    (F.col("id") % 30 - 10.0).alias("c2")).repartition(6)
    data = rows.collect()
    got = {(r["cluster"], r["place"]): r["id"] for r in top_n_per_cluster(rows, ["c0", "c1", "c2"], ["id"], 1500).collect()}
    want = {}
    for c in ("c0", "c1", "c2"):
        best = sorted((-r[c], r["id"]) for r in data if r[c] is not None)[:1500]
        want.update({(c, p): i for p, (_, i) in enumerate(best, 1)})
    assert got == want
