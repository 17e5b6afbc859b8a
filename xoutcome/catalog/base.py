"""Registered queries: a Spark form over the given tables and, where SQL can say it, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from xoutcome.schema import METRICS

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]

# The views below are the same text for both engines; {item} is the engine's list access.
VIEWS = {
    # One row per event, in the order (ts, seq); some values are null by rule.
    "pitch_fx": """
SELECT event_id AS seq, ts, CAST(ts AS DATE) AS game_date, user_id AS pitcher, event_id % 37 AS batter,
  CASE event_type WHEN 'purchase' THEN 'single' WHEN 'signup' THEN 'walk' WHEN 'error' THEN 'strikeout' END AS events,
  CASE event_type WHEN 'view' THEN 'ball' WHEN 'click' THEN 'foul' ELSE 'hit_into_play' END AS description,
  CASE WHEN event_id % 5 = 0 THEN 'ground_ball' WHEN event_id % 5 = 1 THEN 'line_drive'
    WHEN event_id % 5 = 2 THEN 'fly_ball' END AS bb_type,
  CASE WHEN event_id % 13 = 0 THEN NULL ELSE value / 500 END AS xba,
  CASE WHEN event_id % 17 = 0 THEN NULL ELSE value * 5 END AS release_spin_rate,
  CAST(event_id * 7 % 360 AS DOUBLE) AS spin_axis,
  CASE WHEN event_id % 11 = 0 THEN 'S' ELSE 'R' END AS game_type
FROM {events}""",
    # One row per entity and day with a segment-ending event; the other days are gaps.
    "day_fx": """
SELECT pitcher, game_date, COUNT(*) AS pa, CAST(SUM(CASE WHEN events = 'walk' THEN 1 ELSE 0 END) AS BIGINT) AS bb,
  CAST(SUM(CASE WHEN events = 'strikeout' THEN 1 ELSE 0 END) AS BIGINT) AS k, AVG(xba) AS xba
FROM pitch_fx WHERE events IS NOT NULL GROUP BY pitcher, game_date""",
    # Games over seven seasons.
    "season_fx": """
SELECT o_custkey AS pitcher, o_orderkey AS game_pk, CAST(YEAR(o_orderdate) AS INT) AS game_year,
  o_orderpriority AS pitch_type, o_totalprice AS v FROM {orders}""",
    # Play descriptions, one shape for each branch of the actor parser.
    "name_fx": """
SELECT c_custkey AS id, CASE CAST(c_custkey % 5 AS INT)
  WHEN 0 THEN CONCAT(c_name, ' singles on a line drive.')
  WHEN 1 THEN CONCAT('Skipper upheld: ', c_name, ' strikes out swinging.')
  WHEN 2 THEN CONCAT('Runner steals 2nd base. ', c_name, ' walks.')
  WHEN 3 THEN 'no separator in this very long description of a play' ELSE NULL END AS des,
  CASE WHEN c_custkey % 7 = 0 THEN 'wild_pitch' WHEN c_custkey % 7 = 1 THEN NULL ELSE 'single' END AS events,
  CASE WHEN c_custkey % 6 = 0 THEN NULL WHEN c_custkey % 6 = 1 THEN c_name
    ELSE CONCAT(c_mktsegment, ', ', c_name) END AS player_name
FROM {customer}""",
    # 'id; name' lines, one in ten malformed, some ids twice.
    "dim_fx": """
SELECT CONCAT(CAST(c_custkey AS VARCHAR(20)), CASE WHEN c_custkey % 10 = 0 THEN ' ' ELSE '; ' END, c_name) AS line,
  c_custkey AS line_no FROM {customer}
UNION ALL
SELECT CONCAT(CAST(c_custkey AS VARCHAR(20)), '; ', c_mktsegment) AS line, c_custkey + 1000000000 AS line_no
FROM {customer} WHERE c_mktsegment = 'BUILDING'""",
    # One row per entity pair and day with two soft clusters.
    "matchup_fx": """
SELECT l.l_suppkey AS pitcher, o.o_custkey % 50 AS batter, CAST(l.l_shipdate AS DATE) AS game_date, COUNT(*) AS pa,
  CAST(SUM(CASE WHEN l.l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS bb,
  AVG(l.l_discount) AS xba, SUM(ABS(l.l_tax)) AS cluster_attribute_0,
  SUM(0.08 - ABS(l.l_tax)) AS cluster_attribute_1
FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey
GROUP BY l.l_suppkey, o.o_custkey % 50, CAST(l.l_shipdate AS DATE)""",
    # True value, prediction, weight.
    "pred_fx": """
SELECT l_returnflag AS model, l_linestatus AS split, CAST(l_shipdate AS DATE) AS game_date, l_suppkey AS entity,
  l_discount AS y, ABS(l_tax) AS pred, l_quantity AS w FROM {lineitem}""",
    # Points with the metric names and a label.
    "point_fx": "SELECT vec_id, label, " + ", ".join(
        f"CAST({{item}}(embedding, {i + 1}) AS DOUBLE) AS {m}" for i, m in enumerate(METRICS)) + " FROM {embeddings}",
    # Raw events over seven seasons with every input column.
    "raw_fx": """
SELECT o.o_orderpriority AS pitch_type, CAST(CAST(o.o_orderdate AS DATE) AS VARCHAR(10)) AS game_date,
  o.o_custkey % 12 AS pitcher, o.o_orderkey % 9 AS batter,
  CASE CAST(o.o_custkey % 8 AS INT) WHEN 0 THEN 'single' WHEN 1 THEN 'walk' WHEN 2 THEN 'strikeout'
    WHEN 3 THEN 'field_out' WHEN 4 THEN 'double' WHEN 5 THEN 'game_advisory' WHEN 6 THEN 'home_run' END AS events,
  CASE WHEN o.o_orderkey % 2 = 0 THEN 'called_strike' ELSE 'ball' END AS description,
  CONCAT('Batter ', CAST(o.o_orderkey % 9 AS VARCHAR(20)), ' singles to left.') AS des,
  CASE WHEN o.o_orderkey % 23 = 0 THEN 'S' ELSE 'R' END AS game_type, 'L' AS stand, 'R' AS p_throws,
  'AAA' AS home_team, 'BBB' AS away_team, 'X' AS type, CAST(o.o_orderkey % 4 AS INT) AS balls,
  CAST(o.o_orderkey % 3 AS INT) AS strikes, CAST(YEAR(o.o_orderdate) AS INT) AS game_year,
  CASE WHEN o.o_orderkey % 5 = 0 THEN 'ground_ball' WHEN o.o_orderkey % 5 = 1 THEN 'fly_ball' END AS bb_type,
  (CAST(YEAR(o.o_orderdate) AS BIGINT) * 10000 + MONTH(o.o_orderdate) * 100 + DAY(o.o_orderdate)) * 10
    + o.o_custkey % 4 AS game_pk,
  CASE WHEN o.o_orderkey % 7 = 0 THEN NULL ELSE o.o_totalprice / 1000000 END AS estimated_ba_using_speedangle,
  o.o_orderkey AS at_bat_number, CAST(1 AS BIGINT) AS pitch_number,
  CASE WHEN o.o_orderkey % 19 = 0 THEN NULL ELSE CAST(o.o_custkey * 7 % 360 AS DOUBLE) END AS spin_axis,
""" + ",\n".join(f"  p.{m} + 0.1e0 * (o.o_custkey * {i} % 5) AS {m}" for i, m in enumerate(METRICS[:17], 1)) + """
FROM (SELECT o1.*, o1.o_orderkey % (SELECT COUNT(*) FROM {embeddings}) AS at FROM {orders} o1) o
JOIN point_fx p ON p.vec_id = o.at""",
}
NEEDS = {"day_fx": ["pitch_fx"], "raw_fx": ["point_fx"]}


def with_views(names: tuple[str, ...], ref: Callable[[str], str], item: str) -> str:
    """The WITH clause of the views, those they need first."""
    order: list[str] = []
    for name in names:
        order += [n for n in (*NEEDS.get(name, ()), name) if n not in order]
    places = {t: ref(t) for t in TABLES} | {"item": item}
    parts = [f"{n} AS ({VIEWS[n].format(**places)}\n)" for n in order]
    return "WITH " + ",\n".join(parts) if parts else ""


class Tables:
    """The given tables of one folder and the views over them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        if name in VIEWS:
            head = with_views((name,), lambda t: f"parquet.`{self.folder}/{t}.parquet`", "element_at")
            return self.spark.sql(f"{head} SELECT * FROM {name}")
        raise AttributeError(name)


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None, views: tuple[str, ...] = ()):
    """Register a query; ``sql`` may name the listed views and further WITH parts after ``,``."""
    def add(fn: Callable[[Tables], DataFrame]):
        text = None
        if sql is not None:
            head = with_views(views, lambda t: t, "list_extract")
            body = sql.strip()
            if body.startswith("WITH "):
                text = head + ",\n" + body[5:] if head else body
            else:
                text = f"{head}\n{body}"
        assert name not in REGISTRY, name
        REGISTRY[name] = Query(lambda spark, folder: rounded(fn(Tables(spark, folder))), text)
        return fn
    return add


def six(c: Column) -> Column:
    """Six decimals by a formula both engines compute alike; engines differ in how ``round`` treats ties."""
    return F.floor(c * 1e6 + 0.501) / F.lit(1e6)


def rounded(df: DataFrame) -> DataFrame:
    """All doubles to six decimals."""
    def one(field: T.StructField) -> Column:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DoubleType):
            return six(c).alias(field.name)
        if isinstance(field.dataType, T.ArrayType) and isinstance(field.dataType.elementType, T.DoubleType):
            return F.transform(c, six).alias(field.name)
        return c
    if not any("double" in f.dataType.simpleString() for f in df.schema.fields):
        return df
    return df.select(*[one(f) for f in df.schema.fields])


def r6(expr: str, alias: str | None = None) -> str:
    """The SQL side of ``six``."""
    return f"floor(({expr}) * 1e6 + 0.501) / 1e6" + (f" AS {alias}" if alias else "")


def r6s(*names: str) -> str:
    return ", ".join(r6(n, n) for n in names)


def quoted(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)
