"""Scans, sinks, the dimension and the incremental update."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from xoutcome import schema as S
from xoutcome.catalog.base import Tables, query, r6, r6s
from xoutcome.catalog.whole import features_sql
from xoutcome.operators.models import predict
from xoutcome.operators.evaluate import errors
from xoutcome.operators.rank import temporal_split
from xoutcome.plans.features import batter_features
from xoutcome.plans.modelling import fit_model
from xoutcome.session import fresh_path
from xoutcome.sources import dimension, events, tables
from xoutcome.streaming.update import append_arrivals

_DOUBLES = [c for c in S.KEEP if c in S.METRICS or c in (S.TARGET, "spin_axis")]
_OTHERS = [c for c in S.KEEP if c not in _DOUBLES]


@query("scan_events", f"SELECT {', '.join(_OTHERS)}, {r6s(*_DOUBLES)}, at_bat_number FROM raw_fx", ("raw_fx",))
def _(t: Tables):
    path = fresh_path(t.spark, "raw-csv")
    columns = [*S.KEEP, "at_bat_number"]
    # Written as files of two headers: other orders, and a column that the schema does not know in the first ones only.
    for even, names in ((True, ["unknown", *sorted(columns)]), (False, sorted(columns, reverse=True))):
        rows = t.raw_fx.withColumn("unknown", F.lit("more")).where((F.col("at_bat_number") % 2 == 0) == even).select(*names)
        rows.write.mode("append").option("sep", ";").option("header", True).option("encoding", "ISO-8859-1").csv(path)
    return events.scan_events(t.spark, path, T.StructType([S.RAW_SCHEMA[c] for c in columns]))


@query("scan_partitioned", f"SELECT at_bat_number, CAST(game_year AS INTEGER) AS season, bb_type AS team, {r6(S.TARGET, 'y')} "
       "FROM raw_fx WHERE game_year BETWEEN 1996 AND 1998 AND bb_type IN ('fly_ball')", ("raw_fx",))
def _(t: Tables):
    path = fresh_path(t.spark, "season-team")
    rows = t.raw_fx.select("at_bat_number", F.col("game_year").alias("season"), F.col("bb_type").alias("team"),
                           F.col(S.TARGET).alias("y"))
    rows.write.partitionBy("season", "team").parquet(path)
    return events.scan_partitioned(t.spark, path, (1996, 1998), ["fly_ball"])


@query("drop_deprecated", "SELECT vec_id, label FROM embeddings")
def _(t: Tables):
    rows = t.embeddings.select("vec_id", "label", *[F.lit(0).alias(c) for c in S.DEPRECATED])
    return events.drop_deprecated(rows)


@query("append_events", "SELECT game_year, COUNT(*) AS n, MIN(at_bat_number) AS first FROM raw_fx GROUP BY game_year",
       ("raw_fx",))
def _(t: Tables):
    path = fresh_path(t.spark, "appended")
    rows = t.raw_fx.select("at_bat_number", "game_year", "game_type")
    for part in (F.col("game_type") == "R", F.col("game_type") != "R"):
        events.append_events(rows.filter(part), path)
    return t.spark.read.parquet(path).groupBy("game_year").agg(
        F.count("*").alias("n"), F.min("at_bat_number").alias("first"))


@query("high_water_mark", "SELECT MAX(CAST(o_orderdate AS DATE)) AS mark FROM orders WHERE o_orderkey % 5 <> 0")
def _(t: Tables):
    day = F.when(F.col("o_orderkey") % 5 == 0, "no date").otherwise(F.col("o_orderdate").cast("date").cast("string"))
    return events.high_water_mark(t.orders.select(day.alias("game_date")))


_EV = "event_id, CAST(ts AS DATE) AS game_date"


@query("incremental_update", f"SELECT {_EV} FROM events")
def _(t: Tables):
    """Half of the events are held; the batch has all, late days of the other half among them."""
    rows = t.events.select("event_id", F.col("ts").cast("date").alias("game_date"))
    rows = rows.withColumn("game_year", F.year("game_date"))
    path = fresh_path(t.spark, "store")
    events.append_events(rows.filter(F.col("event_id") % 2 == 0), path)
    for _ in range(2):  # the second round adds nothing
        events.incremental_update(t.spark, path, rows, ["event_id"])
    return t.spark.read.parquet(path).select("event_id", "game_date")


@query("append_arrivals", f"SELECT {_EV} FROM events")
def _(t: Tables):
    """All events arrive as files of falling days, one file a batch, three days of them before the store is first filled."""
    rows = t.events.select("event_id", F.col("ts").cast("date").alias("game_date"))
    rows = rows.withColumn("game_year", F.year("game_date"))
    first, last = rows.agg(F.min("game_date"), F.max("game_date")).first()
    store, arrivals, progress = (fresh_path(t.spark, n) for n in ("store", "arrivals", "progress"))
    events.append_events(rows.filter(F.col("game_date") <= F.date_add(F.lit(first), 2)), store)
    third = (last - first).days // 3 + 1
    for k in (2, 1, 0):
        rows.filter(F.floor(F.datediff("game_date", F.lit(first)) / third) == k).coalesce(1).write.mode("append").parquet(arrivals)
    append_arrivals(t.spark, arrivals, store, rows.schema, progress, ["event_id"], files_per_batch=1).awaitTermination()
    return t.spark.read.parquet(store).select("event_id", "game_date")


@query("write_tables", f"SELECT pitcher, game_date, pa, bb, k, {r6s('xba')} FROM day_fx", ("day_fx",))
def _(t: Tables):
    folder = fresh_path(t.spark, "tables")
    tables.write_tables(folder, {"batters": t.day_fx, "pitchers": t.day_fx})
    return t.spark.read.parquet(f"{folder}/pitchers")


_DIM = """dim AS (SELECT id, max_by(name, line_no) AS name FROM (
  SELECT TRY_CAST(split_part(line, '; ', 1) AS BIGINT) AS id, trim(split_part(line, '; ', 2)) AS name, line_no
  FROM dim_fx WHERE len(string_split(line, '; ')) = 2) GROUP BY id)"""


@query("parse_dimension", f"WITH {_DIM} SELECT id, name FROM dim", ("dim_fx",))
def _(t: Tables):
    return dimension.parse_dimension(t.dim_fx)


@query("distinct_ids", "SELECT DISTINCT id FROM (SELECT batter AS id FROM pitch_fx UNION ALL SELECT pitcher FROM pitch_fx)",
       ("pitch_fx",))
def _(t: Tables):
    return dimension.distinct_ids(t.pitch_fx)


@query("missing_ids", f"WITH {_DIM} SELECT c_custkey AS id FROM customer WHERE c_custkey NOT IN (SELECT id FROM dim)",
       ("dim_fx",))
def _(t: Tables):
    ids = t.customer.select(F.col("c_custkey").alias("id"))
    return dimension.missing_ids(ids, dimension.parse_dimension(t.dim_fx))


@query("fill_dimension", f"""WITH {_DIM} SELECT id, name FROM dim UNION ALL
SELECT c_custkey AS id, c_name AS name FROM customer WHERE c_custkey NOT IN (SELECT id FROM dim)""", ("dim_fx",))
def _(t: Tables):
    ids = t.customer.select(F.col("c_custkey").alias("id"))
    lookup = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    return dimension.fill_dimension(dimension.parse_dimension(t.dim_fx), ids, lookup)


@query("enrich_names", f"""WITH {_DIM} SELECT p.seq, p.pitcher, p.batter, a.name AS pitcher_name, b.name AS batter_name
FROM pitch_fx p LEFT JOIN dim a ON a.id = p.pitcher LEFT JOIN dim b ON b.id = p.batter""", ("dim_fx", "pitch_fx"))
def _(t: Tables):
    named = dimension.enrich_names(t.pitch_fx.select("seq", "pitcher", "batter"), dimension.parse_dimension(t.dim_fx))
    return named.select("seq", "pitcher", "batter", "pitcher_name", "batter_name")


@query("write_dimension", f"WITH {_DIM} SELECT id, name FROM dim", ("dim_fx",))
def _(t: Tables):
    path = fresh_path(t.spark, "dimension")
    dimension.write_dimension(dimension.parse_dimension(t.dim_fx), path)
    return dimension.parse_dimension(dimension.scan_dimension(t.spark, path))


@query("read_split", "SELECT pitcher, game_pk, game_year, split FROM (SELECT *, CASE WHEN game_year < 2000 THEN 'train' "
       "WHEN game_year = 2000 THEN 'test' END AS split FROM season_fx) WHERE split IS NOT NULL", ("season_fx",))
def _(t: Tables):
    folder = fresh_path(t.spark, "split")
    rows = t.season_fx.select("pitcher", "game_pk", "game_year")
    tables.write_split(folder, "pitchers", rows.filter("game_year < 2000"), rows.filter("game_year = 2000"))
    train, test = tables.read_split(t.spark, folder, "pitchers")
    return train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))


@query("write_eval", f"""SELECT model, split, {r6('avg(abs(y - pred))', 'mae')}, {r6('avg((y - pred) * (y - pred))', 'mse')},
{r6('sum(w * abs(y - pred)) / sum(w)', 'wmae')} FROM pred_fx GROUP BY model, split""", ("pred_fx",))
def _(t: Tables):
    folder = fresh_path(t.spark, "results")
    tables.write_eval(folder, {"errors": errors(t.pred_fx, ["model", "split"])})
    return t.spark.read.parquet(f"{folder}/evaluation/errors")


@query("model_roundtrip", f"SELECT batter, game_date, TRUE AS same FROM ({features_sql('batter', ['bb', 'k', 'pa', 'next_play'], ['next_xba'], S.BATTER_WINDOWS, 15, True, True)}) x", ("day_fx",))
def _(t: Tables):
    """A forest of two batches of trees, saved, sealed and opened again, predicts what it did before."""
    rows = batter_features(t.day_fx.withColumnsRenamed({"pitcher": "batter", "xba": S.TARGET}))
    model = fit_model(rows, "batter", numTrees=20, trees_per_fit=10)
    folder = fresh_path(t.spark, "model")
    tables.save_model(model, tables.version_path(folder, 1), "batter")
    tables.commit_models(t.spark, folder, 1)
    again = predict(tables.load_model(tables.open_models(t.spark, folder), "batter"), predict(model, rows, "before"), "after")
    return again.select("batter", "game_date", (F.abs(F.col("before") - F.col("after")) < 1e-12).alias("same"))
