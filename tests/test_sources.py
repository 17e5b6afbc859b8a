"""Scans and appends."""

import datetime as dt

from pyspark.sql import functions as F

from xoutcome import schema as S
from xoutcome.operators.filters import remove_header_rows
from xoutcome.sources import dimension, events
from xoutcome.streaming.update import append_arrivals

D = dt.date


def test_scan_reads_repeated_headers_and_latin1(spark, tmp_path):
    names = [f.name for f in S.RAW_SCHEMA.fields]
    values = {"game_date": "2024-05-01", "player_name": "Peña, José", "release_speed": "95.1", "batter": "7"}
    lines = [";".join(names), ";".join(values.get(n, "") for n in names), ";".join(names)]
    (tmp_path / "part.csv").write_bytes("\n".join(lines).encode("latin-1"))
    rows = remove_header_rows(events.scan_events(spark, str(tmp_path))).collect()
    assert len(rows) == 1
    assert rows[0]["player_name"] == "Peña, José" and rows[0]["release_speed"] == 95.1 and rows[0]["batter"] == 7


def test_update_twice_adds_nothing(spark, tmp_path):
    rows = [(1, 1, i, D(2024, 1, 1 + i // 4), 2024) for i in range(12)]
    df = spark.createDataFrame(rows, "game_pk int, at_bat_number int, pitch_number int, game_date date, game_year int")
    store = str(tmp_path / "store")
    events.append_events(df.filter("pitch_number < 6"), store)
    for _ in range(2):
        events.incremental_update(spark, store, df.unionAll(df))
        assert spark.read.parquet(store).count() == 12


def test_season_folders_are_pruned(spark, tmp_path):
    path = str(tmp_path / "parts")
    df = spark.createDataFrame([(y, t, i) for y in (2020, 2021, 2022) for t in ("SF", "SD", "XX") for i in range(2)],
                               "season int, team string, v int")
    df.write.partitionBy("season", "team").parquet(path)
    found = events.scan_partitioned(spark, path, (2021, 2022))
    assert found.count() == 8
    assert "PartitionFilters: [isnotnull(season" in found._jdf.queryExecution().executedPlan().toString()


def test_last_line_of_an_id_counts(spark, tmp_path):
    (tmp_path / "map.csv").write_text("1; Jo Doe\n2 broken\n1; Jo Roe\n3; A; B\n")
    found = dimension.parse_dimension(dimension.scan_dimension(spark, str(tmp_path / "map.csv")))
    assert [tuple(r) for r in found.collect()] == [(1, "Jo Roe")]


def test_arrivals_are_added_once(spark, tmp_path):
    df = spark.range(10).select("id", F.lit(D(2024, 1, 1)).alias("game_date"), F.lit(2024).alias("game_year"))
    store, arrivals, progress = (str(tmp_path / n) for n in ("store", "arrivals", "progress"))
    events.append_events(df.filter("id < 3"), store)
    df.write.parquet(arrivals)
    for _ in range(2):
        append_arrivals(spark, arrivals, store, df.schema, progress, ["id"]).awaitTermination()
    assert spark.read.parquet(store).count() == 10


def test_header_names_decide(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("extra;batter;game_date\nx;7;2024-05-01\ny;no number;2024-05-02\n".encode("latin-1"))
    rows = sorted(events.scan_events(spark, str(tmp_path)).collect(), key=lambda r: r["game_date"])
    assert [f.name for f in S.RAW_SCHEMA.fields] == events.scan_events(spark, str(tmp_path)).columns
    assert [(r["batter"], r["pitcher"]) for r in rows] == [(7, None), (None, None)]


def test_arrivals_in_falling_days_and_null_keys(spark, tmp_path):
    rows = [(i if i % 5 else None, D(2024, 1, 1) + dt.timedelta(days=i), 2024) for i in range(20)]
    df = spark.createDataFrame(rows, "id long, game_date date, game_year int")
    store, arrivals, progress = (str(tmp_path / n) for n in ("store", "arrivals", "progress"))
    events.append_events(df.filter("id = 1"), store)
    for low in (15, 10, 5, 0):
        df.filter(F.col("game_date").between(D(2024, 1, 1) + dt.timedelta(days=low), D(2024, 1, 1) + dt.timedelta(days=low + 4))).coalesce(1).write.mode(
            "append").parquet(arrivals)
    for _ in range(2):
        append_arrivals(spark, arrivals, store, df.schema, progress, ["id", "game_date"], files_per_batch=1).awaitTermination()
    events.incremental_update(spark, store, df, ["id", "game_date"])
    assert spark.read.parquet(store).count() == 20


def test_marks_inside_texts(spark):
    from xoutcome.functions import text
    df = spark.createDataFrame([("Jo >> Doe singles",), ("nothing here",), ("",), (None,)], "t string")
    got = [tuple(r) for r in df.select(text.extract_actor(F.col("t"), [" singles", " s"]), text.after_last_base(F.col("t"), ["Jo ", "(x"])).collect()]
    assert got == [("Jo >> Doe", ">> Doe singles"), ("nothing here", "nothing here"), ("", ""), (None, None)]


def test_files_with_other_headers(spark, tmp_path):
    """Each file goes by its own header: other orders, other names, fewer columns, an empty file, a name with a space."""
    (tmp_path / "a.csv").write_text("game_pk;pitcher;batter\n1;12;20\n2;13;21\n")
    (tmp_path / "b b.csv").write_text("batter;game_pk;pitcher\n30;3;12\n")
    (tmp_path / "c.csv").write_text(" Batter ;more\n40;x\n")
    (tmp_path / "d.csv").write_text("")
    (tmp_path / "e.csv").write_text("batter;game_pk;pitcher\n")
    got = {(r["game_pk"], r["pitcher"], r["batter"]) for r in events.scan_events(spark, str(tmp_path)).collect()}
    assert got == {(1, 12, 20), (2, 13, 21), (3, 12, 30), (None, None, 40)}
    assert len(events.header_groups(spark, str(tmp_path))) == 3


def test_unlike_rows_without_a_key(spark, tmp_path):
    rows = [(None, 1, D(2024, 1, 1), 2024, "a"), (None, 1, D(2024, 1, 1), 2024, "b"), (None, 1, D(2024, 1, 1), 2024, "b"), (7, 1, D(2024, 1, 1), 2024, "c"),
            (7, 1, D(2024, 1, 1), 2024, "d"), (None, None, D(2024, 1, 2), 2024, None)]
    df = spark.createDataFrame(rows, "game_pk int, at_bat_number int, game_date date, game_year int, note string")
    store = str(tmp_path / "store")
    events.append_events(df.limit(0), store)
    df.where("false").write.mode("append").parquet(store + "/game_year=2024")
    for _ in range(2):
        events.incremental_update(spark, store, df, ["game_pk", "at_bat_number"])
        held = spark.read.parquet(store)
        assert sorted(str(r["note"]) for r in held.where("game_pk is null").collect()) == ["None", "a", "b"] and held.where("game_pk = 7").count() == 1


def test_batches_are_known_by_their_number(spark, tmp_path):
    """The ledger's numbers are passed over, even if the store has lost their rows."""
    df = spark.range(6).select("id", F.lit(D(2024, 1, 1)).alias("game_date"), F.lit(2024).alias("game_year"))
    store, arrivals, progress = (str(tmp_path / n) for n in ("store", "arrivals", "progress"))
    events.append_events(df.filter("id = 0"), store)
    df.coalesce(1).write.parquet(arrivals)
    append_arrivals(spark, arrivals, store, df.schema, progress, ["id"]).awaitTermination()
    ledger = [tuple(r) for r in spark.read.parquet(store + "-batches").collect()]
    assert ledger == [(progress, 0, 5)] and spark.read.parquet(store).count() == 6
    spark.createDataFrame([(progress, 1, 0)], "progress string, batch long, rows long").write.mode("append").parquet(store + "-batches")
    df.selectExpr("id + 100 as id", "game_date", "game_year").coalesce(1).write.mode("append").parquet(arrivals)
    append_arrivals(spark, arrivals, store, df.schema, progress, ["id"]).awaitTermination()
    assert spark.read.parquet(store).count() == 6


def test_sealed_versions_of_models(spark, tmp_path):
    import pytest
    from xoutcome.operators.scaling import Components, FitState, Scaler, SoftClusters
    from xoutcome.plans.clusters import ClusterModel
    from xoutcome.sources import tables
    folder = str(tmp_path / "store")
    made = [ClusterModel(Scaler(["a"], [m], [1.0]), Components(["a"], [m], [[1.0]], [1.0]), SoftClusters(["attribute_0"], [[0.0], [m]], FitState(9, 1e-6, 2.0, True)))
            for m in (1.0, 2.0)]
    for version, model in enumerate(made, 1):
        model.save(spark, tables.version_path(folder, version))
        with pytest.raises(ValueError, match="no sealed version"):
            tables.open_models(spark, folder, version) if version > 1 else tables.open_models(spark, _sealed_other(spark, tmp_path), 5)
        tables.commit_models(spark, folder, version)
    assert ClusterModel.load(spark, tables.open_models(spark, folder)) == made[1]
    assert ClusterModel.load(spark, tables.open_models(spark, folder, 1)) == made[0]
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        tables.commit_models(spark, folder, 1)
    part = next((tmp_path / "store" / "models-v000002" / "components").glob("part-*.parquet"))
    part.rename(tmp_path / "gone")
    with pytest.raises(ValueError, match="components"):
        tables.open_models(spark, folder)
    assert ClusterModel.load(spark, tables.open_models(spark, folder, 1)) == made[0]


def _sealed_other(spark, tmp_path):
    from xoutcome.sources import tables
    other = str(tmp_path / "other")
    spark.range(1).write.parquet(tables.version_path(other, 1))
    tables.commit_models(spark, other, 1)
    return other
