"""Event scans, appends and the incremental update."""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from xoutcome import schema as S

EVENT_KEY = ["game_pk", "at_bat_number", "pitch_number"]


def header_groups(spark: SparkSession, path: str) -> list[list[str]]:
    """The files below ``path`` by their header line: one list of files for each different header.

    The lines that begin a file are those of the split at its start; the driver gets one row per header.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    first = lines.where("start = 0").groupBy("file").agg(F.first("value").alias("header"))
    groups = first.groupBy(F.btrim(F.regexp_replace("header", "^\ufeff", "")).alias("header")).agg(F.sort_array(F.collect_list("file")).alias("files"))
    return [[unquote(f) for f in r["files"]] for r in groups.orderBy("header").collect()]


def scan_events(spark: SparkSession, path: str, schema: T.StructType = S.RAW_SCHEMA) -> DataFrame:
    """Raw event text files by the names in their headers (S1): any order, more columns or fewer, other headers in other files.

    Files of one header are read together, each group by its own names. Columns that a file lacks are null, those that
    the schema lacks are not parsed; a value that does not fit its type is null. Empty files have no rows.
    """
    def read(files: list[str]) -> DataFrame:
        rows = spark.read.option("sep", ";").option("header", True).option("encoding", "ISO-8859-1").csv(files)
        present = {c.strip().lower(): c for c in reversed(rows.columns)}
        return rows.select(*[
            (F.col(f"`{present[f.name.lower()]}`").try_cast(f.dataType) if f.name.lower() in present else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields])
    groups = header_groups(spark, path)
    if not groups:
        return spark.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, [read(files) for files in groups])


def scan_partitioned(spark: SparkSession, path: str, seasons: tuple[int, int], teams: list[str] | None = None,
                     fmt: str = "parquet", season: str = "season", team: str = "team") -> DataFrame:
    """Parts of the seasons (both ends included) and teams (S2); other folders are never listed or read."""
    teams = S.TEAMS if teams is None else teams
    return (spark.read.format(fmt).load(path)
            .filter(F.col(season).between(*seasons) & F.col(team).isin(list(teams))))


def drop_deprecated(df: DataFrame, columns: list[str] = S.DEPRECATED) -> DataFrame:
    """Without the columns that are no longer filled (S3); absent ones do not matter."""
    present = [c for c in df.columns if c not in columns]
    return df.select(*[F.col(f"`{c}`") for c in present])


def append_events(df: DataFrame, path: str, partition: str = "game_year") -> None:
    """Append to the event store."""
    df.write.mode("append").partitionBy(partition).parquet(path)


def high_water_mark(df: DataFrame, day: str = "game_date") -> DataFrame:
    """Latest day of a text column, lines without a date skipped."""
    return df.agg(F.max(F.try_to_date(day)).alias("mark"))


def new_rows(stored: DataFrame, batch: DataFrame, key: list[str], day: str = "game_date", partition: str = "game_year") -> DataFrame:
    """Rows of a batch that the store does not hold yet (S6), late days among them.

    A whole key tells a row: of rows that repeat it one is new. Rows that lack a part of their key are told by all that they
    hold, so that unlike ones all stay. The anti joins read the store's partitions and days from the batch's first to its last.
    """
    rows = drop_deprecated(batch)
    lacking = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])
    whole, partial = rows.where(~lacking).dropDuplicates(key), rows.where(lacking).distinct()

    def touched(c: str) -> Column:
        low, high, nulls = rows.agg(F.min(c), F.max(c), F.count(F.when(F.col(c).isNull(), 1))).first()
        inside = F.col(c).between(F.lit(low), F.lit(high)) if low is not None else F.lit(False)
        return inside | F.col(c).isNull() if nulls else inside
    columns = [c for c in dict.fromkeys((partition, day)) if c in rows.columns]
    held = stored
    for c in columns:
        held = held.filter(touched(c))

    def less(fresh: DataFrame, there: DataFrame, names: list[str]) -> DataFrame:
        there = there.select(*[F.col(f"`{k}`").alias(f"_{k}") for k in names])
        return fresh.join(there, [F.col(f"`{k}`").eqNullSafe(F.col(f"`_{k}`")) for k in names], "left_anti")
    every = [c for c in rows.columns if c in stored.columns]
    return less(whole, held.where(~lacking), key).unionByName(less(partial, held.where(lacking), every))


def incremental_update(spark: SparkSession, path: str, batch: DataFrame, key: list[str] = EVENT_KEY,
                       day: str = "game_date", partition: str = "game_year") -> None:
    """Append what is new in ``batch`` (S6); a batch that comes twice adds nothing the second time."""
    append_events(new_rows(spark.read.parquet(path), batch, key, day, partition), path, partition)
