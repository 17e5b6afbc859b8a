"""The id-to-name dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from xoutcome.operators.hot import bounded_broadcast


def scan_dimension(spark: SparkSession, path: str) -> DataFrame:
    """Lines of ``id; name`` files, with their place."""
    place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("n"))
    return spark.read.text(path).select(F.col("value").alias("line"), place.alias("line_no"))


def parse_dimension(lines: DataFrame, line: str = "line", place: str | Column = "line_no") -> DataFrame:
    """``id; name`` per line (S8): other lines are dropped, the last line of an id counts."""
    fields = F.split(line, "; ")
    rows = lines.withColumn("_f", fields).filter(F.size("_f") == 2)
    rows = rows.select(F.col("_f")[0].try_cast("long").alias("id"), F.trim(F.col("_f")[1]).alias("name"),
                       (F.col(place) if isinstance(place, str) else place).alias("_p"))
    return rows.groupBy("id").agg(F.max_by("name", "_p").alias("name"))


def distinct_ids(df: DataFrame, columns: tuple[str, ...] = ("batter", "pitcher"), out: str = "id") -> DataFrame:
    """Ids of all roles, once each."""
    ids = F.explode(F.array(*[F.col(c).cast("long") for c in columns]))
    return df.select(ids.alias(out)).distinct()


def missing_ids(ids: DataFrame, dimension: DataFrame) -> DataFrame:
    """Ids without a name."""
    return ids.join(dimension.filter(F.col("name").isNotNull()), "id", "left_anti")


def fill_dimension(dimension: DataFrame, ids: DataFrame, lookup: DataFrame) -> DataFrame:
    """The dimension with missing ids named from a lookup table."""
    added = missing_ids(ids, dimension).join(lookup.select("id", "name"), "id", "left")
    return dimension.filter(F.col("name").isNotNull()).unionByName(added)


def enrich_names(df: DataFrame, dimension: DataFrame, roles: tuple[str, ...] = ("pitcher", "batter")) -> DataFrame:
    """Add the name of each role's id."""
    names = bounded_broadcast(dimension.select("id", "name"))
    for role in roles:
        df = df.join(names.toDF(role, f"{role}_name"), role, "left")
    return df


def write_dimension(dimension: DataFrame, path: str) -> None:
    """``id; name`` lines (S12), to a path that is not being read."""
    line = F.concat_ws("; ", F.col("id").cast("string"), "name")
    dimension.filter(F.col("name").isNotNull()).select(line.alias("value")).write.mode("overwrite").text(path)
