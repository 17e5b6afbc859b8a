"""Named tables below one folder: cleaned events, splits, rollups, evaluation."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table_path(folder: str, name: str) -> str:
    return f"{folder}/{name}"


def write_tables(folder: str, tables: dict[str, DataFrame], *partition: str) -> None:
    """Write each table as Parquet (S7), in folders by the ``partition`` columns; arrays stay arrays."""
    for name, df in tables.items():
        df.write.mode("overwrite").partitionBy(*partition).parquet(table_path(folder, name))


def write_split(folder: str, kind: str, train: DataFrame, test: DataFrame) -> None:
    write_tables(folder, {f"{kind}_train": train, f"{kind}_test": test})


def read_split(spark: SparkSession, folder: str, kind: str) -> tuple[DataFrame, DataFrame]:
    """Train and test table of one kind."""
    return tuple(spark.read.parquet(table_path(folder, f"{kind}_{part}")) for part in ("train", "test"))


def write_eval(folder: str, tables: dict[str, DataFrame]) -> None:
    """Evaluation tables."""
    write_tables(f"{folder}/evaluation", tables)


MANIFEST = "path string, bytes long, sha256 string"


def _contents(spark: SparkSession, folder: str) -> dict[str, tuple[int, str]]:
    """Length and digest of every file below ``folder``, by its path in it; models are small next to their data."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    rows = files.select("path", "length", F.sha2("content", 256).alias("sha256")).collect()
    mark = "/" + folder.rstrip("/").rsplit("/", 1)[-1] + "/"
    return {r["path"].rsplit(mark, 1)[-1]: (r["length"], r["sha256"]) for r in rows}


def version_path(folder: str, version: int) -> str:
    return f"{folder}/models-v{version:06d}"


def commit_models(spark: SparkSession, folder: str, version: int) -> None:
    """Seal a version of all models - scaler, components, centres, forests - by a manifest of its files.

    Only a version with a manifest is read; one that was being written when its job died has none. A sealed version is
    never changed: sealing it again raises.
    """
    rows = [(path, size, sha) for path, (size, sha) in sorted(_contents(spark, version_path(folder, version)).items())]
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("error").parquet(f"{folder}/manifests/version={version}")


def open_models(spark: SparkSession, folder: str, version: int | None = None) -> str:
    """The folder of a sealed version, of the latest without one named; raises if any part is missing, added or altered."""
    sealed = spark.read.schema(MANIFEST + ", version int").parquet(f"{folder}/manifests")
    if version is None:
        version = sealed.agg(F.max("version")).first()[0]
    wanted = {r["path"]: (r["bytes"], r["sha256"]) for r in sealed.where(F.col("version") == version).collect()}
    if not wanted:
        raise ValueError(f"no sealed version {version} in {folder}")
    found = _contents(spark, version_path(folder, version))
    odd = sorted(p for p in {*wanted, *found} if wanted.get(p) != found.get(p))
    if odd:
        raise ValueError(f"version {version}: missing, added or altered: {', '.join(odd[:5])}")
    return version_path(folder, version)


def save_model(model: PipelineModel, folder: str, name: str) -> None:
    """One path per model."""
    model.write().overwrite().save(f"{folder}/models/{name}")


def load_model(folder: str, name: str) -> PipelineModel:
    return PipelineModel.load(f"{folder}/models/{name}")
