"""The incremental append over files that arrive in a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from xoutcome.sources.events import EVENT_KEY, append_events, new_rows

LEDGER = "progress string, batch long, rows long"


def committed(spark: SparkSession, ledger: str, progress: str) -> set[int]:
    """Numbers of the batches that a stream has added, by its own ledger; one small row for each."""
    known = spark.createDataFrame([(progress, -1, 0)], LEDGER)
    known.limit(0).write.mode("append").parquet(ledger)  # so that there is one to read
    return {r["batch"] for r in spark.read.schema(LEDGER).parquet(ledger).where(F.col("progress") == progress).collect()}


def append_arrivals(spark: SparkSession, arrivals: str, store: str, schema: T.StructType, progress: str,
                    key: list[str] = EVENT_KEY, day: str = "game_date", partition: str = "game_year",
                    files_per_batch: int = 1000, ledger: str | None = None) -> StreamingQuery:
    """Append all files not seen before, then stop.

    A batch that was added is written to the ``ledger`` beside the store by its number, and is passed over if it comes
    again. One that was killed before that finds its own rows in the store and adds none of them. Days may come in any
    order over the batches.
    """
    ledger = ledger or store.rstrip("/") + "-batches"
    done = committed(spark, ledger, progress)

    def add(batch: DataFrame, number: int) -> None:
        if number in done:
            return
        fresh = new_rows(spark.read.parquet(store), batch, key, day, partition).persist()
        rows = fresh.count()  # before the append, which makes Spark read the store anew
        append_events(fresh, store, partition)
        spark.createDataFrame([(progress, number, rows)], LEDGER).coalesce(1).write.mode("append").parquet(ledger)
        fresh.unpersist()

    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(arrivals)
            .writeStream.foreachBatch(add).option("checkpointLocation", progress)
            .trigger(availableNow=True).start())
