"""Structured Streaming forms of the three feeds: task states, tag changes and the update queue."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom.operators import mutations, state


def file_stream(spark: SparkSession, folder: str, file: str) -> DataFrame:
    """Parquet files of a folder that match a name, as a stream with the schema that they have."""
    schema = spark.read.option("pathGlobFilter", file).parquet(folder).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", file).option("maxFilesPerTrigger", 1).parquet(folder)


def latest_states(events: DataFrame, key: list[str], order: list[str], values: list[str]) -> DataFrame:
    """The last event's values of each key. State holds one row a key; an event that comes late loses to a later one."""
    return events.groupBy(*key).agg(F.max_by(F.struct(*values), F.struct(*order)).alias("_v")).select(*key, "_v.*")


def counts_by_window(events: DataFrame, ts: str, key: str, size: str, late: str) -> DataFrame:
    """Events of each key and window; a window is given once the watermark has passed it."""
    e = events.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", late)
    return e.groupBy(F.window("_ts", size), key).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), key, "n")


def run_to_end(df: DataFrame, checkpoint: str, mode: str = "complete") -> DataFrame:
    """Runs a stream over what is there and gives its result as a table."""
    name = f"feed_{uuid.uuid4().hex}"
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start() if mode != "complete" else df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.table(name)


def sync_tags(remote: DataFrame, local_path: str, checkpoint: str, seen: Callable[[DataFrame], None] | None = None):
    """Takes in tag records (segment_id, last_modified, tags) batch by batch: those that are new or changed replace what the
    local table (Parquet, in numbered versions below local_path) has. A batch that is run again gives the same version."""

    def take(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        local = spark.read.parquet(f"{local_path}/v{number}")
        once = mutations.latest(batch, ["segment_id"], ["last_modified", "tags"])
        status = state.tag_sync(once, local)
        if seen:
            seen(status)
        mutations.upsert(local, status.where("status <> 'unchanged'").drop("status"), ["segment_id"], "last_modified").write.mode("overwrite").parquet(f"{local_path}/v{number + 1}")

    return remote.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def drain_queue(queue: DataFrame, update: Callable[[DataFrame], DataFrame], done_path: str, checkpoint: str):
    """Passes each batch of queued keys to `update`, which gives (key, succeeded); successes are appended to done_path, one
    folder a batch, and failures stay for a later run."""

    def take(batch: DataFrame, number: int) -> None:
        update(batch).where("succeeded").write.mode("overwrite").parquet(f"{done_path}/batch={number}")

    return queue.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
