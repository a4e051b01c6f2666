"""Snapshots that arrive as files: each arrival is compared with what is known of its keys, which is keyed state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Versions whose whole table is there, as the writer's success mark says."""
    fs = spark._jvm.org.apache.hadoop.fs
    found = fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(fs.Path(f"{path}/batch=*/_SUCCESS"))
    return sorted(int(f.getPath().getParent().getName().removeprefix("batch=")) for f in found or [])


def baseline(spark: SparkSession, path: str, schema: str, before: int | None = None) -> DataFrame:
    """The latest content of each key: the newest version (below ``before``), which holds all keys."""
    versions = [v for v in _versions(spark, path) if before is None or v < before]
    return spark.read.schema(schema).parquet(f"{path}/batch={versions[-1]}") if versions else spark.createDataFrame([], schema)


class _LatestContent(StatefulProcessor):
    """Per key the digest of its latest content; only keys of the arrival are looked at, only changed ones are written."""

    def __init__(self, key: str, kind: str):
        self.key, self.kind = key, kind

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.latest = handle.getValueState("latest", "digest string")

    def handleInputRows(self, key, rows, timer_values) -> Iterator[pd.DataFrame]:
        found = [d for part in rows for d in part["digest"] if d is not None and d == d]
        new, old = max(found, default=None), self.latest.get()[0] if self.latest.exists() else None
        if new == old:
            return
        if new is None:
            self.latest.clear()
        else:
            self.latest.update((new,))
        yield pd.DataFrame({self.key: [key[0]], "change": ["added" if old is None else "removed" if new is None else "modified"]})

    def handleInitialState(self, key, initial, timer_values) -> None:
        found = [d for d in initial["digest"] if d is not None]
        if found:
            self.latest.update((max(found),))

    def close(self) -> None:
        pass


_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def watch(spark: SparkSession, arrivals: str, baseline_path: str | None, changes_path: str, checkpoint: str, schema: str = "page_id bigint, html string", files: int | None = 1) -> StreamingQuery:
    """Start a query that writes (key, change, version) of every arrival to ``changes_path``.

    The latest digest of each key is keyed state, so an arrival costs work for its own keys, however many are known.  A
    null content is a deletion: it is told once, and the key is new when it comes again.  Of several contents of a key in one arrival the
    one of the greatest digest counts.  ``baseline_path`` may hold versions of a table of known contents (see
    ``baseline``): they are the state that the first start begins with.  ``files`` of new files make an arrival, None takes
    all.  A batch that is run again after a failure overwrites its own version, so nothing is told twice.
    """
    (key, kind), (content, _) = (c.split()[:2] for c in schema.split(","))
    digest = lambda df: df.select(key, F.when(F.col(content).isNotNull(), F.sha2(content, 256)).alias("digest"))

    def tell(batch: DataFrame, version: int) -> None:
        batch.withColumn("version", F.lit(version).cast("bigint")).write.mode("overwrite").parquet(f"{changes_path}/batch={version}")

    reader = spark.readStream.schema(schema)
    stream = (reader.option("maxFilesPerTrigger", files) if files else reader).parquet(arrivals)
    known = digest(baseline(spark, baseline_path, schema)).groupBy(key) if baseline_path and _versions(spark, baseline_path) else None
    changes = digest(stream).groupBy(key).transformWithStateInPandas(_LatestContent(key, kind), f"{key} {kind}, change string", "Append", "None", initialState=known)
    before = {name: spark.conf.get(name, None) for name in _STATE}
    for name, value in _STATE.items():
        spark.conf.set(name, value)
    try:
        # the query keeps the settings it was started with
        return changes.writeStream.foreachBatch(tell).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def event_windows(events: DataFrame, late: str = "1 hour", width: str = "1 day") -> DataFrame:
    """Counts and sums of events in tumbling windows; works on streams, with a watermark, and on tables."""
    seen = events.withWatermark("ts", late) if events.isStreaming else events
    return seen.groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total")).select(F.col("window.start").alias("start"), "event_type", "n", "total")
