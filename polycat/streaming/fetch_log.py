"""The change log followed as it grows: the last status of each car and locale, kept by a stateful operator."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from polycat import schema
from polycat.sources.shared import filesystem

KEYS = ["car_id", "locale"]
STATES = "car_id string, locale string, status string, id long"
_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def read(spark: SparkSession, folder: str, per_batch: int = 1) -> DataFrame:
    """Log rows from Parquet files as they come in."""
    return spark.readStream.schema(schema.struct("fetch_log")).option("maxFilesPerTrigger", per_batch).parquet(folder)


class Last(StatefulProcessor):
    """Keeps the largest id of a car and locale in the state store, and hands on a row only where a batch has a larger one: a repeated or late row changes nothing."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "id long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timers) -> Iterator[pd.DataFrame]:
        best = None
        for some in rows:
            some = some[some["id"].notna()]
            if len(some):
                row = some.loc[some["id"].idxmax()]
                if best is None or row["id"] > best["id"]:
                    best = row
        had = self.last.get()[0] if self.last.exists() else None
        if best is not None and (had is None or int(best["id"]) > had):
            self.last.update((int(best["id"]),))
            yield pd.DataFrame({"car_id": [key[0]], "locale": [key[1]], "status": [best["status"]], "id": [int(best["id"])]})

    def close(self) -> None:
        pass


def changes(log: DataFrame) -> DataFrame:
    """The keys whose last status a batch of log changes, with it."""
    return log.select(*KEYS, "status", "id").groupBy(*KEYS).transformWithStateInPandas(Last(), STATES, "Update", "None")


def into_table(log: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Starts the stream of log's changes into folder, for what there is now; returns the started query.

    A batch writes the keys that it changes and nothing else, to a folder of its own that a batch which runs again
    replaces. What is known is read by states(); a batch's cost follows the batch, not the table.
    """
    spark, run = log.sparkSession, hashlib.sha1(checkpoint.encode()).hexdigest()[:12]

    def write(batch: DataFrame, n: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/run={run}/batch={n}")

    before = spark.conf.get(_STORE)
    spark.conf.set(_STORE, _ROCKS)
    try:
        return changes(log).writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        spark.conf.set(_STORE, before)


def states(spark: SparkSession, folder: str) -> DataFrame:
    """car_id, locale, status, id: the last status of each key among all batches' changes."""
    fs, p = filesystem(spark, folder)
    if not fs.exists(p):
        return spark.createDataFrame([], STATES)
    rows = spark.read.schema(STATES).option("recursiveFileLookup", "true").parquet(folder)
    return rows.groupBy(*KEYS).agg(F.max_by("status", "id").alias("status"), F.max("id").alias("id"))


def compact(spark: SparkSession, folder: str) -> None:
    """All batches' changes as one; for now and then, while no stream writes. Batches that run again afterwards change nothing, since the largest id counts."""
    fs, p = filesystem(spark, folder)
    old = [s.getPath() for s in fs.listStatus(p)]
    names = {x.getName() for x in old}
    n = 1 + max([int(x.removeprefix("run=base-")) for x in names if x.startswith("run=base-")], default=0)
    states(spark, folder).write.parquet(f"{folder}/run=base-{n}/batch=0")
    for x in old:
        fs.delete(x, True)


def latest(log: DataFrame) -> DataFrame:
    """The last status of each car and locale; state is one row for each."""
    return log.groupBy(*KEYS).agg(F.max_by("status", "id").alias("status"))
