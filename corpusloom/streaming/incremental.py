"""Restartable builds and windows over event time (R1 to R6, K2, K3; the windows are an extension)."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def new_rows(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """The rows whose key the output lacks; null keys are always new."""
    return df.join(done.select(key).distinct(), key, "left_anti")


def append_batches(spark: SparkSession, source: str, schema, out: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame], key: str, files_a_batch: int = 8) -> list[int]:
    """Process the files of a folder that no earlier run has, in bounded batches, each written once under its batch id.

    The batch folder is the sentinel: a batch that is run again overwrites its own folder, so the output is exactly-once; the checkpoint
    remembers the files.  Within a batch the first row of a key stays.  Returns the ids of this run's batches.
    """
    ran: list[int] = []

    def write(batch: DataFrame, batch_id: int) -> None:
        transform(batch).dropDuplicates([key]).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
        ran.append(batch_id)

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).parquet(source)
    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return ran


def merged(spark: SparkSession, out: str, key: str) -> DataFrame:
    """K3: all batches; of a key that several batches hold the earliest wins."""
    df = spark.read.parquet(out)
    best = df.groupBy(key).agg(F.min("batch_id").alias("__b"))
    return df.join(best, key).where("batch_id = __b").drop("__b")


def windowed_counts(events: DataFrame, at: str, by: list[str], size: str, slide: str | None, late: str | None) -> DataFrame:
    """Tumbling (no slide) or sliding event-time windows; with ``late`` a watermark bounds the state of a stream."""
    e = events.withWatermark(at, late) if late else events
    w = F.window(at, size, slide) if slide else F.window(at, size)
    return e.groupBy(w.alias("w"), *by).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total")).select(F.col("w.start").alias("w_start"), *by, "n", "total")


def session_counts(events: DataFrame, at: str, by: list[str], gap: str, late: str | None) -> DataFrame:
    """Event-time sessions: a gap of at least ``gap`` ends one."""
    e = events.withWatermark(at, late) if late else events
    return e.groupBy(F.session_window(at, gap).alias("w"), *by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("w_start"), *by, "n")


def distinct_events(events: DataFrame, at: str, key: str, late: str) -> DataFrame:
    """The first event of a key within the watermark."""
    return events.withWatermark(at, late).dropDuplicatesWithinWatermark([key])


def run_to_table(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Run a streaming plan over what is there and return its result, from a table in the shared folder.

    Every batch writes its own folder, again if it is run again; in complete mode the last batch holds the whole result.
    """
    last: list[int] = []

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        last.append(batch_id)

    df.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    fields = df.schema
    if not last:
        return df.sparkSession.createDataFrame([], fields)
    read = df.sparkSession.read.schema(fields)
    return read.parquet(f"{path}/batch_id={last[-1]}") if mode == "complete" else read.parquet(*[f"{path}/batch_id={b}" for b in last])


def early_stop(points: DataFrame, by: str, step: str, value: str, least: float) -> DataFrame:
    """R6, W9 on a stream: (by, step) where the value of a run rose by ``least`` twice in a row; the state is the last two points of a run."""

    def update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = list(state.get[0]) if state.exists else []
        hits = []
        for pdf in batches:
            for s, v in sorted(zip(pdf[step], pdf[value], strict=True)):
                if len(last) == 2 and v - last[1] >= least and last[1] - last[0] >= least:
                    hits.append(s)
                last = [*last[-1:], float(v)]
        state.update((last,))
        yield pd.DataFrame({by: [key[0]] * len(hits), step: hits})

    kinds = {f.name: f.dataType.simpleString() for f in points.schema}
    return points.groupBy(by).applyInPandasWithState(update, f"{by} {kinds[by]}, {step} {kinds[step]}", "last array<double>", "append", GroupStateTimeout.NoTimeout)


def call_rows(df: DataFrame, ident: str, argument: str, action: Callable[[str], str], attempts: int = 4, pause: float = 0.0) -> DataFrame:
    """(ident, result, tries, failed): ``action`` on every row's argument, tried again after a pause that grows by ``pause`` seconds each time.

    After ``attempts`` failures the row counts as failed with a null result; one failing row never stops the others.
    """
    kind = df.schema[ident].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for i, x in zip(pdf[ident], pdf[argument], strict=True):
                result, tries = None, 0
                while tries < attempts and result is None:
                    if tries and pause:
                        time.sleep(pause * tries)
                    tries += 1
                    try:
                        result = action(x)
                    except Exception:  # noqa: BLE001 - any failure of the action counts as one
                        result = None
                rows.append((i, result, tries, result is None))
            yield pd.DataFrame(rows, columns=[ident, "result", "tries", "failed"])

    return df.select(ident, argument).mapInPandas(run, f"{ident} {kind}, result string, tries int, failed boolean")
