"""Training batches from a stream of decisions: a bounded history and a queue for each key, with a limit of size and one of time."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from citeloom.streaming.incremental import folder, run_available, stream_of

# Decisions kept as history, those that make a batch, and the seconds after which fewer make one.
HISTORY, BATCH, INTERVAL = 1_000, 10, 300
ENTRY = "at long, id long"
OUT = "key {key}, reason string, n int, first_id long, last_id long, from_ms long, to_ms long, n_history int"
STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


# workers get the processor itself, so that they need not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Trainer(StatefulProcessor):
    """Of a key, in the order of time and id: each decision joins the history and the queue. The queue becomes a batch when it has `batch` decisions, or when its first one is `interval` seconds old.

    How old it is, is told by later decisions of the key and by a timer on the stream's own time, so that the batches do
    not depend on how the stream is cut.
    """

    def __init__(self, history: int, batch: int, interval: int) -> None:
        self.limits = history, batch, interval * 1_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.history = handle.getListState("history", ENTRY)
        self.queue = handle.getListState("queue", ENTRY)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        keep, size, interval = self.limits
        history, queue, out = list(self.history.get()), list(self.queue.get()), []
        waits = queue[0][0] if queue else None
        for at, id_ in sorted((int(a), int(i)) for df in rows for a, i in zip(df["at"], df["id"], strict=True)):
            if queue and at - queue[0][0] >= interval:
                out.append(self.batch(key, "interval", queue, history))
                queue = []
            history = [*history, (at, id_)][-keep:]
            queue.append((at, id_))
            if len(queue) >= size:
                out.append(self.batch(key, "size", queue, history))
                queue = []
        self.history.put(history)
        if waits is not None and (not queue or queue[0][0] != waits):
            self.handle.deleteTimer(waits + interval)
        if queue:
            self.queue.put(queue)
            if queue[0][0] != waits:
                self.handle.registerTimer(queue[0][0] + interval)
        else:
            self.queue.clear()
        if out:
            yield pd.DataFrame(out)

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        queue = list(self.queue.get())
        if queue and queue[0][0] + self.limits[2] <= expiredTimerInfo.getExpiryTimeInMs():
            self.queue.clear()
            yield pd.DataFrame([self.batch(key, "interval", queue, list(self.history.get()))])

    def batch(self, key: tuple, reason: str, queue: list, history: list) -> dict:
        return {"key": key[0], "reason": reason, "n": len(queue), "first_id": queue[0][1], "last_id": queue[-1][1], "from_ms": queue[0][0], "to_ms": queue[-1][0], "n_history": len(history)}

    def close(self) -> None:
        pass


def training_batches(stream: DataFrame, key: str, id_: str, at: str, late: str = "0 seconds", history: int = HISTORY, batch: int = BATCH, interval: int = INTERVAL) -> DataFrame:
    """(key, reason, n, first_id, last_id, from_ms, to_ms, n_history) of each batch that a stream of decisions gives; late: how far decisions may be out of order.

    State is a list of up to `history` and one of under `batch` decisions for each key; keys are dealt to all tasks.
    Rows without a key, an id or a time are left out, and so are times before 1970, as a stream's own time begins there. What waits in a queue when the stream ends stays there for its next run.
    """
    rows = stream.select(F.col(key).alias("key"), F.col(id_).cast("long").alias("id"), F.col(at).cast("timestamp").alias("time")).where("key IS NOT NULL AND id IS NOT NULL AND time IS NOT NULL")
    rows = rows.withWatermark("time", late).withColumn("at", F.unix_millis("time"))
    kind = dict(rows.dtypes)["key"]
    return rows.groupBy("key").transformWithStateInPandas(Trainer(history, batch, interval), OUT.format(key=kind), outputMode="Append", timeMode="EventTime")


def run(spark: SparkSession, batches: DataFrame, at: str) -> DataFrame:
    """All batches so far after what is available; lists of state need the store that this sets for the run."""
    before = spark.conf.get(STORE, None)
    spark.conf.set(STORE, ROCKS)
    try:
        return run_available(batches, at)
    finally:
        spark.conf.unset(STORE) if before is None else spark.conf.set(STORE, before)


def st03_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training batches of the events of each user."""
    return run(spark, training_batches(stream_of(spark, f"{sf_dir}/events.parquet"), "user_id", "event_id", "ts"), folder(spark))


PROGRAMS = {"st03_training_batches": st03_batches}
