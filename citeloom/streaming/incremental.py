"""Incremental runs as Structured Streaming: resume by checkpoint, skip what is done, and keep bounded histories."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.sources.tables import cut

#: The watermark of the counts; in complete mode all events are counted, late ones too.
LATE = "1 hour"


def folder(spark: SparkSession) -> str:
    cut(spark.range(1))  # sets the folder where there is none
    return f"{spark.sparkContext.getCheckpointDir()}/stream-{uuid.uuid4().hex}"


def run_available(stream: DataFrame, at: str) -> DataFrame:
    """What a run over all that is available appends; a further run with the same folder goes on from there."""
    stream.writeStream.format("parquet").option("checkpointLocation", f"{at}/state").option("path", f"{at}/out").trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{at}/out")


def stream_of(spark: SparkSession, path: str) -> DataFrame:
    """A file stream of a table; the stream reads path as a pattern, so that a single file will do."""
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).parquet(f"{path}*")


def st01(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Resumable extraction: event ids with their type and key."""
    events = stream_of(spark, f"{sf_dir}/events.parquet")
    return run_available(events.select("event_id", "event_type", F.get_json_object("props", "$.k").alias("k")), folder(spark))


def st02(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Idempotent skip: one row for each user and type."""
    events = stream_of(spark, f"{sf_dir}/events.parquet")
    return run_available(events.select("user_id", "event_type").dropDuplicates(["user_id", "event_type"]), folder(spark))


def st03(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Micro-batches by hour: how many of each type."""
    events = stream_of(spark, f"{sf_dir}/events.parquet").withColumn("at", F.col("ts").cast("timestamp"))
    counts = events.withWatermark("at", LATE).groupBy(F.window("at", "1 hour"), "event_type").agg(F.count("*").alias("n"))
    return counts_complete(counts.select(F.date_format("window.start", "yyyy-MM-dd HH").alias("hour"), "event_type", "n"), folder(spark))


def counts_complete(stream: DataFrame, at: str) -> DataFrame:
    """The state's whole table after all that is available."""

    def put(df: DataFrame, _: int) -> None:
        df.write.mode("overwrite").parquet(f"{at}/out")

    stream.writeStream.outputMode("complete").option("checkpointLocation", f"{at}/state").foreachBatch(put).trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{at}/out")


PROGRAMS = {"st01_resumable": st01, "st02_idempotent": st02, "st03_micro_batches": st03}
PROGRAM_SQL = {
    "st01_resumable": (["events"], lambda d: f"SELECT event_id, event_type, {d.json('props', 'k')} AS k FROM events"),
    "st02_idempotent": (["events"], lambda d: "SELECT DISTINCT user_id, event_type FROM events"),
    "st03_micro_batches": (["events"], lambda d: "SELECT strftime(ts, '%Y-%m-%d %H') AS hour, event_type, count(*) AS n FROM events GROUP BY ALL"),
}
