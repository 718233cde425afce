"""Hashes of documents by their canonical JSON: keys sorted at every depth, byte for byte as Python writes it."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def canonical_json(text: Column) -> Column:
    """The JSON text with sorted keys, ASCII escapes and Python's separators and numbers; null for what is null or no JSON.

    Values may nest in any shape, for which SQL has no type: batches of pandas, a document at a time.
    """

    def of(x: str) -> str | None:
        try:
            return json.dumps(json.loads(x), sort_keys=True)
        except (ValueError, RecursionError):
            return None

    return F.pandas_udf(lambda s: s.map(of, na_action="ignore"), "string")(text)


def document_hash(df: DataFrame, *columns: str) -> Column:
    """sha256 of a row's columns as one canonical document; a column without a value is left out, as Spark's JSON has it."""
    return F.sha2(canonical_json(F.to_json(F.struct(*(F.col(f"`{c}`") for c in columns or df.columns)))), 256)


PROPS = "MAP<STRING, BIGINT>"


def o72(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as documents three levels deep, with keys in no order; the ids are hashed as the documents of a crawl are, by their first 16 digits."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    detail = F.struct(F.from_json("props", PROPS).alias("props"), F.struct(F.col("user_id").alias("user"), F.date_format("ts", "yyyy-MM-dd").alias("day")).alias("by"))
    nested = events.select("event_id", F.struct(F.col("event_type").alias("type"), detail.alias("detail"), F.col("event_id").alias("id")).alias("event"))
    return nested.select("event_id", document_hash(nested, "event").alias("sha"), F.substring(F.sha2(F.concat(F.lit("event-"), F.col("event_id").cast("string")), 256), 1, 16).alias("short"))


PROGRAMS = {"o72_canonical_hash": o72}
SQL = {
    "o72_canonical_hash": (
        [],
        lambda: """SELECT event_id, sha256('{"event": {"detail": {"by": {"day": "' || strftime(ts, '%Y-%m-%d') || '", "user": ' || user_id || '}, "props": {"k": ' || json_extract_string(props, '$.k') || '}}, "id": ' || event_id || ', "type": "' || event_type || '"}}') AS sha,
        substring(sha256('event-' || event_id), 1, 16) AS short FROM events""",
    )
}
