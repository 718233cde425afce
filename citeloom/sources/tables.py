"""Readers and writers: JSON lines, JSON arrays, directories, texts, and tables partitioned by corpus."""

from __future__ import annotations

import json
import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Spark's setting that deletes the shuffle files of an execution at its end.
CLEANED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
DOCUMENT = "url STRING, url_hash STRING, header STRING, paragraphs ARRAY<STRING>"


def folder(spark: SparkSession) -> str:
    """The session's checkpoint folder, which executors and driver share. Without spark.checkpoint.dir, a local session takes a temporary one; on a cluster that is an error."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        known = spark.conf.get("spark.checkpoint.dir", None)
        if known is None and not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir(known or tempfile.mkdtemp(prefix="checkpoints"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """df as a table written in the session's checkpoint folder: without lineage, and safe when executors are lost.

    (A table, as a plan over checkpoint() inherits its constraints, which grow exponentially in loops.) What the
    write shuffled is deleted as soon as the table is there, as nothing reads it again.
    """
    conf, path = df.sparkSession.conf, f"{folder(df.sparkSession)}/cut-{uuid.uuid4().hex}"
    before = conf.get(CLEANED)
    conf.set(CLEANED, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        conf.set(CLEANED, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_jsonl(spark: SparkSession, path: str, schema: str = DOCUMENT, skip_bad: bool = True) -> DataFrame:
    """One document a line; a bad line is skipped, or else kept with nulls."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED" if skip_bad else "PERMISSIVE").json(path)


def read_json_array(spark: SparkSession, path: str, schema: str = DOCUMENT) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_json_tree(spark: SparkSession, path: str, schema: str = DOCUMENT) -> DataFrame:
    """Every *.json below path, with the file and its two directory levels as columns."""
    df = spark.read.schema(schema).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").json(path).withColumn("source_file", F.col("_metadata.file_path"))
    levels = F.split("source_file", "/")
    return df.withColumn("directory", F.try_element_at(levels, F.lit(-2))).withColumn("parent", F.try_element_at(levels, F.lit(-3)))


def read_jsonl_with_header(spark: SparkSession, path: str, schema: str, mark: str = "processed_files") -> DataFrame:
    """JSON lines without the header line, the object that has mark as a key of its own: files are split, so that it is known by its key and not by its place."""
    return spark.read.text(path).where(F.get_json_object("value", f"$.{mark}").isNull()).select(F.from_json("value", schema).alias("d")).select("d.*")


def merge_json_files(spark: SparkSession, path: str, record: str) -> DataFrame:
    """(file, pos, record) of the JSON arrays in the files at path; a file that is no such array is left out. The order of the merge is that of file and pos."""
    whole = read_texts(spark, path).select(F.col("path").alias("file"), F.from_json("text", f"ARRAY<{record}>").alias("records"))
    return whole.where("records IS NOT NULL AND NOT exists(records, r -> r IS NULL)").select("file", F.posexplode("records").alias("pos", "record"))


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_store(df: DataFrame, path: str) -> None:
    """A table by corpus; its keys are made unique before (last_puts)."""
    df.write.mode("overwrite").partitionBy("corpus").parquet(path)


def last_puts(df: DataFrame, key: str, *order: str) -> DataFrame:
    """One row for each key, the last in order: a put overwrites. By aggregation, so a hot key is a row for each task."""
    whole = F.struct(*(F.col(f"`{c}`") for c in df.columns))
    return df.groupBy(key).agg(F.max_by(whole, F.struct(*order)).alias("last")).select("last.*")


def organise(df: DataFrame, path: str, key: str, by: list[str]) -> tuple[int, int]:
    """Adds the rows whose key is not at path yet to its directories by the columns `by`; (moved, skipped)."""
    try:
        there = df.sparkSession.read.parquet(path).select(key)
    except AnalysisException:
        there = df.select(key).limit(0)
    new = cut(unprocessed(df, there, key))
    new.repartition(*by).write.mode("append").partitionBy(*by).parquet(path)
    moved = new.count()
    return moved, df.count() - moved


def write_report(row: DataFrame, title: str, path: str) -> None:
    """A row of figures as a text of one line for each, under a title."""
    lines = F.array(F.lit(title), F.lit("=" * len(title)), *(F.concat(F.lit(f"{c}: "), F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("none"))) for c in row.columns))
    row.select(F.array_join(lines, "\n")).coalesce(1).write.mode("overwrite").text(path)


def without_keys(df: DataFrame, column: str, keys: list[str]) -> DataFrame:
    """df with some keys taken out of the JSON in column, at any depth; what is no JSON becomes null. A nested value of any shape has no type for SQL, hence batches of pandas."""
    gone = set(keys)

    def pruned(x: object) -> object:
        if isinstance(x, dict):
            return {k: pruned(v) for k, v in x.items() if k not in gone}
        return [pruned(v) for v in x] if isinstance(x, list) else x

    def of(text: str | None) -> str | None:
        try:
            return None if text is None else json.dumps(pruned(json.loads(text)), ensure_ascii=False)
        except ValueError:
            return None

    return df.withColumn(column, F.pandas_udf(lambda s: s.map(of, na_action="ignore"), "string")(F.col(f"`{column}`")))


def map_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """(key, value) of files whose lines are JSON maps."""
    return spark.read.text(path).select(F.explode(F.from_json("value", schema)))


def with_provenance(df: DataFrame) -> DataFrame:
    """df, the rows of files, with the file that each came from and the time of the conversion."""
    return df.select("*", F.col("_metadata.file_path").alias("_source_file"), F.current_timestamp().alias("_converted_at"))


def unprocessed(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not done."""
    return df.join(done.select(key).distinct(), key, "left_anti")


def batches(df: DataFrame, key: str, size: int = 5_000, ranges: int = 64) -> DataFrame:
    """df with batch: rows in order of a unique key, size of them in each, from 0.

    Rows are ranked within ranges of the key, and each range starts where those before it end, so that no task
    has all rows; the ranges' counts are `ranges` rows.
    """
    dealt = cut(df.repartitionByRange(ranges, key).withColumn("batch_range", F.spark_partition_id()))
    starts = dealt.groupBy("batch_range").agg(F.count("*").alias("n")).select("batch_range", F.coalesce(F.sum("n").over(Window.orderBy("batch_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("batch_start"))
    rank = F.row_number().over(Window.partitionBy("batch_range").orderBy(key)) - 1 + F.col("batch_start")
    return dealt.join(F.broadcast(starts), "batch_range").withColumn("batch", F.floor(rank / size)).drop("batch_range", "batch_start")
