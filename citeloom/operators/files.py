"""Sources and sinks as queries: what is written from a relation in some layout is read again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.operators.graph import relation
from citeloom.sources import tables

RECORD = "STRUCT<url STRING, header STRING, paragraphs ARRAY<STRING>>"


def place(spark: SparkSession) -> str:
    return f"{tables.folder(spark)}/files-{uuid.uuid4().hex}"


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(line_no, chapter, json) of each section."""
    doc = relation(spark, sf_dir, "doc")
    return doc.select("line_no", (F.col("line_no") % 20).alias("code"), F.to_json(F.struct("url", "header", F.split("text", "\n").alias("paragraphs"))).alias("json"))


def s01(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = place(spark)
    records(spark, sf_dir).select(F.when(F.col("line_no") % 10 == 0, '{"url": broken').otherwise(F.col("json"))).write.text(path)
    return tables.read_jsonl(spark, path).select("url", "header", F.size("paragraphs").alias("n"))


#: Lines whose records of one code, a twentieth of them, share a file; and cases in a map.
LINES_A_FILE, CASES_A_MAP = 10_000, 1_000


def arrays(spark: SparkSession, sf_dir: str, path: str, broken: int | None = None) -> None:
    """JSON arrays of sections, one in each directory code=.../bucket=..., those of the broken code cut off. A file has LINES_A_FILE / 20 records, however many there are in all."""
    bucket = F.call_function("div", F.col("line_no"), F.lit(LINES_A_FILE)).alias("bucket")
    whole = records(spark, sf_dir).groupBy("code", bucket).agg(F.concat(F.lit("["), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "json"))), lambda x: x["json"]), ",\n"), F.lit("]")).alias("value"))
    if broken is not None:
        whole = whole.withColumn("value", F.when(F.col("code") == broken, F.substring("value", 1, 40)).otherwise(F.col("value")))
    whole.select("code", "bucket", "value").write.partitionBy("code", "bucket").text(path)


def s02(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = place(spark)
    arrays(spark, sf_dir, path)
    return tables.read_json_array(spark, path).select("code", "url", "header", F.size("paragraphs").alias("n"))


def s03(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = place(spark)
    spark.read.parquet(f"{sf_dir}/nation.parquet").select(F.col("n_regionkey").alias("region"), F.col("n_nationkey").alias("nation"), "n_nationkey", "n_name").write.partitionBy("region", "nation").json(path)
    return tables.read_json_tree(spark, path, "n_nationkey LONG, n_name STRING").select("n_nationkey", "n_name", "directory", "parent", F.col("source_file").endswith(".json").alias("is_json"))


def s05(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = place(spark)
    arrays(spark, sf_dir, path, broken=3)
    merged = tables.merge_json_files(spark, f"{path}/code=*/bucket=*", RECORD)
    return merged.select(F.regexp_extract("file", "code=([0-9]+)", 1).cast("long").alias("code"), "pos", "record.url", "record.header")


def s06(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = place(spark)
    spark.range(1).select(F.lit('{"processed_files": 12, "url": "head"}').alias("json")).write.text(path)
    records(spark, sf_dir).select("json").write.mode("append").text(path)
    return tables.read_jsonl_with_header(spark, path, "url STRING, header STRING")


def s07(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc = relation(spark, sf_dir, "doc")
    done = doc.where("title LIKE 'Penalty%'")
    return tables.batches(tables.unprocessed(doc, done, "section").select("section", "line_no"), "line_no", 50)


def s08(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = place(spark)
    spark.read.parquet(f"{sf_dir}/nation.parquet").select(F.col("n_nationkey").alias("key"), F.concat_ws("\n", "n_name", F.lit("second line")).alias("value")).write.partitionBy("key").text(path)
    return tables.read_texts(spark, f"{path}/*").select(F.regexp_extract("path", "key=([0-9]+)", 1).cast("long").alias("nation"), F.trim(F.col("text"), F.lit("\n")).alias("text"))


def s13(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = place(spark)
    tables.write_jsonl(relation(spark, sf_dir, "doc").select("url", "header", F.split("text", "\n").alias("paragraphs")), path)
    return tables.read_jsonl(spark, path).select("url", "header", F.array_join("paragraphs", "\n").alias("text"))


def s14(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the lines of an order put under one key, the last one put stays; a second put of some keys overwrites."""
    path = place(spark)
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(F.col("l_orderkey").alias("key"), F.col("l_linenumber").alias("nth"), F.col("l_returnflag").alias("corpus"), F.col("l_partkey").alias("value"))
    tables.write_store(tables.last_puts(lines, "key", "nth", "value", "corpus"), path)
    return spark.read.parquet(path).select("key", F.col("nth").cast("long").alias("nth"), "corpus", "value")


def s15(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cases by court and year, in two runs: the second moves only what is not there yet."""
    path = place(spark)
    cases = relation(spark, sf_dir, "courtcase").select("case_id", "court", F.substring("decision_date", 1, 4).alias("year"), "name")
    first = tables.organise(cases.where("year < '1996'"), path, "case_id", ["court", "year"])
    second = tables.organise(cases, path, "case_id", ["court", "year"])
    counts = spark.createDataFrame([("first", *first), ("second", *second)], "run string, moved long, skipped long")
    kept = spark.read.parquet(path).groupBy("year").agg(F.count("*").alias("moved")).select(F.concat(F.lit("year "), F.col("year").cast("string")).alias("run"), "moved", F.lit(0).cast("long").alias("skipped"))
    return counts.unionByName(kept)


def s19(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = place(spark)
    counts = relation(spark, sf_dir, "in_degree").agg(F.count("*").alias("cited sections"), F.sum("cited_by_count").alias("citations"), F.max("cited_by_count").alias("most citations"))
    tables.write_report(counts, "Citation report", path)
    return spark.read.text(path).select(F.col("value").alias("line"))


def o08(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event properties nested in objects and arrays, without the key `drop` at any depth."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    nested = F.concat(F.lit('{"a": [{"drop": 1, "b": '), "props", F.lit('}, 5, "drop"], "drop": {"k": 2}, "c": {"d": {"drop": null, "n": "'), F.col("event_id").cast("string"), F.lit('"}}}'))
    return tables.without_keys(events.select("event_id", nested.alias("json")), "json", ["drop"]).select(
        "event_id", F.get_json_object("json", "$.a[0].b.k").alias("k"), F.get_json_object("json", "$.c.d.n").alias("n"), F.get_json_object("json", "$.a[1]").alias("five"), F.get_json_object("json", "$.a[2]").alias("value"),
        F.regexp_count("json", F.lit('"drop" *:')).cast("int").alias("left"),
    )


def o14(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maps of web cites to records as rows; a map has CASES_A_MAP cases at most."""
    path = place(spark)
    batch = F.call_function("div", F.col("case_id"), F.lit(CASES_A_MAP)).alias("batch")
    cases = relation(spark, sf_dir, "courtcase").groupBy("reporter", batch).agg(F.map_from_entries(F.collect_list(F.struct(F.concat(F.lit("cite-"), F.col("case_id").cast("string")), F.struct("name", "word_count")))).alias("cases"))
    cases.select(F.to_json("cases").alias("value")).write.text(path)
    return tables.map_rows(spark, path, "MAP<STRING, STRUCT<name STRING, word_count INT>>").select(F.col("key").alias("webcite"), "value.name", "value.word_count")


def o19(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provenance: the file that a row came from, and when."""
    rows = tables.with_provenance(spark.read.parquet(f"{sf_dir}/nation.parquet"))
    return rows.select("n_nationkey", F.element_at(F.split("_source_file", "/"), -1).alias("source_file"), F.col("_converted_at").isNotNull().alias("has_time"))


PROGRAMS = {
    "s01_jsonl_scan": s01, "s02_json_array": s02, "s03_json_tree": s03, "s05_merged_files": s05, "s06_header_skip": s06, "s07_batches": s07, "s08_whole_texts": s08, "s13_jsonl_sink": s13, "s14_kv_sink": s14, "s15_reorganised": s15, "s19_report": s19,
    "o08_keys_removed": o08, "o14_map_rows": o14, "o19_provenance": o19,
}
LINES = "(len(text) - len(replace(text, chr(10), '')) + 1)::INTEGER"
#: Name: (relations, oracle).
SQL = {
    "s01_jsonl_scan": (["doc"], f"SELECT url, header, {LINES} AS n FROM doc WHERE line_no % 10 <> 0"),
    "s02_json_array": (["doc"], f"SELECT (line_no % 20)::INTEGER AS code, url, header, {LINES} AS n FROM doc"),
    "s03_json_tree": ([], "SELECT n_nationkey::BIGINT AS n_nationkey, n_name, 'nation=' || n_nationkey AS directory, 'region=' || n_regionkey AS parent, true AS is_json FROM nation"),
    "s05_merged_files": (["doc"], "SELECT line_no % 20 AS code, (row_number() OVER (PARTITION BY line_no % 20, line_no // 10000 ORDER BY line_no) - 1)::INTEGER AS pos, url, header FROM doc WHERE line_no % 20 <> 3"),
    "s06_header_skip": (["doc"], "SELECT url, header FROM doc"),
    "s07_batches": (["doc"], "SELECT section, line_no, (row_number() OVER (ORDER BY line_no) - 1) // 50 AS batch FROM doc WHERE NOT starts_with(title, 'Penalty')"),
    "s08_whole_texts": ([], "SELECT n_nationkey::BIGINT AS nation, n_name || chr(10) || 'second line' AS text FROM nation"),
    "s13_jsonl_sink": (["doc"], "SELECT url, header, text FROM doc"),
    "s14_kv_sink": ([], "SELECT l_orderkey AS key, max(l_linenumber)::BIGINT AS nth, arg_max(l_returnflag, (l_linenumber, l_partkey, l_returnflag)) AS corpus, arg_max(l_partkey, (l_linenumber, l_partkey, l_returnflag)) AS value FROM lineitem GROUP BY l_orderkey"),
    "s15_reorganised": (["courtcase"], "SELECT 'first' AS run, count(*) FILTER (decision_date < '1996') AS moved, 0::BIGINT AS skipped FROM courtcase UNION ALL SELECT 'second', count(*) FILTER (decision_date >= '1996'), count(*) FILTER (decision_date < '1996') FROM courtcase UNION ALL SELECT 'year ' || left(decision_date, 4), count(*), 0 FROM courtcase GROUP BY left(decision_date, 4)"),
    "s19_report": (["in_degree"], "SELECT unnest(['Citation report', '===============', 'cited sections: ' || count(*), 'citations: ' || sum(cited_by_count)::BIGINT, 'most citations: ' || max(cited_by_count)]) AS line FROM in_degree"),
    "o08_keys_removed": ([], "SELECT event_id, json_extract_string(props, '$.k') AS k, event_id::VARCHAR AS n, '5' AS five, 'drop' AS value, 0::INTEGER AS left FROM events"),
    "o14_map_rows": (["courtcase"], "SELECT 'cite-' || case_id AS webcite, name, word_count FROM courtcase"),
    "o19_provenance": ([], "SELECT n_nationkey, 'nation.parquet' AS source_file, true AS has_time FROM nation"),
}
