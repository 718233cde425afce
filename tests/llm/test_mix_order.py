"""The order of the mix reaches the pipeline's result, whatever the sizes of the files between."""

from pyspark.sql import functions as F

import corpus_pipeline
from citeloom.llm import mixing
from citeloom.llm.queries import WEIGHTS

SF = "/root/testdata/sf0.001"


def test_order_of_files(spark, tmp_path):
    rows = spark.range(4000).repartitionByRange(8, "id").sortWithinPartitions("id").select(F.col("id").alias("doc_id"), F.expr("repeat(sha2(CAST(id AS STRING), 256), CAST(id div 200 AS INT))").alias("text"))
    rows.write.parquet(str(tmp_path / "rows"))
    for df in (spark.read.parquet(str(tmp_path / "rows")), rows):
        out = mixing.in_order(df)
        assert out.columns == ["doc_id", "text", "position"]
        got = out.select("doc_id", "position").collect()
        assert len(got) == 4000 and all(r.doc_id == r.position for r in got)
    assert mixing.in_order(rows.where("doc_id < 0")).count() == 0


def test_pipeline_keeps_the_mix(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, SF)
    want = [r.doc_id for r in sorted(mixing.placed(docs, WEIGHTS).collect(), key=lambda r: r.position)]
    got = sorted(corpus_pipeline.run(spark, SF).select("doc_id", "position").collect(), key=lambda r: r.position)
    assert [r.position for r in got] == list(range(len(want))) and [r.doc_id for r in got] == want


def test_ranked_rows_are_written_between_the_shuffles(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plan = mixing.mixed(docs, WEIGHTS)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and plan.count("RepartitionByExpression") == 1
    assert mixing.mixed(docs, WEIGHTS).count() == docs.count()
