"""A cut leaves no shuffle files behind, keeps its rows and the session's setting."""

from pathlib import Path

from pyspark.sql import functions as F

from citeloom.sources.tables import CLEANED, cut


def test_cut(spark):
    roots = list(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())
    files = lambda: {str(p) for root in roots for p in Path(root).glob("*/shuffle*.data")}
    df = spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).count()
    before, there = spark.conf.get(CLEANED), files()
    rows = cut(df)
    assert files() <= there and spark.conf.get(CLEANED) == before
    assert rows.count() == 100 and {r["count"] for r in rows.collect()} == {100} and df.count() == 100
    df.write.format("noop").mode("overwrite").save()
    assert files() > there
