"""Complete contexts of sections: the section itself, what it cites, what cites it, its chain, its sources and the words of all that."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citeloom.operators.graph import chains, relation
from citeloom.sources.tables import cut

DEPTH = 5


def complete_context(docs: DataFrame, edges: DataFrame, members: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(section, part, pos, other, title, url, word_count, total_context_words), a row for each item of a section's context.

    docs has section, title, url and text; edges src and dst; members start, pos and section of the chains.
    Parts are primary (pos 0), direct (from 1, by section), reverse (no pos), chain (the first depth sections,
    from 0) and source (the primary and the direct ones). Items that are no section of docs are left out, after
    places and the chain's depth were counted. total_context_words, of the primary row, has the words of the
    primary, of the direct ones and of the chain without the section itself: one in both counts twice. Items
    are rows, not lists, as a section may be cited without a bound; words are summed before they are joined.
    """
    facts = cut(docs.select(F.col("section").alias("other"), F.coalesce("title", F.lit("")).alias("title"), F.coalesce("url", F.lit("")).alias("url"), F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"\S+")).cast("long").alias("word_count")))
    item = lambda part, pos: (F.lit(part).alias("part"), pos.cast("int").alias("pos"))
    order = Window.partitionBy("src").orderBy("dst")
    own = facts.select(F.col("other").alias("section"), *item("primary", F.lit(0)), "other")
    direct = edges.select(F.col("src").alias("section"), *item("direct", F.row_number().over(order)), F.col("dst").alias("other"))
    reverse = edges.select(F.col("dst").alias("section"), *item("reverse", F.lit(None)), F.col("src").alias("other"))
    chain = members.where(F.col("pos") < depth).select(F.col("start").alias("section"), *item("chain", F.col("pos")), F.col("section").alias("other"))
    items = own.unionByName(direct).unionByName(reverse).unionByName(chain).join(facts, "other")
    items = cut(items.join(facts.select(F.col("other").alias("section")), "section", "left_semi"))
    counted = (F.col("part") == "direct") | (F.col("part") == "primary") | ((F.col("part") == "chain") & (F.col("other") != F.col("section")))
    totals = items.where(counted).groupBy("section").agg(F.sum("word_count").alias("total"))
    sources = items.where(F.col("part").isin("primary", "direct")).withColumn("part", F.lit("source"))
    whole = items.unionByName(sources).join(totals, "section")
    return whole.select("section", "part", "pos", "other", "title", "url", "word_count", F.when(F.col("part") == "primary", F.col("total")).alias("total_context_words"))


def q03(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = relation(spark, sf_dir, "edge")
    return complete_context(relation(spark, sf_dir, "doc"), edges, chains(edges, relation(spark, sf_dir, "node")))


def g23(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q03(spark, sf_dir).where("part = 'primary'").select("section", "total_context_words")


PROGRAMS = {"q03_complete_context": q03, "g23_context_words": g23}
