"""Traversals of the citation graph: bounded chains, their greedy cover, paths, neighbourhoods and ranks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citeloom.plans.corpora import prelude
from citeloom.plans.dialects import Spark
from citeloom.sources.tables import batches, cut

LONGEST, FAN_OUT = 8, 3
#: Steps that searches from a slice of the sections take in all, at most: so much is shuffled before it is gone.
STEPS_AT_ONCE = 100_000_000


def relation(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.sql(prelude(Spark(), [name], sf_dir) + f"SELECT * FROM {name}")


def chains(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(start, pos, section): breadth-first chains from every node with references, of LONGEST sections at most.

    Of a section's references, in order, the first FAN_OUT are followed, and of these the known ones. All
    starts go a level at a time: at most LONGEST - 1 joins with the thinned edges, and never more than
    LONGEST rows for a start.
    """
    order = Window.partitionBy("src").orderBy("dst")
    thin = edges.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= FAN_OUT).join(nodes.select(F.col("section").alias("dst")).distinct(), "dst", "left_semi")
    thin = cut(thin.select("src", "dst", "nth"))
    found = edges.select(F.col("src").alias("start")).distinct().select("start", F.lit(0).alias("pos"), F.col("start").alias("section"))
    front = found
    while True:
        seen = found.groupBy("start").agg(F.count("*").alias("n"), F.collect_set("section").alias("seen"))
        step = front.join(thin, front["section"] == thin["src"]).select("start", F.struct("pos", "nth").alias("at"), F.col("dst").alias("section"))
        step = step.groupBy("start", "section").agg(F.min("at").alias("at")).join(seen, "start").where(~F.array_contains("seen", F.col("section")))
        rank = F.row_number().over(Window.partitionBy("start").orderBy("at"))
        front = cut(step.withColumn("pos", F.col("n").cast("int") + rank - 1).where(F.col("pos") < LONGEST).select("start", "pos", "section"))
        if front.isEmpty():
            return found
        found = cut(found.unionByName(front))


def cover(members: DataFrame) -> DataFrame:
    """The starts whose chains are emitted when, in the order of starts, one already in an emitted chain is skipped.

    A start is blocked by a smaller emitted start whose chain has it. Each round rejects those with an
    emitted blocker and emits those whose blockers are all rejected: the smallest open one is decided in
    every round.
    """
    long_enough = members.groupBy("start").agg(F.count("*").alias("n")).where("n > 1").select("start")
    blocks = cut(members.join(long_enough, "start", "left_semi").where("section > start").select(F.col("start").alias("by"), F.col("section").alias("start")).join(long_enough, "start", "left_semi"))
    open_, emitted = cut(long_enough), None
    while not open_.isEmpty():
        still = blocks.join(open_.withColumnRenamed("start", "by"), "by", "left_semi")
        free = cut(open_.join(still, "start", "left_anti"))
        emitted = free if emitted is None else emitted.unionByName(free)
        hit = blocks.join(free.withColumnRenamed("start", "by"), "by", "left_semi").select("start").distinct()
        open_ = cut(open_.join(free, "start", "left_anti").join(hit, "start", "left_anti"))
        blocks = cut(blocks.join(hit.withColumnRenamed("start", "by"), "by", "left_anti"))
    return long_enough if emitted is None else emitted


def pagerank(edges: DataFrame, nodes: DataFrame, rounds: int = 10, damping: float = 0.85) -> DataFrame:
    """(section, rank) after a fixed number of rounds; what sections without references hold is shared by all."""
    n = nodes.count()
    out = edges.groupBy("src").agg(F.count("*").alias("n_out"))
    links = cut(edges.join(out, "src").select("src", "dst", "n_out"))
    ends = nodes.select("section").join(out, nodes["section"] == out["src"], "left_anti").withColumn("end", F.lit(True))
    ranks = cut(nodes.select("section").join(ends, "section", "left").select("section", "end", F.lit(1.0 / max(n, 1)).alias("rank")))
    for _ in range(rounds):
        given = links.join(ranks, links["src"] == ranks["section"]).groupBy("dst").agg(F.sum(F.col("rank") / F.col("n_out")).alias("got"))
        lost = ranks.where("end").agg(F.sum("rank")).first()[0] or 0.0
        ranks = cut(ranks.join(given, ranks["section"] == given["dst"], "left").select("section", "end", ((1 - damping) / n + damping * (F.coalesce("got", F.lit(0.0)) + lost / n)).alias("rank")))
    return ranks.select("section", F.round("rank", 9).alias("rank"))


def shortest(edges: DataFrame) -> DataFrame:
    """(src, dst, hops, path) for each two different sections of which src leads to dst; path is joined by '>'.

    All starts go a level at a time, until no new pair is found. Of the shortest paths, the one is taken whose
    last step is from the smallest section, and so on backwards. Sections are numbered in their order, so that
    what a level finds is aggregated as numbers; paths are made only for its new pairs. A level lies by its starts, so that
    the steps to one section are reduced before they are shuffled. Starts go in slices, so that what is shuffled at once
    does not grow with the pairs; the pairs themselves are written.
    """
    names = edges.select(F.col("src").alias("section")).union(edges.select("dst")).distinct()
    names = cut(batches(names.where("section IS NOT NULL"), "section", 1).select("section", F.col("batch").cast("int").alias("id")))
    of = lambda c: names.select(F.col("section").alias(c), F.col("id").alias(c[0]))
    steps = cut(edges.where("src <> dst").select("src", "dst").distinct().join(of("src"), "src").join(of("dst"), "dst").select(F.col("s").alias("via"), F.col("d").alias("to"), "src", "dst"))
    slices = max(1, -(-names.count() * steps.count() // STEPS_AT_ONCE))
    found = None
    for s in range(slices):
        front = cut(steps.where(F.pmod(F.xxhash64("via"), F.lit(slices)) == s).select(F.col("via").alias("from"), "to", F.lit(1).alias("hops"), F.concat_ws(">", "src", "dst").alias("path")).repartition("from"))
        found, seen = front if found is None else found.unionByName(front), front.select("from", "to")
        while not front.isEmpty():
            ahead = front.select("from", F.col("to").alias("via")).join(steps.select("via", "to"), "via").where(F.col("from") != F.col("to"))
            new = ahead.groupBy("from", "to").agg(F.min("via").alias("via")).join(seen, ["from", "to"], "left_anti")
            before = front.select("from", F.col("to").alias("via"), "hops", "path")
            front = cut(new.join(before, ["from", "via"]).join(names, F.col("to") == F.col("id")).select("from", "to", (F.col("hops") + 1).alias("hops"), F.concat_ws(">", "path", "section").alias("path")).repartition("from"))
            found, seen = found.unionByName(front), seen.unionByName(front.select("from", "to"))
    return found.select(F.substring_index("path", ">", 1).alias("src"), F.substring_index("path", ">", -1).alias("dst"), "hops", "path")


def n01(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chains(relation(spark, sf_dir, "edge"), relation(spark, sf_dir, "node"))


def n02(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = n01(spark, sf_dir)
    return members.join(cover(members), "start", "left_semi").groupBy("start").agg(F.count("*").alias("length"))


def g06(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = n01(spark, sf_dir)
    sizes = n02(spark, sf_dir).select(F.when(F.col("length") >= 4, "complex").otherwise("simple").alias("category"), F.col("start").alias("section"))
    return relation(spark, sf_dir, "node").select("section").join(members.select(F.col("start").alias("section")).distinct(), "section", "left_anti").select(F.lit("isolated").alias("category"), "section").unionByName(sizes)


def n04(spark: SparkSession, sf_dir: str) -> DataFrame:
    members, docs = n01(spark, sf_dir), relation(spark, sf_dir, "doc").select("section", "title", F.length("text").alias("n_chars"))
    return members.join(docs, "section").groupBy("start").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "title"))), lambda x: x["title"]), "; ").alias("titles"), F.sum("n_chars").alias("n_chars"))


def n05(spark: SparkSession, sf_dir: str) -> DataFrame:
    return n01(spark, sf_dir).where("pos < 4")


def n08(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pagerank(relation(spark, sf_dir, "edge"), relation(spark, sf_dir, "node"))


def n13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shortest(relation(spark, sf_dir, "edge"))


def g17(spark: SparkSession, sf_dir: str) -> DataFrame:
    return n01(spark, sf_dir).groupBy("start").agg(F.count("*").alias("depth")).groupBy("depth").agg(F.count("*").alias("n_chains"))


PROGRAMS = {"n01_chains": n01, "n02_chain_cover": n02, "n04_chain_texts": n04, "n05_truncated_chains": n05, "n08_pagerank": n08, "n13_shortest_path": n13, "g06_categories": g06, "g17_chain_depths": g17}


def related(most: int) -> str:
    """Up to most sections that belong to each: of the first it cites, those that exist; then, as far as there is room, of the first that cite it.

    Places are counted before it is asked whether a section exists. Both windows have a constant limit, so that Spark cuts a hot section before it shuffles.
    """
    return f"""
, forward AS (SELECT r.src AS section, r.dst AS related FROM ranked_edge r WHERE EXISTS (SELECT 1 FROM node n WHERE n.section = r.dst) AND r.nth <= {most} AND r.src <> r.dst),
room AS (SELECT section, {most} - count(*) AS room FROM forward GROUP BY section),
reverse AS (SELECT section, related, nth FROM (SELECT dst AS section, src AS related, row_number() OVER (PARTITION BY dst ORDER BY src) AS nth FROM edge) x WHERE nth <= {most})
SELECT section, related, 'cited_by_primary' AS relation FROM forward
UNION ALL SELECT v.section, v.related, 'cites_primary' FROM reverse v LEFT JOIN room m ON m.section = v.section LEFT JOIN forward f ON f.section = v.section AND f.related = v.related
WHERE v.nth <= coalesce(m.room, {most}) AND v.related <> v.section AND f.related IS NULL AND EXISTS (SELECT 1 FROM node n WHERE n.section = v.related)"""


AROUND = "SELECT src AS a, dst AS b FROM edge UNION SELECT dst, src FROM edge"

#: The oracles of networks.two_steps and networks.citing_items.
PROGRAM_SQL = {
    "n07_neighbourhood": (["edge"], lambda d: f", around AS ({AROUND}), two AS (SELECT a, b, 1 AS dist FROM around UNION ALL SELECT x.a, y.b, 2 FROM around x JOIN around y ON y.a = x.b AND y.b <> x.a) SELECT a, b, min(dist) AS dist, round(greatest(0.2, 1 - 0.2 * min(dist)), 6) * 1e0 AS opacity FROM two GROUP BY a, b"),
    "n12_citing_items": (["edge"], lambda d: "SELECT DISTINCT e.dst, f.src AS citing_at_two FROM edge e JOIN edge f ON f.dst = e.src"),
}
PLANS = {
    "n06_related": (["ranked_edge", "edge", "node"], lambda d: related(5)),
    "n09_ui_graph": (["edge"], lambda d: "SELECT src AS section, 'out' AS side, dst AS other FROM edge UNION ALL SELECT dst, 'in', src FROM edge"),
    "n10_authority_level": (["in_degree"], lambda d: "SELECT section, CASE WHEN cited_by_count > 50 THEN 'very-high' WHEN cited_by_count > 20 THEN 'high' WHEN cited_by_count > 5 THEN 'medium' ELSE 'low' END AS level FROM in_degree"),
    "n11_common_authorities": (["edge"], lambda d: "SELECT a.src AS a, b.src AS b, count(*) AS shared FROM edge a JOIN edge b ON a.dst = b.dst AND a.src < b.src GROUP BY a.src, b.src"),
    "n14_edge_strength": (["lineitem", "node"], lambda d: "SELECT a.l_partkey AS a, b.l_partkey AS b, sum(CASE WHEN a.l_linenumber % 5 = 0 THEN 2 ELSE 1 END) * 1.0 AS strength FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND b.l_linenumber = a.l_linenumber + 1 GROUP BY a.l_partkey, b.l_partkey"),
}
