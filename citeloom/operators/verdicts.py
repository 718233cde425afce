"""Comparable verdicts: a band join whose work stays linear in the verdicts of a county.

What decides which verdicts come first (their liability and year) is the verdict's own, so of each bucket, which is a kind, a
county and a severity, only the first LIMIT can be among the first of any claim. A bucket is cut to these before it
is shuffled, by every task for what it has read; a claim then meets the buckets of its own severity and the
next ones, at most three times LIMIT rows, however many verdicts its county has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Severities in order, liabilities that count as strong, the first year, the year that ages are counted from, and the most verdicts of a claim.
SEVERITIES = ["minor", "moderate", "severe", "catastrophic"]
STRONG = ["clear", "strong"]
FIRST_YEAR, THIS_YEAR, LIMIT = 2019, 2025, 50
KIND = "personal_injury"


def level(severity: Column) -> Column:
    """The place of a severity from 1; null for what is none."""
    return F.nullif(F.array_position(F.array(*map(F.lit, SEVERITIES)), severity), F.lit(0))


def first_of(df: DataFrame, part: list[str], order: list[Column], n: int, name: str) -> DataFrame:
    """df with the rank in its part, of which the first n rows stay; Spark cuts each task's rows before the shuffle."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*part).orderBy(*order))).where(F.col(name) <= n)


def comparables(claims: DataFrame, verdicts: DataFrame, limit: int = LIMIT) -> DataFrame:
    """The columns of claims, prefixed claim_, beside those of their verdicts, and place: from 1 to limit for each claim.

    claims: claim_id, county, severity, liability, injuries, impairment; verdicts: verdict_id, kind, county, severity, liability,
    injuries, impairment, year. A verdict fits if it is of KIND, of the claim's county, from FIRST_YEAR on and at most one
    severity away. For claims of clear or strong liability, verdicts of other than clear liability come first, and the
    latest of each; ties, and other claims, go by verdict_id. Nulls in a county or a severity fit nothing; a
    claim_id that is there twice is two claims only if its columns differ.
    """
    fit = verdicts.where((F.col("kind") == KIND) & (F.col("year") >= FIRST_YEAR)).withColumn("level", level(F.col("severity"))).where("level IS NOT NULL AND county IS NOT NULL")
    clear = F.coalesce((F.col("liability") == "clear").cast("int"), F.lit(0))
    orders = {True: [clear, F.col("year").desc(), F.col("verdict_id")], False: [F.col("verdict_id")]}
    asked = claims.select(*(F.col(f"`{c}`").alias(f"claim_{c}" if c != "claim_id" else c) for c in claims.columns)).distinct()
    asked = asked.withColumn("claim_strong", F.coalesce(F.col("claim_liability").isin(STRONG), F.lit(False))).withColumn("claim_level", level(F.col("claim_severity")))
    near = asked.withColumn("level", F.explode(F.filter(F.array(F.col("claim_level") - 1, F.col("claim_level"), F.col("claim_level") + 1), lambda x: x.between(1, len(SEVERITIES)))))
    out = []
    for strong, order in orders.items():
        heads = first_of(fit, ["county", "level"], order, limit, "head").drop("head")
        side = near.where(F.col("claim_strong") == strong).withColumnRenamed("claim_county", "county")
        met = side.join(heads, ["county", "level"]).withColumn("claim_county", F.col("county"))
        out.append(first_of(met, ["claim_id", "claim_county", "claim_severity", "claim_liability", "claim_injuries", "claim_impairment"], order, limit, "place"))
    return out[0].unionByName(out[1])


def similarity(df: DataFrame) -> Column:
    """From 0 to 100: shared injuries 40, severity 20 or 10, liability 15 or 10, county 10, age 10 or 5, impairment 5. An impairment that is null is none."""
    shared = F.size(F.array_intersect("claim_injuries", "injuries")) / F.greatest(F.size(F.array_distinct("claim_injuries")), F.lit(1))
    away, age = F.abs(level(F.col("claim_severity")) - level(F.col("severity"))), THIS_YEAR - F.col("year")
    both = F.col("claim_liability").isin(STRONG) & F.col("liability").isin(STRONG)
    impaired = lambda c: F.coalesce(F.col(c), F.lit(False))
    return (
        40 * F.coalesce(shared, F.lit(0.0)) + F.when(away == 0, 20).when(away == 1, 10).otherwise(0) + F.when(F.col("claim_liability") == F.col("liability"), 15).when(both, 10).otherwise(0)
        + F.when(F.col("claim_county") == F.col("county"), 10).otherwise(0) + F.when(age <= 2, 10).when(age <= 5, 5).otherwise(0) + F.when(impaired("claim_impairment") == impaired("impairment"), 5).otherwise(0)
    )


def ranked(found: DataFrame) -> DataFrame:
    """(claim_id, rank, verdict_id, score, percentage): a claim's comparables by similarity; of equal ones, the earlier found comes first."""
    scored = found.withColumn("score", similarity(found))
    rank = F.row_number().over(Window.partitionBy("claim_id").orderBy(F.col("score").desc(), "place", "verdict_id"))
    return scored.select("claim_id", rank.alias("rank"), "verdict_id", F.round("score", 6).alias("score"), F.floor("score").cast("int").alias("percentage"))


# Claims and verdicts of the given tables: a claim for each customer, a verdict for each order, in the nation of its customer.
INJURIES = ["fracture", "burn", "concussion", "whiplash", "laceration"]


def traits(key: str, year: str) -> str:
    """Columns of a case by its key, in SQL that both engines read; the arrays of injuries are made apart."""
    words = lambda x, names: f"CASE {x} " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(names)) + " END"
    return f"{words(f'{key} * 7 % 9 % 5', SEVERITIES)} AS severity, {words(f'{key} * 5 % 7 % 4', ['clear', 'strong', 'disputed'])} AS liability, {key} % 3 = 0 AS impairment, {key} % 31 AS bits, {year} AS year"


CLAIMS = f"SELECT c_custkey AS claim_id, n_name AS county, {traits('c_custkey', '0')} FROM customer JOIN nation ON n_nationkey = c_nationkey"
VERDICTS = f"SELECT o_orderkey AS verdict_id, CASE WHEN o_orderkey % 4 = 3 THEN 'contract' ELSE '{KIND}' END AS kind, n_name AS county, {traits('o_orderkey', 'year(o_orderdate) + 25')} FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey"


def given(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    tables = {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("nation", "customer", "orders")}
    injured = F.filter(F.array(*map(F.lit, INJURIES)), lambda x, i: F.call_function("shiftright", F.col("bits").cast("int"), i) % 2 == 1)
    made = [spark.sql(text.replace("nation ", "{nation} ", 1).replace("FROM customer", "FROM {customer}").replace("JOIN customer", "JOIN {customer}").replace("FROM orders", "FROM {orders}"), **tables) for text in (CLAIMS, VERDICTS)]
    return tuple(df.withColumn("injuries", injured).drop("bits") for df in made)


def q17(spark: SparkSession, sf_dir: str) -> DataFrame:
    claims, verdicts = given(spark, sf_dir)
    return comparables(claims.drop("year"), verdicts).select("claim_id", "place", "verdict_id")


def q18(spark: SparkSession, sf_dir: str) -> DataFrame:
    claims, verdicts = given(spark, sf_dir)
    return ranked(comparables(claims.drop("year"), verdicts))


PROGRAMS = {"q17_verdict_band": q17, "q18_verdict_similarity": q18}

# The oracle meets every pair of a county.
BAND = f""", lv AS (SELECT * FROM (VALUES {', '.join(f"('{s}', {i})" for i, s in enumerate(SEVERITIES, 1))}) AS s(severity, level)),
c AS (SELECT x.*, level FROM ({CLAIMS}) x JOIN lv USING (severity)), v AS (SELECT x.*, level FROM ({VERDICTS}) x JOIN lv USING (severity)),
met AS (SELECT claim_id, verdict_id, c.bits AS cb, v.bits AS vb, abs(c.level - v.level) AS away, c.liability AS cl, v.liability AS vl, c.impairment AS ci, v.impairment AS vi, v.year,
    CASE WHEN c.liability IN ('clear', 'strong') THEN coalesce(v.liability = 'clear', false)::INTEGER ELSE 0 END AS k1, CASE WHEN c.liability IN ('clear', 'strong') THEN -v.year ELSE 0 END AS k2
    FROM c JOIN v ON c.county = v.county AND abs(c.level - v.level) <= 1 WHERE v.kind = '{KIND}' AND v.year >= {FIRST_YEAR}),
best AS (SELECT *, row_number() OVER (PARTITION BY claim_id ORDER BY k1, k2, verdict_id)::INTEGER AS place FROM met QUALIFY place <= {LIMIT})"""
SCORES = f"""{BAND}, scored AS (SELECT *, 40e0 * bit_count(cb & vb) / greatest(bit_count(cb), 1) + CASE away WHEN 0 THEN 20 ELSE 10 END + CASE WHEN cl = vl THEN 15 WHEN cl IN ('clear', 'strong') AND vl IN ('clear', 'strong') THEN 10 ELSE 0 END + 10
+ CASE WHEN {THIS_YEAR} - year <= 2 THEN 10 WHEN {THIS_YEAR} - year <= 5 THEN 5 ELSE 0 END + CASE WHEN ci = vi THEN 5 ELSE 0 END AS score FROM best)
SELECT claim_id, row_number() OVER (PARTITION BY claim_id ORDER BY round(score, 9) DESC, place)::INTEGER AS rank, verdict_id, round(score, 6) AS score, floor(score)::INTEGER AS percentage FROM scored"""
SQL = {"q17_verdict_band": (["customer"], lambda: BAND.lstrip(", ").join(["WITH ", " SELECT claim_id, place, verdict_id FROM best"])), "q18_verdict_similarity": (["customer"], lambda: "WITH " + SCORES.lstrip(", "))}
