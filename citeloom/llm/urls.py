"""URL filters: logistic regression on hashed character n-grams of host and path, beside rules for hosts and paths."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed training hosts, by verdict. The filter is to find new hosts that resemble them.
BLOCKED = "ad-server adult adult-chat adult-clips adult-video adult-zone ads-track banner-ads bet-now best-casino bonus-casino buy-pills casino-bonus casino-win cheap-meds cheap-pills click-farm click-track diet-pills easy-bets fast-loans free-bets free-casino free-porn hot-adult link-farm lucky-slots mega-jackpot online-bets online-casino pay-day-loans pharma-cheap pill-shop poker-bonus porn-tube pop-ads seo-farm sex-chat slots-win spam-farm spam-links track-click win-bets win-money xxx-adult".split()
ALLOWED = "archive arts astro bakery bike biology books bridge campus city clinic cloud college council daily data docs earth energy forum garden gallery geo green health herald history home journal kitchen lab learn library maps market math media music nature news notes ocean paper park photo physics planet poems press radio recipes river school science shop sport story studio surf tech times tour travel trail union valley video voice water weather wiki wood world write".split()
ENDINGS = ("com", "org", "net")
PATHS = ("/en/12", "/fr/345.html", "/de/78", "/es/9/", "/", "/index.html", "/blog/2021/05", "/a/b")
#: The most labelled rows that a filter is fitted on.
MOST_LABELLED = 10_000
GRAMS, BUCKETS = (3, 4, 5), 1 << 14
#: (host, path, verdict)
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"))


def labelled_urls(spark: SparkSession) -> DataFrame:
    """(url, label): a small table of hosts under each of three endings, label 1 for those to block; generated, under 400 rows."""
    rows = []
    for label, hosts in ((1, BLOCKED), (0, ALLOWED)):
        for i, host in enumerate(hosts):
            for j, end in enumerate(ENDINGS):
                prefix = ("", "www.", "m.", "blog.")[(i + j) % 4]
                rows.append(f"('https://{prefix}{host}.{end}{PATHS[(i * 3 + j) % len(PATHS)]}', {label}.0D)")
    return spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS t(url, label)")


def host_and_path(url: Column) -> Column:
    """struct(host, path), both empty without "://"."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    host, path = (F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", n) for n in (1, 2))
    some = lambda c: F.coalesce(c, F.lit(""))
    return F.struct(F.translate(some(host), upper, upper.lower()).alias("host"), some(path).alias("path"))


def grams(text: Column) -> Column:
    """The character n-grams of a text, and one token for every text."""
    of = lambda n: F.when(F.length(text) >= n, F.transform(F.sequence(F.lit(1), F.length(text) - (n - 1)), lambda i: text.substr(i, F.lit(n)))).otherwise(F.array().cast("array<string>"))
    return F.concat(F.array(F.lit("")), *(of(n) for n in GRAMS))


def featured(urls: DataFrame) -> DataFrame:
    """urls with u_parts (host, path) and u_features: hashed n-grams of the host between dots, and of the path."""
    parts = urls.withColumn("u_parts", host_and_path(F.col("url")))
    counted = parts.withColumn("u_grams", grams(F.concat(F.lit("."), F.col("u_parts.host"), F.col("u_parts.path"))))
    return HashingTF(numFeatures=BUCKETS, binary=True, inputCol="u_grams", outputCol="u_features").transform(counted).drop("u_grams")


def fit(labelled: DataFrame) -> LogisticRegressionModel:
    """The filter for a labelled table of (url, label 0 or 1), fitted on MOST_LABELLED rows at most, in one task so that it is repeatable."""
    rows = labelled.where("url IS NOT NULL AND label IS NOT NULL").orderBy("url", "label").limit(MOST_LABELLED).coalesce(1)
    return LogisticRegression(featuresCol="u_features", labelCol="label", predictionCol="u_block", probabilityCol="u_p", rawPredictionCol="u_raw", maxIter=60, regParam=0.002).fit(featured(rows).select("u_features", F.col("label").cast("double")))


def rule_of(host: Column, path: Column, rules: tuple[tuple[str, str, str], ...] = RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, or null.

    A rule fits its host and the hosts below it if the path starts with the rule's. rules are part of the
    plan: keep them to some thousands.
    """
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for h, p, verdict in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def filter_urls(pages: DataFrame, model: LogisticRegressionModel, rules: tuple[tuple[str, str, str], ...] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict and own_verdict (the filter's) of each row of pages.

    The rule's verdict, else the filter's. A null or odd url has an empty host and path, fits no rule and is
    judged by the filter on an empty text. Each row is judged alone: no shuffle, and other columns than
    page_id and url are not read.
    """
    judged = model.transform(featured(pages.select("page_id", "url")))
    of_rule = rule_of(F.col("u_parts.host"), F.col("u_parts.path"), rules)
    own = F.when(F.col("u_block") == 1, "block").otherwise("allow")
    return judged.withColumn("u_rule", of_rule).select(
        "page_id", "u_parts.host", "u_parts.path", "u_rule.rule", F.coalesce("u_rule.verdict", own).alias("verdict"), own.alias("own_verdict")
    )
