"""Quality rules: thresholds for each language and source from mergeable quantile sketches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeloom.llm.common import cut, let, small_side, words_of

#: Metrics in whole numbers, and the spread that takes the place of a quartile range of zero, in the same units.
#: Symbols, repeated words and upper-case letters are per thousand words or characters, duplicate lines
#: per thousand lines, the mean word length in hundredths.
METRICS = {"m_symbols": 100, "m_repeats": 300, "m_dup_lines": 500, "m_word_len": 150, "m_upper": 150}
#: Metrics with a lower limit as well.
TWO_SIDED = {"m_word_len"}
#: Quartile ranges from a quartile to its limit. Chosen on the labels of one table: from 5 to 15, no document labelled good went there.
SPREADS = 6
#: A source of fewer rows takes its language's quartiles.
LEAST_GROUP = 100
MIN_WORDS = 50
MAX_REPEAT_PCT = 50


def repeat_words(words: Column) -> Column:
    """Words in 3-word windows that occur twice or more, in O(n log n) of the words of one text.

    Windows are compared by 64-bit hashes: of a text of a million words, two differ with equal hashes with
    a probability under 1e-7.
    """

    def covered(at: Column) -> Column:
        start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last"))
        step = lambda s, p: F.struct((s["n"] + F.least(F.lit(3), p - s["last"])).alias("n"), p.alias("last"))
        return F.aggregate(at, start, step, lambda s: s["n"])

    def positions(ordered: Column) -> Column:
        at = lambda i, x: F.coalesce(F.get(ordered, i)["h"] == x["h"], F.lit(False))
        return F.array_sort(F.transform(F.filter(ordered, lambda x, i: at(i - 1, x) | at(i + 1, x)), lambda x: x["i"]))

    def of(hashes: Column) -> Column:
        ordered = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        some = F.size(F.array_distinct(hashes)) < F.size(hashes)
        return F.when(some, covered(let(ordered, positions))).otherwise(F.lit(0).cast("long"))

    hashes = F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    return F.when(F.size(words) >= 3, let(hashes, of)).otherwise(F.lit(0).cast("long"))


def measures(text: Column) -> Column:
    """struct of n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_upper and n_lines; a null text has none."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    count = lambda p: F.regexp_count(text, F.lit(p)).cast("long")
    of_lines = let(lines, lambda x: F.struct((F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"), F.size(x).cast("long").alias("n")))
    return let(
        F.struct(words_of(text).alias("w"), of_lines.alias("l")),
        lambda s: F.struct(
            F.size(s["w"]).cast("long").alias("n_words"), F.length(F.array_join(s["w"], "")).cast("long").alias("word_chars"), count("[#*$%&|<>]").alias("n_symbols"),
            s["l"]["dup"].alias("n_dup_lines"), repeat_words(s["w"]).alias("n_repeat_words"), count("[A-ZÀ-ÖØ-Þ]").alias("n_upper"), s["l"]["n"].alias("n_lines"),
        ),
    )


def with_metrics(docs: DataFrame, prefix: str = "q_") -> DataFrame:
    """docs with one struct column, prefix + "m", of the measures, metrics, base_failed, lang and source."""
    m = lambda k: F.col(f"{prefix}raw")[k]
    share = lambda a, b, by: F.call_function("div", m(a) * by, F.greatest(m(b), F.lit(1).cast("long")))
    failed = (m("n_words") < MIN_WORDS) | (m("n_repeat_words") * 100 > m("n_words") * MAX_REPEAT_PCT)
    fields = [m(k).alias(k) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    metrics = {
        "m_symbols": share("n_symbols", "n_words", 1000), "m_repeats": share("n_repeat_words", "n_words", 1000), "m_dup_lines": share("n_dup_lines", "n_lines", 1000),
        "m_word_len": share("word_chars", "n_words", 100), "m_upper": share("n_upper", "word_chars", 1000),
    }
    some = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return docs.withColumn(f"{prefix}raw", measures(F.col("text"))).withColumn(
        f"{prefix}m", F.struct(*fields, *(v.alias(k) for k, v in metrics.items()), failed.alias("base_failed"), some("lang").alias("lang"), some("source").alias("source"))
    ).drop(f"{prefix}raw")


def bin_of(v: Column) -> Column:
    """The sketch's bin of a whole number: exact up to 127, then 64 bins for each power of two (an error under 1.6 %)."""
    shift = F.greatest(F.length(F.bin(v)) - 7, F.lit(0))
    return F.struct(shift.alias("e"), F.call_function("shiftright", v, shift).alias("b"))


def value_of(b: Column) -> Column:
    return F.call_function("shiftleft", b["b"], b["e"])


def thresholds(metrics: DataFrame) -> DataFrame:
    """(lang, source, limits) for each group of the rows that passed the base rules.

    metrics: rows of lang, source and METRICS. A group's sketch of a metric is its counts by bin (bin_of):
    bins are fixed, so sketches merge by adding counts, in any order and with the same result; a group has
    some hundred bins at most, and partial aggregation keeps a hot source's shuffle to its bins. A metric's
    limit is the third quartile and SPREADS times the range between the first and the third; m_word_len has
    the mirrored lower limit. The range is the source's or its language's, whichever is larger, so that a
    source of much alike texts keeps what is usual in its language; where both are zero, METRICS has the
    spread. Copies of one text that are under half of a group leave some of its range, wherever they lie. A
    source of fewer than LEAST_GROUP rows takes its language's merged sketch.
    """
    long = metrics.select("lang", "source", F.explode(F.array(*(F.struct(F.lit(k).alias("metric"), bin_of(F.col(k)).alias("bin")) for k in METRICS))).alias("x")).select("lang", "source", "x.*")
    fine = long.groupBy("lang", "source", "metric", "bin").agg(F.count("*").alias("n"))
    merged = fine.groupBy("lang", "metric", "bin").agg(F.sum("n").alias("n")).select("lang", F.lit(None).cast("string").alias("source"), "metric", "bin", "n")
    sketch = fine.unionByName(merged)
    group = ["lang", "source", "metric"]
    up_to = Window.partitionBy(*group).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    ranked = sketch.withColumn("upto", F.sum("n").over(up_to)).withColumn("total", F.sum("n").over(Window.partitionBy(*group)))
    at = lambda pct: F.min(F.when(F.col("upto") * 100 >= F.col("total") * pct, value_of(F.col("bin"))))
    quartiles = ranked.groupBy(*group).agg(F.max("total").alias("total"), at(25).alias("q1"), at(75).alias("q3"))
    by_group = quartiles.groupBy("lang", "source").agg(F.max("total").alias("total"), F.map_from_entries(F.collect_list(F.struct("metric", F.struct("q1", "q3")))).alias("own"))
    whole = by_group.where("source IS NULL").select("lang", F.col("own").alias("of_lang"))
    own = F.when(F.col("total") >= LEAST_GROUP, F.col("own")).otherwise(F.col("of_lang"))
    width = lambda q: q["q3"] - q["q1"]

    def limit(k: str, least: int) -> Column:
        widest = F.greatest(width(own[k]), width(F.col("of_lang")[k]))
        spread = F.when(widest > 0, widest * SPREADS).otherwise(least)
        lo = own[k]["q1"] - spread if k in TWO_SIDED else F.lit(None).cast("long")
        return F.struct(lo.alias("lo"), (own[k]["q3"] + spread).alias("hi")).alias(k)

    return by_group.where("source IS NOT NULL").join(whole, "lang").select("lang", "source", F.struct(*(limit(k, v) for k, v in METRICS.items())).alias("limits"))


def verdict(m: Column, limits: Column) -> Column:
    """Whether a document is kept; one whose group has no limits failed the base rules."""
    ok = ~m["base_failed"]
    for k in METRICS:
        ok = ok & (m[k] <= F.coalesce(limits[k]["hi"], m[k])) & (m[k] >= F.coalesce(limits[k]["lo"], m[k]))
    return ok


def quality_report(docs: DataFrame) -> DataFrame:
    """Measures and verdict of each row of docs.

    A null or empty text has no words and fails; null languages or sources are groups of their own. Rows
    count as often as they occur. An empty table gives an empty result. Measured rows are narrow (no text)
    and are kept in the checkpoint folder, so texts are read once; the limits join them by language and
    source, broadcast if counted small and otherwise shuffled, where Spark splits a hot source.
    """
    rows = cut(with_metrics(docs.select("doc_id", "text", "lang", "source")).select("doc_id", "q_m.*"))
    limits = thresholds(rows.where(~F.col("base_failed")).select("lang", "source", *METRICS))
    m = F.struct("base_failed", *METRICS)
    return rows.join(small_side(cut(limits)), ["lang", "source"], "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", verdict(m, F.col("limits")).alias("kept"), *METRICS, "lang", "source"
    )


def quality_filter(docs: DataFrame) -> DataFrame:
    """The rows of docs that quality_report keeps, with all their columns, whatever their names.

    Rows and their measures are written once to the checkpoint folder, each as one column, so that each text
    is measured once: the limits read the measures alone, and the filter joins them to the rows. The limits
    are a row for each language and source, broadcast if counted small; else Spark splits a hot source.
    """
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("whole")
    measured = cut(with_metrics(docs.select(whole, *(F.col(f"`{c}`") for c in ("text", "lang", "source")))).select("whole", F.struct("q_m.base_failed", *(f"q_m.{k}" for k in METRICS)).alias("m"), "q_m.lang", "q_m.source"))
    limits = thresholds(measured.where("NOT m.base_failed").select("lang", "source", *(f"m.{k}" for k in METRICS)))
    judged = measured.where("NOT m.base_failed").join(small_side(cut(limits)), ["lang", "source"])
    return judged.where(verdict(F.col("m"), F.col("limits"))).select(*(F.col("whole")[c].alias(c) for c in docs.columns))
