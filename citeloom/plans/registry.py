"""All queries by operator, each with the SQL that the oracle compares it with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from citeloom.operators import aggregates, answers, cases, citations, classification, context, extraction, files, graph, hashes, networks, pages, provisions, reports, reshaping, retrieval, statutes, training, verdicts
from citeloom.plans.corpora import prelude
from citeloom.plans.dialects import Duck, Spark
from citeloom.streaming import batches, incremental


def planned(needs: list[str], body: Callable[[Spark], str]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: spark.sql(joined(prelude(Spark(), needs, sf_dir), body(Spark())))


#: Operators as plans in either dialect.
PLANS = {**reshaping.PLANS, **extraction.PLANS, **classification.PLANS, **aggregates.PLANS, **graph.PLANS, **networks.PLANS, **retrieval.PLANS, **training.PLANS, **answers.PLANS, **reports.PLANS}
#: Operators as programs over DataFrames.
PROGRAMS: dict[str, Callable[[SparkSession, str], DataFrame]] = {**graph.PROGRAMS, **context.PROGRAMS, **training.PROGRAMS, **incremental.PROGRAMS, **files.PROGRAMS, **citations.PROGRAMS, **networks.PROGRAMS, **batches.PROGRAMS, **pages.PROGRAMS, **hashes.PROGRAMS, **cases.PROGRAMS, **verdicts.PROGRAMS}
#: SQL for programs, in the oracle's dialect: (relations, body).
PROGRAM_SQL = {**graph.PROGRAM_SQL, **training.PROGRAM_SQL, **incremental.PROGRAM_SQL}

#: Operators whose oracle is written apart from the plan: (relations, plan, SQL).
PAIRED = {**provisions.PAIRED, **statutes.PAIRED}


def joined(clause: str, body: str) -> str:
    """A body after a WITH clause; one that begins with a comma adds to it."""
    return clause.rstrip() + body if body.startswith(",") else clause + body


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {name: planned(needs, body) for name, (needs, body) in PLANS.items()} | {name: planned(needs, body) for name, (needs, body, _) in PAIRED.items()} | PROGRAMS
ORACLES: dict[str, str] = {name: prelude(Duck(), needs) + body(Duck()) for name, (needs, body) in {**PLANS, **PROGRAM_SQL}.items()} | {
    name: joined(prelude(Duck(), needs), sql if isinstance(sql, str) else sql()) for name, (needs, _, sql) in PAIRED.items()
} | {name: prelude(Duck(), needs) + sql for name, (needs, sql) in files.SQL.items()} | {
    name: joined(prelude(Duck(), needs), sql()) for name, (needs, sql) in {**citations.SQL, **networks.SQL, **hashes.SQL, **cases.SQL, **verdicts.SQL}.items()
}
