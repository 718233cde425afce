"""Training sets from documents and conversations, with deterministic checks of answers."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUESTIONS = ["What does section {s} cover?", "Who is affected by section {s}?", "What are the penalties under section {s}?", "What terms does section {s} define?"]
TRIGGERS = {"penalty": ["felony", "misdemeanor"], "definition": ["as used in", "means"], "money": ["tax", "wage"], "authority": ["department", "board"]}


def template_rows() -> str:
    return ", ".join("({}, '{}')".format(i, q.replace("{s}", "@")) for i, q in enumerate(QUESTIONS))


def trigger_rows() -> str:
    return ", ".join(f"('{k}', '{w}')" for k, words in TRIGGERS.items() for w in words)


def first_json(text: str | None) -> str | None:
    """The first balanced [...] or else {...} of a text, if it is JSON; code fences do not matter."""
    for opening, closing in ("[]", "{}"):
        start = (text or "").find(opening)
        depth, quoted, skip = 0, False, False
        for i in range(start, len(text or "")) if start >= 0 else ():
            c = text[i]
            if skip or c == "\\":
                skip = not skip and quoted
            elif c == '"':
                quoted = not quoted
            elif not quoted and c in (opening, closing):
                depth += 1 if c == opening else -1
                if depth == 0:
                    try:
                        return json.dumps(json.loads(text[start : i + 1]))
                    except ValueError:
                        break
    return None


def extracted_json(df: DataFrame, text: str = "text") -> DataFrame:
    """df with found: balanced JSON cannot be matched by a regular expression, hence batches of pandas."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + ", found string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(found=pdf[text].map(first_json))

    return df.mapInPandas(run, schema)


def t05(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", F.concat(F.lit("Here it is: "), "props", F.lit(" ok")).alias("text"))
    return extracted_json(events).select("event_id", F.get_json_object("found", "$.k").alias("k"))


PROGRAMS = {"t05_json_from_text": t05}
PROGRAM_SQL = {"t05_json_from_text": (["events"], lambda d: f"SELECT event_id, {d.json('props', 'k')} AS k FROM events")}

PLANS = {
    "t01_questions": (["doc"], lambda d: f"SELECT section, replace(q, '@', section) AS question FROM doc JOIN (SELECT * FROM (VALUES {template_rows()}) AS v(nth, q)) t ON nth < 10"),
    "t02_applicable": (["doc"], lambda d: f"SELECT DISTINCT section, kind FROM doc JOIN (SELECT * FROM (VALUES {trigger_rows()}) AS v(kind, word)) t ON contains(lower(text), word)"),
    "t04_strict_validation": (["conversations"], lambda d: f"SELECT conv_id, turn, length(text) >= 25 AND {d.has('text', '[.!?]$')} AS valid FROM conversations WHERE role = 'assistant'"),
    "t09_composite": (["ranked_edge"], lambda d: f"SELECT src, {d.list_join('CAST(nth AS STRING) || chr(46) || dst', ' ', 'nth')} AS response FROM ranked_edge WHERE nth <= 2 GROUP BY src"),
    "t13_training_union": (["doc", "conversations"], lambda d: "SELECT section AS id, title AS question, CAST(NULL AS STRING) AS role FROM doc UNION ALL SELECT CAST(conv_id AS STRING), text, role FROM conversations"),
    "t15_strategy_table": (["doc"], lambda d: """SELECT x.section, v.kind, v.strategy FROM (SELECT section, CASE WHEN contains(lower(text), 'felony') THEN 'felony' WHEN contains(lower(text), 'misdemeanor') THEN 'misdemeanor' ELSE 'civil' END AS kind FROM doc) x
    JOIN (VALUES ('felony', 'suppression'), ('misdemeanor', 'plea'), ('civil', 'settlement')) AS v(kind, strategy) ON v.kind = x.kind"""),
    "w07_question_priority": (["doc"], lambda d: f"SELECT section, kind, CASE WHEN n > 2 THEN 0 WHEN n > 0 THEN 1 ELSE 2 END AS priority FROM (SELECT section, kind, sum(CASE WHEN contains(lower(text), word) THEN 1 ELSE 0 END) AS n FROM doc JOIN (SELECT * FROM (VALUES {trigger_rows()}) AS v(kind, word)) t ON true GROUP BY section, kind) x"),
}
