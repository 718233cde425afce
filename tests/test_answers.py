"""The stages of answer validation against plain Python."""

import re

from citeloom.functions import fixed
from citeloom.operators import answers
from citeloom.plans.corpora import prelude
from citeloom.plans.dialects import Spark
from citeloom.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"


def valid(answer, kind, source):
    low, src = answer.lower().strip(), source.lower()
    if len(answer.strip()) < 20 or any(p in low for p in fixed.NON_ANSWERS + fixed.SPECULATION) or sum(p in low for p in fixed.META) > 2:
        return False
    if kind in fixed.REQUIRED and not any(p in low for p in fixed.REQUIRED[kind]):
        return False
    mine, other = ({w.lower().strip(".,;:()[]{}\"'-") for w in x.split() if len(w) > 3 and w.lower() not in fixed.COMMON_WORDS} for x in (answer, source))
    if mine and len(mine & other) / len(mine) < 0.35:
        return False
    if any(r.replace(".", "") not in src.replace(".", "") for r in re.findall(r"(?:section|§)\s*(\d+(?:\.\d+)*)", low)):
        return False
    if len(answer) < fixed.LEAST_LENGTHS.get(kind, 0):
        return False
    if kind in fixed.LISTED and not any(m in answer for m in ("\n", "•", "-", "1.", "2.", "(a)", "(1)", "(i)")) and ";" not in answer and answer.count(" and ") < 2:
        return False
    return len(answer.split()) >= 5


def test_stages(spark):
    d = Spark()
    rows = spark.sql(prelude(d, ["doc"], SF) + f"SELECT key, kind, answer, source FROM {answers.answers(d)}").collect()
    got = {r.key: r.valid for r in QUERIES["t03_answer_validation"](spark, SF).collect()}
    assert got == {r.key: valid(r.answer, r.kind, r.source) for r in rows}
    assert 0 < sum(got.values()) < len(got)


def test_each_stage_is_met(spark):
    failed = {r.failed for r in QUERIES["t03_answer_validation"](spark, SF).collect()}
    assert {"long", "answers", "certain", "direct", "required", "grounded", "known", None} <= failed
