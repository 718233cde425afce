"""Checks of answers against their type and source, in SQL of either dialect; tests compare them with plain Python."""

from __future__ import annotations

from citeloom.functions import fixed, rules

TYPES = list(fixed.REQUIRED)
MARKS = ".,;:()[]{}\"'-"


def escaped(d, x: str) -> str:  # noqa: ANN001
    return rules.quoted(d, x)


def told(d, x: str, phrases: list[str]) -> str:  # noqa: ANN001
    """How many of the phrases are in x."""
    return "(" + " + ".join(f"CAST(contains({x}, {escaped(d, p)}) AS INT)" for p in phrases) + ")"


def telling(d, x: str) -> str:  # noqa: ANN001
    """Distinct words of x of more than 3 characters that are not common, without marks at their ends."""
    common = ", ".join(map(rules.lit, fixed.COMMON_WORDS))
    bare = f"trim(BOTH {escaped(d, MARKS)} FROM lower(w))" if d.name == "spark" else f"trim(lower(w), {escaped(d, MARKS)})"
    return d.distinct_sorted(d.mapped(d.kept(d.found(x, r"[^\s]+"), "w", f"length(w) > 3 AND lower(w) NOT IN ({common})"), "w", bare))


def checks(d) -> dict[str, str]:  # noqa: ANN001
    """The stages, by name, over the columns answer, kind and source."""
    low, src = "lower(trim(answer))", "lower(source)"
    required = rules.cases([(f"kind = '{k}'", f"{told(d, low, words)} > 0") for k, words in fixed.REQUIRED.items()], "TRUE")
    least = rules.cases([(f"kind = '{k}'", str(n)) for k, n in fixed.LEAST_LENGTHS.items()], "0")
    listed = " OR ".join(f"contains(answer, {escaped(d, m)})" for m in ("•", "-", "1.", "2.", "(a)", "(1)", "(i)"))
    words = d.found("answer", r"[^\s]+")
    unknown = d.kept(d.found(low, r"(?:section|§)\s*(\d+(?:\.\d+)*)", 1), "r", f"NOT contains(replace({src}, '.', ''), replace(r, '.', ''))")
    ands = d.size(d.found("answer", " and "))
    return {
        "long": "length(trim(answer)) >= 20", "answers": f"{told(d, low, fixed.NON_ANSWERS)} = 0", "certain": f"{told(d, low, fixed.SPECULATION)} = 0", "direct": f"{told(d, low, fixed.META)} <= 2", "required": required,
        "grounded": f"{d.size(telling(d, 'answer'))} = 0 OR {d.overlap(telling(d, 'answer'), telling(d, 'source'))} >= 0.35 * {d.size(telling(d, 'answer'))}", "known": f"{d.size(unknown)} = 0", "least": f"length(answer) >= {least}",
        "listed": f"kind NOT IN ({', '.join(map(rules.lit, fixed.LISTED))}) OR contains(answer, chr(10)) OR {listed} OR contains(answer, ';') OR {ands} >= 2", "words": f"{d.size(words)} >= 5",
    }


def validated(d, source: str) -> str:  # noqa: ANN001
    """source's rows (key, answer, kind, source) with valid, and the first stage that fails."""
    stages = checks(d)
    first = rules.cases([(f"NOT coalesce({test}, FALSE)", rules.lit(name)) for name, test in stages.items()], "NULL")
    return f"SELECT key, kind, failed IS NULL AS valid, failed FROM (SELECT key, kind, {first} AS failed FROM {source}) y"


#: Answers made from sections: of their text, with a phrase of each kind that a stage rejects.
ANSWERS = f"""(SELECT section || ':' || CAST(nth AS STRING) AS key, text AS source, CASE (line_no * 7 + nth) % 11 {' '.join(f"WHEN {i} THEN '{k}'" for i, k in enumerate(TYPES))} END AS kind, CASE nth
    WHEN 0 THEN text WHEN 1 THEN substring(text, 1, 15 + line_no % 60) WHEN 2 THEN 'I don''t know; it is not specified in section ' || section WHEN 3 THEN substring(text, 1, 90) || ' This probably means section 999.99.' WHEN 4 THEN 'According to it, the text says what it is written; the law provides ' || substring(text, 1, 60)
    WHEN 5 THEN 'Zebras shall file "quartz", when it means felony; board duties, unlawful (violins) and drums and a subsection' WHEN 6 THEN '- shall ' || text || ' as section 101.01 has it' ELSE 'Short.' END AS answer FROM doc CROSS JOIN (SELECT * FROM (VALUES (0), (1), (2), (3), (4), (5), (6), (7)) AS v(nth)) n)"""


def answers(d) -> str:  # noqa: ANN001
    return f"{ANSWERS if d.name == 'duck' else ANSWERS.replace(chr(39) * 2 + 't', chr(92) + chr(39) + 't')} z"


PLANS = {"t03_answer_validation": (["doc"], lambda d: validated(d, answers(d)))}
