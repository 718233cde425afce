"""Expressions made from tables of rules: classification, scores and keyword tests, as SQL text for either dialect."""

from __future__ import annotations

from citeloom.functions import fixed
from citeloom.plans.dialects import Spark


def lit(x: str | int) -> str:
    return "'" + x.replace("'", "''") + "'" if isinstance(x, str) else str(x)


def quoted(d: Spark, x: str) -> str:
    """A string literal: quotes are doubled for the oracle and escaped for Spark."""
    return "'" + (x.replace("'", "''") if d.name == "duck" else x.replace("'", r"\'")) + "'"


def cases(rules: list[tuple[str, str]], other: str) -> str:
    """The value of the first test that holds."""
    return "CASE " + " ".join(f"WHEN {test} THEN {value}" for test, value in rules) + f" ELSE {other} END"


def any_word(x: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains({x}, {lit(w)})" for w in words) + ")"


def word_count(x: str, words: list[str]) -> str:
    """How many of the words are substrings of x."""
    return "(" + " + ".join(f"CAST(contains({x}, {lit(w)}) AS INT)" for w in words) + ")"


def areas(x: str, table: dict[str, list[str]], least: int) -> str:
    """Names of the table whose words are found at least so often, joined by commas; '' if there are none."""
    return "concat_ws(',', " + ", ".join(f"CASE WHEN {word_count(x, words)} >= {least} THEN {lit(name)} END" for name, words in table.items()) + ")"


def any_pattern(patterns: list[str]) -> str:
    return "|".join(patterns)


def first_pattern(d: Spark, x: str, table: dict[str, list[str]], other: str) -> str:
    return cases([(d.has(x, "(?i)" + any_pattern(p)), lit(name)) for name, p in table.items()], lit(other))


def summary(title: str) -> str:
    t = f"lower({title})"
    return cases(
        [(any_word(t, ["definition", "defined"]), f"'Defines ' || {t}"), (any_word(t, ["penalty", "penalties", "punishment"]), f"'Establishes penalties for ' || {t}"), (any_word(t, ["procedure", "process", "filing"]), f"'Describes procedure for ' || {t}")],
        f"'Relates to ' || {t}",
    )


def provision_summary(title: str) -> str:
    t = f"lower({title})"
    return cases(
        [(any_word(t, words), f"'{verb} ' || {t}") for verb, words in (("Guarantees", ["rights", "freedom", "liberty"]), ("Establishes", ["power", "authority", "duty"]), ("Governs", ["procedure", "process", "election"]), ("Prohibits or limits", ["prohibition", "prohibited", "limit"]))],
        f"'Addresses ' || {t}",
    )


def case_summary(d: Spark, name: str) -> str:
    split = lambda sep, i: d.at(f"split({name}, '{sep}')" if d.name == "duck" else f"split({name}, {d.rx(sep.replace('.', '[.]'))})", i)
    between = lambda sep: f"'Case between ' || trim({split(sep, 0)}) || ' and ' || trim({split(sep, 1)})"
    return cases([(f"contains({name}, ' v. ')", between(" v. ")), (f"contains({name}, ' vs. ')", between(" vs. "))], f"'Case regarding ' || substring({name}, 1, 100)")


def legal_type(text: str, header: str) -> str:
    t = f"lower({text})"
    return cases(
        [(f"{word_count(t, fixed.CRIMINAL)} >= 2", "'criminal_statute'"), (f"(contains({t}, 'as used in') OR contains(lower({header}), 'definition'))", "'definitional'"), (any_word(t, ["procedure", "process", "filing", "hearing", "motion"]), "'procedural'")],
        "'civil_statute'",
    )


def case_type(text: str) -> str:
    t = f"lower({text})"
    return cases([(f"{word_count(t, fixed.CRIMINAL_CASE)} >= 3", "'criminal_case'"), (any_word(t, ["appeal", "appellant", "appellee"]), "'appellate_case'")], "'civil_case'")


def complexity(words: str, parts: str, cites: str, w: tuple[int, int, int], p: tuple[int, int], c: tuple[int, int]) -> str:
    """A score from 1 to 10 around 5."""
    score = (
        f"5 + {cases([(f'{words} > {w[0]}', '2'), (f'{words} > {w[1]}', '1'), (f'{words} < {w[2]}', '-1')], '0')}"
        f" + {cases([(f'{parts} > {p[0]}', '2'), (f'{parts} > {p[1]}', '1')], '0')} + {cases([(f'{cites} > {c[0]}', '2'), (f'{cites} > {c[1]}', '1'), (f'{cites} = 0', '-1')], '0')}"
    )
    return f"CAST(greatest(1, least(10, {score})) AS INT)"


def offense_level(text: str) -> str:
    t = f"lower({text})"
    return cases([(f"contains({t}, 'felony')", "'felony'"), (f"contains({t}, 'misdemeanor')", "'misdemeanor'")], "NULL")


def offense_degree(text: str) -> str:
    t = f"lower({text})"
    names = ["first", "second", "third", "fourth", "fifth"]
    return cases([(f"contains({t}, 'felony of the {n} degree')", f"'F{i}'") for i, n in enumerate(names, 1)] + [(f"contains({t}, 'misdemeanor of the {n} degree')", f"'M{i}'") for i, n in enumerate(names[:4], 1)], "NULL")


def title_rows(d: Spark) -> str:
    return ", ".join(f"({lo}, {hi}, {quoted(d, name)})" for lo, hi, name in fixed.TITLES)


def agency_rows(d: Spark) -> str:
    return ", ".join(f"({i}, {lo}, {hi}, {quoted(d, name)})" for i, (lo, hi, name) in enumerate(fixed.AGENCIES))


def rule_type(chapter: str) -> str:
    return cases([("(" + " OR ".join(f"({chapter} >= {lo} AND {chapter} < {hi})" for lo, hi in ranges) + ")", lit(name)) for ranges, name in fixed.RULE_TYPES], "'Regulatory'")


def court_kind(name: str) -> str:
    n = f"lower({name})"
    return cases([(" AND ".join(f"contains({n}, {lit(w)})" for w in words), lit(kind)) for words, kind, _ in fixed.COURTS], "'unknown'")


def court_level(name: str) -> str:
    n = f"lower({name})"
    return cases([(" AND ".join(f"contains({n}, {lit(w)})" for w in words), str(level)) for words, _, level in fixed.COURTS], "0")


def county_rows() -> str:
    """Counties and districts; the last district that names a county counts."""
    last = {county: district for district, counties in fixed.DISTRICTS.items() for county in counties}
    return ", ".join(f"('{c}', '{k}')" for c, k in last.items())


def authority(kind: str, level: str, cited_kind: str, cited_level: str, district: str, cited_district: str) -> str:
    """How a cited court's precedent binds a citing court; null if no rule says."""
    same = f"({district} IS NOT NULL AND {district} = {cited_district})"
    above = cases(
        [
            (f"{cited_kind} = 'supreme' AND {kind} <> 'federal-supreme'", "'binding'"), (f"{cited_kind} = 'federal-supreme'", "'binding'"), (f"{cited_kind} = 'federal-circuit' AND {kind} = 'federal-district'", "'binding'"),
            (f"{cited_kind} = 'appeals' AND {level} < 80", f"CASE WHEN {same} THEN 'binding' ELSE 'persuasive' END"),
        ],
        "NULL",
    )
    return cases([(f"{cited_level} > {level}", above), (f"{cited_level} < {level}", "'lower'"), (f"{kind} = 'appeals' AND {cited_kind} = 'appeals' AND {same}", "'horizontal'")], "'persuasive'")


def cite_class(d: Spark, cite: str) -> str:
    c = f"lower({cite})"
    return cases(
        [(d.has(c, r"\d{4}-ohio-\d+"), "'ohio-neutral'"), (f"contains({c}, 'ohio st')", "'ohio-state'"), (f"contains({c}, 'ohio app')", "'ohio-app'"), (f"contains({c}, 'n.e.')", "'northeast'"), (f"contains({c}, 'u.s.')", "'federal-supreme'"), (f"(contains({c}, 'f.') AND NOT contains({c}, 'supp'))", "'federal-reporter'"), (f"contains({c}, 'f. supp')", "'federal-supp'")],
        "'other'",
    )


def keeps_case(words: str, rank: str, year: str, cites: str) -> str:
    return f"({rank} >= 0.5 OR NOT ({words} < 500 OR ({year} >= 1900 AND {cites} = 0 AND {rank} = 0) OR ({rank} = 0 AND {words} < 1000)))"


def why_rejected(words: str, rank: str, year: str, cites: str) -> str:
    return cases([(keeps_case(words, rank, year, cites), "NULL"), (f"{words} < 500", "'too_short'"), (f"{rank} = 0 AND {words} < 1000", "'zero_authority'")], "'no_citations'")
