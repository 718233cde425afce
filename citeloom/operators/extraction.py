"""Citations from text to typed edges."""

from __future__ import annotations

from citeloom.functions import fixed, rules

REFERENCE = r"[Ss]ections?\s+(\d+\.\d+)"
RANGE_END = r"[Ss]ections?\s+\d+\.\d+\s+to\s+(\d+\.\d+)"
RUN = r"[.\d]+"
VALID = r"^\d{3,4}\.\d+$"


def references(d):  # noqa: ANN001, ANN201
    """Distinct valid references of a text: named, ends of ranges, and whole runs of digits and dots."""
    if d.name == "spark":
        return d.distinct_sorted(d.kept(f"concat({d.found('text', REFERENCE, 1)}, {d.found('text', RANGE_END, 1)}, {d.found('text', r'(?<![.\d])\d{3,4}\.\d+(?![.\d])')})", "x", d.has("x", VALID)))
    return d.distinct_sorted(d.kept(f"list_concat({d.found('text', REFERENCE, 1)}, {d.found('text', RANGE_END, 1)}, {d.found('text', RUN)})", "x", d.has("x", VALID)))


PLANS = {
    "o20_statute_references": (["doc"], lambda d: f"SELECT section, {d.joined(references(d))} AS refs, {d.size(references(d))} AS n FROM doc"),
    "o23_multi_corpus": (["rule"], lambda d: f"SELECT rule_id, 'oac' AS corpus, {d.each(d.found('text', r'\d{3,4}-\d{1,2}-\d{1,2}'))} AS ref FROM rule UNION ALL SELECT rule_id, 'orc', {d.each(d.found('text', REFERENCE, 1))} FROM rule"),
    "o24_reference_class": (["rule"], lambda d: "SELECT rule_id, " + rules.cases([(d.has("ref", r"^\d{3,4}\.\d+$"), "'orc'"), (d.has("ref", r"^\d+-\d+-\d+$"), "'oac'"), (d.has("ref", r"^[IVX]+-\d+$"), "'constitution'"), (d.has("ref", r"^case_"), "'case'")], "'unknown'") + " AS kind FROM (SELECT rule_id, CASE s_suppkey % 5 WHEN 0 THEN '2903.01' WHEN 1 THEN rule_id WHEN 2 THEN 'IV-2' WHEN 3 THEN 'case_5' ELSE 'x' END AS ref FROM rule) x"),
    "o25_reference_validation": (["rule"], lambda d: f"SELECT rule_id, {d.has('rule_id', r'^(?:\d{3,4}-\d{1,2}-\d{1,2})')} AS valid FROM rule"),
    "o29_relationship": (["courtcase"], lambda d: f"SELECT case_id, {rules.first_pattern(d, 'opinion', fixed.RELATIONS, 'cited')} AS relationship FROM courtcase"),
    "o30_citation_class": (["courtcase"], lambda d: f"SELECT case_id, {rules.cite_class(d, 'opinion')} AS class FROM courtcase"),
    "o31_structured_citations": (["case_edge"], lambda d: "SELECT src, dst, 'cited' AS relationship FROM case_edge"),
    "o32_resolved_edges": (["case_edge"], lambda d: "SELECT src, CAST(dst AS STRING) AS target FROM case_edge WHERE dst IS NOT NULL"),
    "o33_edge_union": (["case_edge", "courtcase"], lambda d: f"SELECT src, CAST(dst AS STRING) AS target FROM case_edge UNION SELECT case_id, {d.each(d.found('opinion', r'\d{4}-Ohio-\d+'))} FROM courtcase"),
    "o36_hallucinated": (["doc"], lambda d: f"SELECT section, {d.size(d.kept(d.found('answer', r'(?:section|§)\s+(\d+(?:\.\d+)*)', 1), 'r', "NOT contains(replace(text, '.', ''), replace(r, '.', ''))"))} AS n_unknown FROM (SELECT section, text, 'See section ' || section || ' and section 101.15.' AS answer FROM doc) x"),
}
