"""Search, comparison and context assembly."""

from __future__ import annotations

from citeloom.functions import fixed, rules


def corpora(d) -> str:  # noqa: ANN001
    return f"(SELECT rule_id AS section, 'rules' AS source, 'statutes' AS target, {d.each(d.found('text', r'section\s+(\d+\.\d+)', 1))} AS ref FROM rule UNION ALL SELECT rule_id, 'rules', 'rules', {d.each(d.found('text', r'\d{3,4}-\d{1,2}-\d{1,2}'))} FROM rule UNION ALL SELECT section, 'statutes', 'statutes', {d.each(d.found('text', r'section\s+(\d+\.\d+)', 1))} FROM doc)"


PLANS = {
    "q01_section_record": (["doc", "in_degree", "out_degree"], lambda d: "SELECT d.section, d.title, coalesce(o.reference_count, 0) AS refs, coalesce(i.cited_by_count, 0) AS cited FROM doc d LEFT JOIN in_degree i ON i.section = d.section LEFT JOIN out_degree o ON o.section = d.section"),
    "q04_context_text": (["doc", "edge"], lambda d: f"SELECT e.src, {d.list_join('n.section || chr(58) || substring(n.text, 1, 500)', ' ', 'n.section')} AS context FROM edge e JOIN doc n ON n.section = e.dst GROUP BY e.src"),
    "q11_cross_corpus": (["rule", "doc"], lambda d: f"SELECT section, source, target, ref FROM {corpora(d)} c"),
    "q13_matrix": (["rule", "doc"], lambda d: f"SELECT source, target, count(*) AS n FROM {corpora(d)} c GROUP BY CUBE (source, target)"),
    "q16_multi_query": (["doc"], lambda d: "SELECT section, min(q) AS first_query FROM (SELECT section, q, row_number() OVER (PARTITION BY q ORDER BY section) AS rn FROM doc JOIN (SELECT * FROM (VALUES ('lease'), ('tax'), ('wage')) AS v(q)) w ON contains(lower(text), q)) x WHERE rn <= 10 GROUP BY section ORDER BY section LIMIT 20"),
    "q21_judge_analytics": (["courtcase"], lambda d: "SELECT court, reporter, count(*) AS n, round(avg(word_count), 6) AS mean_words FROM courtcase GROUP BY court, reporter"),
    "q22_membership": (["doc"], lambda d: f"SELECT section FROM (SELECT section, {rules.areas('lower(text)', fixed.AREAS, 2)} AS a FROM doc) x WHERE contains(a, 'criminal_law')"),
    "q24_negative_treatment": (["courtcase", "case_edge"], lambda d: f"SELECT e.dst, max(CASE WHEN {rules.first_pattern(d, 'c.opinion', fixed.RELATIONS, 'cited')} IN ('overruled', 'questioned') THEN 1 ELSE 0 END) AS negative FROM case_edge e JOIN courtcase c ON c.case_id = e.src GROUP BY e.dst"),
}
