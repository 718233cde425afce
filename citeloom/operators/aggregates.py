"""Joins, groupings, statistics and rankings over the citation graph and the cases."""

from __future__ import annotations

from citeloom.functions import rules


def hist(d, key: str, source: str) -> str:  # noqa: ANN001
    return f"SELECT {key} AS k, count(*) AS n FROM {source} GROUP BY {key}"


PLANS = {
    "j01_targets": (["edge", "doc"], lambda d: "SELECT e.src, e.dst, coalesce(n.title, '') AS title, coalesce(n.url, '') AS url FROM edge e LEFT JOIN doc n ON n.section = e.dst"),
    "j03_ordered_members": (["ranked_edge", "node"], lambda d: f"SELECT src, {d.list_join('title', '; ', 'nth')} AS titles FROM ranked_edge JOIN node ON section = dst GROUP BY src"),
    "j04_existence_flags": (["node", "in_degree", "out_degree"], lambda d: "SELECT n.section, o.section IS NOT NULL AS has_forward, i.section IS NOT NULL AS has_reverse, (o.section IS NOT NULL OR i.section IS NOT NULL) AS is_clickable FROM node n LEFT JOIN out_degree o ON o.section = n.section LEFT JOIN in_degree i ON i.section = n.section"),
    "j05_semi": (["edge"], lambda d: "SELECT src, dst FROM edge WHERE dst IN (SELECT src FROM edge)"),
    "j06_anti": (["node", "edge"], lambda d: "SELECT section FROM node n WHERE NOT EXISTS (SELECT 1 FROM edge e WHERE e.src = n.section)"),
    "j08_forward_neighbours": (["edge", "doc"], lambda d: "SELECT e.src, n.section, n.text FROM edge e JOIN doc n ON n.section = e.dst"),
    "j09_reverse_neighbours": (["edge", "doc"], lambda d: "SELECT e.dst, n.section, n.header FROM edge e JOIN doc n ON n.section = e.src"),
    "j10_reference_context": (["ranked_edge", "doc"], lambda d: f"SELECT src, {d.list_join('substring(text, 1, 1000)', ' | ', 'nth')} AS context FROM ranked_edge JOIN doc ON section = dst WHERE nth <= 3 GROUP BY src"),
    "g01_inverted": (["edge"], lambda d: f"SELECT dst, {d.set_join('src')} AS cited_by, count(DISTINCT src) AS n FROM edge GROUP BY dst"),
    "g02_inverted_list": (["case_edge"], lambda d: f"SELECT dst, {d.list_join('CAST(src AS STRING)', ',', 'src')} AS cited_by FROM case_edge GROUP BY dst"),
    "g03_inbound": (["edge"], lambda d: "SELECT dst, count(*) AS n FROM edge GROUP BY dst"),
    "g04_corpus_summary": (["node", "out_degree"], lambda d: "SELECT count(*) AS total, count(o.section) AS with_refs, sum(coalesce(reference_count, 0)) * 1.0 AS total_refs, round(avg(coalesce(reference_count, 0)), 6) AS avg_refs, max(reference_count) AS max_refs FROM node n LEFT JOIN out_degree o ON o.section = n.section"),
    "g05_most_referenced": (["in_degree"], lambda d: "SELECT section FROM in_degree ORDER BY cited_by_count DESC, section LIMIT 1"),
    "g07_corpus_info": (["node", "edge"], lambda d: "SELECT (SELECT count(*) FROM node) AS total_sections, (SELECT count(DISTINCT src) FROM edge) AS sections_with_citations, (SELECT count(DISTINCT dst) FROM edge) AS cited_sections"),
    "g08_section_meta": (["doc", "out_degree"], lambda d: "SELECT d.section, d.title, coalesce(o.reference_count, 0) AS citation_count, coalesce(o.reference_count, 0) > 0 AS has_citations FROM doc d LEFT JOIN out_degree o ON o.section = d.section"),
    "g09_metrics": (["node", "in_degree", "out_degree"], lambda d: "SELECT n.section, coalesce(o.reference_count, 0) AS outgoing, coalesce(i.cited_by_count, 0) AS incoming, round(coalesce(i.cited_by_count, 0) + 0.1 * coalesce(o.reference_count, 0), 6) * 1e0 AS centrality FROM node n LEFT JOIN in_degree i ON i.section = n.section LEFT JOIN out_degree o ON o.section = n.section"),
    "g12_profile": (["courtcase"], lambda d: "SELECT reporter, court, count(*) AS n, min(substring(decision_date, 1, 4)) AS first_year, max(substring(decision_date, 1, 4)) AS last_year, count(DISTINCT court) AS courts FROM courtcase GROUP BY GROUPING SETS ((reporter), (court), (reporter, court))"),
    "g15_store_statistics": (["doc", "out_degree"], lambda d: "SELECT count(*) AS total, count(url) AS with_url, count(o.section) AS with_citations, round(avg(length(text)), 6) AS avg_chars FROM doc d LEFT JOIN out_degree o ON o.section = d.section"),
    "g16_degree_statistics": (["in_degree", "out_degree"], lambda d: "SELECT 'in' AS side, count(*) AS n, max(cited_by_count) AS most, min(cited_by_count) AS least, round(avg(cited_by_count), 6) AS mean FROM in_degree UNION ALL SELECT 'out', count(*), max(reference_count), min(reference_count), round(avg(reference_count), 6) FROM out_degree"),
    "g19_progress": (["events"], lambda d: "SELECT event_type, count(*) AS total, count(CASE WHEN value > 0 THEN 1 END) AS with_value FROM events GROUP BY event_type"),
    "g21_internal_external": (["edge"], lambda d: "SELECT count(CASE WHEN substring(src, 1, 2) = substring(dst, 1, 2) THEN 1 END) AS internal, count(CASE WHEN substring(src, 1, 2) <> substring(dst, 1, 2) THEN 1 END) AS external FROM edge"),
    "g22_reporter_breakdown": (["courtcase"], lambda d: hist(d, "reporter", "courtcase")),
    "w01_top_cited": (["in_degree", "doc"], lambda d: "SELECT d.section, d.title, i.cited_by_count FROM in_degree i JOIN doc d ON d.section = i.section ORDER BY cited_by_count DESC, d.section LIMIT 10"),
    "w04_last_wins": (["lineitem"], lambda d: "SELECT l_orderkey, l_partkey FROM (SELECT l_orderkey, l_partkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_partkey) AS rn FROM lineitem) x WHERE rn = 1"),
    "w05_first_per_group": (["ranked_edge"], lambda d: "SELECT src, dst, CAST(nth AS INT) AS nth FROM ranked_edge WHERE nth <= 3"),
    "w08_early_exit": (["doc"], lambda d: "SELECT section FROM doc WHERE contains(lower(text), 'tenant') ORDER BY section LIMIT 10"),
    "w09_recent": (["events"], lambda d: "SELECT event_id, event_type FROM events ORDER BY ts DESC, event_id LIMIT 5"),
}


def W(d, x: str) -> str:  # noqa: ANN001, N802
    return d.distinct_sorted(d.found(f"lower({x})", r"[^\s]+"))
