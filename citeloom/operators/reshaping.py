"""Projection, reshaping, filters and sources as plans: parse headers, count words, flatten cases, read and write."""

from __future__ import annotations

from citeloom.functions import rules

WORDS = r"[^\s]+"


def parsed(d):  # noqa: ANN001, ANN201
    sep = d.rx("[|]") if d.name == "spark" else "'|'"
    return f"SELECT section, trim(replace(replace({d.at(f'split(header, {sep})', 0)}, 'Section ', ''), 'Rule ', '')) AS id, trim({d.at(f'split(header, {sep})', 1)}) AS parsed_title FROM doc WHERE contains(header, '|')"


PLANS = {
    "s10_html_extract": (["pages"], lambda d: f"SELECT page_id, {d.at(d.found('html', '(?s)<h1>(.*?)</h1>', 1), 0)} AS heading, {d.size(d.found('html', '<p>'))} AS n_paragraphs FROM pages"),
    "s11_link_frontier": (["pages"], lambda d: f"SELECT link, count(DISTINCT page_id) AS n_pages FROM (SELECT page_id, {d.each(d.found('html', 'href=\"([^\"]+)\"', 1))} AS link FROM pages) x WHERE link LIKE '/%' GROUP BY link"),
    "s16_point_get": (["doc"], lambda d: "SELECT section, header, url FROM doc WHERE section = (SELECT min(section) FROM doc)"),
    "s17_cursor_scan": (["doc"], lambda d: "SELECT section, length(text) AS n_chars FROM doc ORDER BY section"),
    "s18_sample_first": (["doc"], lambda d: "SELECT section, header FROM doc ORDER BY section LIMIT 5"),
    "o01_header_parse": (["doc"], parsed),
    "o02_constitution_header": (["node"], lambda d: "SELECT section, replace(replace(replace('Article I, Section ' || section, 'Article ', ''), ', Section ', '.'), ' ', '') AS id FROM node"),
    "o03_mapping_id": (["doc"], lambda d: f"SELECT section, {d.at(d.found('header', r'Section\s+(\d+\.\d+)', 1), 0)} AS id FROM doc WHERE {d.has('header', r'Section\s+\d+\.\d+')}"),
    "o04_case_id": (["courtcase"], lambda d: "SELECT case_id, coalesce('case_' || CAST(case_id AS STRING), replace(replace(name, ' ', '_'), '.', '')) AS identifier FROM courtcase"),
    "o05_text_stats": (["documents"], lambda d: f"SELECT doc_id, {d.size(d.found('text', WORDS))} AS word_count, {d.size('split(text, chr(10))')} AS paragraph_count, CAST(length(text) AS INT) AS n_code_points FROM documents"),
    "o07_flatten": (["doc"], lambda d: "SELECT section, header || ' ' || replace(text, chr(10), ' ') AS content FROM doc"),
    "o09_case_flatten": (["courtcase"], lambda d: "SELECT CAST(case_id AS STRING) AS case_id, name, decision_date, reporter, court, word_count, CAST(length(opinion) AS INT) AS char_count, n_cites AS citation_count, rank_raw FROM courtcase"),
    "o10_official_citation": (["courtcase"], lambda d: f"SELECT case_id, coalesce({d.at(d.found('opinion', r'\d{4}-Ohio-\d+'), 0)}, {d.at(d.found('opinion', r'\d+ Ohio [A-Za-z.]+ \d[a-z]+ \d+'), 0)}, '') AS cite FROM courtcase"),
    "o11_opinion_text": (["courtcase"], lambda d: "SELECT o_custkey, " + d.list_join("'[MAJORITY - court]' || chr(10) || opinion", "\\n\\n" if d.name == "spark" else "\n\n", "case_id") + " AS opinions FROM courtcase WHERE trim(opinion) <> '' GROUP BY o_custkey"),
    "o15_quality_predicate": (["courtcase"], lambda d: f"SELECT case_id, {rules.keeps_case('word_count', 'rank_raw', 'CAST(substring(decision_date, 1, 4) AS INT)', 'n_cites')} AS kept FROM courtcase"),
    "o16_reject_reason": (["courtcase"], lambda d: f"SELECT case_id, {rules.why_rejected('word_count', 'rank_raw', 'CAST(substring(decision_date, 1, 4) AS INT)', 'n_cites')} AS reason FROM courtcase"),
    "o18_valid_links": (["pages"], lambda d: "SELECT page_id, url FROM pages WHERE url IS NOT NULL AND NOT starts_with(url, 'javascript:') AND NOT contains(url, '#')" if d.name == "duck" else "SELECT page_id, url FROM pages WHERE url IS NOT NULL AND NOT startswith(url, 'javascript:') AND NOT contains(url, '#')"),
    "o72_document_hash": (["documents"], lambda d: f"SELECT doc_id, {d.sha256('text')} AS sha, md5(text) AS md, substring({d.sha256('source')}, 1, 16) AS short FROM documents"),
    "w11_numeric_sort": (["documents"], lambda d: "SELECT source, CAST(substring(source, 4) AS INT) AS n FROM (SELECT DISTINCT source FROM documents) x ORDER BY n"),
    "w12_page_count": (["courtcase"], lambda d: "SELECT reporter, CAST(greatest(1, ceil(count(*) / 50.0)) AS INT) AS pages FROM courtcase GROUP BY reporter"),
}
