"""Range lookups, classes and scores."""

from __future__ import annotations

from citeloom.functions import fixed, rules

CHAPTER = "CAST(floor(CAST(section AS DOUBLE)) AS INT)"


def dpart(name: str = "court") -> str:
    ordinals = ["first", "second", "third", "fourth", "fifth", "sixth", "seventh", "eighth", "ninth", "tenth", "eleventh", "twelfth"]
    return rules.cases([(f"contains(lower({name}), '{w} appellate')", f"'{i:02d}'") for i, w in enumerate(ordinals, 1)], "NULL")


def county(d, name: str = "court") -> str:  # noqa: ANN001
    return d.at(d.found(name, r"^([A-Z][a-z]+) County", 1), 0)


def placed(d) -> str:  # noqa: ANN001
    """Courts with kind, level and district."""
    return f"(SELECT c.court_key, c.court, {rules.court_kind('c.court')} AS kind, {rules.court_level('c.court')} AS level, coalesce({dpart('c.court')}, k.district) AS district FROM court c LEFT JOIN (SELECT * FROM (VALUES {rules.county_rows()}) AS v(county, district)) k ON k.county = {county(d, 'c.court')})"


PLANS = {
    "o37_title_scope": (["doc"], lambda d: "SELECT section FROM doc WHERE section LIKE '1%' AND CAST(replace(section, '.', '') AS DOUBLE) BETWEEN 10000 AND 199999"),
    "o38_chapter_title": (["node"], lambda d: f"SELECT n.section, coalesce(t.title, 'Unknown Title (Chapter ' || CAST(n.chapter AS STRING) || ')') AS title FROM (SELECT section, {CHAPTER} AS chapter FROM node) n LEFT JOIN (SELECT * FROM (VALUES {rules.title_rows(d)}) AS v(lo, hi, title)) t ON n.chapter >= t.lo AND n.chapter < t.hi"),
    "o40_rule_agency": (["rule"], lambda d: f"SELECT rule_id, coalesce(agency, 'State Agency (Unknown)') AS agency FROM (SELECT r.rule_id, a.agency, row_number() OVER (PARTITION BY r.s_suppkey ORDER BY a.nth) AS rn FROM rule r LEFT JOIN (SELECT * FROM (VALUES {rules.agency_rows(d)}) AS v(nth, lo, hi, agency)) a ON r.chapter >= a.lo AND r.chapter < a.hi) x WHERE rn = 1"),
    "o41_rule_type": (["rule"], lambda d: f"SELECT rule_id, {rules.rule_type('chapter')} AS rule_type FROM rule"),
    "o43_court_level": (["court"], lambda d: f"SELECT court_key, {rules.court_kind('court')} AS kind, {rules.court_level('court')} AS level FROM court"),
    "o44_district": (["court"], lambda d: f"SELECT court_key, district FROM {placed(d)} p"),
    "o45_county": (["court"], lambda d: f"SELECT court_key, {county(d)} AS county FROM court"),
    "o46_routing_path": (["courtcase"], lambda d: f"SELECT case_id, {rules.court_kind('court')} || '/' || lower(replace(replace(court, ' ', '-'), ',', '')) || '/' || substring(decision_date, 1, 4) AS path FROM courtcase"),
    "o47_precedent": (["court"], lambda d: f"SELECT a.court_key AS citing, b.court_key AS cited, {rules.authority('a.kind', 'a.level', 'b.kind', 'b.level', 'a.district', 'b.district')} AS authority FROM {placed(d)} a JOIN {placed(d)} b ON a.court_key <> b.court_key"),
    "o48_case_flags": (["courtcase"], lambda d: f"SELECT case_id, {rules.court_kind('court')} = 'supreme' AS is_supreme_court, {rules.court_kind('court')} = 'appeals' AS is_appellate, contains({rules.court_kind('court')}, 'federal') AS is_federal, substring(decision_date, 1, 4) AS year FROM courtcase"),
    "o49_case_subjects": (["courtcase"], lambda d: "SELECT case_id, coalesce(nullif(concat_ws(',', " + ", ".join(f"CASE WHEN {d.has('lower(name)', rules.any_pattern(p))} OR {d.has('lower(substring(opinion, 1, 1000))', rules.any_pattern(p))} THEN '{k}' END" for k, p in fixed.CASE_CLASSES.items()) + "), ''), 'general') AS subjects FROM courtcase"),
    "o50_roman": (["node"], lambda d: "SELECT section, " + rules.cases([(f"r = '{n}'", str(i)) for i, n in enumerate("I II III IV V VI VII VIII IX X XI XII XIII XIV XV XVI XVII XVIII XIX".split(), 1)], "0") + " AS n FROM (SELECT section, CASE p_size % 4 WHEN 0 THEN 'IV' WHEN 1 THEN 'XIX' WHEN 2 THEN 'I' ELSE 'Q' END AS r FROM node) x"),
    "o51_statute_summary": (["doc"], lambda d: f"SELECT section, {rules.summary('title')} AS summary FROM doc"),
    "o52_provision_summary": (["doc"], lambda d: f"SELECT section, {rules.provision_summary('title')} AS summary FROM doc"),
    "o53_case_summary": (["courtcase"], lambda d: f"SELECT case_id, {rules.case_summary(d, 'name')} AS summary FROM courtcase"),
    "o54_legal_type": (["doc"], lambda d: f"SELECT section, {rules.legal_type('text', 'header')} AS legal_type FROM doc"),
    "o55_case_type": (["courtcase"], lambda d: f"SELECT case_id, {rules.case_type('opinion')} AS legal_type FROM courtcase"),
    "o57_case_areas": (["courtcase"], lambda d: f"SELECT case_id, coalesce(nullif({rules.areas('lower(opinion)', fixed.CASE_AREAS, 2)}, ''), 'general') AS practice_areas FROM courtcase"),
    "o58_subject_matter": (["doc"], lambda d: f"SELECT section, {rules.areas('lower(text)', fixed.SUBJECTS, 1)} AS subjects FROM doc"),
    "o59_offense_level": (["doc"], lambda d: f"SELECT section, {rules.offense_level('text')} AS level FROM doc"),
    "o60_offense_degree": (["doc"], lambda d: f"SELECT section, {rules.offense_degree('text')} AS degree FROM doc"),
    "o63_case_complexity": (["courtcase"], lambda d: f"SELECT case_id, {rules.complexity('word_count', '1', 'n_cites', (5000, 2000, 500), (2, 1), (20, 10))} AS complexity FROM courtcase"),
    "o65_case_terms": (["courtcase"], lambda d: "SELECT case_id, concat_ws(',', lower(trim(" + d.at("split(" + d.at("split(name, ' v[.] ')" if d.name == "spark" else "split(name, ' v. ')", 1) + ", ',')", 0) + ")), " + ", ".join(f"CASE WHEN contains(lower(opinion), '{p}') THEN '{p}' END" for p in fixed.PHRASES) + ") AS terms FROM courtcase"),
    "o69_fallback_analysis": (["documents"], lambda d: f"SELECT doc_id, CAST(least({d.div('length(text)', '200')} + 3, 10) AS INT) AS complexity, {d.size(d.found('text', '[A-Z][a-z]+'))} AS n_capitalised FROM documents"),
    "o70_page_features": (["pages"], lambda d: f"SELECT page_id, CAST(length(html) AS INT) AS n_chars, {d.size(d.found('html', '<a '))} AS n_links, {d.size(d.found('html', '<img'))} AS n_images, contains(lower(html), '<form') AS has_form, contains(lower(html), 'captcha') AS has_captcha, {d.size(d.found('url', '/'))} AS depth FROM pages"),
    "o71_decisions": (["pages"], lambda d: f"SELECT page_id, CASE WHEN n_links > 8 AND n_chars < 4000 THEN 'navigate' WHEN n_chars > 1000 THEN 'extract' ELSE 'skip' END AS action, CASE WHEN n_links > 8 THEN 0.8 ELSE 0.6 END AS confidence, CAST(5 * power(2, n_links % 4) AS INT) AS retry_s FROM (SELECT page_id, length(html) AS n_chars, {d.size(d.found('html', '<a '))} AS n_links FROM pages) x"),
    "q14_derivations": (["courtcase"], lambda d: f"SELECT case_id, 'valid' AS treatment_status, CASE WHEN {rules.court_level('court')} >= 100 THEN 'high' WHEN {rules.court_level('court')} >= 60 THEN 'medium' ELSE 'low' END AS precedent_value FROM courtcase"),
}
