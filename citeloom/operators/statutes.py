"""Statutes: titles, scores, terms, searches and last-wins contexts. Each plan has an oracle written apart from it."""

from __future__ import annotations

from citeloom.functions import fixed, rules

CHAPTER = "CAST(floor(CAST(section AS DOUBLE)) AS INT)"
#: Practice areas that chapters add: (first, first after, area). Fixed values.
BY_CHAPTER = [(2900, 3000, "criminal_law"), (3100, 3200, "family_law"), (5500, 5800, "tax_law"), (1700, 1800, "business_law")]
STOPS = ", ".join(map(rules.lit, fixed.STOP_WORDS))
KEYWORD = "property"


def areas(d) -> str:  # noqa: ANN001
    """Areas by words, then those that the chapter adds, else general."""
    by_words = ", ".join(f"CASE WHEN {rules.word_count('lower(text)', words)} >= 2 THEN {rules.lit(k)} END" for k, words in fixed.AREAS.items())
    added = ", ".join(f"CASE WHEN {CHAPTER} >= {lo} AND {CHAPTER} < {hi} THEN {rules.lit(k)} END" for lo, hi, k in BY_CHAPTER)
    return f"coalesce(nullif(array_join(array_distinct(array_compact(array({by_words}, {added}))), ','), ''), 'general')"


def duck_areas() -> str:
    rows = ", ".join(f"({i}, {rules.lit(k)}, {rules.lit(w)})" for i, (k, words) in enumerate(fixed.AREAS.items()) for w in words)
    added = " UNION ALL ".join(f"SELECT section, {100 + i}, '{k}' FROM doc WHERE floor(section::DOUBLE) BETWEEN {lo} AND {hi - 1}" for i, (lo, hi, k) in enumerate(BY_CHAPTER))
    return f"""hits AS (SELECT section, nth, area FROM (SELECT d.section, k.nth, k.area, count(*) AS n FROM doc d JOIN (VALUES {rows}) AS k(nth, area, word) ON strpos(lower(d.text), k.word) > 0 GROUP BY ALL) x WHERE n >= 2 UNION ALL {added}),
    placed AS (SELECT section, area, min(nth) AS nth FROM hits GROUP BY ALL), area AS (SELECT d.section, coalesce(string_agg(p.area, ',' ORDER BY p.nth), 'general') AS practice_areas FROM doc d LEFT JOIN placed p ON p.section = d.section GROUP BY d.section)"""


SCORE = rules.complexity("w", "p", "c", (1000, 500, 100), (15, 10), (10, 5))
MEASURED = "(SELECT d.section, d.text, d.header, d.title, size(regexp_extract_all(d.text, r'[^\\s]+', 0)) AS w, size(split(d.text, chr(10))) AS p, coalesce(o.reference_count, 0) AS c FROM doc d LEFT JOIN out_degree o ON o.section = d.section) x"
DUCK_SCORE = """score AS (SELECT d.section, greatest(1, least(10, 5 + CASE WHEN w > 1000 THEN 2 WHEN w > 500 THEN 1 WHEN w < 100 THEN -1 ELSE 0 END + CASE WHEN p > 15 THEN 2 WHEN p > 10 THEN 1 ELSE 0 END + CASE WHEN c > 10 THEN 2 WHEN c > 5 THEN 1 WHEN c = 0 THEN -1 ELSE 0 END))::INTEGER AS complexity
    FROM (SELECT section, len(regexp_split_to_array(trim(replace(text, chr(10), ' ')), '\\s+')) AS w, len(text) - len(replace(text, chr(10), '')) + 1 AS p, (SELECT count(*) FROM edge e WHERE e.src = doc.section) AS c FROM doc) d)"""
TERMS = f"""slice(array_distinct(concat(filter(split(lower(trim(get(split(header, '[|]'), 1))), r'[,;.\\s-]+'), w -> length(w) > 3 AND w NOT IN ({STOPS})), transform(filter(regexp_extract_all(text, '"([^"]+)"', 1), q -> length(q) < 30), q -> lower(q)),
    transform(filter(regexp_extract_all(substring(text, 1, 500), r'\\b([A-Z][a-z]+(?:\\s+[A-Z][a-z]+)*)\\b', 1), q -> length(q) > 5), q -> lower(q)))), 1, 10)"""
DUCK_TERMS = f"""all_terms AS (SELECT section, 1 AS part, generate_subscripts(l, 1) AS i, unnest(l) AS t FROM (SELECT section, regexp_split_to_array(lower(trim(string_split(header, '|')[2])), '[,;.\\s-]+') AS l FROM doc) x
    UNION ALL SELECT section, 2, generate_subscripts(l, 1), unnest(l) FROM (SELECT section, regexp_extract_all(text, '"([^"]+)"', 1) AS l FROM doc) x UNION ALL SELECT section, 3, generate_subscripts(l, 1), unnest(l) FROM (SELECT section, regexp_extract_all(text[1:500], '\\b[A-Z][a-z]+(?:\\s+[A-Z][a-z]+)*\\b') AS l FROM doc) x),
    wanted AS (SELECT section, lower(t) AS t, min((part, i)) AS spot FROM all_terms WHERE (part = 1 AND len(t) > 3 AND t NOT IN ({STOPS})) OR (part = 2 AND len(t) < 30) OR (part = 3 AND len(t) > 5) GROUP BY section, lower(t)),
    first_ten AS (SELECT *, row_number() OVER (PARTITION BY section ORDER BY spot) AS n FROM wanted)
    SELECT d.section, coalesce(string_agg(f.t, ';' ORDER BY f.n), '') AS terms FROM doc d LEFT JOIN first_ten f ON f.section = d.section AND f.n <= 10 GROUP BY d.section"""
PAIRS = "FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND b.l_linenumber = a.l_linenumber + 1 JOIN node s ON s.p_partkey = a.l_partkey JOIN node t ON t.p_partkey = b.l_partkey WHERE a.l_partkey <> b.l_partkey"
CONTEXT = "substring('cited by line ' || CAST(a.l_linenumber AS STRING) || ' of order ' || CAST(a.l_orderkey AS STRING), 1, 100)"
RELATION = "CASE a.l_linenumber % 3 WHEN 0 THEN 'defines' WHEN 1 THEN 'amended_by' ELSE 'superseded_by' END"

#: Name: (relations, plan, oracle).
PAIRED = {
    "o27_context_last_wins": (
        ["node", "edge", "lineitem"],
        lambda d: f"""SELECT e.src, e.dst, coalesce(c.last.relationship, 'cross_reference') AS relationship, coalesce(c.last.context, '') AS context, coalesce(c.last.at, 0) AS position FROM edge e LEFT JOIN (SELECT s.section AS src, t.section AS dst,
        max(struct(CAST(a.l_orderkey AS BIGINT) AS at, CAST(a.l_linenumber AS BIGINT) AS line, {RELATION} AS relationship, {CONTEXT} AS context)) AS last {PAIRS} AND a.l_returnflag <> 'R' GROUP BY s.section, t.section) c ON c.src = e.src AND c.dst = e.dst""",
        f"""SELECT e.src, e.dst, coalesce(c.relationship, 'cross_reference') AS relationship, coalesce(c.context, '') AS context, coalesce(c.at, 0)::BIGINT AS position FROM edge e LEFT JOIN (SELECT * FROM (SELECT s.section AS src, t.section AS dst, {RELATION} AS relationship, {CONTEXT} AS context, a.l_orderkey AS at,
        row_number() OVER (PARTITION BY s.section, t.section ORDER BY a.l_orderkey DESC, a.l_linenumber DESC) AS rn {PAIRS} AND a.l_returnflag <> 'R') y WHERE rn = 1) c ON c.src = e.src AND c.dst = e.dst""",
    ),
    "o39_title_ladder": (
        ["node"], lambda d: "SELECT section, CASE WHEN n <= 27 THEN 'Title ' || CAST(n | 1 AS STRING) WHEN n % 2 = 1 AND n <= 59 THEN 'Title ' || CAST(n AS STRING) END AS title FROM (SELECT section, CAST(substring(substring_index(section, '.', 1), 1, 2) AS INT) AS n FROM node) x",
        "SELECT section, 'Title ' || CASE WHEN n <= 27 THEN (SELECT min(b) FROM range(1, 28, 2) r(b) WHERE b >= n) WHEN n IN (29, 31, 33, 35, 37, 39, 41, 43, 45, 47, 49, 51, 53, 55, 57, 59) THEN n END::VARCHAR AS title FROM (SELECT section, left(split_part(section, '.', 1), 2)::BIGINT AS n FROM node) x",
    ),
    "o56_practice_areas": (["doc"], lambda d: f"SELECT section, {areas(d)} AS practice_areas FROM doc", lambda: f", {duck_areas()} SELECT section, practice_areas FROM area"),
    "o61_statute_complexity": (["doc", "out_degree"], lambda d: f"SELECT section, {SCORE} AS complexity FROM {MEASURED}", f", {DUCK_SCORE} SELECT section, complexity FROM score"),
    "o64_key_terms": (["doc"], lambda d: f"SELECT section, array_join({TERMS}, ';') AS terms FROM doc", f", {DUCK_TERMS}"),
    "o68_enrichment": (
        ["doc", "out_degree"], lambda d: f"SELECT section, {rules.summary('title')} AS summary, {rules.legal_type('text', 'header')} AS legal_type, {areas(d)} AS practice_areas, {SCORE} AS complexity, array_join({TERMS}, ';') AS terms, CASE WHEN {rules.legal_type('text', 'header')} = 'criminal_statute' THEN {rules.offense_level('text')} END AS offense_level FROM {MEASURED}",
        lambda: f", {DUCK_SCORE}, {duck_areas()}, terms AS (WITH {DUCK_TERMS[DUCK_TERMS.index('all_terms'):]}) SELECT d.section, {rules.summary('d.title')} AS summary, {rules.legal_type('d.text', 'd.header')} AS legal_type, a.practice_areas, s.complexity, t.terms, CASE WHEN {rules.legal_type('d.text', 'd.header')} = 'criminal_statute' THEN {rules.offense_level('d.text')} END AS offense_level FROM doc d JOIN area a USING (section) JOIN score s USING (section) JOIN terms t USING (section)",
    ),
    "j02_citing": (
        ["edge", "doc"],
        lambda d: f"SELECT e.dst, {d.set_join('e.src')} AS cited_by, count(*) AS n, count(t.section) AS n_details, {d.set_join('t.title')} AS titles FROM edge e LEFT JOIN (SELECT section, title FROM doc WHERE title NOT LIKE 'Penalty%') t ON t.section = e.src GROUP BY e.dst",
        "SELECT dst, string_agg(DISTINCT src, ',' ORDER BY src) AS cited_by, count(*) AS n, coalesce(sum(CASE WHEN title IS NULL THEN 0 ELSE 1 END), 0)::BIGINT AS n_details, coalesce(string_agg(DISTINCT title, ',' ORDER BY title), '') AS titles FROM (SELECT dst, src, (SELECT title FROM doc WHERE section = src AND title NOT LIKE 'Penalty%') AS title FROM edge) x GROUP BY dst",
    ),
    "j07_pair_relation": (
        ["edge", "node"],
        lambda d: "SELECT p.a, p.b, CASE WHEN f.src IS NOT NULL AND r.src IS NOT NULL THEN 'mutual' WHEN f.src IS NOT NULL THEN 'a_cites_b' WHEN r.src IS NOT NULL THEN 'b_cites_a' ELSE 'none' END AS relation FROM (SELECT least(src, dst) AS a, greatest(src, dst) AS b FROM edge UNION SELECT least(m.section, n.section), greatest(m.section, n.section) FROM node m JOIN node n ON n.line_no = m.line_no + 1) p LEFT JOIN edge f ON f.src = p.a AND f.dst = p.b LEFT JOIN edge r ON r.src = p.b AND r.dst = p.a",
        "SELECT a, b, CASE count(DISTINCT way) FILTER (way <> 'none') WHEN 2 THEN 'mutual' WHEN 0 THEN 'none' ELSE max(way) FILTER (way <> 'none') END AS relation FROM (SELECT least(src, dst) AS a, greatest(src, dst) AS b, CASE WHEN src < dst THEN 'a_cites_b' ELSE 'b_cites_a' END AS way FROM edge UNION ALL SELECT least(m.section, n.section), greatest(m.section, n.section), 'none' FROM node m JOIN node n ON n.line_no = m.line_no + 1) x GROUP BY a, b",
    ),
    "j12_event_history": (
        ["events"], lambda d: "SELECT event_id, CAST(least(earlier, 1000) AS BIGINT) AS n_before FROM (SELECT event_id, rank() OVER (PARTITION BY user_id, event_type ORDER BY ts) - 1 AS earlier FROM events WHERE ts IS NOT NULL AND user_id IS NOT NULL AND event_type IS NOT NULL) x WHERE earlier > 0",
        "SELECT a.event_id, least(count(*), 1000)::BIGINT AS n_before FROM events a JOIN events b ON a.user_id = b.user_id AND a.event_type = b.event_type AND b.ts < a.ts GROUP BY a.event_id",
    ),
    "n03_paths": (
        ["node", "edge", "ranked_edge"],
        lambda d: """, five AS (SELECT src, dst FROM ranked_edge WHERE nth <= 5), leaf AS (SELECT section FROM node n WHERE NOT EXISTS (SELECT 1 FROM edge e WHERE e.src = n.section)),
        p1 AS (SELECT src AS a, dst AS b FROM five), p2 AS (SELECT a, b, dst AS c FROM p1 JOIN five ON src = b WHERE dst <> a AND dst <> b), p3 AS (SELECT a, b, c, dst AS e FROM p2 JOIN five ON src = c WHERE dst <> a AND dst <> b AND dst <> c)
        SELECT a || '>' || b AS path FROM p1 LEFT SEMI JOIN leaf ON section = b UNION ALL SELECT a || '>' || b || '>' || c FROM p2 LEFT SEMI JOIN leaf ON section = c UNION ALL SELECT a || '>' || b || '>' || c || '>' || e FROM p3""",
    """, five AS (SELECT src, dst FROM ranked_edge WHERE nth <= 5), walk AS (WITH RECURSIVE w(trail) AS (SELECT [src, dst] FROM five UNION ALL SELECT list_append(trail, dst) FROM w JOIN five ON src = trail[-1] WHERE len(trail) < 4 AND NOT list_contains(trail, dst)) SELECT trail FROM w)
    SELECT array_to_string(trail, '>') AS path FROM walk WHERE len(trail) = 4 OR trail[-1] NOT IN (SELECT src FROM edge)""",
    ),
    "n15_foundational": (
        ["in_degree"],
        lambda d: "SELECT i.section, CAST(h.impact AS INT) AS impact FROM in_degree i JOIN (SELECT cited_by_count, ceil(10e0 * sum(n) OVER (ORDER BY cited_by_count) / sum(n) OVER ()) AS impact FROM (SELECT cited_by_count, count(*) AS n FROM in_degree GROUP BY cited_by_count) x) h ON h.cited_by_count = i.cited_by_count WHERE h.impact > 7",
        "SELECT section, ceil(10e0 * cume_dist() OVER (ORDER BY cited_by_count))::INTEGER AS impact FROM in_degree QUALIFY ceil(10e0 * cume_dist() OVER (ORDER BY cited_by_count)) > 7",
    ),
    "w06_sequence_ids": (
        ["out_degree"],
        lambda d: f""", chosen AS (SELECT section, {CHAPTER} AS chapter FROM out_degree WHERE reference_count >= 3), starts AS (SELECT chapter, coalesce(sum(n) OVER (ORDER BY chapter ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM (SELECT chapter, count(*) AS n FROM chosen GROUP BY chapter) x)
        SELECT section, 'complex_' || CAST(start + row_number() OVER (PARTITION BY c.chapter ORDER BY section) - 1 AS STRING) AS chain_id FROM chosen c JOIN starts s ON s.chapter = c.chapter""",
        "SELECT section, 'complex_' || (row_number() OVER (ORDER BY floor(section::DOUBLE), section) - 1)::VARCHAR AS chain_id FROM out_degree WHERE reference_count >= 3",
    ),
    "q02_keyword_search": (
        ["doc"], lambda d: f"SELECT section, title, url, CASE WHEN contains(lower(title), lower('{KEYWORD}')) THEN 'title' ELSE 'text' END AS relevance, substring(text, 1, 200) || '...' AS preview FROM doc WHERE contains(lower(title), lower('{KEYWORD}')) OR contains(lower(text), lower('{KEYWORD}')) ORDER BY section LIMIT 10",
        f"SELECT section, title, url, CASE WHEN title ILIKE '%{KEYWORD}%' THEN 'title' ELSE 'text' END AS relevance, text[1:200] || '...' AS preview FROM doc WHERE title ILIKE '%{KEYWORD}%' OR text ILIKE '%{KEYWORD}%' ORDER BY section LIMIT 10",
    ),
    "w10_train_eval_split": (
        ["conversations"], lambda d: "SELECT conv_id, CASE WHEN CAST(conv(substring(md5(CAST(conv_id AS STRING)), 1, 8), 16, 10) AS BIGINT) % 10 = 0 THEN 'eval' ELSE 'train' END AS part FROM conversations GROUP BY conv_id",
        "SELECT DISTINCT conv_id, CASE WHEN right((('0x' || left(md5(conv_id::VARCHAR), 8))::BIGINT)::VARCHAR, 1) = '0' THEN 'eval' ELSE 'train' END AS part FROM conversations",
    ),
}
