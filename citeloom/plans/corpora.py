"""Corpora derived from the driver's tables: statutes that cite each other, rules, and cases. As SQL for either dialect."""

from __future__ import annotations

from citeloom.plans.dialects import Spark

#: The 52,200 pairs of chapter and number repeat: each further round of keys has more digits behind its number, so that sections are unique.
SECTION = "printf('%d.%02d', 101 + ({k} * 37) % 5800, {k} % 90 + 1) || CASE WHEN {k} < 52200 THEN '' ELSE CAST(CAST(floor({k} / 52200.0) AS BIGINT) AS STRING) END"
#: Article numerals, by number from 1.
NUMERALS = "I II III IV V VI VII VIII IX X XI XII XIII XIV XV XVI XVII XVIII XIX".split()

#: Names of courts, as SQL over a place: every rule of routing has one. The form behind the last is a court without a name.
VENUES = [
    "'Supreme Court of Ohio'", "'Court of Appeals of Ohio, Eighth Appellate District'", "'Court of Appeals of Ohio'", "'Court of Claims of Ohio'", "place || ' County Circuit Court'", "'Ohio Circuit Court'", "'Third circuit Court'",
    "place || ' County Court of Common Pleas'", "'Court of Common Pleas'", "place || ' County Probate Court'", "'Court of Probate'", "place || ' County Juvenile Court'", "'Court for Juvenile Matters'", "place || ' Municipal Court'", "'Municipal Court'",
    "place || ' Police Court'", "'Superior Court of ' || place", "'City Superior Court'", "'United States Court of Appeals for the Sixth Circuit'", "'United States District Court for the Northern District of Ohio'",
    "'United States District Court for the Southern District of Ohio'", "'Supreme Court of the United States'", "'Ohio Board of Tax Appeals'", "'Public Utilities Commission of Ohio'", "'Ohio Civil Rights Commission'", "'Ohio State Racing Commission'",
    "'Supreme Court of Indiana'", "'Tribunal of ' || place", "place || ' County Court'",
]
PLACES = ["Cuyahoga", "Van Wert", "Union", "Springfield", "Hamilton"]


def relations(d: Spark) -> dict[str, tuple[list[str], str]]:
    """Name: (what it needs, SQL)."""
    sec = SECTION.format(k="p_partkey")
    day = "o_orderdate"
    return {
        "node": (
            ["part"],
            f"""SELECT p_partkey AS line_no, {sec} AS section, p_partkey, p_type, p_brand, p_size, p_retailprice,
            CASE p_partkey % 7 WHEN 0 THEN 'Definitions of ' WHEN 1 THEN 'Penalty for ' WHEN 2 THEN 'Filing procedure of ' WHEN 3 THEN 'Rights in ' WHEN 4 THEN 'Authority over ' ELSE '' END || p_name || '.' AS title FROM part""",
        ),
        "edge": (
            ["lineitem", "node"],
            """SELECT s.section AS src, t.section AS dst, min(a.l_linenumber) AS kind FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND b.l_linenumber = a.l_linenumber + 1
            JOIN node s ON s.p_partkey = a.l_partkey JOIN node t ON t.p_partkey = b.l_partkey WHERE a.l_partkey <> b.l_partkey GROUP BY s.section, t.section""",
        ),
        "cites": (
            ["edge"],
            f"""SELECT src, {d.list_join("sentence", " ", "dst", "sentence")} AS cited FROM (SELECT src, dst, CASE kind % 5 WHEN 0 THEN 'as defined in section ' || dst || ' of the Revised Code' WHEN 1 THEN 'pursuant to section ' || dst || ', and'
            WHEN 2 THEN 'sections ' || dst || ' to ' || dst || ' apply' WHEN 3 THEN 'superseded by section ' || dst || ' there' ELSE 'division (A) of section ' || dst || ' holds' END AS sentence FROM edge) x GROUP BY src""",
        ),
        "doc": (
            ["node", "cites"],
            """SELECT n.line_no, n.section, 'Section ' || n.section || '|' || n.title AS header, n.title, 'https://code.example.org/section-' || n.section AS url,
            CASE n.line_no % 4 WHEN 0 THEN 'Whoever violates this is guilty of an offense, a felony of the ' || CASE n.p_size % 5 WHEN 0 THEN 'first' WHEN 1 THEN 'second' WHEN 2 THEN 'third' WHEN 3 THEN 'fourth' ELSE 'fifth' END || ' degree.'
            WHEN 1 THEN 'As used in this section, "' || lower(n.p_type) || '" means property under a lease by a tenant and a landlord.' WHEN 2 THEN 'The department and its board adopt a rule by motion on a tax assessment and levy. A misdemeanor of the second degree.'
            ELSE 'An employer shall pay each employee a wage.' END || chr(10) || coalesce(c.cited, 'No reference.') AS text FROM node n LEFT JOIN cites c ON c.src = n.section""",
        ),
        "court": (
            ["nation"],
            """SELECT n_nationkey AS court_key, CASE n_nationkey % 9 WHEN 0 THEN 'Supreme Court of Ohio' WHEN 1 THEN 'Court of Appeals of Ohio, Eighth Appellate District' WHEN 2 THEN 'Hamilton County Municipal Court' WHEN 3 THEN 'Union County Court of Common Pleas'
            WHEN 4 THEN 'Supreme Court of the United States' WHEN 5 THEN 'United States District Court for the Northern District of Ohio' WHEN 6 THEN 'Court of Claims of Ohio' WHEN 7 THEN 'Franklin County Probate Court' ELSE 'Tribunal of ' || n_name END AS court FROM nation""",
        ),
        "courtcase": (
            ["orders", "court", "customer"],
            f"""SELECT o.o_orderkey AS case_id, 'State of Ohio v. Party ' || CAST(o.o_custkey AS STRING) || ', Appellant' AS name, c.court, substring(CAST({day} AS STRING), 1, 10) AS decision_date, CAST(floor(o.o_totalprice / 100) AS INT) % 3000 AS word_count,
            CAST(o.o_orderkey % 40 AS DOUBLE) / 64 * CASE WHEN o.o_orderkey % 3 = 0 THEN 0 ELSE 1 END AS rank_raw, o.o_orderkey % 5 AS n_cites, o.o_orderpriority AS reporter, o.o_custkey,
            CASE o.o_orderkey % 6 WHEN 0 THEN 'The judgment was affirmed in 2019-Ohio-' WHEN 1 THEN 'This was overruled in 2020-Ohio-' WHEN 2 THEN 'See, citing 12 Ohio St. 3d ' WHEN 3 THEN 'We distinguished it from 174 Ohio App. 2d ' WHEN 4 THEN 'Contrast 5 U.S. ' ELSE 'Reversing the sentence for negligence, 9 F. Supp. 2d ' END
            || CAST(o.o_orderkey % 97 + 1 AS STRING) || ' on the contract of the defendant.' AS opinion FROM orders o JOIN customer u ON u.c_custkey = o.o_custkey JOIN court c ON c.court_key = u.c_nationkey""",
        ),
        "case_edge": (
            ["courtcase"],
            "SELECT DISTINCT a.case_id AS src, b.case_id AS dst FROM courtcase a JOIN courtcase b ON a.o_custkey = b.o_custkey AND b.case_id <> a.case_id",
        ),
        "rule": (
            ["supplier", "node"],
            """SELECT s_suppkey, CAST(101 + (s_suppkey * 379) % 5800 AS STRING) || '-' || CAST(s_suppkey % 60 + 1 AS STRING) || '-' || printf('%02d', s_suppkey % 40) AS rule_id, 101 + (s_suppkey * 379) % 5800 AS chapter,
            'See rule ' || CAST(3701 + s_suppkey % 999 AS STRING) || '-17-01 and section ' || n.section || ' of the Revised Code.' || CASE s_suppkey % 3 WHEN 0 THEN ' O.A.C. 5101-2-09 applies, as does 119.03.' WHEN 1 THEN ' Ohio Administrative Code 4731:11:02 does not.' ELSE '' END AS text FROM supplier JOIN node n ON n.p_partkey = s_suppkey""",
        ),
        "provision": (
            ["part"],
            f"""SELECT p_partkey, numeral, number, 'Article ' || numeral || ', Section ' || CAST(number AS STRING) AS section_id, 'Article ' || numeral || ', Section ' || CAST(number AS STRING) || '|' || p_name AS header,
            CASE p_partkey % 9 WHEN 0 THEN 'No law shall restrain the liberty of speech or of the press.' WHEN 1 THEN 'All may worship; no person is compelled to attend.' WHEN 2 THEN 'No warrant shall issue but upon probable cause.' WHEN 3 THEN 'The right of trial by jury is inviolate.'
            WHEN 4 THEN 'Excessive bail is not required.' WHEN 5 THEN 'Private property is inviolate.' WHEN 6 THEN 'The people may petition the general assembly.' WHEN 7 THEN 'The governor sees that laws are executed.' ELSE 'Schools are thorough and efficient.' END
            || CASE p_partkey % 5 WHEN 0 THEN ' See Article IV, Section ' || CAST(p_size AS STRING) || ' and Article II Section 1.' WHEN 1 THEN ' Compare Art. VIII § ' || CAST(p_size AS STRING) || '.' WHEN 2 THEN ' As section ' || CAST(p_size AS STRING) || ' of article XII has it.' WHEN 3 THEN ' X.' || CAST(p_size AS STRING) || ' holds.' ELSE '' END AS text
            FROM (SELECT p_partkey, p_name, p_size, p_partkey % 22 + 1 AS number, CASE p_partkey % 20 {' '.join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(NUMERALS))} ELSE 'Q' END AS numeral FROM part) x""",
        ),
        "venue": (
            ["customer"],
            f"""SELECT c_custkey AS court_id, CASE form {' '.join(f"WHEN {i} THEN {v}" for i, v in enumerate(VENUES))} ELSE NULL END AS court FROM (SELECT c_custkey, c_custkey % {len(VENUES) + 1} AS form,
            CASE floor(c_custkey / {len(VENUES) + 1}e0) % {len(PLACES)} {' '.join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(PLACES))} END AS place FROM customer) x""",
        ),
        "opinion_row": (
            ["orders"],
            f"""SELECT case_id, nth, CASE (case_id + nth) % 4 WHEN 0 THEN 'majority' WHEN 1 THEN 'dissent' WHEN 2 THEN 'concurrence' END AS type, CASE (case_id + nth) % 3 WHEN 0 THEN 'Judge ' || CAST(o_custkey % 50 AS STRING) WHEN 1 THEN '' END AS author,
            CASE (case_id + 2 * nth) % 9 WHEN 0 THEN ' ' || chr(10) || ' ' WHEN 1 THEN NULL ELSE chr(10) || ' Opinion ' || CAST(nth AS STRING) || ' of "case" ' || CAST(case_id AS STRING) || '. ' END AS text
            FROM (SELECT o_orderkey AS case_id, o_custkey, {d.each(d.array('1', '2', '3'))} AS nth FROM orders) x WHERE nth <= case_id % 4 AND case_id % 11 <> 3""",
        ),
        "parallel_cite": (
            ["orders"],
            f"""SELECT case_id, nth, CASE (case_id + nth) % 3 WHEN 0 THEN 'official' WHEN 1 THEN 'parallel' END AS type, CAST(case_id % 90 + nth AS STRING) || ' Ohio St. 3d ' || CAST(case_id AS STRING) AS cite
            FROM (SELECT o_orderkey AS case_id, {d.each(d.array('1', '2', '3'))} AS nth FROM orders) x WHERE nth <= case_id % 4 AND case_id % 7 <> 5""",
        ),
        "case_ref": (
            ["lineitem"],
            f"""SELECT case_id, l_linenumber, l_partkey, l_suppkey, nth, CAST(l_suppkey % 100 AS STRING) || ' Ohio App. ' || CAST(l_partkey + nth AS STRING) AS cite, CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE l_partkey + nth END AS first_id,
            CASE WHEN l_partkey % 5 <> 0 AND l_suppkey % 2 = 0 THEN l_suppkey END AS second_id, CASE WHEN l_suppkey % 4 <> 0 THEN 'reporters:state' END AS category
            FROM (SELECT l_orderkey AS case_id, l_linenumber, l_partkey, l_suppkey, {d.each(d.array(*map(str, range(1, 8))))} AS nth FROM lineitem) x WHERE nth <= l_linenumber""",
        ),
        "ranked_edge": (["edge"], "SELECT src, dst, row_number() OVER (PARTITION BY src ORDER BY dst) AS nth FROM edge"),
        "in_degree": (["edge"], "SELECT dst AS section, count(*) AS cited_by_count FROM edge GROUP BY dst"),
        "out_degree": (["edge"], "SELECT src AS section, count(*) AS reference_count FROM edge GROUP BY src"),
    }


#: The driver's tables.
TABLES = {"region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"}


def prelude(d: Spark, needs: list[str], sf_dir: str | None = None) -> str:
    """The WITH clause for relations and, for Spark, the tables they read."""
    known, out = relations(d), []

    def add(name: str) -> None:
        if any(name == n for n, _ in out):
            return
        if name in known:
            for x in known[name][0]:
                add(x)
            out.append((name, f"{name} AS ({known[name][1]})"))
        elif sf_dir is not None:
            out.append((name, d.table(name, sf_dir)))

    for n in needs:
        add(n)
    return ("WITH " + ",\n".join(x for _, x in out) + "\n") if out else ""
