"""Fixed values of the legal corpora: names, keywords, limits and patterns."""

# Words that mark a criminal text, for statutes and (with the further ones) for cases.
CRIMINAL = ["felony", "misdemeanor", "imprisonment", "imprisoned", "convicted", "guilty", "offense", "violation", "penalty"]
CRIMINAL_CASE = [*CRIMINAL, "defendant", "prosecution", "sentence", "criminal"]
# Keywords of practice areas.
AREAS = {
    "criminal_law": ["felony", "misdemeanor", "imprisonment", "convicted", "offense", "guilty", "crime", "criminal", "penal", "defendant", "prosecution", "sentence", "jail", "prison", "punish"],
    "family_law": ["marriage", "divorce", "custody", "child support", "adoption", "spouse", "parent", "guardian", "domestic", "alimony", "visitation"],
    "property_law": ["property", "real estate", "conveyance", "deed", "mortgage", "landlord", "tenant", "lease", "title", "easement", "lien"],
    "business_law": ["corporation", "llc", "partnership", "business", "commercial", "contract", "enterprise", "company", "shareholder", "entity"],
    "tax_law": ["tax", "revenue", "assessment", "levy", "taxation", "taxable", "income tax", "sales tax", "property tax"],
    "employment_law": ["employment", "employee", "employer", "workplace", "labor", "wage", "worker", "compensation", "unemployment", "benefits"],
    "administrative_law": ["agency", "regulation", "administrative", "rule", "board", "commission", "department", "licensing", "permit"],
    "civil_procedure": ["complaint", "summons", "pleading", "discovery", "trial", "judgment", "appeal", "motion", "filing"],
}
CASE_AREAS = {
    **AREAS,
    "constitutional_law": ["constitutional", "amendment", "due process", "equal protection", "first amendment", "fourth amendment", "rights"],
    "tort_law": ["negligence", "damages", "liability", "injury", "tort", "personal injury", "wrongful death", "malpractice"],
}
# Subjects of constitutional provisions.
SUBJECTS = {
    "fundamental_rights": ["rights", "liberty", "freedom", "equality", "justice", "free", "independent", "inalienable", "protect"],
    "voting_elections": ["election", "vote", "ballot", "suffrage", "voter", "elect", "electoral", "candidate", "poll"],
    "judicial_system": ["court", "judge", "justice", "judicial", "trial", "jury", "judgment", "appeal", "supreme court"],
    "legislative_process": ["general assembly", "legislature", "bill", "law", "senate", "house", "representatives", "enact"],
    "executive_powers": ["governor", "executive", "veto", "appointment", "pardon", "command", "enforce"],
    "education": ["school", "education", "educational", "university", "college", "instruction", "learning", "teacher"],
    "taxation_finance": ["tax", "revenue", "debt", "fiscal", "appropriation", "treasury", "fund", "levy", "assessment"],
    "local_government": ["municipal", "county", "township", "city", "local", "home rule", "charter", "corporation"],
    "amendments": ["amend", "amendment", "revision", "constitution", "propose", "ratify", "convention"],
}
# Fixed values: (first chapter, first chapter after, title).
TITLES = [
    (101, 200, "Title 1 - General Provisions"),
    (301, 400, "Title 3 - State Government"),
    (501, 600, "Title 5 - Townships"),
    (701, 800, "Title 7 - Municipal Corporations"),
    (901, 1000, "Title 9 - Agriculture-Animals-Fences"),
    (1101, 1200, "Title 11 - Banks-Savings and Loan Associations"),
    (1301, 1400, "Title 13 - Commercial Transactions"),
    (1501, 1600, "Title 15 - Conservation of Natural Resources"),
    (1701, 1800, "Title 17 - Corporations-Partnerships"),
    (1901, 2000, "Title 19 - Courts-Municipal-Mayor's-County"),
    (2101, 2200, "Title 21 - Courts-Probate-Juvenile"),
    (2301, 2400, "Title 23 - Courts-Common Pleas"),
    (2501, 2600, "Title 25 - Courts-Appellate"),
    (2701, 2800, "Title 27 - Courts-General Provisions-Special Remedies"),
    (2901, 3000, "Title 29 - Crimes-Procedure"),
    (3101, 3200, "Title 31 - Domestic Relations-Children"),
    (3301, 3400, "Title 33 - Education-Libraries"),
    (3501, 3600, "Title 35 - Elections"),
    (3701, 3800, "Title 37 - Health-Safety-Morals"),
    (3901, 4000, "Title 39 - Insurance"),
    (4101, 4200, "Title 41 - Labor and Industry"),
    (4301, 4400, "Title 43 - Liquor"),
    (4501, 4600, "Title 45 - Motor Vehicles-Aeronautics-Watercraft"),
    (4701, 4800, "Title 47 - Occupations-Professions"),
    (4901, 5000, "Title 49 - Public Utilities"),
    (5101, 5200, "Title 51 - Public Welfare"),
    (5301, 5400, "Title 53 - Real Property"),
    (5501, 5600, "Title 55 - Roads-Highways-Bridges"),
    (5701, 5800, "Title 57 - Taxation"),
    (5801, 5900, "Title 58 - Trusts"),
    (5901, 6000, "Title 59 - Veterans-Military Affairs"),
    (6101, 6200, "Title 61 - Water Supply-Sanitation-Ditches"),
    (6301, 6400, "Title 63 - Workforce Development"),
]
# Fixed values: (first chapter, first chapter after, agency), where the first fit counts; ranges that lie wholly in an earlier one are left out.
AGENCIES = [
    (1, 100, "Legislative Service Commission (LSC)"), (101, 200, "Auditor of State (AUD)"), (3701, 3800, "Department of Health (ODH)"), (5101, 5200, "Department of Job and Family Services (ODJFS)"),
    (4723, 4730, "Board of Nursing (OBN)"), (4731, 4740, "State Medical Board (SMBO)"), (4755, 4760, "Board of Pharmacy (BOPHAR)"), (3301, 3400, "Department of Education (ODE)"), (1301, 1400, "Department of Commerce (COM)"),
    (1501, 1600, "Department of Natural Resources (ODNR)"), (1701, 1800, "Division of Securities (DOS)"), (4101, 4200, "Department of Industrial Compliance (DIC)"), (3901, 4000, "Department of Insurance (ODI)"),
    (4501, 4600, "Department of Public Safety (DPS)"), (5501, 5600, "Department of Transportation (ODOT)"), (901, 1000, "Department of Agriculture (ODA)"), (5703, 5750, "Department of Taxation (TAX)"),
    (4901, 5000, "Public Utilities Commission (PUCO)"), (4301, 4400, "Division of Liquor Control (DLC)"),
]
# Fixed values: (chapter ranges, type of rule), where the first fit counts.
RULE_TYPES = [
    ([(3700, 3800), (4700, 4800)], "Healthcare Licensing"), ([(5100, 5200)], "Social Services"), ([(3300, 3400)], "Education"), ([(3900, 4000)], "Insurance"), ([(4500, 4600), (5500, 5600)], "Transportation"),
    ([(1500, 1600)], "Environment"), ([(5700, 5750)], "Taxation"), ([(4900, 5000)], "Utilities"), ([(4100, 4200)], "Labor & Employment"),
]
# Counties of the appellate districts; the last district that names a county counts.
DISTRICTS = {
    "01": ["Butler", "Clermont", "Hamilton", "Warren"],
    "02": ["Champaign", "Clark", "Darke", "Greene", "Miami", "Montgomery", "Preble"],
    "03": ["Allen", "Auglaize", "Crawford", "Defiance", "Hancock", "Hardin", "Henry", "Logan", "Marion", "Mercer", "Paulding", "Putnam", "Shelby", "Union", "Van Wert", "Williams", "Wyandot"],
    "04": ["Adams", "Athens", "Gallia", "Highland", "Hocking", "Jackson", "Lawrence", "Meigs", "Pickaway", "Pike", "Ross", "Scioto", "Vinton", "Washington"],
    "05": ["Delaware", "Fairfield", "Franklin", "Knox", "Licking", "Madison", "Morrow", "Perry", "Richland", "Union"],
    "06": ["Erie", "Fulton", "Huron", "Lucas", "Ottawa", "Sandusky", "Williams", "Wood"],
    "07": ["Belmont", "Carroll", "Columbiana", "Harrison", "Jefferson", "Mahoning", "Monroe", "Noble"],
    "08": ["Cuyahoga"],
    "09": ["Lorain", "Medina", "Summit", "Wayne"],
    "10": ["Franklin"],
    "11": ["Ashtabula", "Geauga", "Lake", "Portage", "Trumbull"],
    "12": ["Brown", "Butler", "Clermont", "Clinton", "Fayette", "Madison", "Preble", "Warren"],
}
# Fixed values: (words that a court's name has, kind, authority), where the first fit counts.
COURTS = [
    (["supreme court of ohio"], "supreme", 100), (["supreme court", "united states"], "federal-supreme", 110), (["sixth circuit"], "federal-circuit", 90), (["district", "northern"], "federal-district", 70),
    (["district", "southern"], "federal-district", 70), (["court of appeals", "ohio"], "appeals", 80), (["court of claims"], "claims", 70), (["circuit court"], "circuit", 75), (["superior court"], "superior", 65),
    (["common pleas"], "common-pleas", 60), (["probate"], "probate", 50), (["juvenile"], "juvenile", 50), (["municipal court"], "municipal", 40), (["police court"], "municipal", 40), (["county court"], "county", 30), (["mayor"], "mayor", 20),
]
# Words of ordinals that name an appellate district, from 1.
ORDINALS = ["first", "second", "third", "fourth", "fifth", "sixth", "seventh", "eighth", "ninth", "tenth", "eleventh", "twelfth"]
# Directories of courts, where the first fit counts: words of the name without case, words as they are written, words that may not be there,
# the directory, what takes the place of * in it, the directory without that, and what counts as without.
ROUTES = [
    (["supreme court of ohio"], [], [], "supreme-court", None, None, []),
    (["court of appeals", "ohio"], [], [], "appeals-courts/district-*", "district", "appeals-courts/general", []),
    (["court of claims", "ohio"], [], [], "state-courts/court-of-claims", None, None, []),
    (["circuit court"], [], [], "historical-courts/circuit/*", "county", "historical-courts/circuit/general", ["ohio"]),
    ([], ["circuit", "Court"], [], "historical-courts/circuit/*", "county", "historical-courts/circuit/general", ["ohio"]),
    (["common pleas"], [], [], "county-courts/*/common-pleas", "county", "county-courts/unknown/common-pleas", []),
    (["probate"], [], [], "county-courts/*/probate", "county", "county-courts/unknown/probate", []),
    (["juvenile"], [], [], "county-courts/*/juvenile", "county", "county-courts/unknown/juvenile", []),
    (["municipal court"], [], [], "municipal-courts/*", "city", "municipal-courts/unknown", []),
    (["police court"], [], [], "municipal-courts/*", "city", "municipal-courts/unknown", []),
    (["superior court"], [], [], "historical-courts/superior/*", "city", "historical-courts/superior/general", []),
    (["united states", "sixth circuit"], [], [], "federal-courts/sixth-circuit", None, None, []),
    (["federal", "sixth circuit"], [], [], "federal-courts/sixth-circuit", None, None, []),
    (["united states", "northern district of ohio"], [], [], "federal-courts/district-northern", None, None, []),
    (["federal", "northern district of ohio"], [], [], "federal-courts/district-northern", None, None, []),
    (["united states", "southern district of ohio"], [], [], "federal-courts/district-southern", None, None, []),
    (["federal", "southern district of ohio"], [], [], "federal-courts/district-southern", None, None, []),
    (["united states"], [], [], "federal-courts/other", None, None, []),
    (["federal"], [], [], "federal-courts/other", None, None, []),
    (["tax appeals"], [], [], "state-agencies/board-of-tax-appeals", None, None, []),
    (["public utilities commission"], [], [], "state-agencies/public-utilities", None, None, []),
    (["civil rights commission"], [], [], "state-agencies/civil-rights", None, None, []),
    (["racing commission"], [], [], "state-agencies/racing", None, None, []),
    (["supreme court"], [], ["ohio"], "out-of-state/supreme-courts", None, None, []),
]
OTHER_ROUTE = "other-courts/miscellaneous"
# Words at which the name of a county or of a city ends, for a directory, and for the county of a court.
COUNTY_ENDS = ["county", "circuit", "court"]
CITY_ENDS = ["municipal", "city", "police"]
COURT_ENDS = ["county", "circuit", "court", "common", "pleas", "probate", "juvenile", "municipal"]
# Subject classes of cases and their patterns.
CASE_CLASSES = {
    "criminal": [r"\bstate\s+v\.", r"\bcriminal\b", r"\bconviction\b", r"\bsentenc(e|ing)\b"],
    "civil": [r"\bcontract\b", r"\btort\b", r"\bnegligence\b", r"\bdamages\b"],
    "family": [r"\bdivorce\b", r"\bcustody\b", r"\bchild support\b", r"\badoption\b"],
    "probate": [r"\bestate\b", r"\bwill\b", r"\btrust\b", r"\bguardianship\b"],
    "corporate": [r"\bcorporation\b", r"\bshareholder\b", r"\bllc\b", r"\bpartnership\b"],
    "tax": [r"\btax\b", r"\brevenue\b", r"\bassess(ment|or)\b"],
    "employment": [r"\bemployment\b", r"\bworker\b", r"\blabor\b", r"\bwage\b"],
    "property": [r"\breal estate\b", r"\bforeclosure\b", r"\beasement\b", r"\bzoning\b"],
    "constitutional": [r"\bconstitution(al)?\b", r"\bamendment\b", r"\brights?\b"],
    "administrative": [r"\bagency\b", r"\bregulation\b", r"\badministrative\b"],
}
# Patterns of case citations, in order.
CASE_CITES = {
    "ohio_neutral": r"\b\d{4}-Ohio-\d+\b", "ohio_state": r"\b\d+\s+Ohio\s+St\.?\s*(?:\d[dr]d?)?\s+\d+\b", "ohio_app": r"\b\d+\s+Ohio\s+App\.?\s*(?:\d[dr]d?)?\s+\d+\b",
    "ohio_misc": r"\b\d+\s+Ohio\s+(?:Misc\.?|Dec\.?|N\.P\.?)\s*(?:\d[dr]d?)?\s+\d+\b", "northeast": r"\b\d+\s+N\.E\.\s*(?:\d[dr]d?)?\s+\d+\b", "federal_supreme": r"\b\d+\s+U\.S\.\s+\d+\b",
    "federal_reporter": r"\b\d+\s+F\.\s*(?:\d[dr]d?)?\s+\d+\b", "federal_supp": r"\b\d+\s+F\.\s*Supp\.\s*(?:\d[dr]d?)?\s+\d+\b",
}
# How a context relates to a citation; the first pattern that is found counts.
RELATIONS = {
    "overruled": [r"overrul(?:ed|ing)\s", r"\s(?:was|is)\s+overruled"],
    "reversed": [r"revers(?:ed|ing)\s", r"\s(?:was|is)\s+reversed"],
    "affirmed": [r"affirm(?:ed|ing)\s", r"\s(?:was|is)\s+affirmed"],
    "distinguished": [r"distinguish(?:ed|ing)\s", r"\s(?:is|was)\s+distinguished"],
    "followed": [r"follow(?:ed|ing|s)\s", r"pursuant\s+to\s", r"consistent\s+with\s"],
    "cited": [r"(?:see|citing|accord)\s", r"as\s+(?:stated|held|noted)\s+in\s"],
    "questioned": [r"question(?:ed|ing)\s", r"doubt(?:ed|ing)\s"],
    "compared": [r"compar(?:ed|ing)\s", r"(?:cf\.|contrast)\s"],
}
# How statutes cite each other, in order, and a reference of no such kind; the target is the group.
TYPED = {
    "defines": [
        r"as defined in (?:section|§)\s*(\d+\.\d+)",
        r"meaning (?:of|in) (?:section|§)\s*(\d+\.\d+)",
        r"definition in (?:section|§)\s*(\d+\.\d+)",
    ],
    "cross_reference": [
        r"pursuant to (?:section|§)\s*(\d+\.\d+)",
        r"in accordance with (?:section|§)\s*(\d+\.\d+)",
        r"as provided in (?:section|§)\s*(\d+\.\d+)",
        r"under (?:section|§)\s*(\d+\.\d+)",
    ],
    "amended_by": [r"as amended by (?:section|§)\s*(\d+\.\d+)"],
    "superseded_by": [
        r"superseded by (?:section|§)\s*(\d+\.\d+)",
        r"replaced by (?:section|§)\s*(\d+\.\d+)",
    ],
}
GENERIC = r"(?:section|§)\s*(\d+\.\d+)"
# Words that do not count, and phrases that do.
STOP_WORDS = ["the", "and", "for", "with", "from", "this", "that"]
PHRASES = ["summary judgment", "due process", "probable cause", "reasonable doubt", "good faith", "bad faith", "strict liability", "proximate cause"]
# Articles of the constitution, and words of an article's name that give its category, where the first fit counts.
ARTICLES = {
    "I": "Bill of Rights", "II": "Legislative", "III": "Executive", "IV": "Judicial", "V": "Elective Franchise", "VI": "Education", "VII": "Public Institutions", "VIII": "Public Debt and Public Works",
    "IX": "Militia", "X": "County and Township Organizations", "XI": "Apportionment", "XII": "Finance and Taxation", "XIII": "Corporations", "XIV": "Jurisprudence", "XV": "Miscellaneous", "XVI": "Amendments",
    "XVII": "Elections", "XVIII": "Municipal Corporations", "XIX": "Initiative and Referendum",
}
ARTICLE_CATEGORIES = [
    (["Bill of Rights"], "bill_of_rights"), (["Legislative"], "legislative_branch"), (["Executive"], "executive_branch"), (["Judicial"], "judicial_branch"), (["Education", "School"], "education"),
    (["Election", "Suffrage"], "elections"), (["Finance", "Revenue", "Taxation"], "finance"), (["Municipal", "Corporation"], "municipal"), (["Public"], "public_institutions"), (["Amendment", "Revision"], "amendments"),
]
BRANCHES = {"legislative_branch": "legislative", "executive_branch": "executive", "judicial_branch": "judicial"}
# Categories of the sections of the bill of rights, by number from 1.
RIGHTS = [
    "inalienable_rights", "government_powers", "religious_freedom", "habeas_corpus", "trial_by_jury", "slavery_prohibition", "political_rights", "writ_of_habeas_corpus", "bail_and_punishment", "criminal_procedure",
    "free_speech", "assembly_and_petition", "quartering_soldiers", "search_and_seizure", "grand_jury", "criminal_justice", "civil_trials", "suspension_of_laws", "eminent_domain", "powers_reserved",
]
# Words of other sections' rights, where the first fit counts.
RIGHTS_WORDS = [
    (["speech", "press", "expression"], "free_speech"), (["religion", "worship"], "religious_freedom"), (["search", "seizure", "warrant"], "search_and_seizure"), (["jury", "trial"], "trial_by_jury"),
    (["bail", "punishment", "cruel"], "bail_and_punishment"), (["property", "eminent domain", "taking"], "eminent_domain"), (["assembly", "petition"], "assembly_and_petition"),
]
# What an answer may not say, and what it may say twice at most.
NON_ANSWERS = [
    "not specified", "no information", "does not mention", "not found", "unclear", "n/a", "none", "not applicable", "cannot determine", "no such", "does not contain", "not present", "not provided", "not stated", "not included",
]
SPECULATION = [
    "appears to", "seems to", "likely", "probably", "suggests", "implies", "might", "could be", "possibly", "may be", "presumably", "apparently", "arguably", "it looks like", "this indicates", "one could interpret",
]
META = ["the text says", "according to", "the section states", "the law provides", "the statute mentions", "it is written"]
# Of what an answer of a type needs one, its least length, and the words that do not count in the overlap with its source.
REQUIRED = {
    "mandatory_actions": ["shall", "must", "required", "obligated", "duty"], "prohibitions": ["shall not", "prohibited", "may not", "unlawful", "forbidden"], "shall_requirements": ["shall"],
    "criminal_penalties": ["misdemeanor", "felony", "degree", "imprisonment", "jail"], "definitions": ["means", "includes", "defined", "refers to", "term"], "procedures": ["shall", "must", "submit", "file", "provide", "follow"],
    "authorities": ["board", "commission", "director", "department", "officer", "agency"], "cross_references": ["section", "chapter", "division", "subsection", "paragraph"],
    "entity_roles": ["shall", "may", "authorized", "responsible", "duties"], "compliance_checklist": ["must", "shall", "required", "submit", "file", "maintain"], "if_then_conditions": ["if", "when", "unless", "provided that", "in the event"],
}
LEAST_LENGTHS = {"compliance_checklist": 100, "entity_roles": 50, "if_then_conditions": 50, "procedures": 50, "shall_requirements": 40, "mandatory_actions": 40}
LISTED = ["compliance_checklist", "entity_roles", "shall_requirements"]
COMMON_WORDS = "the and for are but not you all with from this that have has will can may shall must such any each both other same been".split()
