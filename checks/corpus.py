"""Rule sets for the given tables.

The texts of the given tables are invented words in four languages, so the
built-in job vocabulary hardly occurs in them.  These rule sets have the same
form, with words that do occur.
"""

from siftworks.operators.projections import RuleBook
from siftworks.rules import (
    CandidateRules, CleanRules, CommunityRules, IssueRules, MailRules, PostingRules, QualityRules,
    RemoteRules, ReportRules, StudentRules, UrlPatterns, WeightedRules, fixed_values as fv,
)

POSTING = PostingRules(
    bad=("worthless", "nterti"),
    remote=("free", "license", "thonst", "mit der", "que la", "100% "),
    not_remote=("apache", "attion to", "les les"),
    part_time=("eriner", "pour ", "part-time"),
    categories=(
        ("alpha", ("antion", "para los")), ("beta", ("retion", "und der")),
        ("gamma", ("von ", "les ", "eringer")), ("technical", ("onble", "edble")),
    ),
    data=("onanea", "license", "sch den"), data_guard=("license", "the the"), generic_office=("inea", "que"),
    local=("napoli", "para "), ai=("worthless", "eauvi le"), ecommerce=("erble", "éri"),
)
QUALITY = QualityRules(
    categories=(("AI Training", ("worthless", "antion of")), ("Data Entry", ("license", "erst")),
                ("Logistics", ("und die", "les ")), ("Research", ("thonst", "para"))),
    countries=(("US only", ("apache", "antion the")), ("Europe", ("von der", "que le")), ("Worldwide", ("free", "anywhere"))),
    employment=(("Part-time", ("eriner",)), ("Contract", ("mit ", "retion")), ("Internship", ("stage", "inea"))),
    country_points={"Worldwide": 20, "Europe": 15, "US only": -40},
    positive=(("Alpha", ("antion", "thonst", "retion", "onanea", "eriner"), 45), ("Beta", ("und", "der ", "die "), 35),
              ("Gamma", ("que ", "les ", "pour"), 20)),
    negative=(("seniority", ("the the", "of of", "attion"), -35), ("country", ("apache", "von "), -40), ("low priority", ("hr", "edwh"), -30)),
)
WEIGHTED = WeightedRules(
    positive=(
        ("license", 45), ("mit license", 30), ("free", 25), ("thonst", 20), ("antion", 35), ("retion", 15), ("the", 5),
        ("und", 10), ("der die", 12), ("que la", 12), ("les", 9), ("para", 18), ("eriner", 22), ("thing", 7), ("only", 11),
        ("[for hire]", 60), ("von der", 14), ("pour", 8), ("that the", 6), ("ist", 4),
    ),
    combos=(
        (("license", "the"), 20, "license + the"), (("und", "der"), 10, "und + der"), (("que", "les"), 10, "que + les"),
        (("antion", "retion", "the"), 40, "three words"), (("para", "los"), 15, "para + los"),
    ),
    negative=(("worthless", -60), ("of of", -20), ("apache", -30), ("anti", -15), ("es", -5)),
    excluded_titles=("antion", "retion", "der der"),
    source_bonus={"remotive": 15, "arbeitnow": 10, "himalayas": 10, "jobicy": 15, "duckduckgo": 5, "reddit": 0},
    min_score_by_source={"remotefirstjobs": 90, "smartjobspa": 60, "duckduckgo": 25},
    high=140, medium=90,
)
STUDENT = StudentRules(
    preferred_titles=("the", "der", "que la"), unwanted_titles=("antion", "les les", "on-hold"),
    allowed_locations=("Napoli", "Castello d'Argile"), excluded_locations=("Milano",),
    location_points={"napoli": 20, "thonst": 5},
    category_points={"alpha": 20, "data_office": 20, "beta": 15, "gamma": 10},
    keyword_points={"license": 15, "lun-ven": 10, "worthless": -40, "eriner": -20},
    category_terms={"alpha": ("para los",), "data_office": ("onanea",), "beta": ("und der",)},
)
CANDIDATE = CandidateRules(
    groups=((("license", "sch den"), 20), (("free",), 15), (("thonst", "para"), 25), (("antion",), 10),
            (("worthless",), -45), (("of of", "attion to"), -20), (("5+ anni", "apache"), -15)),
    category_points={"alpha": 35, "data_entry": 35, "beta": -10, "technical": -10, "gamma": 25},
    part_time=("eriner", "part-time"), low_fit=("beta", "technical"), specialist=("license", "the"),
)
REMOTE = RemoteRules(
    keywords=("free", "license", "que la", "und "), blockers=("apache", "worthless"),
    groups=((("thonst", "que la"), 30), (("license",), 25), (("retion", "pour"), 15), (("the the",), -30), (("attion to",), -20)),
)
CLEAN = CleanRules(
    article=("worthless", "anea the"), listing_titles=("the ", "le "), aggregator=("und der", "que le"),
    soft_pages=(*fv.SOFT_TRUSTED_PAGES, ("it.linkedin.com", "/jobs/search"), ("adecco.it", "/lavora-con-noi")),
    seeks_work=("que que", "thonst"), roles=("the", "der"),
)
MAIL = MailRules(
    phrases=("mit license", "nterti"), title_prefixes=("the ", "de "), mismatch=("antion", "eau"), target=("la", "the"),
    summary=(("Remote", ("free", "remote")), ("Russian language", ("und ",)), ("Data Entry", ("license",)), ("Transcription", ("antion", "para"))),
)
COMMUNITY = CommunityRules(
    remote=("the", "une", "und", "los"), onsite=("attion to", "que que", "sch der"),
    categories=(("ai_data", ("antion", "les eau")), ("back_office_va", ("die der", "pour")), ("research", ("on", "para", "erth"))),
    ai=("antion",), tasks=("para", "thing"), language=("der", "von"),
    scam=("worthless", "nterti"), non_job=("is be", "le la"), unpaid=("ndwh",), commission=("free",),
    payment=("that", "est", "mit", "$/hour"), contact=("with", "avec", "con"), weak_contact=("he", "ch"),
)
ISSUE = IssueRules(
    remote=("the", "une", "und", "los"), onsite=("attion to", "que que"),
    categories=(("ai_data", ("antion",)), ("research", ("on", "para"))), developer=("worthless", "ions"),
    non_job=("is be", "le la"), help_term="erth", unpaid=("free",), payment=("that", "est"), contact=("with", "avec"), language=("der",),
)
REPORT = ReportRules(
    local=("napoli",), hospitality=("antion",), cleaning=("retion",), maintenance=("und der",), warehouse=("que la",),
    remote=("free", "license"), ai=("worthless", "thonst"), data=("license",), transcription=("les ",), assistant=("para",),
    logistics=("von ",), reception=("onble",), entry=("license", "erst"), office=("eriner",), stock=("die ",), retail=("los",),
    part_time=("part time", "edble"), schedule=("thing",), degree=("apache",), language_risk=("von der",), night=("nterti", "eau "),
    hard_risk=("worthless",), places=(("thonst", "Near the first place"), ("napoli", "Near the second place")),
)
PATTERNS = UrlPatterns.from_mapping({
    "indeed": {"domains": ["it.indeed.com", "indeed.com"], "job": ["/viewjob"], "search": ["/jobs?", "/q-"], "career_page": ["/cmp/"]},
    "jooble": {"domains": ["it.jooble.org"], "job": ["/jdp/"], "search": ["/SearchResult"]},
    "linkedin": {"domains": ["it.linkedin.com"], "job": ["/jobs/view/"], "search": ["/jobs/", "/jobs/search"]},
    "randstad": {"domains": ["www.randstad.it"], "search_before_job": True, "job_all": ["/offerte-lavoro/", "_"],
                 "search": ["/offerte-lavoro/", "/page-", "/offerte-lavoro/q-"]},
    "adecco": {"domains": ["www.adecco.it"], "job": ["/offerta/"], "job_all": ["/lavoro/", "_"], "search": ["/lavoro?"],
               "career_page": ["/lavora-con-noi"]},
    "gigroup": {"domains": ["gigroup.it"], "job": ["/offerte-lavoro-dettaglio/", "/jobs/"], "search": ["/offerte-lavoro/", "/jobs/all"]},
    "subito": {"domains": ["subito.it"], "search_before_job": True, "job_all": ["/offerte-lavoro/", ".htm"], "search": ["/annunci-"]},
    "lidl": {"domains": ["lavoro.lidl.it"], "job": ["/punti-vendita/"]},
    "talent": {"domains": ["it.talent.com"], "job": ["/view?id="], "search": ["/jobs?"]},
    "general_exclude_domains": ["comune.napoli.it"],
})
# Patterns for the hosts of the pages table.
PAGE_PATTERNS = UrlPatterns.from_mapping({
    "blog": {"domains": ["blog.tionsh.example.net", "blog.ththan.example.net", "blog.ththly.example.org"], "job": ["/en/", "/fr/"],
             "search": ["?page=", "/en/4"], "article": ["/de/"]},
    "shop": {"domains": ["cheap-pills.example.com", "m.ththth.example.net", "ththhe.example.com"], "search_before_job": True,
             "job_all": ["/en/", ".html"], "search": ["?page="], "company_page": ["/es/"], "profile": ["/fr/"]},
    "plain": {"domains": ["thther.example.org", "ththed.example.org"], "category_page": ["utm_"], "aggregator_page": ["/en/"]},
    "general_exclude_domains": ["spam-farm.example.org"],
})
BOOK = RuleBook(
    posting=POSTING, quality=QUALITY, student=STUDENT, candidate=CANDIDATE, remote=REMOTE, clean=CLEAN, mail=MAIL,
    report=REPORT, weighted=WEIGHTED, community=COMMUNITY, issue=ISSUE, patterns=PATTERNS,
)
NOW = "2026-07-01 12:00:00"
SOURCES = ("reddit", "remotive", "arbeitnow", "himalayas", "remotejobs_org", "remotefirstjobs", "jobicy",
           "workanywhere", "smartjobspa", "attalgroup", "direzionelavoro", "duckduckgo")
