"""Fixed values.

Everything in this module is a constant that must have exactly this content
for results to agree with the pipelines this engine replaces: word lists,
lookup tables, point values, thresholds and label texts.  They are data, kept
together and in their natural order; all of them can be replaced by passing
another rule object to the functions that use them.
"""

# --- URL handling (fixed values) -------------------------------------------
TRACKING_PARAMETERS = (
    "utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content",
    "fbclid", "gclid",
)
REDIRECT_PARAMETERS = ("uddg", "url")

# --- posting classification terms (fixed values) ----------------------------
BAD_TERMS = (
    "solo provvigioni", "agente commerciale", "porta a porta",
    "network marketing", "investimento iniziale", "corso a pagamento",
    "forex", "crypto", "trading",
)
REMOTE_TERMS = (
    "remote", "remoto", "da remoto", "smart working", "smartworking",
    "lavoro da casa", "work from home", "home based", "100% remote",
    "full remote", "ibrido", "hybrid", "telelavoro", "online",
)
NEGATIVE_REMOTE_TERMS = (
    "in sede", "presenza", "in presenza", "on site", "onsite", "non remoto",
    "no smart working", "no smartworking", "sede di lavoro",
)
PART_TIME_TERMS = (
    "part-time", "part time", "tempo parziale", "4 ore", "6 ore", "20 ore",
)
CATEGORY_TERMS = (
    ("hr_recruiting", ("talent acquisition", "recruiter", "recruiting", "risorse umane", "human resources")),
    ("design", ("grafico", "graphic designer", "designer", "photoshop", "illustrator")),
    ("accounting", ("contabile", "contabilità", "contabilita", "ciclo attivo", "ciclo passivo", "tesoreria", "sap contabile")),
    ("logistics", ("logistica", "spedizioni", "spedizioni aeree", "supply chain", "trasporti", "shipping", "freight forwarding")),
    ("facilities", ("facilities", "facility", "maintenance office", "servizi generali")),
    ("security", ("security", "vigilanza", "sicurezza", "sorveglianza")),
    ("customer_service", ("customer service", "call center", "operatori inbound", "operatore inbound", "assistenza clienti", "servizio clienti")),
    ("administration", ("ufficio amministrativo", "impiegato amministrativo", "addetto amministrativo", "ufficio acquisti", "acquisti", "amministrativo", "amministrativa", "amministrazione")),
    ("back_office", ("back office", "segreteria", "segretaria")),
    ("reception", ("receptionist", "reception", "front office", "accoglienza")),
    ("hotel", ("boutique hotel", "housekeeping", "portiere", "hotel", "albergo")),
    ("cleaning", ("pulizie", "addetto pulizie", "addetta pulizie", "sanificazione", "cleaning", "cleaner")),
    ("warehouse", ("magazziniere", "magazzino", "picking", "scaffalista", "carico scarico", "carico/scarico", "warehouse")),
    ("gdo", ("addetto vendita", "addetta vendita", "cassiere", "cassiera", "gdo", "supermercato")),
    ("sales", ("sales", "venditore", "commerciale", "addetto vendite", "addetta vendite")),
    ("technical", ("tecnico", "elettricista", "idraulico", "manutentore", "meccanico", "montatore")),
)
DATA_TERMS = ("data entry", "inserimento dati", "back office data entry", "excel", "google sheets")
DATA_GUARD_TERMS = (
    "data entry", "inserimento dati", "back office", "amministrativo",
    "amministrativa", "contabile", "logistica", "spedizioni", "excel",
    "google sheets",
)
GENERIC_OFFICE_TERMS = ("office", "ufficio", "consultant", "junior officer", "specialist")
LOCAL_TERMS = (
    "napoli", "pozzuoli", "bacoli", "monte di procida", "quarto",
    "fuorigrotta", "campi flegrei", "campania",
)
AI_TERMS = ("ai trainer", "ai annotator", "transcription", "trascrizione")
ECOMMERCE_TERMS = ("e-commerce", "ecommerce", "catalogo prodotti")
BASE_POINTS = {
    "part_time": 40, "local": 35, "data": 30, "remote": 25, "ai": 15,
    "ecommerce": 10, "bad": -30,
}

# --- result cleaning (fixed values) ------------------------------------------
SEARCH_PATH_TERMS = ("/search",)
CATEGORY_PATH_TERMS = ("/cerca",)
SEARCH_QUERY_KEYS = ("q",)
SEARCH_QUERY_PATHS = ("/jobs", "/offerte")
LISTING_TITLE_STARTS = ("più di", "offerte di lavoro", "lavoro urgente", "trova lavoro", "annunci")
AGGREGATOR_TERMS = ("offerte di lavoro", "annunci", "trova lavoro", "risultati", "jobs found", "more than")
ARTICLE_TERMS = (
    "captcha entry", "captcha job", "open data", "dataset",
    "fatturazione elettronica", "marcatempo", "rilevazione presenze",
    "treasure in the phlegrean", "turismo", "travel guide",
    "comune di napoli", "elenco dei dataset", "concorso", "scuola",
    "istituto", "liceo", "motocross", "partita", "campionato",
    "posti agente", "comune di", "circolare",
)
SOFT_TRUSTED_PAGES = (
    ("subito.it", "/offerte-lavoro"),
    ("subito.it", "/annunci-"),
    ("lavoro.lidl.it", "/annunci-di-lavoro"),
    ("lavoro.lidl.it", "/punti-vendita/"),
    ("eurospin.it", "/lavora-con-noi"),
    ("randstad.it", "/offerte-lavoro/"),
    ("manpower.it", "/trova-lavoro"),
)
EUROSPIN_ROLE_TERMS = (
    "addetto", "addetta", "vendita", "vendite", "cassiere", "cassiera",
    "scaffalista", "magazziniere", "responsabile", "store manager",
    "vice store", "operatore", "operatrice",
)
EUROSPIN_GENERIC_TITLES = ("lavora con noi", "eurospin lavora con noi", "lavora con noi eurospin")
RANDSTAD_SEARCH_PARTS = ("/q-", "/re-", "/ci-")
MANPOWER_VACANCY_PARTS = ("/annuncio-lavoro/", "/offerte-lavoro/", "/job/", "/jobs/")
PERSON_SEEKS_WORK_TERMS = ("cerco-lavoro", "cerco lavoro")
REMOVED_URL_TYPES = (
    "search_page", "category_page", "aggregator_page", "article", "profile",
    "company_page", "career_page", "excluded_domain",
)
RESULT_TYPES = (
    "job", "search_page", "category_page", "aggregator_page", "article",
    "profile", "company_page", "career_page", "excluded_domain", "unknown",
)

# --- quality labels (fixed values) -------------------------------------------
QUALITY_CATEGORIES = (
    ("AI Training", ("ai trainer", "ai evaluator", "ai tutor", "search evaluator", "rlhf", "human feedback")),
    ("AI Annotation", ("ai annotation", "ai annotator", "data annotation", "data annotator", "data labeling", "llm annotation")),
    ("Data Entry", ("data entry", "data processing", "inserimento dati", "excel", "google sheets", "csv", "validation", "qa data")),
    ("Virtual Assistant", ("virtual assistant", "administrative assistant", "back office", "admin assistant")),
    ("Logistics", ("ocean freight", "shipping", "freight forwarding", "container", "supply chain", "logistics coordinator")),
    ("Analytics", ("operations analyst", "junior analyst", "reporting analyst", "analytics", "dashboard", "reporting")),
    ("Python", ("python", "automation", "pandas", "api")),
    ("Customer Support", ("customer support", "customer service", "support specialist")),
    ("Translation", ("translation", "translator", "localization", "localisation", "multilingual")),
    ("Transcription", ("transcription", "transcriber", "speech", "audio annotation")),
    ("Moderation", ("content moderator", "content moderation", "moderation", "content reviewer")),
    ("Research", ("research assistant", "research", "web research")),
)
COUNTRY_LIMITS = (
    ("US only", ("us only", "u.s. only", "usa only", "united states only", "must be based in the us", "us-based only")),
    ("Canada only", ("canada only", "canadian only", "must be based in canada")),
    ("Brazil only", ("brazil only", "brazilian only", "brasil only")),
    ("LATAM only", ("latam only", "latin america only", "south america only")),
    ("India only", ("india only", "india-based only", "must be based in india")),
    ("Italy", ("italy only", "italia", "italy-based", "based in italy")),
    ("Europe", ("europe only", "european time zones", "european timezone", "based in europe")),
    ("EU", ("eu only", "european union")),
    ("EMEA", ("emea",)),
    ("Worldwide", ("worldwide", "anywhere", "global", "fully remote", "work from anywhere")),
)
WORLDWIDE_LOCATIONS = ("remote", "worldwide", "anywhere")
EMPLOYMENT_TYPES = (
    ("Part-time", ("part-time", "part time", "tempo parziale")),
    ("Full-time", ("full-time", "full time", "tempo pieno")),
    ("Contract", ("contract", "contractor", "contratto")),
    ("Freelance", ("freelance", "freelancer")),
    ("Project", ("project based", "project-based", "per project")),
    ("Temporary", ("temporary", "temp", "fixed term", "tempo determinato")),
    ("Internship", ("internship", "intern", "stage", "tirocinio")),
)
COUNTRY_POINTS = {
    "Worldwide": 20, "Europe": 15, "EU": 15, "Italy": 15, "EMEA": 10,
    "US only": -40, "Canada only": -35, "Brazil only": -40,
    "LATAM only": -40, "India only": -40,
}
QUALITY_POSITIVE = (
    ("AI Trainer", ("ai trainer", "ai evaluator", "ai tutor"), 45),
    ("AI Annotation", ("ai annotation", "data annotation", "data labeling", "human feedback", "rlhf", "llm"), 45),
    ("Data", ("data entry", "excel", "google sheets", "csv", "reporting", "dashboard", "validation", "qa data"), 35),
    ("Logistics", ("ocean freight", "shipping", "freight forwarding", "container", "supply chain", "operations analyst", "logistics coordinator"), 40),
    ("Languages", ("ukrainian", "russian", "english", "multilingual", "українська", "русский"), 20),
    ("Virtual Assistant", ("virtual assistant", "administrative", "back office"), 30),
)
QUALITY_NEGATIVE = (
    ("seniority", ("senior", "lead", "principal", "head", "director", "manager", "staff engineer"), -35),
    ("country", ("us only", "canada only", "latam only", "brazil only", "india only"), -40),
    ("restriction", ("relocation required", "security clearance", "licensed", "certification required"), -35),
    ("irrelevant", ("geopolitical", "intelligence analyst", "military", "cyber security", "cybersecurity", "soc analyst", "penetration testing"), -55),
    ("medical", ("physician", "medical doctor", "doctor", "nurse", "dentist", "pharmacist"), -60),
    ("low priority", ("sales", "marketing", "recruiter", "hr", "graphic design", "manual qa", "finance senior", "project manager"), -30),
)
SALARY_POINTS = 5
CURRENCY_CODES = {"€": "EUR", "$": "USD", "£": "GBP", "eur": "EUR", "usd": "USD", "gbp": "GBP"}

# --- weighted scoring defaults (fixed values) --------------------------------
EXCLUDED_TITLE_SCORE = -100
DEFAULT_MIN_SCORE = 45
TOP_MIN_SCORE = 70
TOP_REPORT_LIMIT = 50
PRIORITY_HIGH = 90
PRIORITY_MEDIUM = 75
PRIORITY_LEVELS = ("HIGH", "MEDIUM", "LOW")

# --- student profile scoring (fixed values) ----------------------------------
STUDENT_START = 50
STUDENT_REMOTE = 30
STUDENT_FULL_REMOTE = 30
STUDENT_PART_TIME = 25
STUDENT_PREFERRED_TITLE = 7
STUDENT_FAR_CAP = 40
STUDENT_UNKNOWN_CAP = 70
STUDENT_LOCATION_POINTS = {
    "napoli": 20, "pozzuoli": 20, "bacoli": 20, "monte di procida": 20,
    "casoria": 15, "caivano": 15, "arzano": 15, "marano di napoli": 15,
}
STUDENT_CATEGORY_POINTS = {
    "data_office": 20, "data_entry": 20, "back_office": 20,
    "administration": 20, "accounting": 15, "logistics": 15,
    "customer_service": 15, "reception": 15, "hotel": 15, "hospitality": 15,
    "cleaning": 10, "maintenance": 10, "warehouse": 5, "gdo": 5,
    "facilities": 5,
}
STUDENT_KEYWORD_POINTS = {
    "mattina": 15, "lun-ven": 10, "tempo parziale": 10,
    "notturno": -40, "sera": -20, "night": -40,
}
STUDENT_CATEGORY_TERMS = {
    "data_office": ("data office", "data entry", "inserimento dati", "back office", "ufficio", "excel", "google sheets"),
    "administration": ("administration", "administrative", "amministrazione", "amministrativo", "segreteria", "segretaria"),
    "reception": ("reception", "receptionist", "front office"),
    "hotel": ("hotel", "albergo"),
    "hospitality": ("hospitality", "ristorante", "bar", "cameriere", "turismo"),
    "cleaning": ("cleaning", "cleaner", "pulizie", "addetto pulizie", "addetta pulizie"),
    "maintenance": ("maintenance", "manutenzione", "manutentore"),
    "warehouse": ("warehouse", "magazzino", "magazziniere", "logistica"),
    "gdo": ("gdo", "supermercato", "scaffalista", "cassiere", "addetto vendita"),
    "accounting": ("contabile", "contabilità", "contabilita", "ciclo attivo", "ciclo passivo", "tesoreria"),
    "logistics": ("logistica", "spedizioni", "supply chain", "trasporti"),
    "customer_service": ("customer service", "assistenza clienti", "servizio clienti", "call center"),
    "facilities": ("facilities", "facility", "servizi generali"),
}
STUDENT_CATEGORY_ALIASES = {
    "ai_data": "ai_annotation", "data_entry": "data_office",
    "campania_part_time_data": "data_office", "office": "data_office",
    "admin": "administration", "pulizie": "cleaning",
    "manutenzione": "maintenance", "logistics": "warehouse",
}

# --- candidate profile scoring (fixed values) ---------------------------------
CANDIDATE_START = 50
CANDIDATE_GROUPS = (
    (("data entry", "inserimento dati"), 20),
    (("back office",), 20),
    (("office", "ufficio", "office assistant"), 20),
    (("administration", "amministrazione", "amministrativo", "segreteria"), 20),
    (("reception", "receptionist", "front office"), 15),
    (("excel",), 20),
    (("google sheets",), 20),
    (("python",), 15),
    (("ai trainer", "ai evaluator", "ai tutor", "rlhf"), 25),
    (("ai annotation", "data annotation", "data labeling", "human feedback"), 25),
    (("virtual assistant",), 20),
    (("ocean freight", "supply chain", "operations analyst"), 20),
    (("ukrainian", "russian", "multilingual"), 15),
    (("logistics", "logistica", "spedizioni", "shipping", "freight forwarding"), 15),
    (("warehouse", "magazzino", "magazziniere"), 10),
    (("customer service", "assistenza clienti", "servizio clienti"), 10),
    (("hotel", "albergo", "hotel reception"), 10),
    (("stage", "tirocinio", "internship"), 5),
    (("italian b2", "italiano b2", "b2 italiano", "b2 italian"), -10),
    (("italian c1", "italiano c1", "c1 italiano", "c1 italian"), -20),
    (("laurea obbligatoria", "laurea richiesta", "laurea necessaria"), -25),
    (("5 anni", "5+ anni", "almeno 5 anni", "minimo 5 anni"), -15),
    (("night shift", "turno notte", "notturno", "notte"), -20),
    (("english c1", "inglese c1", "c1 english", "c1 inglese"), -20),
    (("senior", "lead", "principal", "director", "manager", "staff engineer"), -30),
    (("us only", "canada only", "latam only", "brazil only", "india only"), -35),
    (("cyber security", "cybersecurity", "soc analyst", "intelligence analyst"), -45),
    (("physician", "medical doctor", "doctor", "nurse", "dentist", "pharmacist"), -45),
)
CANDIDATE_PART_TIME_TERMS = ("part time", "part-time", "tempo parziale")
CANDIDATE_PART_TIME = 10
CANDIDATE_CATEGORY_POINTS = {
    "data_entry": 35, "back_office": 35, "administration": 35,
    "accounting": 30, "logistics": 25, "reception": 25,
    "customer_service": 25, "remote_data": 25, "ai_annotation": 20,
    "ai training": 35, "ai annotation": 35, "data entry": 35,
    "virtual assistant": 30, "analytics": 30, "python": 25,
    "translation": 25, "moderation": 15, "research": 15,
    "transcription": 20, "warehouse": 10, "gdo": 10, "hotel": 10,
    "cleaning": 10, "facilities": 10, "hr_recruiting": -10, "design": -10,
    "sales": -10, "security": -10, "technical": -10,
}
CANDIDATE_LOW_FIT = ("hr_recruiting", "design", "sales", "security", "technical")
CANDIDATE_LOW_FIT_CAP = 60
CANDIDATE_SPECIALIST_TERMS = ("laurea", "certificazione", "abilitazione", "ingegnere", "engineer", "specialist")
MATCH_STUDENT_SHARE = 0.45
MATCH_CANDIDATE_SHARE = 0.55
REMOTE_MATCH_CANDIDATE_SHARE = 0.8
REMOTE_MATCH_REMOTE_SHARE = 0.2

# --- remote profile (fixed values) --------------------------------------------
REMOTE_KEYWORDS = (
    "remote", "remoto", "full remote", "smart working", "lavoro da casa",
    "work from home", "home based", "da remoto", "online", "freelance",
    "contractor", "ai trainer", "ai annotator", "data annotator",
    "ai evaluator", "search evaluator", "data labeling", "data annotation",
    "transcription", "trascrizione", "virtual assistant",
    "assistente virtuale", "google sheets", "excel remote",
    "data processing", "data entry remoto", "customer support remote",
    "content reviewer", "moderation", "logistics remote",
)
REMOTE_BLOCKERS = ("onsite", "in sede", "presenza", "non remoto")
REMOTE_GROUPS = (
    (("ai trainer", "ai annotator", "data annotator"), 30),
    (("transcription", "trascrizione"), 30),
    (("data entry remote", "data entry remoto"), 25),
    (("virtual assistant", "assistente virtuale"), 25),
    (("google sheets", "excel remote"), 25),
    (("customer support remote",), 20),
    (("content reviewer", "moderation"), 20),
    (("logistics remote",), 15),
    (("python", "automation"), 15),
    (("freelance", "contractor"), 10),
    (("part-time", "part time", "tempo parziale"), 10),
    (("onsite",), -30),
    (("in sede",), -30),
    (("presenza",), -30),
    (("non remoto",), -30),
    (("italian c1 required", "italiano c1 richiesto"), -20),
    (("english c1 required", "inglese c1 richiesto"), -20),
)

# --- quota groups of the export (fixed values) ---------------------------------
QUOTA_TERMS = {
    "data_office": ("data entry", "inserimento dati", "back office", "office", "ufficio", "excel", "google sheets"),
    "hospitality": ("hospitality", "hotel", "albergo", "restaurant", "ristorante", "barista", "cameriere", "cameriera", "cuoco", "receptionist", "sala", "turismo"),
    "cleaning": ("cleaning", "cleaner", "pulizie", "addetto pulizie", "addetta pulizie"),
    "maintenance": ("maintenance", "manutenzione", "manutentore", "tecnico manutenzione", "elettricista", "idraulico"),
}
QUOTA_CATEGORIES = {
    "data_office": ("data_office", "campania_part_time_data", "data_entry"),
    "hospitality": ("hospitality", "hotel", "restaurant"),
    "cleaning": ("cleaning", "pulizie"),
    "maintenance": ("maintenance", "manutenzione"),
}
QUOTA_SIZES = {"remote": 20, "data_office": 20, "hospitality": 20, "cleaning": 15, "maintenance": 10}
EXPORT_TOP = 500
SELECTION_TARGET = 50
SELECTION_MIN_MATCH = 50
ROTATION_DAYS = 7
MAX_SEEN_REPEAT = 1
POOL_MATCH_THRESHOLD = 70
STATUS_ORDER = ("NEW", "UPDATED", "RESURFACED", "SEEN")
SELECTION_ORDER = ("NEW", "UPDATED", "NEVER_SENT_FILL", "RESURFACED", "FALLBACK_ROTATION", "SEEN")
SENT_KEY_TTL_DAYS = 90
SENT_KEY_LIMIT = 20

# --- listing page detection of the mail cleaner (fixed values) -------------------
LISTING_PHRASES = ("hiring now", "job search", "search results", "jobs found", "open jobs", "vacancies")
LISTING_TITLE_PREFIX = ("top ",)
LISTING_PATH_TERMS = ("/jobs/search", "/job-search", "/search", "/careers/search", "/offerte-lavoro")
LISTING_ROOT_PATHS = ("/jobs", "/remote-jobs")
LISTING_QUERY_KEYS = ("q", "query", "keyword", "keywords", "what", "where")
LISTING_HOST_MARKS = ("indeed.", "jooble.", "linkedin.", "virtualvocations.com")
MISMATCH_LANGUAGES = (
    "korean", "japanese", "german", "french", "spanish", "dutch",
    "portuguese", "arabic", "hindi", "chinese", "swedish", "norwegian",
    "polish", "czech", "turkish",
)
TARGET_LANGUAGES = ("russian", "ukrainian", "русский", "украинский")
SUMMARY_LABELS = (
    ("Remote", ("remote", "work from home", "worldwide", "home based")),
    ("Russian language", ("russian", "russian language", "русский")),
    ("Ukrainian language", ("ukrainian", "ukrainian language", "украинский")),
    ("AI Data Annotation", ("data annotation", "data annotator", "annotation", "ai trainer", "ai annotator")),
    ("Data Labeling", ("data labeling",)),
    ("Transcription", ("transcription", "audio")),
    ("Virtual Assistant", ("virtual assistant",)),
    ("Administration / Back Office", ("admin", "administrative", "back office")),
    ("Data Entry", ("data entry",)),
)

# --- community posts (fixed values) ----------------------------------------------
POST_REMOTE_TERMS = ("remote", "work from home", "wfh", "anywhere", "worldwide", "fully remote", "online", "async")
POST_ONSITE_TERMS = ("onsite", "on-site", "in office", "hybrid only", "relocation required", "local only")
POST_CATEGORIES = (
    ("ai_data", ("ai annotator", "ai trainer", "ai evaluator", "llm evaluator", "data annotation", "data labeling", "data entry")),
    ("back_office_va", ("virtual assistant", "va", "assistant", "admin", "back office", "operations")),
    ("research", ("research assistant", "web research", "internet research", "data collection", "lead generation")),
    ("transcription_language", ("transcription", "transcriber", "ukrainian", "russian", "language evaluator", "translation", "localization", "content moderator")),
)
POST_AI_TERMS = ("ai annotator", "ai trainer", "ai evaluator", "llm evaluator", "data annotation", "data labeling")
POST_TASK_TERMS = ("data entry", "web research")
POST_LANGUAGE_TERMS = ("ukrainian", "russian")
POST_SCAM_TERMS = (
    "crypto", "casino", "gambling", "adult", "nsfw", "investment",
    "trading bot", "forex", "mlm", "deposit required", "pay first",
    "registration fee", "telegram only", "whatsapp only",
    "dm me for details", "easy money", "earn $500/day",
    "no experience high pay",
)
POST_NON_JOB_TERMS = ("looking for advice", "how do i find", "is this legit", "discussion", "rant", "meta", "question", "survey unpaid")
POST_UNPAID_TERMS = ("unpaid", "volunteer", "experience only", "for exposure", "free work")
POST_COMMISSION_TERMS = ("commission only", "referral only")
POST_PAYMENT_TERMS = (
    "paid", "salary", "hourly", "contract", "freelance", "compensation",
    "usd", "eur", "€/h", "$/hour", "per hour", "weekly payment", "paypal",
    "wise", "deel", "bank transfer",
)
POST_CONTACT_TERMS = (
    "email", "apply", "application", "form", "careers", "google form",
    "typeform", "website", "dm with portfolio", "send cv", "resume",
)
POST_WEAK_CONTACT_TERMS = ("dm me", "dm", "message me")
POST_OLD_DAYS = 30
POST_MAX_DAYS = 90
COMMUNITY_LIMIT = 100

# --- issues (fixed values) ---------------------------------------------------------
ISSUE_REMOTE_TERMS = ("remote", "work from home", "anywhere", "worldwide", "fully remote", "distributed", "async")
ISSUE_ONSITE_TERMS = ("onsite", "on-site", "in office", "hybrid only", "relocation required")
ISSUE_DEVELOPER_TERMS = (
    "senior software engineer", "staff engineer", "backend developer",
    "frontend developer", "full stack", "fullstack", "devops", "kubernetes",
    "blockchain", "solidity",
)
ISSUE_NON_JOB_TERMS = (
    "bug", "feature request", "acceptance criteria", "arxiv", "code review",
    "compliance", "implementation", "pull request", "risk detected",
    "scope boundaries", "spec_id", "success criteria", "uat_id",
    "good first issue", "hacktoberfest", "open source contribution",
    "contributor needed",
)
ISSUE_HELP_TERM = "help wanted"
ISSUE_UNPAID_TERMS = ("unpaid", "volunteer", "no pay", "uncompensated")
ISSUE_PAYMENT_TERMS = ("paid", "salary", "hourly", "contract", "freelance", "compensation", "usd", "eur", "€/h", "$/hour", "weekly payment")
ISSUE_CONTACT_TERMS = ("email", "apply", "application", "form", "careers", "greenhouse", "lever", "ashby", "workable")
ISSUE_CATEGORIES = (
    ("ai_data", ("ai annotator", "ai trainer", "ai evaluator", "llm evaluator", "data annotation", "data labeling")),
    ("back_office_va", ("virtual assistant", "assistant", "admin", "back office", "operations")),
    ("research", ("research assistant", "web research", "internet research", "data collection")),
    ("transcription_language", ("transcription", "transcriber", "ukrainian", "russian", "language evaluator", "translation", "localization")),
)
ISSUE_LANGUAGE_TERMS = ("ukrainian", "russian")
ISSUE_OLD_DAYS = 180

# --- report (fixed values) -----------------------------------------------------------
LOCAL_BLOCKS = (
    "Campania part-time", "Hospitality / Hotel / Restaurant",
    "Cleaning / Pulizie", "Maintenance / Manutenzione", "Warehouse / GDO",
    "Remote / Data / AI", "Other",
)
REMOTE_BLOCKS = ("AI Training", "Data", "Logistics", "Virtual Assistant", "Transcription", "Other")
REPORT_HOSPITALITY_TERMS = (
    "hospitality", "hotel", "albergo", "restaurant", "ristorante",
    "accoglienza", "front office", "barista", "cameriere", "cameriera",
    "cuoco", "receptionist", "reception", "sala", "turismo",
)
REPORT_CLEANING_TERMS = ("cleaning", "cleaner", "pulizie", "addetto pulizie", "addetta pulizie")
REPORT_MAINTENANCE_TERMS = ("maintenance", "manutenzione", "manutentore", "tecnico", "elettricista", "idraulico")
REPORT_WAREHOUSE_TERMS = ("warehouse", "magazzino", "magazziniere", "logistica", "gdo", "supermercato", "scaffalista")
REPORT_REMOTE_TERMS = (
    "remote", "remoto", "smart working", "data", "ai", "annotation",
    "annotator", "trainer", "transcription", "data entry",
    "inserimento dati", "back office",
)
REPORT_AI_TERMS = ("ai trainer", "ai annotator", "data annotator", "ai evaluator", "search evaluator", "data labeling", "data annotation")
REPORT_DATA_TERMS = ("data entry", "data processing", "google sheets", "excel")
REPORT_TRANSCRIPTION_TERMS = ("transcription", "trascrizione", "localization", "translation")
REPORT_ASSISTANT_TERMS = ("virtual assistant", "assistente virtuale")
REPORT_LOGISTICS_TERMS = ("logistics", "logistica", "operations", "freight forwarding")
REPORT_RECEPTION_TERMS = ("reception", "receptionist", "front office", "accoglienza")
REPORT_ENTRY_TERMS = ("data entry", "inserimento dati", "excel", "google sheets")
REPORT_OFFICE_TERMS = ("back office", "amministrazione", "amministrativo", "segreteria")
REPORT_STOCK_TERMS = ("logistics", "logistica", "warehouse", "magazzino", "spedizioni")
REPORT_RETAIL_TERMS = ("gdo", "retail", "vendita", "cassiere", "scaffalista", "supermercato")
REPORT_PART_TIME_TERMS = ("part time", "part-time", "tempo parziale")
REPORT_SCHEDULE_TERMS = ("mattina", "lun-ven", "weekday", "giorno")
REPORT_DEGREE_TERMS = ("laurea obbligatoria", "laurea richiesta", "degree required")
REPORT_LANGUAGE_RISK_TERMS = ("italian b2", "italiano b2", "b2 italiano", "italian c1", "italiano c1", "c1 italiano")
REPORT_NIGHT_TERMS = ("night shift", "turno notte", "notturno", "notte")
REPORT_HARD_RISK_TERMS = ("italian c1", "italiano c1", "c1 italiano", "night shift", "notturno", "turno notte")
REPORT_ENTRY_CATEGORIES = ("data_entry", "data_office", "campania_part_time_data")
REPORT_OFFICE_CATEGORIES = ("back_office", "administration", "accounting", "admin", "office")
REPORT_AI_CATEGORIES = ("remote_data", "ai_data", "ai_annotation", "ai training", "ai annotation")
REPORT_STOCK_CATEGORIES = ("logistics", "warehouse")
REPORT_RECEPTION_CATEGORIES = ("reception", "front_office", "receptionist", "accoglienza")
REPORT_HOSPITALITY_CATEGORIES = ("hospitality", "hotel", "restaurant", "barista", "reception", "front_office", "receptionist", "accoglienza")
REPORT_RETAIL_CATEGORIES = ("gdo", "retail", "vendita", "sales")
GENERIC_CATEGORIES = ("general", "other", "unknown")
REPORT_PLACE_REASONS = (
    ("pozzuoli", "Pozzuoli / close to Monte di Procida"),
    ("bacoli", "Bacoli / close to Monte di Procida"),
    ("monte di procida", "Monte di Procida / very close"),
    ("napoli", "Napoli / allowed local area"),
)
REPORT_LOCAL_REASON = "Local area allowed by student profile"
FIT_LABELS = {
    "remote": "Remote possible", "part_time": "Part-time signal found",
    "study": "Compatible with study",
    "schedule": "Schedule signal looks study-friendly",
    "entry": "Matches Excel / Google Sheets / data entry",
    "office": "Matches back office / admin experience",
    "stock": "Matches logistics / warehouse experience",
    "hospitality": "Hospitality role, possible entry-level",
    "ai": "Matches remote AI / data annotation profile",
    "degree": "No degree required signal found",
}
RISK_LABELS = {
    "hours": "Full-time / part-time not confirmed",
    "language": "Italian B2/C1 may be required", "night": "Night shift",
    "far": "Far location", "unknown": "Location not confirmed",
    "category": "Category too generic", "company": "Company missing",
    "location": "Location missing", "salary": "Salary missing",
}
NO_SELECTION_REASON = "No selected jobs in this email."
BEST_MATCH_REASON = "Highest match score in the current selection."
LEVEL_LABELS = {
    "apply_today": "★★★★★ Apply today", "good": "★★★★ Good",
    "consider": "★★★ Consider", "watch": "★★ Watch", "skip": "★ Skip",
}
STATUS_LABELS = {"NEW": "🔥 NEW", "UPDATED": "♻️ UPDATED", "RESURFACED": "↩️ RESURFACED", "SEEN": "SEEN"}
MATCH_LABELS = ((90, "★★★★★ Strong match"), (80, "★★★★ Good match"), (None, "★★★ Consider"))
LETTER_BY_CV = {
    "AI / Data Annotation CV": "AI Trainer / Annotator cover letter",
    "Data Entry CV": "Data Processing cover letter",
    "Back Office / Reception CV": "Back Office / Administration cover letter",
    "Back Office CV": "Back Office / Administration cover letter",
    "Logistics CV": "Logistics cover letter",
    "Hospitality CV": "Hospitality short message",
    "Retail / GDO CV": "Retail short message",
    "Generic CV": "Generic short message",
}
REPORT_TOP = 100
REASON_LIMIT = 7
HISTORY_REASONS = ("history_seen", "seen_recently")
PROFILE_REASONS = ("profile_rejected", "rejected_by_profile", "rejected_by_country", "rejected_by_seniority", "low_match")
CLEANER_REASONS = (
    "location_rejected", "excluded_far", "unknown_location",
    "matched_search_page", "matched_category_page", "matched_company_page",
    "matched_profile", "matched_article", "matched_excluded_domain",
    "unknown_pattern",
)
MATCHED_REASON_BY_TYPE = {
    "search_page": "matched_search_page", "category_page": "matched_category_page",
    "aggregator_page": "matched_category_page", "company_page": "matched_company_page",
    "career_page": "matched_company_page", "profile": "matched_profile",
    "article": "matched_article", "excluded_domain": "matched_excluded_domain",
}

# --- page access (fixed values) ----------------------------------------------------------
BLOCKED_STATUS = (403, 429, 503)
BLOCKED_TERMS = ("captcha", "access denied", "too many requests", "verifica", "robot")
BLOCKED_TERMS_INDEED = ("captcha", "unusual traffic", "verify")
SKILL_TERMS = (
    "excel", "office", "google sheets", "data entry", "back office",
    "inglese", "italiano", "customer service", "gestionale", "sap",
)
SEARCH_BAD_DOMAINS = (
    "facebook.com", "instagram.com", "pinterest.", "youtube.com",
    "tiktok.com", "reddit.com", "amazon.", "wikipedia.org",
)
SEARCH_GOOD_DOMAINS = (
    "indeed.", "infojobs.", "linkedin.com/jobs", "jooble.", "talent.com",
    "glassdoor.", "monster.", "azienda", "careers", "lavora-con-noi",
)
PREFERRED_MARK = "preferred_domain"
BUTTON_LABELS = ("mostra di più", "mostra di piu", "apply", "candidati")
SOURCE_GROUPS = ("aggregators", "classifieds", "agencies", "remote_data_ai", "public_employment")
STRATEGY_KEYWORDS = ("lavoro", "jobs", "careers", "offerte", "posizione", "vacancy", "remote", "remoto")


# --- marks of the sites' pages (fixed values) -----------------------------------------

CARD_ATTRIBUTE = "data-new-id"
CARD_CLASSES = {"company": ("span", "JobCard_company"), "location": ("span", "JobCard_location"), "snippet": ("p", "JobCard_snippet")}
GIGROUP_BLOCK = ("article", "ggp-job-item")
GIGROUP_KEYWORDS = "ggp-job-keywords"
GIGROUP_PLACE_LABEL = "Luogo di lavoro:"
RESULT_CLASS = "singleResult"
RESULT_DESCRIPTION = "descriptionContainer"
RESULT_LABELS = {"location": "Luogo di lavoro", "sector": "Settore", "role": "Ruolo", "contract": "Tipo di contratto"}
RESULT_PLACES = ("Nazione", "Regione", "Luogo")
META_DESCRIPTIONS = ("description", "og:description")
SMART_WORKING_TERMS = ("smart working", "full remote", "remoto", "lavoro da casa", "ibrido", "ibrida")
FULL_TIME_TERMS = ("full time", "tempo pieno")
