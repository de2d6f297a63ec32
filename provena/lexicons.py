"""Word lists, patterns and tables. They decide results and are stated as they are."""

from __future__ import annotations

SOURCE_TYPES = (
    "official_home", "undergraduate_admissions", "graduate_admissions", "international_admissions", "program_catalog", "tuition_fees",
    "scholarships", "english_requirements", "cost_of_living", "housing", "career", "ranking",
)
CRAWL_METHODS = ("static", "playwright", "pdf", "manual")
REQUIRED_SOURCE_TYPES = ("official_home", "undergraduate_admissions", "tuition_fees", "english_requirements")
ADMISSIONS = ("undergraduate_admissions", "graduate_admissions", "international_admissions")
#: Must-have fields of a profile that count for its completeness.
SCORED_FIELDS = (
    "display_name", "country", "city", "website_url", "type", "subject_tags", "study_level_tags", "tuition_usd_min", "tuition_usd_max",
    "living_cost_usd_min", "living_cost_usd_max", "scholarship_available", "application_system", "deadline_summary", "english_requirement_summary", "review_status",
)

SUBJECTS = {
    "computer_science": ["computer science", "computing", "software", "artificial intelligence", "data science", "informatics"],
    "engineering": ["engineering", "mechanical", "electrical", "civil engineering"],
    "business": ["business", "management", "finance", "accounting", "economics", "mba"],
    "medicine": ["medicine", "medical", "health sciences", "nursing", "biomedical"],
    "law": ["law", "legal studies", "juris"],
    "arts_design": ["art", "design", "fine arts", "creative", "media"],
    "social_sciences": ["social science", "sociology", "politics", "psychology", "anthropology"],
    "natural_sciences": ["science", "physics", "chemistry", "biology", "mathematics"],
    "humanities": ["humanities", "history", "philosophy", "literature", "languages"],
    "architecture": ["architecture", "built environment"],
    "education": ["education", "teaching"],
    "hospitality": ["hospitality", "tourism", "hotel"],
    "environment": ["environment", "sustainability", "climate", "earth sciences"],
}
STUDY_LEVELS = {
    "foundation": ["foundation", "pathway"],
    "bachelor": ["undergraduate", "bachelor", "bachelors", "ba ", "bsc", "b.a.", "b.s."],
    "master": ["graduate", "postgraduate", "master", "masters", "msc", "ma ", "m.a.", "m.s."],
    "phd": ["phd", "ph.d", "doctoral", "doctorate"],
    "mba": ["mba", "master of business administration"],
    "medicine": ["medicine", "mbbs", "md "],
    "law": ["llb", "jd ", "juris doctor", "law"],
}
VIBES = {
    "urban": ["urban", "city", "downtown", "metropolitan"],
    "suburban": ["suburban"],
    "college_town": ["college town", "university town"],
    "campus_based": ["campus-based", "residential campus", "campus life"],
    "research_heavy": ["research-intensive", "research university", "research excellence"],
    "career_focused": ["employability", "career-focused", "career readiness"],
    "arts_friendly": ["arts", "creative community"],
    "startup_focused": ["startup", "entrepreneurship", "innovation hub"],
    "competitive": ["competitive admission", "highly selective"],
    "collaborative": ["collaborative", "team-based"],
    "large_public": ["public university", "large public"],
    "small_private": ["small private", "private university"],
}
SUPPORTS = {
    "scholarship": ["scholarship", "financial aid", "bursary", "grant"],
    "strong_international_office": ["international office", "international student support"],
    "housing_support": ["housing", "accommodation", "residence"],
    "career_services": ["career services", "careers service", "employability"],
    "coop_available": ["co-op", "cooperative education", "work-integrated"],
    "internship_friendly": ["internship", "placement"],
    "english_support": ["english language support", "academic english"],
    "visa_support": ["visa", "immigration advice"],
}
CERTIFICATES = {
    "SAT": r"\bSAT\b", "ACT": r"\bACT\b", "GRE": r"\bGRE\b", "GMAT": r"\bGMAT\b", "LSAT": r"\bLSAT\b", "MCAT": r"\bMCAT\b", "LNAT": r"\bLNAT\b", "UCAT": r"\bUCAT\b", "BMAT": r"\bBMAT\b",
    "TMUA": r"\bTMUA\b", "STEP": r"\bSTEP\b", "AP": r"\bAP\b", "IB": r"\bIB\b|International Baccalaureate", "A_LEVEL": r"\bA-?levels?\b|Advanced Level", "HSK": r"\bHSK\b", "JLPT": r"\bJLPT\b", "TOPIK": r"\bTOPIK\b",
}
CERTIFICATE_NAMES = {"A_LEVEL": "A-Level"}
#: Certificates whose key is also a common word or short form: only upper case counts.
UPPER_CERTIFICATES = ("ACT", "AP", "IB", "STEP")
CERTIFICATE_EXCLUDED = ["certificate", "certification authority", "copyright"]
STEP_WORDS = ["step mathematics", "sixth term", "admissions test", "admission test", "mathematics test", "mathematical"]
CERTIFICATE_WORDS = ["required", "requirement", "admission", "apply", "application", "submit", "score", "qualification", "exam", "test", "optional", "accepted"]
CERTIFICATE_FIRM = ["required", "requirement", "must submit"]
CERTIFICATE_SOFT = ["optional", "accepted", "may submit"]
APPLICATION_SYSTEMS = {
    "ucas": ["ucas"],
    "common_app": ["common app", "common application"],
    "ouac": ["ouac"],
    "coalition_app": ["coalition application", "coalition app"],
    "direct": ["apply direct", "direct application", "online application portal"],
    "school_portal": ["applicant portal", "application portal"],
}
USD = {
    "USD": 1.0, "US$": 1.0, "$": 1.0, "GBP": 1.25, "£": 1.25, "EUR": 1.08, "€": 1.08, "CAD": 0.74, "C$": 0.74, "AUD": 0.66, "A$": 0.66,
    "SGD": 0.74, "S$": 0.74, "HKD": 0.13, "HK$": 0.13, "JPY": 0.0065, "¥": 0.0065, "CNY": 0.14, "RMB": 0.14, "CHF": 1.10,
}
CURRENCY_CODES = {"$": "USD", "US$": "USD", "£": "GBP", "€": "EUR", "¥": "JPY", "C$": "CAD", "A$": "AUD", "S$": "SGD", "HK$": "HKD", "RMB": "CNY"}

SIGNALS = {
    "official_home": ["university", "campus", "students", "research", "admissions"],
    "undergraduate_admissions": ["apply", "admission", "undergraduate", "deadline", "requirements"],
    "graduate_admissions": ["graduate", "postgraduate", "admission", "apply", "requirements"],
    "international_admissions": ["international", "admission", "applicants", "requirements"],
    "program_catalog": ["program", "programme", "course", "degree", "bachelor", "master"],
    "tuition_fees": ["tuition", "fee", "fees", "cost", "international student"],
    "scholarships": ["scholarship", "financial aid", "bursary", "funding", "grant"],
    "english_requirements": ["english", "ielts", "toefl", "pte", "duolingo", "language"],
    "cost_of_living": ["living cost", "cost of living", "accommodation", "housing", "expenses"],
    "housing": ["housing", "accommodation", "residence", "residences"],
    "career": ["career", "employability", "internship", "placement"],
}
BLOCKS = {
    "blocked": ["403 forbidden", "access denied", "request unsuccessful. incapsula incident id"],
    "js_challenge": ["just a moment", "enable javascript", "verify you are human", "checking your browser"],
    "not_found": ["404 not found", "page not found", "oops! page not found", "the page you requested could not be found"],
}
BLOCK_MARKERS = ["request unsuccessful. incapsula incident id", "access denied", "captcha", "verify you are human", "enable javascript and cookies"]

CURRENCY_SIGNS = r"US\$|C\$|A\$|S\$|HK\$|USD|GBP|EUR|CAD|AUD|SGD|HKD|JPY|CNY|RMB|CHF|[$£€¥]"
AMOUNT = r"\d{1,3}(?:,\d{3})+|\d{4,6}"
IELTS = r"IELTS[^.\n]{0,80}?([5-9](?:\.\d)?)"
TOEFL = r"TOEFL[^.\n]{0,80}?(\d{2,3})"
PTE = r"\bPTE\b[^.\n]{0,80}?(\d{2,3})"
MONTHS = "Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Sept|Oct|Nov|Dec"
DATE = rf"\b(?:\d{{1,2}}\s+(?:{MONTHS})[a-z]*\.?\s+\d{{4}}|(?:{MONTHS})[a-z]*\.?\s+\d{{1,2}}(?:,\s*\d{{4}})?|\d{{8}})\b"
PROGRAM_NAME = r"((?:Bachelor|Master|MSc|MA|BSc|PhD|MBA)[^.;:\n]{3,80})"
VALID_ENGLISH = r"\bIELTS\s+[4-9](?:\.\d)?\b|\bTOEFL\s+(?:[4-9]\d|1[01]\d|120)\b|\bPTE\s+(?:[3-8]\d|90)\b|\bDuolingo\s+(?:[6-9]\d|1[0-5]\d|160)\b"
MONEY_REJECT = [
    "application fee", "deposit", "housing", "room", "board", "meal", "books", "personal expenses", "transportation", "financial aid",
    "family income", "scholarship", "grant", "cost of attendance", "estimated expenses",
]
MONEY_LABELS = {
    "tuition_fee": ["tuition", "tuition fee", "programme fee", "program fee", "annual fee", "international student fee", "non-local student fee", "overseas fee"],
    "living_cost": ["living cost", "cost of living", "living expenses"],
    "housing_cost": ["housing", "room", "accommodation", "residence"],
    "application_fee": ["application fee", "admission fee"],
    "scholarship_amount": ["scholarship", "grant", "bursary"],
    "aid_income_threshold": ["family income", "household income", "income threshold"],
    "total_cost": ["cost of attendance", "total cost"],
}
ENGLISH_WORDS = ["english language", "english proficiency", "toefl", "ielts", "pte", "duolingo"]
SUMMARY_JUNK = ["skip navigation", "breadcrumb", "search", "helpful links", "compare programmes", "contact us", "applicant portal", "menu"]
EXTRACTED_ORIGINS = ("extracted_from_source", "llm_extracted_from_source", "manual")
LLM_ORIGIN = "llm_extracted_from_source"

#: Link labels in the order in which candidates are chosen.
CANDIDATE_TYPES = (
    "undergraduate_admissions", "international_admissions", "graduate_admissions", "program_catalog", "tuition_fees",
    "scholarships", "english_requirements", "cost_of_living", "housing", "career",
)
LINK_HINTS = {
    "undergraduate_admissions": ["undergraduate admission", "undergraduate admissions", "apply undergraduate", "admissions", "apply"],
    "graduate_admissions": ["graduate admission", "graduate admissions", "postgraduate", "graduate apply"],
    "international_admissions": ["international admissions", "international students", "international applicants"],
    "program_catalog": ["programs", "programmes", "courses", "degrees", "academics", "study"],
    "tuition_fees": ["tuition", "fees", "cost of attendance", "student fees"],
    "scholarships": ["scholarship", "scholarships", "financial aid", "bursaries", "funding"],
    "english_requirements": ["english language", "ielts", "toefl", "language requirements", "english requirements"],
    "cost_of_living": ["cost of living", "living costs", "student budget"],
    "housing": ["housing", "accommodation", "residence", "residences"],
    "career": ["career", "careers", "employability", "internship", "co-op"],
}
MEDIA_SUFFIX = r"(?i)\.(jpg|jpeg|png|gif|svg|webp|zip|mp4|mp3)$"
TWO_PART_SUFFIXES = ("ac.uk", "edu.au", "edu.cn")
QUERY_TEMPLATES = {
    "undergraduate_admissions": "{name} undergraduate admissions official",
    "tuition_fees": "{name} international tuition fees official",
    "english_requirements": "{name} English language requirements admissions official",
    "program_catalog": "{name} undergraduate programs official",
    "scholarships": "{name} scholarships international students official",
}

ID_ALIASES = {
    "uva_nl": "amsterdam", "anu_au": "anu", "auck_nz": "auckland", "bocconi_it": "bocconi", "caltech_us": "caltech", "cam_uk": "cambridge", "cmu_us": "cmu", "columbia_us": "columbia",
    "cornell_us": "cornell", "cuhk_hk": "cuhk", "tudelft_nl": "delft", "ed_uk": "edinburgh", "epfl_ch": "epfl", "ethz_ch": "eth-zurich", "harvard_us": "harvard", "heidelberg_de": "heidelberg",
    "hku_hk": "hku", "hkust_hk": "hkust", "imperial_uk": "imperial", "kaist_kr": "kaist", "kcl_uk": "kcl", "kuleuven_be": "ku-leuven", "kyoto_jp": "kyoto", "lmu_de": "lmu-munich",
    "melb_au": "melbourne", "mit_us": "mit", "nus_sg": "nus", "oxford_uk": "oxford", "pku_cn": "peking", "princeton_us": "princeton", "snu_kr": "snu", "sorbonne_fr": "sorbonne",
    "stanford_us": "stanford", "usyd_au": "sydney", "utokyo_jp": "tokyo", "utoronto_ca": "toronto", "tsinghua_cn": "tsinghua", "ubc_ca": "ubc", "uchicago_us": "uchicago", "ucl_uk": "ucl", "yale_us": "yale",
}
COUNTRY_ALIASES = {
    "united states": "united states", "united states of america": "united states", "usa": "united states", "us": "united states", "united kingdom": "united kingdom", "uk": "united kingdom",
    "south korea": "south korea", "korea south": "south korea", "republic of korea": "south korea", "china mainland": "china", "mainland china": "china",
    "hong kong sar": "hong kong", "hong kong s.a.r.": "hong kong", "hong kong sar china": "hong kong", "taiwan china": "taiwan",
}
#: Other names of an institution, by its id.
NAME_ALIASES = {
    "mit": ["MIT"],
    "uc-berkeley": ["University of California, Berkeley", "UC Berkeley", "Berkeley"],
    "caltech": ["Caltech"],
    "uchicago": ["The University of Chicago"],
    "upenn": ["Penn", "University of Pennsylvania"],
    "cmu": ["Carnegie Mellon"],
    "ubc": ["The University of British Columbia"],
    "ucl": ["UCL", "University College London"],
    "lse": ["London School of Economics", "The London School of Economics and Political Science"],
    "kcl": ["King's College London", "King’s College London"],
    "eth-zurich": ["ETH Zurich - Swiss Federal Institute of Technology", "ETH Zürich"],
    "epfl": ["Ecole Polytechnique Fédérale de Lausanne", "EPFL"],
    "tum": ["Technical University of Munich", "Technische Universität München"],
    "lmu-munich": ["LMU Munich", "Ludwig-Maximilians-Universität München"],
    "lmumunich": ["LMU Munich", "Ludwig-Maximilians-Universität München"],
    "ku-leuven": ["KU Leuven", "Katholieke Universiteit Leuven"],
    "nus": ["NUS", "National University of Singapore"],
    "ntu-singapore": ["Nanyang Technological University, Singapore", "NTU Singapore"],
    "hku": ["The University of Hong Kong", "University of Hong Kong"],
    "cuhk": ["The Chinese University of Hong Kong", "Chinese University of Hong Kong"],
    "hkust": ["The Hong Kong University of Science and Technology", "HKUST"],
    "tokyo": ["The University of Tokyo", "University of Tokyo"],
    "snu": ["Seoul National University"],
    "kaist": ["Korea Advanced Institute of Science and Technology", "KAIST"],
    "unsw": ["UNSW Sydney", "The University of New South Wales"],
    "jhu": ["Johns Hopkins University"],
    "wustl": ["Washington University in St. Louis"],
    "notredame": ["University of Notre Dame"],
    "umich": ["University of Michigan-Ann Arbor", "University of Michigan"],
    "uva": ["University of Virginia"],
    "unc": ["University of North Carolina at Chapel Hill"],
    "utaustin": ["University of Texas at Austin", "The University of Texas at Austin"],
    "uwmadison": ["University of Wisconsin-Madison", "University of Wisconsin Madison"],
    "uiuc": ["University of Illinois Urbana-Champaign", "University of Illinois at Urbana-Champaign"],
    "ucsd": ["University of California, San Diego", "UC San Diego"],
    "ucsb": ["University of California, Santa Barbara", "UC Santa Barbara"],
    "ucdavis": ["University of California, Davis", "UC Davis"],
    "uci": ["University of California, Irvine", "UC Irvine"],
    "gatech": ["Georgia Institute of Technology", "Georgia Tech"],
    "umontreal": ["Université de Montréal", "University of Montreal"],
    "ualberta": ["University of Alberta"],
    "ucalgary": ["University of Calgary"],
    "kth": ["KTH Royal Institute of Technology"],
    "uzh": ["University of Zurich", "Universität Zürich"],
    "psl": ["Université PSL", "Paris Sciences et Lettres University", "PSL University"],
    "polytechnique": ["Ecole Polytechnique", "Institut Polytechnique de Paris"],
    "sjtu": ["Shanghai Jiao Tong University"],
    "ustc": ["University of Science and Technology of China"],
    "sysu": ["Sun Yat-sen University"],
    "cityu": ["City University of Hong Kong"],
    "polyu": ["The Hong Kong Polytechnic University", "Hong Kong Polytechnic University"],
    "ntu_tw": ["National Taiwan University"],
    "uq": ["The University of Queensland", "University of Queensland"],
    "uwa": ["The University of Western Australia", "University of Western Australia"],
    "usc": ["University of Southern California"],
    "psu": ["Pennsylvania State University", "Penn State"],
    "osu": ["The Ohio State University", "Ohio State University"],
    "ucsc": ["University of California, Santa Cruz", "UC Santa Cruz"],
    "umd": ["University of Maryland, College Park", "University of Maryland College Park"],
    "bc": ["Boston College"],
    "osaka": ["Osaka University", "The University of Osaka"],
    "rutgers": ["Rutgers University", "Rutgers University New Brunswick", "Rutgers University - New Brunswick"],
    "tcd": ["Trinity College Dublin", "The University of Dublin, Trinity College", "Trinity College Dublin The University of Dublin"],
    "ucd": ["University College Dublin"],
    "uwashington": ["University of Washington"],
    "postech": ["Pohang University of Science and Technology", "POSTECH"],
    "tamu": ["Texas A&M University"],
}
NAME_STOPWORDS = ("the", "of", "and", "at", "in", "for")

RANKING_PROVIDER = "QS"
RANKING_YEAR = "2026"
RANKING_URL = "https://www.topuniversities.com/world-university-rankings"
# Addresses that are asked for rankings, in this order.
RANKING_URLS = (
    RANKING_URL, "https://www.topuniversities.com/universities/json", "https://www.topuniversities.com/universities/api",
    "https://www.topuniversities.com/universities/static/api", "https://www.topuniversities.com/universities/qs-world-university-rankings",
)
RANK_HEADERS = ("rank", "rank_raw", "rank display", "rank_display", "2026 rank", "overall rank", "world rank")
NAME_HEADERS = ("institution_name", "institution", "university", "university name", "name", "title")
COUNTRY_HEADERS = ("country", "location", "country/territory", "country territory", "region")
CITY_HEADERS = ("city", "city_name")
RECORD_NAME_KEYS = ("institution_name", "university", "title", "name", "uni", "nid_title")
RECORD_RANK_KEYS = ("rank", "rank_display", "overall_rank", "ranking", "rank_2026", "rank_display_rank")
RECORD_COUNTRY_KEYS = ("country", "location", "country_name", "region_country")
RECORD_CITY_KEYS = ("city", "city_name")
#: Weights of the published profile match score.
MATCH_WEIGHTS = {"country": 25, "subject": 25, "budget": 20, "level": 15, "vibe": 10, "support": 5}
