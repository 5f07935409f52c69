"""Word lists, patterns, labels and thresholds.

Everything here is a value that must be exactly so for results to be right.
Rules are configuration: every function that uses one takes it as a parameter.
"""

from __future__ import annotations

# --- Fixed values: labels -------------------------------------------------
UNKNOWN = "Unknown"
UNKNOWN_COMPANY = "Unknown Company"
NOT_SPECIFIED = "Not Specified"
OTHER_ROLE = "Other Analyst"
OTHER_CATEGORY = "Other"
CITY_NOT_SPECIFIED = "City Not Specified"
REMOTE_PLACE = "Remote - India"
SCOPE_REMOTE = "Remote India"
SCOPE_COUNTRY = "India - City Not Specified"
SCOPE_CITY = "Specific City"
RECENT_PERIOD = "Recent 90 Days"
EARLIER_PERIOD = "Pre-90-Day Period"

# --- Fixed values: placeholder employer names ------------------------------
PLACEHOLDER_NAMES = [
    "testhiring", "test", "demo", "sample company", "xyz company", "abc company", "dummy",
]

# --- Fixed values: boolean texts -------------------------------------------
TRUE_TEXTS = ["1", "1.0", "true", "yes", "y"]
FALSE_TEXTS = ["0", "0.0", "false", "no", "n", "<na>", ""]

# --- Fixed values: null tokens of delimited text files ----------------------
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# --- Fixed values: role families, first match wins --------------------------
ROLE_RULES = [
    ("Data Analyst", [r"\bdata analyst\b", r"\bdata analytics analyst\b", r"\bdata analysis analyst\b"]),
    ("Business Analyst", [r"\bbusiness data analyst\b", r"\bbusiness analyst\b"]),
    ("BI Analyst", [r"\bbusiness intelligence analyst\b", r"\bbi analyst\b", r"\bbusiness intelligence\b"]),
    ("Reporting / MIS Analyst", [r"\breporting analyst\b", r"\bmis analyst\b", r"\bdata visualization analyst\b"]),
    ("Product Analyst", [r"\bproduct analytics analyst\b", r"\bproduct analyst\b", r"\bproduct analytics\b"]),
    ("Insights / Customer Analytics", [
        r"\bcustomer insights analyst\b", r"\binsights analyst\b", r"\bcustomer analytics analyst\b",
        r"\bcustomer analytics\b",
    ]),
    ("Marketing Analytics", [
        r"\bmarketing analytics analyst\b", r"\bmarketing analyst\b", r"\bmarketing analytics\b",
    ]),
    ("Data Quality / Governance", [
        r"\bdata quality analyst\b", r"\bdata governance analyst\b", r"\bdata management analyst\b",
        r"\bdata integrity analyst\b", r"\bdata validation analyst\b", r"\bdata quality\b",
        r"\bdata governance\b",
    ]),
    ("Operations / Process Analytics", [
        r"\boperations analytics analyst\b", r"\boperations analyst\b", r"\bprocess analytics analyst\b",
        r"\boperations analytics\b", r"\bprocess analytics\b",
    ]),
    ("Risk / Quantitative Analytics", [
        r"\brisk analytics analyst\b", r"\brisk analyst\b", r"\bquantitative analyst\b", r"\brisk analytics\b",
    ]),
    ("Pricing / Revenue / Commercial", [
        r"\bpricing analyst\b", r"\brevenue analyst\b", r"\bcommercial analytics analyst\b",
        r"\bcommercial analyst\b", r"\bcommercial analytics\b",
    ]),
    ("Performance / Strategy", [r"\bperformance analyst\b", r"\bstrategy analyst\b"]),
    ("Analytics Analyst", [r"\banalytics analyst\b", r"\banalytics associate\b"]),
]

# --- Fixed values: place aliases, first match wins ---------------------------
PLACE_ALIASES = [
    ("bangalore", "Bengaluru"), ("bengaluru", "Bengaluru"), ("hyderabad", "Hyderabad"), ("pune", "Pune"),
    ("mumbai", "Mumbai"), ("navi mumbai", "Navi Mumbai"), ("thane", "Thane"), ("chennai", "Chennai"),
    ("gurgaon", "Gurugram"), ("gurugram", "Gurugram"), ("noida", "Noida"), ("new delhi", "Delhi"),
    ("delhi", "Delhi"), ("kolkata", "Kolkata"), ("calcutta", "Kolkata"), ("ahmedabad", "Ahmedabad"),
    ("kochi", "Kochi"), ("cochin", "Kochi"), ("jaipur", "Jaipur"), ("chandigarh", "Chandigarh"),
    ("coimbatore", "Coimbatore"), ("indore", "Indore"), ("vadodara", "Vadodara"), ("baroda", "Vadodara"),
    ("bhubaneswar", "Bhubaneswar"), ("visakhapatnam", "Visakhapatnam"), ("vizag", "Visakhapatnam"),
    ("lucknow", "Lucknow"), ("thiruvananthapuram", "Thiruvananthapuram"),
    ("trivandrum", "Thiruvananthapuram"),
]

# --- Fixed values: region of a place -----------------------------------------
REGION_OF_PLACE = {
    "Bengaluru": "Karnataka", "Hyderabad": "Telangana", "Pune": "Maharashtra", "Mumbai": "Maharashtra",
    "Navi Mumbai": "Maharashtra", "Thane": "Maharashtra", "Chennai": "Tamil Nadu", "Gurugram": "Haryana",
    "Noida": "Uttar Pradesh", "Delhi": "Delhi", "Kolkata": "West Bengal", "Ahmedabad": "Gujarat",
    "Kochi": "Kerala", "Jaipur": "Rajasthan", "Chandigarh": "Chandigarh", "Coimbatore": "Tamil Nadu",
    "Indore": "Madhya Pradesh", "Vadodara": "Gujarat", "Bhubaneswar": "Odisha",
    "Visakhapatnam": "Andhra Pradesh", "Lucknow": "Uttar Pradesh", "Thiruvananthapuram": "Kerala",
}

# --- Fixed values: region names searched in the raw text, first match wins ----
REGION_TOKENS = [
    ("karnataka", "Karnataka"), ("telangana", "Telangana"), ("maharashtra", "Maharashtra"),
    ("tamil nadu", "Tamil Nadu"), ("haryana", "Haryana"), ("uttar pradesh", "Uttar Pradesh"),
    ("west bengal", "West Bengal"), ("gujarat", "Gujarat"), ("kerala", "Kerala"),
    ("rajasthan", "Rajasthan"), ("madhya pradesh", "Madhya Pradesh"), ("odisha", "Odisha"),
    ("andhra pradesh", "Andhra Pradesh"), ("punjab", "Punjab"), ("delhi", "Delhi"),
]

# --- Fixed values: work modes, first match wins --------------------------------
WORK_MODE_RULES = [
    ("Hybrid", [r"\bhybrid\b"]),
    ("Remote", [r"\b(remote|work from home|wfh|work remotely)\b"]),
    ("On-site", [r"\b(on[- ]?site|onsite|in[- ]office|in office)\b"]),
]

# --- Fixed values: tags, their patterns and categories -------------------------
TAG_RULES = [
    ("SQL", [r"\bsql\b"]),
    ("Python", [r"\bpython\b"]),
    ("Excel", [r"\bmicrosoft excel\b", r"\bms excel\b", r"\bexcel\b"]),
    ("Power BI", [r"\bpower\s*bi\b", r"\bpowerbi\b"]),
    ("Tableau", [r"\btableau\b"]),
    ("R", [r"(?<![a-z0-9])r programming(?![a-z0-9])", r"(?<![a-z0-9])r language(?![a-z0-9])"]),
    ("DAX", [r"\bdax\b"]),
    ("Power Query", [r"\bpower query\b"]),
    ("PostgreSQL", [r"\bpostgresql\b", r"\bpostgres\b"]),
    ("MySQL", [r"\bmysql\b"]),
    ("Oracle", [r"\boracle sql\b", r"\boracle database\b", r"\boracle db\b"]),
    ("SQL Server", [r"\bsql server\b", r"\bmssql\b"]),
    ("BigQuery", [r"\bbigquery\b", r"\bgoogle big query\b"]),
    ("Snowflake", [r"\bsnowflake\b"]),
    ("Redshift", [r"\bredshift\b"]),
    ("Databricks", [r"\bdatabricks\b"]),
    ("Azure", [r"\bmicrosoft azure\b", r"\bazure\b"]),
    ("AWS", [r"\bamazon web services\b", r"\baws\b"]),
    ("GCP", [r"\bgoogle cloud platform\b", r"\bgcp\b"]),
    ("Looker", [r"\blooker\b"]),
    ("Qlik", [r"\bqlik sense\b", r"\bqlikview\b", r"\bqlik\b"]),
    ("Alteryx", [r"\balteryx\b"]),
    ("dbt", [r"\bdbt\b"]),
    ("Airflow", [r"\bapache airflow\b", r"\bairflow\b"]),
    ("Spark", [r"\bapache spark\b", r"\bpyspark\b", r"\bspark\b"]),
    ("Hadoop", [r"\bhadoop\b"]),
    ("ETL", [r"\betl\b"]),
    ("ELT", [r"\belt\b"]),
    ("Data Modeling", [
        r"\bdata modelling\b", r"\bdata modeling\b", r"\bdimensional modeling\b", r"\bdimensional modelling\b",
    ]),
    ("Data Warehousing", [r"\bdata warehouse\b", r"\bdata warehousing\b"]),
    ("Statistics", [
        r"\bstatistics\b", r"\bstatistical analysis\b", r"\bstatistical modelling\b", r"\bstatistical modeling\b",
    ]),
    ("A/B Testing", [r"\ba/?b testing\b", r"\bab testing\b", r"\bexperimentation\b"]),
    ("Regression", [r"\bregression\b"]),
    ("Forecasting", [r"\bforecasting\b"]),
    ("Machine Learning", [r"\bmachine learning\b", r"\bml models?\b"]),
    ("Pandas", [r"\bpandas\b"]),
    ("NumPy", [r"\bnumpy\b"]),
    ("SciPy", [r"\bscipy\b"]),
    ("Git", [r"\bgit\b", r"\bgithub\b", r"\bgitlab\b"]),
    ("Jira", [r"\bjira\b"]),
    ("SSIS", [r"\bssis\b"]),
    ("SAP", [r"\bsap\b"]),
    ("SAS", [r"\bsas\b"]),
    ("SPSS", [r"\bspss\b"]),
]

TAG_CATEGORIES = {
    "SQL": "Database / Query", "Python": "Programming", "Excel": "Spreadsheet",
    "Power BI": "BI / Visualization", "Tableau": "BI / Visualization", "R": "Programming",
    "DAX": "BI / Visualization", "Power Query": "BI / Visualization", "PostgreSQL": "Database / Query",
    "MySQL": "Database / Query", "Oracle": "Database / Query", "SQL Server": "Database / Query",
    "BigQuery": "Cloud / Warehouse", "Snowflake": "Cloud / Warehouse", "Redshift": "Cloud / Warehouse",
    "Databricks": "Data Engineering", "Azure": "Cloud", "AWS": "Cloud", "GCP": "Cloud",
    "Looker": "BI / Visualization", "Qlik": "BI / Visualization", "Alteryx": "Analytics Tool",
    "dbt": "Data Engineering", "Airflow": "Data Engineering", "Spark": "Data Engineering",
    "Hadoop": "Data Engineering", "ETL": "Data Engineering", "ELT": "Data Engineering",
    "Data Modeling": "Data Engineering", "Data Warehousing": "Data Engineering",
    "Statistics": "Statistics / Analytics", "A/B Testing": "Statistics / Analytics",
    "Regression": "Statistics / Analytics", "Forecasting": "Statistics / Analytics",
    "Machine Learning": "Machine Learning", "Pandas": "Programming", "NumPy": "Programming",
    "SciPy": "Programming", "Git": "Developer Tool", "Jira": "Collaboration Tool",
    "SSIS": "Data Engineering", "SAP": "Enterprise Tool", "SAS": "Statistics / Analytics",
    "SPSS": "Statistics / Analytics",
}

TRACKED_TAGS = ["SQL", "Excel", "Power BI", "Python", "Tableau"]
COMPARED_TAG = "SQL"

# --- Fixed values: years-of-experience patterns ---------------------------------
# (pattern, has_high, texts of which one is always part of a match): without has_high
# the single number is both ends of the range.
RANGE_PATTERNS = [
    (r"\b(\d{1,2})\s*(?:-|–|to)\s*(\d{1,2})\s*(?:years?|yrs?)\b", True, ["year", "yr"]),
    (r"\b(?:minimum|min\.?|at least)\s*(?:of\s*)?(\d{1,2})\+?\s*(?:years?|yrs?)\b", False, ["min", "at least"]),
    (r"\b(\d{1,2})\+\s*(?:years?|yrs?)\b", False, ["+"]),
    (r"\b(\d{1,2})\s*(?:years?|yrs?)\s+(?:of\s+)?experience\b", False, ["experience"]),
]
RANGE_LOW, RANGE_HIGH = 0, 30

# --- Fixed values: experience bands [low, high) ----------------------------------
BAND_EDGES = [
    (0, 1, "0–1"), (1, 2, "1–2"), (2, 3, "2–3"), (3, 4, "3–4"), (4, 5, "4–5"), (5, 6, "5–6"),
    (6, 7, "6–7"), (7, 8, "7–8"), (8, 9, "8–9"), (9, 10, "9–10"), (10, 15, "10–15"),
]
BAND_ABOVE = "15+"
BAND_ORDER = [label for _, _, label in BAND_EDGES] + [BAND_ABOVE, NOT_SPECIFIED]

# --- Fixed values: pay-period evidence, first match wins ---------------------------
# (unit, multiplier, texts of which one is always part of a match, pattern)
PAY_PATTERNS = [
    ("MONTHLY", 1.0, ["month", "pm", "p.m"],
     r"(?:salary|budget|ctc)[^.\n]{0,120}?(?:₹|rs\.?|inr)?\s*([\d,]+(?:\.\d+)?)\s*"
     r"(?:per\s+month|monthly|/month|p\.?m\.?)\b"),
    ("MONTHLY", 1.0, ["month", "pm", "p.m"],
     r"(?:₹|rs\.?|inr)\s*([\d,]+(?:\.\d+)?)\s*(?:per\s+month|monthly|/month|p\.?m\.?)\b"),
    ("ANNUAL", 100_000.0, ["lpa", "lakh"],
     r"(?:salary|budget|ctc)?[^.\n]{0,100}?([\d]+(?:\.\d+)?)\s*(?:lpa|lakhs?\s+per\s+annum)\b"),
    ("ANNUAL", 1.0, ["annum", "year", "annual"],
     r"(?:salary|budget|ctc)[^.\n]{0,120}?(?:₹|rs\.?|inr)?\s*([\d,]+(?:\.\d+)?)\s*"
     r"(?:per\s+annum|per\s+year|yearly|annual(?:ly)?)\b"),
]
PAY_TOLERANCE = 0.35
PAY_ANNUAL_SCALE = 300_000
PAY_EVIDENCE_CHARS = 180
PAY_NO_EVIDENCE = "No explicit salary-period evidence"
PAY_NO_RANGE = "No usable source salary range"
STATUS_NOT_ELIGIBLE = "Not Eligible"
STATUS_MONTHLY_AS_IS = "Monthly Evidence - Source Annualized"
STATUS_MONTHLY_SCALED = "Annualized from Monthly"
STATUS_ANNUAL_AS_IS = "Annual Evidence"
STATUS_ANNUAL_SCALED = "Annualized using LPA Evidence"
STATUS_SCALE = "Annual Scale"
STATUS_AMBIGUOUS = "Ambiguous Salary Period"
STATUS_FALLBACK = "No Salary Source"
DISCLOSURE_NONE = "No Source Salary"
DISCLOSURE_ELIGIBLE = "Analysis Eligible"
DISCLOSURE_EXCLUDED = "Source Salary - Excluded"

# --- Fixed values: thresholds ----------------------------------------------------
MIN_N_ROLE_CITY = 30
MIN_N_BAND = 20
MIN_N_TAG = 10
HIGH_PAY = 3_000_000
FLAT_SLOPE = 0.05
BOOTSTRAP_ITERATIONS = 50_000
BOOTSTRAP_SEED = 42
RECENT_DAYS = 90
WINDOW_START = "2026-01-01"
WINDOW_END = "2026-08-16"

# --- Fixed values: columns of the clean table, in order ----------------------------
CLEAN_COLUMNS = [
    "job_id", "source", "source_family", "source_provider", "title", "company_name", "location_name",
    "city", "state", "location_scope", "role_family", "work_mode", "description", "created_at",
    "posted_date", "posted_month", "week_start", "is_recent_90d", "is_complete_week",
    "experience_min_years", "experience_max_years", "experience_band", "salary_min_source",
    "salary_max_source", "salary_min", "salary_max", "salary_is_predicted", "has_salary_source",
    "salary_analysis_eligible", "salary_midpoint", "salary_normalization_status",
    "salary_text_evidence", "skill_count", "has_extracted_skill", "contract_type", "contract_time",
    "redirect_url",
]
