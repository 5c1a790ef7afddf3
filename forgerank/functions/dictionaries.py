"""Fixed values that must equal the reference's for right results.

FIXED VALUES — keyword lists, language hints, level cut-offs, follower slices,
region patterns, retryable error substrings and pipeline constants. They are
kept here plainly, in their natural order, and passed to the operators as
parameters (callers may supply their own).
"""

# ---------------------------------------------------------------- FIXED VALUES
# Model A categories, matched by exact equality on the lower-cased topic.
CATEGORIES_EXACT = {
    "AI": ["machine-learning", "deep-learning", "ai", "artificial-intelligence",
           "neural-network", "tensorflow", "pytorch", "keras", "scikit-learn", "nlp",
           "computer-vision"],
    "Backend": ["api", "server", "backend", "microservices", "rest", "graphql", "database",
                "postgresql", "mysql", "mongodb", "redis", "docker", "kubernetes"],
    "Frontend": ["frontend", "react", "vue", "angular", "javascript", "typescript", "html",
                 "css", "web", "ui", "ux"],
    "DevOps": ["devops", "ci-cd", "automation", "infrastructure", "terraform", "ansible",
               "jenkins", "github-actions", "docker", "kubernetes", "aws", "azure", "gcp"],
    "Data": ["data", "analytics", "big-data", "data-science", "sql", "python", "r", "pandas",
             "numpy", "jupyter", "data-visualization"],
}

# Model A language fallback (exact case), used only when no topic matched.
LANGUAGE_HINTS = {
    "Python": "AI",
    "R": "Data",
    "Julia": "AI",
    "JavaScript": "Frontend",
    "TypeScript": "Frontend",
    "Java": "Backend",
    "C#": "Backend",
    "Go": "Backend",
    "Rust": "Backend",
    "C++": "Backend",
    "PHP": "Backend",
    "Ruby": "Backend",
    "SQL": "Data",
    "Shell": "DevOps",
    "Dockerfile": "DevOps",
    "HCL": "DevOps",
}

# Stage-4 categories, matched by substring over topics + primary language.
CATEGORIES_SUBSTRING = {
    "ai": ["ai", "ml", "machine-learning", "deep-learning", "neural", "tensorflow", "pytorch",
           "nlp", "gpt", "llm", "langchain", "huggingface", "scikit-learn", "keras"],
    "backend": ["backend", "api", "server", "nodejs", "node.js", "python", "java", "go", "rust",
                "spring", "express", "django", "fastapi", "graphql", "database", "sql",
                "mongodb", "postgresql"],
    "frontend": ["frontend", "react", "vue", "angular", "svelte", "typescript", "javascript",
                 "css", "html", "nextjs", "nuxt", "tailwind", "ui", "ux", "web"],
    "devops": ["devops", "docker", "kubernetes", "k8s", "terraform", "aws", "gcp", "azure",
               "ci-cd", "github-actions", "gitlab", "jenkins", "monitoring", "logging",
               "infrastructure"],
    "data": ["data", "analytics", "data-science", "pandas", "numpy", "spark", "hadoop",
             "snowflake", "dbt", "tableau", "powerbi", "etl", "warehouse", "bigquery"],
}

# Experience levels: total score strictly below the bound gets the label.
LEVELS = [
    (10, "Newcomer"),
    (100, "Contributor"),
    (500, "Active Contributor"),
    (2000, "Core Contributor"),
]
TOP_LEVEL = "Open Source Leader"

# Follower slices in search order (lower bound, upper bound or None for open).
FOLLOWER_SLICES = [
    ("10..20", 10, 20),
    ("21..30", 21, 30),
    ("31..40", 31, 40),
    ("41..50", 41, 50),
    ("51..75", 51, 75),
    ("76..100", 76, 100),
    ("101..150", 101, 150),
    ("151..200", 151, 200),
    ("201..300", 201, 300),
    ("301..500", 301, 500),
    ("501..1000", 501, 1000),
    ("1001..2000", 1001, 2000),
    ("2001..5000", 2001, 5000),
    ("5001..10000", 5001, 10000),
    (">10000", 10001, None),
    ("0..9", 0, 9),
]

# Bay Area location patterns used by the regional SQL (substring, lower-cased).
BAY_AREA_PATTERNS = [
    "san francisco", "sf", "sfo", "san fran", "frisco", "the city by the bay",
    "the golden gate city", "golden gate bridge", "mission bay", "daly city",
    "south san francisco", "ssf", "bay area", "the bay", "sf bay area", "norcal",
    "northern california", "america", "silicon valley", "sv", "south bay", "peninsula",
    "san jose", "sj", "sunnyvale", "cupertino", "mountain view", "palo alto", "menlo park",
    "santa clara", "milpitas", "campbell", "los gatos", "saratoga", "los altos", "stanford",
    "redwood city", "san mateo", "foster city", "burlingame", "san bruno", "brisbane",
    "millbrae", "belmont", "san carlos", "atherton", "woodside", "portola valley",
    "half moon bay", "berkeley", "uc berkeley", "oakland", "oaktown", "east bay", "fremont",
    "hayward", "alameda", "richmond", "emeryville", "walnut creek", "concord", "pleasanton",
    "livermore", "dublin", "san ramon", "danville", "castro valley", "union city", "newark",
    "mill valley", "sausalito", "tiburon", "san rafael", "novato", "marin county", "marin",
    "corte madera", "larkspur",
]

# Retryable error substrings (exception path of the enrichment call).
RETRYABLE_ERRORS_REGIONAL = ["timeout", "timed out", "ETIMEDOUT", "ECONNRESET",
                             "ECONNREFUSED", "HTTP 5", "HTTP 429"]
RETRYABLE_ERRORS_GLOBAL = ["timeout", "timed out", "ETIMEDOUT", "ECONNRESET"]

# Pipeline constants.
MAX_REPO_SCORE = 10000.0
MIN_STARS = 10
TOP_REPOS_MODEL_A = 10
TOP_REPOS_STAGE4 = 5
TOP_SKILLS = 10
REGION_SKIP, REGION_TAKE = 250, 4000
GLOBAL_SKIP, GLOBAL_TAKE = 264, 995
MAX_RETRIES = 2
OWNED_REPOS_CAP = 50
CONTRIBUTED_REPOS_CAP = 50
PRS_PER_REPO_CAP = 100
QUALIFYING_REPOS_CAP = 50
USERS_PER_SLICE_CAP = 1000
FRESH_DAYS = 30
DISCOVERY_FRESH_HOURS = 1
RESPONSE_TTL_DAYS = 30
REQUEST_KEY_PREFIX = "github:graphql:"
PROFILE_URL_PREFIX = "https://github.com/"
LINK_URL_PREFIX = "https://linkedin.com/in/"
LINK_PATTERN = r"(?i)(?:linkedin\.com/in/|lnkd\.in/)([a-zA-Z0-9_-]+)"
GHOST_LOGIN = "ghost"

# Enrichment outcome codes.
CODE_HTTP_PREFIX = "HTTP_"
CODE_TIMEOUT = "APIFY_TIMEOUT"
CODE_INVALID = "INVALID_RESPONSE"
CODE_TRANSIENT = "TRANSIENT_ERROR"
CODE_UNKNOWN = "UNKNOWN_ERROR"
TIMEOUT_MESSAGE = "timed out"
# ----------------------------------------------------------- END FIXED VALUES
