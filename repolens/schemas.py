"""Schemas of the landed and modelled tables, and the fixed values the
results depend on."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must stay exactly as listed for results to agree)
# ---------------------------------------------------------------------------

# Missing licence / topic sentinel and the bucket for values outside a top-k.
NA = "__NA__"
OTHER = "Other"

# Supported languages: partition alias -> display name, in this order.
SUPPORTED_LANGUAGES = {
    "python": "Python",
    "jupyter-notebook": "Jupyter Notebook",
    "markdown": "Markdown",
    "html": "HTML",
    "shell": "Shell",
    "java": "Java",
    "javascript": "JavaScript",
    "typescript": "TypeScript",
    "c": "C",
    "cpp": "C++",
    "csharp": "C#",
    "rust": "Rust",
    "go": "Go",
}

# Languages the structure / content crawl accepts.
CONTENT_LANGUAGES = ["python", "jupyter-notebook"]

# Requirement operators that are kept; anything else becomes NULL.
VERSION_OPERATORS = ["~=", ">=", "<=", "==", ">", "<"]

# File-path patterns for the structure crawl and the content crawl.
FULL_PATH_PATTERN = (
    r"^readme.md$|^pyproject.toml$|requirements.*\.txt|"
    r"setup.py|environment.yaml|pipfile|poetry|dockerfile|docker-compose"
)
DEFAULT_PATH_PATTERN = r"^readme.md$|requirements.*\.txt"

# Search paging and report limits.
MAX_ITEMS_PER_PAGE = 100
SEARCH_ITEMS_LIMIT = 1000
MIN_STARS_COUNT = 1
TOP_K_VALUES_TO_KEEP = 10
REPORT_LIMIT = 10000
DISPLAY_LIMIT = 100
TOPIC_OPTION_FLOOR = 10
PACKAGE_OPTION_FLOOR = 10
TOPICS_MAX_LENGTH = 255
VERSION_MAX_LENGTH = 25
DEFAULT_VERSION = "0.0.0"
REFRESH_WINDOW_DAYS = 7

# Regular expressions (Java syntax; \w is spelled out so that it is
# Unicode-aware and reads the same in RE2).
RE_TOPICS_CUT = r"\|?[^|]*$"
RE_TOPICS_SPLIT = "[|]"
RE_COMMENT = r"#.*$"
RE_FIRST_LETTER = r"^\p{L}"
RE_REQUIREMENT = (
    r"^\s*([\p{L}\p{N}_\-\.]+)\s*([><=~]+)?\s*([\p{L}\p{N}_\.]+)?\s*(.*?)\s*(;.*)?$"
)
RE_VERSION = r"\b\d+(\.\d+){0,2}\b"

# ---------------------------------------------------------------------------
# Landed (raw) layer
# ---------------------------------------------------------------------------

OWNER = T.StructType(
    [T.StructField("login", T.StringType()), T.StructField("html_url", T.StringType())]
)
LICENSE = T.StructType([T.StructField("name", T.StringType())])

# The 18 projected columns of a search item.
RAW_REPO_FIELDS = [
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("owner", OWNER),
    T.StructField("html_url", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("topics", T.ArrayType(T.StringType())),
    T.StructField("license", LICENSE),
    T.StructField("archived", T.BooleanType()),
    T.StructField("has_wiki", T.BooleanType()),
    T.StructField("size", T.LongType()),
    T.StructField("default_branch", T.StringType()),
    T.StructField("stargazers_count", T.LongType()),
    T.StructField("watchers_count", T.LongType()),
    T.StructField("forks_count", T.LongType()),
    T.StructField("open_issues_count", T.LongType()),
    T.StructField("created_at", T.StringType()),
    T.StructField("pushed_at", T.StringType()),
]
RAW_REPO_COLUMNS = [f.name for f in RAW_REPO_FIELDS]

# Landed dataset: data columns + created_date, hive partitions
# language=<alias>/created_month=<first day of month>.
RAW_REPO = T.StructType(
    RAW_REPO_FIELDS
    + [
        T.StructField("created_date", T.DateType()),
        T.StructField("language", T.StringType()),
        T.StructField("created_month", T.DateType()),
    ]
)

# Partition layout of every landed dataset: a (language, month) directory
# holds the days of that month, sorted by day inside the files.
LANDING_PARTITIONS = ["language", "created_month"]

# One search response page.
SEARCH_PAGE = T.StructType(
    [
        T.StructField("total_count", T.LongType()),
        T.StructField("items", T.ArrayType(T.StructType(RAW_REPO_FIELDS + [
            T.StructField("language", T.StringType())]))),
    ]
)

TREE_ENTRY = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("url", T.StringType()),
    ]
)
# One recursive file-tree response, tagged with the repo and branch it answers.
TREE_PAGE = T.StructType(
    [
        T.StructField("repo_id", T.LongType()),
        T.StructField("branch", T.StringType()),
        T.StructField("tree", T.ArrayType(TREE_ENTRY)),
    ]
)

STRUCTURE = T.StructType(
    [
        T.StructField("repo_id", T.LongType()),
        T.StructField("path", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("created_date", T.DateType()),
        T.StructField("language", T.StringType()),
        T.StructField("created_month", T.DateType()),
    ]
)

CONTENT = T.StructType(
    [
        T.StructField("repo_id", T.LongType()),
        T.StructField("path", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("created_date", T.DateType()),
        T.StructField("language", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("created_month", T.DateType()),
    ]
)

# ---------------------------------------------------------------------------
# Modelled layer
# ---------------------------------------------------------------------------

REPO_COLUMNS = [
    "id", "name", "owner", "language", "lang_alias", "url", "topics",
    "archived", "has_license", "has_description", "has_wiki", "default_branch",
    "license", "description", "size", "stars", "watchers", "forks",
    "open_issues", "days_since_creation", "days_since_last_commit",
    "creation_date", "last_commit_date", "has_topic",
]

NTZ = T.TimestampNTZType()

REPO = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("owner", T.StringType()),
        T.StructField("language", T.StringType()),
        T.StructField("lang_alias", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("topics", T.StringType()),
        T.StructField("archived", T.IntegerType()),
        T.StructField("has_license", T.IntegerType()),
        T.StructField("has_description", T.IntegerType()),
        T.StructField("has_wiki", T.IntegerType()),
        T.StructField("default_branch", T.StringType()),
        T.StructField("license", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("size", T.LongType()),
        T.StructField("stars", T.LongType()),
        T.StructField("watchers", T.LongType()),
        T.StructField("forks", T.LongType()),
        T.StructField("open_issues", T.LongType()),
        T.StructField("days_since_creation", T.LongType()),
        T.StructField("days_since_last_commit", T.LongType()),
        T.StructField("creation_date", NTZ),
        T.StructField("last_commit_date", NTZ),
        T.StructField("has_topic", T.IntegerType()),
        T.StructField("updated_at", NTZ),
    ]
)

REPO_TOPIC = T.StructType(
    [
        T.StructField("repo_id", T.LongType()),
        T.StructField("language", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("updated_at", NTZ),
    ]
)

OWNER_TABLE = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("n_repos", T.LongType()),
        T.StructField("updated_at", NTZ),
    ]
)

REPO_ANALYTICS = T.StructType(
    [
        T.StructField("language", T.StringType()),
        T.StructField("license", T.StringType()),
        T.StructField("default_branch", T.StringType()),
        T.StructField("creation_date", NTZ),
        T.StructField("creation_year", T.IntegerType()),
        T.StructField("last_commit_date", NTZ),
        T.StructField("last_commit_year", T.IntegerType()),
        T.StructField("n_repos", T.LongType()),
        T.StructField("n_owners", T.LongType()),
        T.StructField("n_archived_repos", T.LongType()),
        T.StructField("n_repos_with_license", T.LongType()),
        T.StructField("n_repos_with_topic", T.LongType()),
        T.StructField("n_repos_with_desc", T.LongType()),
        T.StructField("n_repos_with_wiki", T.LongType()),
        T.StructField("size", T.LongType()),
        T.StructField("stars", T.DoubleType()),
        T.StructField("watchers", T.DoubleType()),
        T.StructField("forks", T.DoubleType()),
        T.StructField("open_issues", T.DoubleType()),
        T.StructField("days_since_creation", T.LongType()),
        T.StructField("days_since_last_commit", T.LongType()),
        T.StructField("updated_at", NTZ),
    ]
)

TOPIC_ANALYTICS = T.StructType(
    [
        T.StructField("language", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("creation_date", NTZ),
        T.StructField("last_commit_date", NTZ),
        T.StructField("n_repos", T.LongType()),
        T.StructField("updated_at", NTZ),
    ]
)

REPO_FILE_METADATA = T.StructType(
    [
        T.StructField("repo_language", T.StringType()),
        T.StructField("repo_creation_date", T.DateType()),
        T.StructField("n_repos", T.LongType()),
        T.StructField("file_path", T.StringType()),
        T.StructField("elapsed_time_seconds", T.LongType()),
        T.StructField("updated_at", NTZ),
    ]
)

PACKAGE = T.StructType(
    [
        T.StructField("repo_id", T.LongType()),
        T.StructField("language", T.StringType()),
        T.StructField("package", T.StringType()),
        T.StructField("version", T.StringType()),
        T.StructField("operator", T.StringType()),
        T.StructField("updated_at", NTZ),
    ]
)

TABLE_SCHEMAS = {
    "repo": REPO,
    "repo_topic": REPO_TOPIC,
    "owner": OWNER_TABLE,
    "repo_analytics": REPO_ANALYTICS,
    "topic_analytics": TOPIC_ANALYTICS,
    "repo_file_metadata": REPO_FILE_METADATA,
    "package": PACKAGE,
}

# Keep-latest keys of each modelled table.
TABLE_KEYS = {
    "repo": ["id"],
    "repo_topic": ["repo_id", "topic"],
    "owner": ["url"],
    "repo_analytics": ["language", "license", "creation_date", "last_commit_date"],
    "topic_analytics": ["language", "topic", "creation_date", "last_commit_date"],
    "repo_file_metadata": ["repo_language", "repo_creation_date"],
    "package": ["repo_id", "package"],
}
