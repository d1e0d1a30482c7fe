"""Results agree with the original analysis only when these lists and limits do."""

# fixed values: labels that are markup, configuration or too generic to be a language
EXCLUDED_LABELS = (
    "other", "markdown", "text", "unknown", "data", "json", "yaml",
    "xml", "html", "css", "makefile", "dockerfile", "cmake", "shell",
    "batchfile", "ignore list", "rich text format", "ant build system",
)

# fixed values: technologies a migration edge may connect
TECHNOLOGIES = (
    # languages
    "python", "javascript", "typescript", "java", "go", "rust", "kotlin",
    "swift", "scala", "ruby", "php", "c", "cpp", "r", "dart",
    "elixir", "clojure", "haskell", "lua", "perl", "groovy", "coffeescript",
    # frameworks
    "flask", "fastapi", "django", "rails", "spring", "express", "react",
    "angular", "vue", "svelte", "nextjs", "nuxt", "laravel", "symfony",
    # testing
    "junit", "pytest", "mocha", "jest", "rspec",
    # build and delivery
    "webpack", "vite", "rollup", "parcel", "gradle", "maven", "bazel",
    "travis", "jenkins", "github-actions", "circleci", "gitlab-ci",
    # databases
    "mysql", "postgres", "postgresql", "mongodb", "redis", "elasticsearch",
    "sqlite", "cassandra", "dynamodb", "firebase",
    # infrastructure
    "docker", "kubernetes", "terraform", "ansible", "helm",
    "aws", "gcp", "azure", "heroku", "netlify", "vercel",
    # package managers
    "npm", "yarn", "pnpm", "pip", "poetry", "cargo",
)

# fixed values: automation accounts
BOT_PATTERN = "bot|renovate|dependabot|github-actions|autobot|no-reply"

# fixed values: months sampled from each year, and the usual thresholds
SAMPLED_MONTHS = (4, 8, 12)
LAST_ACTIVITY_MONTH = "2025-06"
LAST_ACTOR_YEAR = "2025"
MIN_MONTHS = 12
MIN_SPAN = 36
HORIZON = 24
TOP_SERIES = 30
MIN_EDGE_WEIGHT = 3
TOP_ACTORS = 25_000
MIN_REPOS, MAX_REPOS = 2, 2_000
MAX_MEMBERS = 200
MIN_SHARED = 1
CLUSTERS = 6
SEED = 42
DAMPING = 0.85

# fixed values: word stems that announce a migration, and the token that names a technology
MIGRATION_STEMS = ("migrat", "replac", "rewrite", "switch", "mov", "upgrad", "drop", "remov", "swap")
SWAP_STEMS = ("replac", "swap")
TOKEN = r"[\w][\w\-\.]{1,29}"
TOKEN_LENGTH = (2, 30)

# fixed values: the narrower whole-word filters and parsers of the original extraction
STRICT_PAYLOAD_FILTER = r"\b(?:migrat|replac|rewrite|switch|upgrad|drop|remov|swap)\b"
STRICT_MESSAGE_FILTER = (
    r"\b(?:migrat|replac|rewrite|switch\w*\s+to|mov\w*\s+to|upgrad|drop\w*\s+from|remov\w*\s+from|swap\w*\s+with)\b"
)
STRICT_PATTERNS = {
    "from_verb": r"(?:migrat\w*|replac\w*|rewrite\w*|switch\w*|mov\w*|upgrad\w*|drop\w*|remov\w*)[^.\n]{0,60}?\bfrom\b\s+([\w][\w\-\.]{1,29})",
    "from_swap": r"\b(?:replac\w*|swap\w*)\s+([\w][\w\-\.]{1,29})\s+with\b",
    "to_verb": r"(?:migrat\w*|replac\w*|rewrite\w*|switch\w*|mov\w*|upgrad\w*|drop\w*|remov\w*)[^.\n]{0,60}?\b(?:to|with|into)\b\s+([\w][\w\-\.]{1,29})",
    "to_direct": r"\b(?:switch\w*|mov\w*|migrat\w*|upgrad\w*|rewrite\w*)\s+to\s+([\w][\w\-\.]{1,29})",
}

# fixed values: growth ratio from first to last month, above which a trajectory has the name
TRAJECTORY_BOUNDS = ((20.0, "explosive"), (4.0, "strong"), (1.2, "stable"))
TRAJECTORY_ELSE = "declining"

# fixed values: overlapping periods of the migration view (from year, to year)
EDGE_PERIODS = (("full", None, None), ("early", None, 2018), ("mid", 2018, 2021), ("late", 2021, None))

# fixed values: the features of a category, in the order of the stored centres
FEATURES = (
    "avg_repo_growth",
    "commit_volatility",
    "repo_range_ratio",
    "avg_repo_count",
    "avg_commit_count",
)
