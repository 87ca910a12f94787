"""Fixed values that must equal the reference's for identical results.

Fixed values: task parameter names, session field names, the bucket labels
and their edges (visit length in seconds, step length in actions), the
rounding scale of ratios and the text time formats.
"""

# Task parameter names (JSON keys of task_param).
PARAM_START_DATE = "startDate"
PARAM_END_DATE = "endDate"
PARAM_START_AGE = "startAge"
PARAM_END_AGE = "endAge"
PARAM_PROFESSIONALS = "professionals"
PARAM_CITIES = "cities"
PARAM_SEX = "sex"
PARAM_KEYWORDS = "keywords"
PARAM_CATEGORY_IDS = "categoryIds"
PARAM_TARGET_PAGE_FLOW = "targetPageFlow"

TASK_PARAM_NAMES = (
    PARAM_START_DATE, PARAM_END_DATE, PARAM_START_AGE, PARAM_END_AGE,
    PARAM_PROFESSIONALS, PARAM_CITIES, PARAM_SEX, PARAM_KEYWORDS,
    PARAM_CATEGORY_IDS, PARAM_TARGET_PAGE_FLOW,
)

# Visit-length buckets as (label, lowest second, highest second
# or None for open). Edges: [1,3] [4,6] [7,9] [10,30) [30,60) [60,180)
# [180,600) [600,1800) [1800,inf). A 0-second visit falls in no bucket.
VISIT_BUCKETS = (
    ("1s_3s", 1, 3),
    ("4s_6s", 4, 6),
    ("7s_9s", 7, 9),
    ("10s_30s", 10, 29),
    ("30s_60s", 30, 59),
    ("1m_3m", 60, 179),
    ("3m_10m", 180, 599),
    ("10m_30m", 600, 1799),
    ("30m", 1800, None),
)

# Step-length buckets, same layout: [1,3] [4,6] [7,9] [10,30)
# [30,60) [60,inf).
STEP_BUCKETS = (
    ("1_3", 1, 3),
    ("4_6", 4, 6),
    ("7_9", 7, 9),
    ("10_30", 10, 29),
    ("30_60", 30, 59),
    ("60", 60, None),
)

# Ratios are rounded half-up to this many decimals.
RATIO_SCALE = 2

# Text formats of times and keys.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
TIME_PARSE_FORMAT = "yyyy-MM-dd H:mm:ss"   # accepts the unpadded hour of the mock data
DATE_FORMAT = "yyyy-MM-dd"
DATE_KEY_FORMAT = "yyyyMMdd"
MINUTE_KEY_FORMAT = "yyyyMMddHHmm"
DATE_HOUR_FORMAT = "yyyy-MM-dd_HH"

# Result column names of session_aggr_stat after session_count.
VISIT_RATIO_COLUMNS = tuple(f"visit_length_{label}_ratio" for label, _, _ in VISIT_BUCKETS)
STEP_RATIO_COLUMNS = tuple(f"step_length_{label}_ratio" for label, _, _ in STEP_BUCKETS)
