"""Results depend on these, so they are stated as they are."""

# Separator inside entity values, group patterns and distinct keys.
SEPARATOR = "|"
# Decimals kept by the wide merge and the population statistics.
MERGE_DECIMALS = 4
# Fill value for features an entity does not have.
MISSING_FEATURE = -1.0
# Threshold that stands for "below the lowest grid point".
BELOW_GRID = -1.0
# Decimals of grid thresholds.
GRID_DECIMALS = 3
# Hour partition that holds a whole day of group features.
DAILY_HOUR = "23"

# App tag given to make-money apps.
MAKE_MONEY_TAG = 99999
MAKE_MONEY_FIRST_TAG = "网赚应用"
# Disposal tags that mark an app as risky, for convert events and for labels.
CONVERT_DISPOSAL_TAGS = (12, 42, 10003, 10004, 10005)
LABEL_DISPOSAL_TAGS = (12, 42)
# Policies that do not put a request on the black list.
PASSING_POLICIES = ("900002", "900001", "0")
CONVERT_BUSINESS_LINE = "union"
CONVERT_LABEL = "convert"
PLACEMENT_FLOOR = 800000000
ECPM_SCALE = 100000
ECPM_BIN_WIDTH = 100

# Retention labels: stay above this many seconds counts as retained.
STAY_SECONDS = 1800
# Orders above this amount are "trusted".
TRUSTED_AMOUNT = 20
# (bucket, first day, last day); no last day means no upper limit.
RETENTION_BUCKETS = (
    ("day_0", 0, 0),
    ("day_1", 1, 1),
    ("day_2", 2, 2),
    ("day_1_10", 1, 10),
    ("day_3_10", 3, 10),
    ("day_3_30", 3, 30),
    ("day_1_30", 1, None),
)
# Buckets that rule mining reports.
MINED_BUCKETS = ("day_0", "day_1", "day_2", "day_3_10", "day_3_30")
