"""Parameters of the registered queries (shared by the Spark plans and the SQL oracle)."""

# Similarity to one reference item (supplier key), strict thresholds, top k.
REF_ITEM = 50
MIN_SCORE = 0.85
MIN_SUPPORT = 150
TOP_SIMILAR = 10

# Top-k sizes of the ranking reports.
TOP_ITEMS = 10
TOP_SPENDERS = 5
TOP_PAIRS = 10

# Group-statistics filters (customer nation key plays the part of an age).
RANGE_LOW, RANGE_HIGH = 12, 20
LESS_THAN = 21
SHIFT = 10
MEASURE = "click"

# Degree reports on the order graph.
FEW_CONNECTIONS = 2

# BFS over the order graph.
BFS_START = 0
BFS_TARGET = 71
BFS_LEVELS = 5

# Splits of the ratings view (order: user, then item).
HOLDOUT_START, HOLDOUT_STOP = 1, 10
HOLDOUT_MAX_TEST = 5000
FOLDS = 5
BASE_OF_FOLD = 2

# Repeatable sample of the ratings view.
SAMPLE_ROWS, SAMPLE_SEED = 10_000, 7
