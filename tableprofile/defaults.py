"""Default parameters and fixed texts, in one place.

Every default is also a keyword argument of the operator that uses it.
"""

# Every column counts unless a caller names or limits them.
SUMMARY_COLUMNS = None
CORRELATION_COLUMNS = None
FEATURE_COLUMNS = None
BASKET_COLUMNS = None

# Defaults of the jobs.
TOP_VALUES = 10
TOP_PATTERNS = 10
TRAIN_RATIO = 0.8
SEED = 42
REGRESSION_MAX_ITER = 10
REGRESSION_REG_PARAM = 0.3
REGRESSION_ELASTIC_NET = 0.8
KMEANS_K = 3
KMEANS_MAX_ITER = 20
KMEANS_TOL = 1e-4
KMEANS_ROUNDS = 4
KMEANS_OVERSAMPLING = 2
TREE_MAX_DEPTH = 5
TREE_MAX_BINS = 32
MEDIAN_RELATIVE_ERROR = 0.01
MIN_SUPPORT = 0.3
MIN_CONFIDENCE = 0.6
RETENTION_DAYS = 7
BASELINE_WORKERS = 1
PERCENT_DIGITS = 2
RATIO_DIGITS = 4

# Names of the models.
REGRESSION_MODEL = "Linear Regression"
KMEANS_MODEL = "K-Means Clustering"
TREE_MODEL = "Decision Tree Classifier"
FPGROWTH_MODEL = "FP-Growth (Frequent Pattern Mining)"

# Messages.
NO_METRICS = "No metrics collected"
NO_NUMERIC_COLUMNS = "No numeric columns found in dataset"
TWO_COLUMNS_FOR_CORRELATION = "Need at least 2 numeric columns for correlation"
TWO_COLUMNS_FOR_REGRESSION = "Need at least 2 numeric columns for regression"
TWO_COLUMNS_FOR_CLASSIFICATION = "Need at least 2 numeric columns for classification"
NO_FEATURE_COLUMNS = "No numeric columns found for feature preparation"
NO_COMPLETED_JOBS = "No completed jobs"
NO_VALUE_COUNT_COLUMNS = "No columns named for value counts"
INSUFFICIENT_RUNS = "Insufficient data for scalability analysis"

# Scalability classes as (lowest mean efficiency, class, recommendation).
SCALABILITY_CLASSES = (
    (
        85.0,
        "Excellent (Near-linear scalability)",
        "System scales very well. Consider adding more workers for larger datasets.",
    ),
    (
        70.0,
        "Good (Effective parallelization)",
        "Good scalability. Current configuration is efficient.",
    ),
    (
        50.0,
        "Fair (Moderate scalability)",
        "Consider optimizing data partitioning or algorithm implementation.",
    ),
    (
        None,
        "Poor (Limited benefits)",
        "Parallelization overhead may be too high. Review algorithm and data size.",
    ),
)
