"""Describe, model and mine tables with PySpark.

Every operator takes a DataFrame and returns a DataFrame (fits also return the
fitted pipeline). Nothing here creates, configures or stops a Spark session.
"""

from tableprofile.operators.clustering import fit_kmeans, lloyd_kmeans
from tableprofile.operators.describe import (
    basic_info,
    correlation,
    missing_overall,
    missing_values,
    summary_statistics,
    unique_values,
    value_counts,
)
from tableprofile.operators.evaluation import classification_metrics, regression_metrics
from tableprofile.operators.features import baskets, binarise, fill_missing, split_by_key
from tableprofile.operators.heavy import top_values
from tableprofile.operators.patterns import (
    association_rules,
    frequent_itemsets,
    top_itemsets,
    top_rules,
)
from tableprofile.operators.quantiles import approx_median, exact_median, exact_quantiles
from tableprofile.operators.regression import fit_linear_regression
from tableprofile.operators.scaling import (
    performance_by_workers,
    run_summary,
    scalability,
    scalability_detail,
    speedup,
)
from tableprofile.operators.sketches import (
    load_states,
    merge_states,
    save_states,
    sketch_states,
    state_estimates,
)
from tableprofile.operators.trees import fit_decision_tree
from tableprofile.plans.analysis import analyze
from tableprofile.plans.jobs import MODEL_JOBS, run_model
from tableprofile.plans.profiling import STATISTICS, profile
from tableprofile.sources.results import (
    expired_jobs,
    load_results,
    retained_results,
    rewrite_retained,
    save_results,
    save_run_metrics,
    storage_inventory,
)
from tableprofile.sources.tables import copy_table, load_table, object_uri, save_table
from tableprofile.sources.transfer import transfer_files
from tableprofile.sources.versions import (
    latest_version,
    publish_results,
    publish_retained,
    published_versions,
    read_version,
)

__all__ = [
    "MODEL_JOBS",
    "STATISTICS",
    "analyze",
    "approx_median",
    "association_rules",
    "basic_info",
    "baskets",
    "binarise",
    "classification_metrics",
    "copy_table",
    "correlation",
    "exact_median",
    "exact_quantiles",
    "expired_jobs",
    "fill_missing",
    "fit_decision_tree",
    "fit_kmeans",
    "fit_linear_regression",
    "frequent_itemsets",
    "latest_version",
    "lloyd_kmeans",
    "load_results",
    "load_states",
    "load_table",
    "merge_states",
    "missing_overall",
    "missing_values",
    "object_uri",
    "performance_by_workers",
    "profile",
    "publish_results",
    "publish_retained",
    "published_versions",
    "read_version",
    "regression_metrics",
    "retained_results",
    "rewrite_retained",
    "run_model",
    "run_summary",
    "save_results",
    "save_run_metrics",
    "save_states",
    "save_table",
    "scalability",
    "scalability_detail",
    "sketch_states",
    "speedup",
    "split_by_key",
    "state_estimates",
    "storage_inventory",
    "summary_statistics",
    "top_itemsets",
    "top_rules",
    "top_values",
    "transfer_files",
    "unique_values",
    "value_counts",
]
