"""cohortflow: longitudinal and clinical cohort tables as Spark jobs."""

from cohortflow.operators.cluster import cluster_patients, instrument_scores, range_scores
from cohortflow.operators.corr import correlation_report, top_correlations
from cohortflow.operators.locf import locf_fill
from cohortflow.operators.outlier import removal_report, remove_outliers
from cohortflow.operators.prep import encoding_map, label_encode, scale
from cohortflow.operators.timepoint import assign_timepoints
from cohortflow.operators.wide import wide_stacked, wide_tables
from cohortflow.plans.sql_step import sql_transform
from cohortflow.session import build_session

__all__ = [
    "assign_timepoints",
    "build_session",
    "cluster_patients",
    "correlation_report",
    "encoding_map",
    "instrument_scores",
    "label_encode",
    "locf_fill",
    "range_scores",
    "removal_report",
    "remove_outliers",
    "scale",
    "sql_transform",
    "top_correlations",
    "wide_stacked",
    "wide_tables",
]
