"""Table-level operators: cleaning, reports, metrics."""

from lotcast.operators.clean import REASON_COL, clean, reject_reason, split_rejects, tag_rejects
from lotcast.operators.dedup import distinct_by_digest
from lotcast.operators.metrics import (
    class_totals,
    classification_metrics,
    confusion,
    leaderboard_classification,
    leaderboard_regression,
    per_class_recall,
    regression_metrics,
)
from lotcast.operators.split import hash_split
from lotcast.operators.reports import band_counts, category_counts, sold_reports, split_report, top_k

__all__ = [
    "REASON_COL", "clean", "distinct_by_digest", "reject_reason", "split_rejects", "tag_rejects",
    "class_totals", "classification_metrics", "confusion", "leaderboard_classification",
    "leaderboard_regression", "per_class_recall", "regression_metrics",
    "hash_split", "band_counts", "category_counts", "sold_reports", "split_report", "top_k",
]
