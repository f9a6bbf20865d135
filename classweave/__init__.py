"""Binary classification on tables with Spark: audit, weigh, select, train, score."""

from classweave.functions import class_probability, class_score, hash_fold, is_missing
from classweave.operators.balance import class_ratio, weight_totals, with_class_weight
from classweave.operators.categories import index_by_table, write_category_table, write_share_table
from classweave.operators.contract import check_features, feature_contract
from classweave.operators.estimators import boosted, forest, logistic, ranking_forest
from classweave.operators.features import (
    assemble,
    build_pipeline,
    category_counts,
    category_labels,
    category_shares,
    column_report,
    column_roles,
    fit_pipeline,
    label_index,
    positive_index,
    string_cardinality,
    string_index,
    wide_columns,
)
from classweave.operators.folds import fold_assembly, fold_sizes, hash_folds, random_folds
from classweave.operators.metrics import (
    confusion_matrix,
    long_metrics,
    metrics_table,
    positive_class_metrics,
    roc_auc,
)
from classweave.operators.profile import (
    class_balance,
    class_counts,
    column_profile,
    columns_present,
    dataset_shape,
    imbalance_flag,
    missing_columns,
    missing_counts,
    schema_report,
)
from classweave.operators.ranking import project_top, rank_features, stable_layout, top_features, top_names
from classweave.operators.scoring import batch_score, prediction_distribution, prediction_sample, prediction_view
from classweave.operators.validation import compare_models, cross_validate, cv_summary, fold_rankings, leaderboard
from classweave import sources
from classweave.sources import (
    load_model,
    read_csv,
    read_csv_checked,
    read_parquet,
    read_version,
    save_model,
    staged,
    write_parquet,
    write_version,
)

__all__ = [name for name in dir() if not name.startswith("_")]
