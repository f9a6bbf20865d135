"""The stages from a raw table to a prediction table, each from path to path."""

from classweave.plans.stages import (
    audit,
    score_table,
    select_features,
    train_model,
    view_predictions,
    weigh_table,
)

__all__ = ["audit", "score_table", "select_features", "train_model", "view_predictions", "weigh_table"]
