"""Column expressions shared by the operators."""

from classweave.functions.columns import (
    class_probability,
    class_score,
    hash_fold,
    is_missing,
    quoted,
    require_columns,
)

__all__ = [
    "class_probability",
    "class_score",
    "hash_fold",
    "is_missing",
    "quoted",
    "require_columns",
]
