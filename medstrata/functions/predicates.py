"""Row predicates and labels."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

from medstrata.config import KEPT_CHANGE_TYPES, UNKNOWN


def all_present(columns: Sequence[str]) -> Column:
    """True when every listed column has a value."""
    return reduce(Column.__and__, [F.col(c).isNotNull() for c in columns])


def new_state(change_type: str = "_change_type") -> Column:
    """True for change rows that carry the record as it is after the change."""
    return F.col(change_type).isin(*KEPT_CHANGE_TYPES)


def not_blank(column: Column | str) -> Column:
    text = F.col(column) if isinstance(column, str) else column
    return text.isNotNull() & (F.trim(text) != "")


def differs(left: Sequence[Column], right: Sequence[Column]) -> Column:
    """True when any pair differs, where NULL equals NULL."""
    return reduce(Column.__or__, [~a.eqNullSafe(b) for a, b in zip(left, right, strict=True)])


def or_unknown(column: Column | str, label: str = UNKNOWN) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(label))
