"""Removal of sensitive values."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

from medstrata.functions.parsing import DATE_PATTERN, date_of


def masked(columns: Iterable[str]) -> list[Column]:
    """A NULL text column, named in lower case, for each listed column."""
    return [F.lit(None).cast("string").alias(name.lower()) for name in columns]


def birth_year(text: Column | str) -> Column:
    """Year of a ``yyyy-MM-dd`` birth date; the date itself is not kept."""
    return F.year(date_of(text, DATE_PATTERN))
