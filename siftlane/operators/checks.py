"""Assertions on DataFrames: each raises with a message that shows a few offenders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class DataError(ValueError):
    """A table breaks a rule that an operator relies on."""


def require_none(offenders: DataFrame, message: str, show: int = 3) -> None:
    found = [tuple(r) for r in offenders.take(show)]
    if found:
        raise DataError(f"{message}: {', '.join(map(str, found))}")


def require_unique(df: DataFrame, keys: Sequence[str], message: str) -> None:
    require_none(df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").select(*keys), message)


def require_columns(df: DataFrame, columns: Sequence[str], exact: bool = False) -> None:
    missing, extra = [c for c in columns if c not in df.columns], [c for c in df.columns if c not in columns]
    if missing or (exact and extra):
        raise DataError(f"columns missing: {missing}, unexpected: {extra if exact else []}")


def require_subset(df: DataFrame, of: DataFrame, key: str, message: str) -> None:
    """Every key of ``df`` is one of ``of``."""
    require_none(df.select(key).join(of.select(key), key, "left_anti"), message)


def require_disjoint(a: DataFrame, b: DataFrame, key: str, message: str) -> None:
    require_none(a.select(key).join(b.select(key), key, "left_semi"), message)
