"""Projection and curation of flat columns whose names may contain dots."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """``name`` as one identifier, dots and backticks included."""
    return "`" + name.replace("`", "``") + "`"


def flat(name: str) -> Column:
    """Reference to the single column called ``name``, not to a path."""
    return F.col(quoted(name))


def require_unique(df: DataFrame) -> DataFrame:
    """Return ``df``, or raise if two of its columns cannot be told apart."""
    case_sensitive = str(df.sparkSession.conf.get("spark.sql.caseSensitive")).lower() == "true"
    seen = Counter(c if case_sensitive else c.lower() for c in df.columns)
    clashes = sorted(name for name, count in seen.items() if count > 1)
    if clashes:
        raise ValueError(f"column names clash: {', '.join(clashes)}")
    return df


def add_columns(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Append columns, or replace those that exist, in one projection.

    Every expression sees the columns as they were before the call.
    """
    return df.withColumns(dict(columns))


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns by literal name; names that do not exist are ignored."""
    return df.drop(*names) if names else df


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename columns by literal name; names that do not exist are ignored.

    A rename onto a name that is already taken raises ``ValueError``.
    """
    return require_unique(df.withColumnsRenamed(dict(names)))


def select_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Exactly these columns in this order; a missing one is an error.

    Where names are matched without case, the output takes the written case.
    """
    return df.selectExpr(*(f"{quoted(name)} AS {quoted(name)}" for name in names))


def constant(value: str | int | float | bool | None, dtype: str = "string") -> Column:
    """A literal column with a definite type, so that NULL can be written."""
    return F.lit(value).cast(dtype)
