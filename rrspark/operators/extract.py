"""Value extraction (P12-P14), distinct values (A2) and RESULT / NO RESULT counts (A8)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import json_scalar, strip_outer_quotes
from .filters import as_column


def _encoded(df: DataFrame, expr: str | Column, strip: bool) -> Column:
    col = as_column(expr)
    dtype = df.select(col).schema.fields[0].dataType.simpleString()
    value = json_scalar(col, dtype)
    return strip_outer_quotes(value) if strip else value


def extract_values(
    df: DataFrame,
    expr: str | Column,
    strip_outer_quotes: bool = True,
    distinct: bool = True,
) -> DataFrame:
    """Evaluate ``expr`` per record; a NULL result gives no row; otherwise the result is
    JSON-encoded (strings quoted and escaped, lists and maps as JSON) and, by default, every
    leading and trailing quote is stripped. Distinct values by default, as the reference's
    extract job; the partial aggregate collapses repeats before the shuffle."""
    out = df.select(_encoded(df, expr, strip_outer_quotes).alias("value")).where(F.col("value").isNotNull())
    return out.distinct() if distinct else out


def extract_count_columns(expr: str | Column) -> list[Column]:
    """Aggregate columns ``result`` / ``no_result``, to combine with other counts in one pass."""
    has = as_column(expr).isNotNull()
    return [F.count_if(has).alias("result"), F.count_if(~has).alias("no_result")]


def extract_counts(df: DataFrame, expr: str | Column) -> DataFrame:
    """One row: records with a result and with no result (before deduplication)."""
    return df.agg(*extract_count_columns(expr))
