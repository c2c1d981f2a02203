"""Record filters (F1-F5, F7) and their match counts (A7).

Expressions are Spark SQL text (or a Column). Catalyst parses, pushes down and compiles them;
a filter adds no exchange. Translation of the reference's expression language:
``a != b`` -> ``NOT (a <=> b)`` (a missing field is not equal to anything),
``x =~ p`` -> ``full_match(x, p)``, ``x.toLowerCase()`` -> ``lower(x)``,
``if (c) return x`` -> ``CASE WHEN c THEN x END``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import full_match, looks_like_ipv4_name


def as_column(expr: str | Column) -> Column:
    return F.expr(expr) if isinstance(expr, str) else expr


def predicate(df: DataFrame, expr: str | Column, strict: bool = True) -> Column:
    """Boolean column for ``expr``. A result that is not boolean never matches: with
    ``strict`` (default) this raises up front; otherwise the predicate is constant false."""
    col = as_column(expr)
    dtype = df.select(col).schema.fields[0].dataType  # analysis only, no job
    if not isinstance(dtype, T.BooleanType):
        if strict:
            raise TypeError(f"filter expression is {dtype.simpleString()}, not boolean: {expr}")
        return F.lit(False)
    return col


def filter_records(df: DataFrame, expr: str | Column, strict: bool = True) -> DataFrame:
    """Keep records whose predicate is true; NULL counts as not matched. Duplicates stay."""
    return df.where(predicate(df, expr, strict))


def filter_count_columns(df: DataFrame, expr: str | Column, strict: bool = True) -> list[Column]:
    """Aggregate columns ``matched`` / ``non_matched``, to combine with other counts in one pass."""
    p = F.coalesce(predicate(df, expr, strict), F.lit(False))
    return [F.count_if(p).alias("matched"), F.count_if(~p).alias("non_matched")]


def filter_counts(df: DataFrame, expr: str | Column, strict: bool = True) -> DataFrame:
    """One row: MATCHED and NON-MATCHED record counts for ``expr``."""
    return df.agg(*filter_count_columns(df, expr, strict))


def observe_filter(df: DataFrame, expr: str | Column, name: str = "filter", strict: bool = True):
    """Filter and count in the same pass: returns ``(filtered_df, observation)``; read
    ``observation.get`` after an action on ``filtered_df``."""
    p = F.coalesce(predicate(df, expr, strict), F.lit(False))
    obs = Observation(name)
    observed = df.withColumn("__m", p).observe(
        obs, F.count_if(F.col("__m")).alias("matched"), F.count_if(~F.col("__m")).alias("non_matched")
    )
    return observed.where("__m").drop("__m"), obs


def not_ipv4_name(col: str | Column) -> Column:
    """``col !~ "^\\d{1,3}(\\.\\d{1,3}){3}\\.$"`` of the reference's examples."""
    c = F.col(col) if isinstance(col, str) else col
    return ~looks_like_ipv4_name(c)


def lower_unless_ipv4(field: str) -> Column:
    """``if (field !~ <ipv4 name>) return field.toLowerCase()`` as a column."""
    c = F.col(field)
    return F.when(not_ipv4_name(c), F.lower(c))


__all__ = [
    "filter_records", "filter_counts", "filter_count_columns", "observe_filter", "predicate", "full_match",
    "not_ipv4_name", "lower_unless_ipv4", "as_column",
]
