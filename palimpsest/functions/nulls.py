"""Null handling (O-05, O-19, O-22): one rule each, used everywhere."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import constants as K
from .text import _col


def null_token(c, tokens: Iterable[str] = K.PANDAS_NULL_TOKENS) -> Column:
    """Null when the cell is one of ``tokens`` (the CSV reader's null list made explicit)."""
    c = _col(c)
    return F.when(c.isin(list(tokens)), F.lit(None).cast("string")).otherwise(c)


def normalise_null_tokens(df: DataFrame, cols: Iterable[str], tokens: Iterable[str] = K.PANDAS_NULL_TOKENS) -> DataFrame:
    """O-05: apply :func:`null_token` to ``cols``."""
    toks = list(tokens)
    return df.withColumns({c: null_token(c, toks) for c in cols})


def coerce_text(c, legacy_nan: bool = False) -> Column:
    """O-19: null -> ``''`` and cast to string.

    ``legacy_nan`` reproduces the pandas ``astype(str)`` of a missing value, ``'nan'``.
    """
    fill = "nan" if legacy_nan else ""
    return F.coalesce(_col(c).cast("string"), F.lit(fill))


def fill_if_null(df: DataFrame, target: str, compute: Column) -> DataFrame:
    """O-22: compute ``target`` only where it is null; filled cells are kept."""
    return df.withColumn(target, F.coalesce(F.col(target), compute))
