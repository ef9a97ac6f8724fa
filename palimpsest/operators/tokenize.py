"""Pluggable subword tokeniser for O-76 / O-43 (a pandas UDF over Arrow batches).

The default token is a whitespace word (pure column expressions, ``operators/sft.py``).
A real tokeniser plugs in here: a ``tokenizers`` JSON definition (a path on shared
storage, or the JSON text itself), loaded once per Python worker, encodes whole batches
with ``encode_batch``; the resulting ``array<int>`` columns feed ``sft.pad_ids``.
"""

from __future__ import annotations

import functools

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


@functools.lru_cache(maxsize=4)
def _load(spec: str):
    from tokenizers import Tokenizer

    if spec.lstrip().startswith("{"):
        return Tokenizer.from_str(spec)
    from ..sources.files import read_bytes

    return Tokenizer.from_str(read_bytes(spec).decode("utf-8"))


def tokenizer_ids(col: Column | str, spec: str, max_length: int | None = None,
                  add_special_tokens: bool = True) -> Column:
    """``array<int>`` token ids of a text column, cut at ``max_length``."""

    @F.pandas_udf("array<int>")
    def encode(s: pd.Series) -> pd.Series:
        tok = _load(spec)
        encs = tok.encode_batch(s.fillna("").tolist(), add_special_tokens=add_special_tokens)
        return pd.Series([e.ids[:max_length] if max_length else e.ids for e in encs])

    return encode(F.col(col) if isinstance(col, str) else col)


def tokenizer_tokens(col: Column | str, spec: str) -> Column:
    """``array<string>`` tokens (for O-43 parts cut by model tokens)."""

    @F.pandas_udf("array<string>")
    def toks(s: pd.Series) -> pd.Series:
        tok = _load(spec)
        return pd.Series([e.tokens for e in tok.encode_batch(s.fillna("").tolist(), add_special_tokens=False)])

    return toks(F.col(col) if isinstance(col, str) else col)
