"""Cleaning of text and floating-point columns."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts that count as a missing value in a delimited file.
NULL_TOKENS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]

# Every character Python counts as white space.
BLANKS = "".join(chr(code) for code in range(0x3001) if chr(code).isspace())


def clean_text(text: Column, tokens: Iterable[str] = ()) -> Column:
    """Text without Unicode white space at both ends; NULL when nothing is left or
    when the text, before it is stripped, is one of ``tokens``.

    Nearly all texts begin and end with a printable ASCII character and skip the
    costly character-set trim. The expression is kept short on purpose: a dozen
    cleaned columns and their rules have to fit in one generated method that the JVM
    still compiles.
    """
    missing = "|".join(re.escape(token) for token in tokens)
    start = rf"^(?!(?:{missing})\z)" if missing else "^"
    plain = rf"{start}[!-~](?s:.*[!-~])?\z"
    some = rf"{start}(?s:.*)[^{BLANKS}]"
    return F.when(text.rlike(plain), text).when(text.rlike(some), F.btrim(text, F.lit(BLANKS)))


def null_tokens(text: Column, tokens: Iterable[str] = NULL_TOKENS) -> Column:
    """NULL for an exact missing-value token, else the text as it is."""
    return F.when(~text.isin(*tokens), text)


def clean_value(df: DataFrame, name: str, tokens: Iterable[str] = ()) -> Column:
    """One column cleaned by its type: text as in :func:`clean_text`, NaN to NULL."""
    kind, value = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, T.StringType):
        return clean_text(value, tokens).alias(name)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.nanvl(value, F.lit(None).cast(kind)).alias(name)
    return value


def clean_columns(df: DataFrame, columns: list[str] | None = None, tokens: Iterable[str] = ()) -> DataFrame:
    """Clean the named columns (default: all) in one projection."""
    chosen, tokens = set(df.columns if columns is None else columns), list(tokens)
    return df.select(*[clean_value(df, c, tokens) if c in chosen else F.col(f"`{c}`") for c in df.columns])
