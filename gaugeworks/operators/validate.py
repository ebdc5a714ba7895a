"""Validation: each row gets the first rule it breaks, or NULL.

Everything here is one narrow projection; valid and rejected rows are two filters
on the same tagged frame.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.functions.parse import is_number, parse_date, parse_int, parse_number
from gaugeworks.functions.text import clean_columns
from gaugeworks.schemas import LINEAGE
from gaugeworks.sources.files import MALFORMED
from gaugeworks.sources.spec import RuleSet

REASON = "error_reason"
BAD_INTEGER = "Invalid integer field"
MALFORMED_ROW = "Malformed row"


def _is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StringType)


def _broken_rules(df: DataFrame, rules: RuleSet) -> list[Column]:
    """One column per rule, in rule order: the reason, or NULL when the rule holds."""
    present = set(df.columns)

    def value(name: str) -> Column:
        return F.col(name) if name in present else F.lit(None).cast("string")

    broken = []
    if MALFORMED in present:
        broken.append(F.when(value(MALFORMED).isNotNull(), F.lit(MALFORMED_ROW)))
    for name in rules.required:
        broken.append(F.when(value(name).isNull(), F.lit(f"Missing required field: {name}")))
    for name in rules.required_integers:
        broken.append(F.when(parse_int(value(name), rules.lenient_int).isNull(), F.lit(BAD_INTEGER)))
    for name in rules.optional_integers:
        bad = value(name).isNotNull() & parse_int(value(name), rules.lenient_int).isNull()
        broken.append(F.when(bad, F.lit(BAD_INTEGER)))
    for name in rules.numeric:
        if name in present and _is_text(df, name):
            broken.append(F.when(~is_number(value(name)), F.lit(f"Invalid numeric value for {name}")))
    for name in rules.dates:
        bad = value(name).isNotNull() & parse_date(value(name)).isNull()
        broken.append(F.when(bad, F.lit(f"Invalid date format for {name}")))
    return broken


def tag_records(df: DataFrame, rules: RuleSet | None = None, tokens: Iterable[str] = ()) -> DataFrame:
    """Cleaned columns plus ``error_reason``: the first broken rule in the order
    malformed, required, integer, numeric, date.

    With several consumers, write the tagged rows first, as a load does: a filter on
    the reason is pushed down and would compute it once more.
    """
    rules = rules or RuleSet()
    cleaned = clean_columns(df, [c for c in df.columns if c not in (MALFORMED, *LINEAGE)], tokens)
    reason = F.coalesce(*_broken_rules(cleaned, rules), F.lit(None).cast("string"))
    return cleaned.withColumn(REASON, reason).drop(MALFORMED)


def valid_rows(tagged: DataFrame, rules: RuleSet | None = None) -> DataFrame:
    """Rows without a reason, with integers, numbers and dates typed."""
    rules = rules or RuleSet()
    present = set(tagged.columns)
    typed = {name: parse_int(F.col(name), rules.lenient_int) for name in rules.integers if name in present}
    typed |= {
        name: parse_number(F.col(name)) if _is_text(tagged, name) else F.col(name).cast("double")
        for name in rules.numeric
        if name in present
    }
    typed |= {name: parse_date(F.col(name)) for name in rules.dates if name in present}
    return tagged.filter(F.col(REASON).isNull()).drop(REASON).withColumns(typed)


def rejected_rows(tagged: DataFrame) -> DataFrame:
    """Rows with a reason, as cleaned text."""
    return tagged.filter(F.col(REASON).isNotNull())


def validate(df: DataFrame, rules: RuleSet | None = None) -> tuple[DataFrame, DataFrame]:
    """``(valid, rejected)``, both lazy."""
    tagged = tag_records(df, rules)
    return valid_rows(tagged, rules), rejected_rows(tagged)
