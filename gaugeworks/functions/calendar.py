"""Calendar columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Season numbers. The correlation depends on these numbers.
SEASON_MONTHS = {1: [12, 1, 2], 2: [6, 7, 8], 3: [9, 10, 11], 4: [3, 4, 5]}
SEASON_NAMES = {1: "Winter", 2: "Summer", 3: "Fall", 4: "Spring"}


def season_index(month: Column) -> Column:
    """Season number of a month number; NULL for NULL."""
    season = F.lit(None).cast("int")
    for number, months in SEASON_MONTHS.items():
        season = F.when(month.isin(*months), F.lit(number)).otherwise(season)
    return season


def season_name(season: Column) -> Column:
    name = F.lit(None).cast("string")
    for number, label in SEASON_NAMES.items():
        name = F.when(season == number, F.lit(label)).otherwise(name)
    return name


def split_date(df: DataFrame, date: str = "start_date") -> DataFrame:
    """Add ``year``, ``month`` and ``day`` of a date column."""
    day = F.col(date)
    return df.withColumns({"year": F.year(day), "month": F.month(day), "day": F.dayofmonth(day)})


def add_season(df: DataFrame, date: str = "start_date") -> DataFrame:
    """Add ``month`` and ``season_idx`` of a date column."""
    month = F.month(F.col(date))
    return df.withColumns({"month": month, "season_idx": season_index(month)})
