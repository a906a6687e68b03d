"""Calendar and clock dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Business periods (first day, id, name) and day parts (first hour, id, name).
PERIODS = (
    ("1900-01-01", 1, "Pre-Crisis"),
    ("2025-06-01", 2, "Crisis"),
    ("2025-08-01", 3, "Recovery"),
    ("2025-10-01", 4, "Post-Recovery"),
)
DAY_PARTS = (
    (0, 6, "00:00 - 06:00"),
    (6, 1, "06:00 - 11:00"),
    (11, 2, "11:00 - 14:00"),
    (14, 3, "14:00 - 17:00"),
    (17, 4, "17:00 - 21:00"),
    (21, 5, "21:00 - 24:00"),
)
PEAK_DAY_PARTS = (2, 4)
FISCAL_START_MONTH = 4


def date_key(column: Column) -> Column:
    return F.date_format(column, "yyyyMMdd").cast("int")


def time_key(column: Column) -> Column:
    return F.hour(column) * 100 + F.minute(column)


def key_to_date(key: Column) -> Column:
    """Integer key back to a date; keys that are no date (such as -1) give NULL."""
    return F.try_to_date(key.cast("string"), "yyyyMMdd")


def key_to_time(key: Column) -> Column:
    """hhmm key to `HH:mm:ss` text."""
    return F.when(
        key.between(0, 2359),
        F.format_string("%02d:%02d:00", (key / 100).cast("int"), (key % 100).cast("int")),
    )


def _stepped(value: Column, steps, pick: int) -> Column:
    """The entry of the last step that starts at or before the value."""
    expr = None
    for step in sorted(steps, key=lambda s: s[0], reverse=True):
        expr = F.when(value >= F.lit(step[0]), step[pick]) if expr is None else expr.when(
            value >= F.lit(step[0]), step[pick]
        )
    return expr


def calendar_columns(day: Column) -> list[Column]:
    month = F.month(day)
    fiscal_month = F.pmod(month - FISCAL_START_MONTH, F.lit(12)) + 1
    fiscal_quarter = ((fiscal_month - 1) / 3).cast("int") + 1
    iso_day = F.date_format(day, "yyyy-MM-dd")
    return [
        date_key(day).alias("date_key"),
        day.alias("full_date"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.concat(F.lit("Q"), F.quarter(day).cast("string")).alias("quarter_name"),
        month.alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.date_format(day, "MMM").alias("month_short"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
        F.weekofyear(day).alias("week_of_year"),
        F.dayofmonth(day).alias("day_of_month"),
        F.dayofweek(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.date_format(day, "EEE").alias("day_short"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"),
        F.when(month >= FISCAL_START_MONTH, F.year(day)).otherwise(F.year(day) - 1).alias("fiscal_year"),
        F.concat(F.lit("FQ"), fiscal_quarter.cast("string")).alias("fiscal_quarter"),
        fiscal_quarter.alias("fiscal_quarter_number"),
        F.date_format(day, "MMMM").alias("fiscal_month"),
        fiscal_month.alias("fiscal_month_number"),
        _stepped(iso_day, PERIODS, 2).alias("period"),
        _stepped(iso_day, PERIODS, 1).alias("period_id"),
    ]


def clock_columns(minute_of_day: Column) -> list[Column]:
    hour = (minute_of_day / 60).cast("int")
    minute = (minute_of_day % 60).cast("int")
    hour_12 = F.when(hour % 12 == 0, 12).otherwise(hour % 12)
    half = F.when(hour >= 12, "PM").otherwise("AM")
    part_id = _stepped(hour, DAY_PARTS, 1)
    return [
        (hour * 100 + minute).alias("time_key"),
        F.format_string("%02d:%02d:00", hour, minute).alias("time_value"),
        hour.alias("hour"),
        minute.alias("minute"),
        hour_12.alias("hour_12"),
        half.alias("am_pm"),
        F.format_string("%02d:%02d %s", hour_12, minute, half).alias("time_display"),
        _stepped(hour, DAY_PARTS, 2).alias("time_group"),
        part_id.alias("time_group_id"),
        part_id.isin(*PEAK_DAY_PARTS).alias("is_peak_hour"),
    ]


def _with_unknown(df: DataFrame, unknown: dict) -> DataFrame:
    """Add the -1 member, typed like the rest of the table."""
    row = df.sparkSession.range(1).select(
        *[F.lit(unknown[f.name]).cast(f.dataType).alias(f.name) for f in df.schema.fields]
    )
    return row.unionByName(df)


def dim_date(
    spark: SparkSession, start: str | Column = "2024-01-01", end: str | Column = "2026-12-31"
) -> DataFrame:
    """One row per day from start to end, plus the -1 member. The ends may be scalar subqueries."""
    first, last = (c if isinstance(c, Column) else F.lit(c).cast("date") for c in (start, end))
    days = spark.range(1).select(first.alias("first"), last.alias("last")).select(
        F.explode(F.sequence("first", "last")).alias("day")
    )
    return _with_unknown(
        days.select(*calendar_columns(F.col("day"))),
        {
            "date_key": -1, "full_date": "1900-01-01", "year": 1900, "quarter": 0, "quarter_name": "N/A",
            "month": 0, "month_name": "Unknown", "month_short": "UNK", "year_month": "1900-00",
            "week_of_year": 0, "day_of_month": 0, "day_of_week": 0, "day_name": "Unknown", "day_short": "UNK",
            "is_weekend": False, "fiscal_year": 1900, "fiscal_quarter": "N/A", "fiscal_quarter_number": 0,
            "fiscal_month": "Unknown", "fiscal_month_number": 0, "period": "Unknown", "period_id": 0,
        },
    )


def dim_time(spark: SparkSession) -> DataFrame:
    return _with_unknown(
        spark.range(1440).select(*clock_columns(F.col("id"))),
        {
            "time_key": -1, "time_value": None, "hour": 0, "minute": 0, "hour_12": 0, "am_pm": "NA",
            "time_display": "Unknown", "time_group": "Unknown", "time_group_id": 0, "is_peak_hour": False,
        },
    )
