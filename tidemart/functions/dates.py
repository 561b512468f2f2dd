"""Date and time expressions (session time zone UTC)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats tried in this order by the lenient parser.
TIMESTAMP_FORMATS = (
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ssXXX",
    "yyyy-MM-dd",
    "dd/MM/yyyy",
    "MM-dd-yyyy",
)


def parse_timestamp(c: Column, formats: Sequence[str] = TIMESTAMP_FORMATS) -> Column:
    """First format that fits, else null; never raises."""
    return F.coalesce(*[F.try_to_timestamp(c.cast("string"), F.lit(f)) for f in formats])


def day_of_week(d: Column) -> Column:
    """0 = Sunday ... 6 = Saturday."""
    return F.dayofweek(d) - 1


def calendar_parts(d: Column, pad_names: bool = False) -> dict[str, Column]:
    """Calendar attributes of a date; `pad_names` right-pads names to 9 characters as to_char does."""
    day, month = F.date_format(d, "EEEE"), F.date_format(d, "MMMM")
    if pad_names:
        day, month = F.rpad(day, 9, " "), F.rpad(month, 9, " ")
    return {
        "day_of_week": day_of_week(d),
        "day_name": day,
        "week_of_year": F.weekofyear(d),
        "month": F.month(d),
        "month_name": month,
        "quarter": F.quarter(d),
        "year": F.year(d),
        "is_weekend": day_of_week(d).isin(0, 6),
    }


def transaction_parts(t: Column) -> dict[str, Column]:
    return {
        "transaction_hour": F.hour(t),
        "transaction_day": F.dayofmonth(t),
        "transaction_month": F.month(t),
        "transaction_year": F.year(t),
    }


def purchase_parts(signup: Column, purchase: Column) -> dict[str, Column]:
    return {
        "time_since_signup": F.unix_timestamp(purchase.cast("timestamp")) - F.unix_timestamp(signup.cast("timestamp")),
        "hour_of_day": F.hour(purchase),
        "day_of_week": day_of_week(purchase),
    }


def iso_timestamp(t: Column) -> Column:
    return F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss")
