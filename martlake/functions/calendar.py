"""Calendar feature steps (F9, F12, F14–F18) as DataFrame -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake.functions import scalars as S


def add_log_features(df: DataFrame, q: str = "Quantity", p: str = "UnitPrice") -> DataFrame:
    """log_Quantity, log_UnitPrice, TotalSum, log_TotalSum."""
    return df.withColumns({
        "log_Quantity": S.log_quantity(q),
        "log_UnitPrice": S.log_unit_price(p),
        "TotalSum": S.total_sum(q, p),
        "log_TotalSum": S.log_total_sum(q, p),
    })


def add_time_parts(df: DataFrame, ts: str = "InvoiceDate") -> DataFrame:
    """TransactionHour, DayOfYear."""
    return df.withColumns({"TransactionHour": F.hour(ts), "DayOfYear": F.dayofyear(ts)})


def add_iso_parts(df: DataFrame, ts: str = "InvoiceDate") -> DataFrame:
    """DayOfMonth, IsoWeek and the year that the ISO week belongs to."""
    return df.withColumns({"DayOfMonth": F.dayofmonth(ts), "IsoWeek": F.weekofyear(ts),
                           "IsoYear": F.extract(F.lit("YEAROFWEEK"), F.col(ts)).cast("int")})


def add_calendar_flags(df: DataFrame, ts: str = "InvoiceDate") -> DataFrame:
    """Year, Month, Weekday (Mon=1), IsWeekend, HolidaySeason,
    IsStartOfMonth, IsEndOfMonth, BlackFriday (boolean, as in the script)."""
    return df.withColumns({
        "Year": F.year(ts),
        "Month": F.month(ts),
        "Weekday": S.weekday_1_7(ts),
        "IsWeekend": S.is_weekend(ts),
        "HolidaySeason": S.holiday_season(ts),
        "IsStartOfMonth": S.is_month_start(ts),
        "IsEndOfMonth": S.is_month_end(ts),
        "BlackFriday": S.black_friday(ts),
    })


def add_cyclic(df: DataFrame, month: str = "Month", weekday: str = "Weekday") -> DataFrame:
    """Month_sin/cos (period 12), Weekday_sin/cos (period 7)."""
    return df.withColumns({
        "Month_sin": S.cyclic(month, 12, "sin"),
        "Month_cos": S.cyclic(month, 12, "cos"),
        "Weekday_sin": S.cyclic(weekday, 7, "sin"),
        "Weekday_cos": S.cyclic(weekday, 7, "cos"),
    })
