"""Scalar column functions.

Pure ``Column -> Column`` helpers built from Spark SQL expressions, so they
stay inside whole-stage codegen.  Two Spark behaviours are handled here once:
``greatest``/``least`` skip NULLs (so a clip must guard NULL explicitly), and
ANSI mode raises on division by zero (so ratios go through ``try_divide``).
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's feature definitions.
PRICE_FLOOR = 1e-6          # log_UnitPrice lower clip
STD_ZERO_GUARD = 1e-9       # rolling std replacement for exact zeros
MAPE_EPS = 2.220446049250313e-16   # float64 machine epsilon (MAPE denominator floor)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def clip(x, lower=None, upper=None) -> Column:
    """pandas ``clip``: NULL stays NULL, bounds may be columns or numbers."""
    x = _c(x)
    out = x
    if lower is not None:
        out = F.greatest(out, lower if isinstance(lower, Column) else F.lit(lower))
    if upper is not None:
        out = F.least(out, upper if isinstance(upper, Column) else F.lit(upper))
    return F.when(x.isNotNull(), out)


def safe_ratio(num, den) -> Column:
    """ratio with a zero denominator mapped to NULL."""
    return F.try_divide(_c(num), _c(den))


def log_quantity(q="Quantity") -> Column:
    """log1p(max(q, 0))."""
    return F.log1p(clip(_c(q).cast("double"), lower=0.0))


def log_unit_price(p="UnitPrice") -> Column:
    """log1p(max(p, 1e-6))."""
    return F.log1p(clip(_c(p).cast("double"), lower=PRICE_FLOOR))


def total_sum(q="Quantity", p="UnitPrice") -> Column:
    """q * p."""
    return _c(q) * _c(p)


def log_total_sum(q="Quantity", p="UnitPrice") -> Column:
    """log1p(max(max(q,0) * max(p,1e-6), 0))."""
    prod = clip(_c(q).cast("double"), lower=0.0) * clip(_c(p).cast("double"), lower=PRICE_FLOOR)
    return F.log1p(clip(prod, lower=0.0))


def inverse_log(x) -> Column:
    """expm1."""
    return F.expm1(_c(x))


def percent_error(y, yhat, cap=100.0) -> Column:
    """F8: |y - yhat| / nullif(y, 0) * 100, upper-clipped at ``cap``."""
    return clip(F.try_divide(F.abs(_c(y) - _c(yhat)), F.nullif(_c(y), F.lit(0))) * 100,
                upper=cap)


def cyclic(x, period: int, fn: str = "sin") -> Column:
    """sin/cos(2*pi*x/period)."""
    arg = F.lit(2 * math.pi) * _c(x) / F.lit(float(period))
    return F.sin(arg) if fn == "sin" else F.cos(arg)


def half_even_round(x) -> Column:
    """Python's ``round`` (banker's rounding) of a double."""
    return F.rint(_c(x))


def parse_timestamp(x, fmt: str | None = None, strict: bool = False) -> Column:
    """text -> timestamp; ``strict=False`` maps bad text to NULL."""
    x = _c(x)
    if strict:
        return F.to_timestamp(x, fmt) if fmt else F.to_timestamp(x)
    return F.try_to_timestamp(x, F.lit(fmt)) if fmt else F.try_to_timestamp(x)


def parse_date(x) -> Column:
    """text -> date, bad text -> NULL (``errors='coerce'``)."""
    return F.try_to_timestamp(_c(x).cast("string")).cast("date")


def parse_time_of_day(x) -> Column:
    """``%H:%M:%S`` with coercion; '7:8:9' reads as 07:08:09, '25:00:00'
    is NULL.  Returned as ``HH:mm:ss`` text (Spark has no TIME type by
    default)."""
    ts = F.try_to_timestamp(_c(x).cast("string"), F.lit("H:m:s"))
    return F.date_format(ts, "HH:mm:ss")


def weekday_1_7(ts) -> Column:
    """Monday = 1 ... Sunday = 7 (Spark ``weekday``: Monday = 0)."""
    return F.weekday(_c(ts)) + 1


def is_weekend(ts) -> Column:
    """F16: weekday in (6, 7) as 0/1."""
    return weekday_1_7(ts).isin(6, 7).cast("int")


def holiday_season(ts) -> Column:
    """F16: month in (11, 12) as 0/1."""
    return F.month(_c(ts)).isin(11, 12).cast("int")


def is_month_start(ts) -> Column:
    """calendar day 1 (time of day ignored)."""
    return (F.dayofmonth(_c(ts)) == 1).cast("int")


def is_month_end(ts) -> Column:
    """last calendar day of the month."""
    d = F.to_date(_c(ts))
    return (d == F.last_day(d)).cast("int")


def black_friday(ts) -> Column:
    """November, day 23..29, Friday (boolean)."""
    ts = _c(ts)
    return ((F.month(ts) == 11) & F.dayofmonth(ts).between(23, 29)
            & (F.weekday(ts) == 4))


def week_start_monday(ts) -> Column:
    """Monday of the week (date)."""
    return F.to_date(F.date_trunc("week", _c(ts)))


def week_end_sunday(ts) -> Column:
    """Sunday that closes the week (pandas ``freq='W'`` label)."""
    return F.date_add(week_start_monday(ts), 6)


def whole_days_between(start, end) -> Column:
    """``(end - start).days`` for timestamps (whole elapsed days)."""
    return F.timestamp_diff("DAY", _c(start), _c(end))


def hit_key(session_id="session_id", hit_number="hit_number") -> Column:
    """session_id + '_' + hit_number."""
    return F.concat(_c(session_id).cast("string"), F.lit("_"), _c(hit_number).cast("string"))


def first_word_lower(x) -> Column:
    """lower-cased first space-separated word; NULL stays NULL."""
    return F.split_part(F.lower(_c(x)), F.lit(" "), F.lit(1))


def replace_suffix(x, old: str, new: str) -> Column:
    """swap a file-name suffix ('.json' -> '.pkl')."""
    return F.regexp_replace(_c(x), F.lit(old.replace(".", r"\.") + "$"), F.lit(new))


def age_category(year, new_after: int = 2013, old_before: int = 2006) -> Column:
    """'new' if year > 2013, 'old' if year < 2006, else 'average'
    (missing years fall to 'average')."""
    y = _c(year)
    return (F.when(y > new_after, F.lit("new"))
            .when(y < old_before, F.lit("old"))
            .otherwise(F.lit("average")))


def run_id(ts=None, fmt: str = "yyyyMMdd_HHmmss") -> Column:
    """timestamp formatted as a run identifier."""
    return F.date_format(_c(ts) if ts is not None else F.current_timestamp(), fmt)
