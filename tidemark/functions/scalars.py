"""Scalar column functions. All are native Catalyst expressions (no UDFs),
so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from typing import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, StringType

# ---------------------------------------------------------------- keys


def digits_only(c: Column) -> Column:
    return F.regexp_replace(c.cast("string"), r"[^0-9]", "")


def format_key(c: Column) -> Column:
    """Keep digits, left-pad with zeros to 14, render XX.XXX.XXX/XXXX-XX.

    NULL renders as all zeros; more than 14 digits spill into the last part
    (``lpad`` would truncate, so padding is applied only when shorter).
    """
    d = F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), r"[^0-9]", "")
    p = F.when(F.length(d) < 14, F.lpad(d, 14, "0")).otherwise(d)
    return F.concat(
        F.substring(p, 1, 2), F.lit("."), F.substring(p, 3, 3), F.lit("."), F.substring(p, 6, 3), F.lit("/"),
        F.substring(p, 9, 4), F.lit("-"), F.substr(p, F.lit(13)),
    )


def normalise_code(c: Column, dtype=None, strip_decimal_suffix: bool = False) -> Column:
    """A numeric code becomes its truncated integer text; a text code is
    trimmed and '' becomes NULL. Optionally cut a textual '.0' suffix."""
    if dtype is not None and isinstance(dtype, NumericType):
        return c.cast("bigint").cast("string")
    t = F.trim(c.cast("string"))
    if strip_decimal_suffix:
        t = F.regexp_replace(t, r"\.0+$", "")
    return F.when(t == "", F.lit(None).cast("string")).otherwise(t)


def digit_count(c: Column) -> Column:
    """Number of digits in a key."""
    return F.length(digits_only(c))


# ---------------------------------------------------------------- coercion


def to_number_or_null(c: Column, dtype=None) -> Column:
    """Coercing numeric parse (NULL when it does not parse; the text NaN is no number)."""
    if dtype is not None and isinstance(dtype, NumericType):
        return c.cast("double")
    number = c.cast("string").try_cast("double")
    return F.when(~F.isnan(number), number)


def to_date_or_null(c: Column, dtype=None) -> Column:
    """Coercing date parse (ISO text, dates and timestamps)."""
    if dtype is not None and not isinstance(dtype, StringType):
        return c.cast("date")
    return F.try_to_date(c.cast("string"))


def normalise_fee(c: Column) -> Column:
    """Fees above 5 are read as basis-point-like percents and divided by 100 once."""
    return F.when(c <= 5, c).otherwise(c / 100.0)


def flag_from_yn(c: Column) -> Column:
    """X6: 'S' -> true, 'N' -> false, anything else -> NULL."""
    return F.when(c == "S", F.lit(True)).when(c == "N", F.lit(False)).otherwise(F.lit(None).cast("boolean"))


def flag_positive(c: Column) -> Column:
    """X > 0, NULL stays NULL."""
    return F.when(c.isNull(), F.lit(None).cast("boolean")).otherwise(c > 0)


# ---------------------------------------------------------------- calendar

_EPOCH = "1900-01-01"  # a Monday


def _weekday_count_before(d: Column) -> Column:
    """Mon-Fri days in [epoch, d): floor(k/7)*5 + least(k mod 7, 5)."""
    k = F.datediff(d, F.lit(_EPOCH).cast("date")).cast("bigint")
    return F.floor(k / 7).cast("bigint") * 5 + F.least(F.pmod(k, F.lit(7)), F.lit(5))


def business_days(first: Column, last: Column) -> Column:
    """Mon-Fri days in [first, last], both ends included (holidays ignored)."""
    return _weekday_count_before(F.date_add(last, 1)) - _weekday_count_before(first)


def month_floor(d: Column) -> Column:
    """First day of the calendar month."""
    return F.trunc(d, "MM")


def months_back(d: Column, months: int) -> Column:
    """D minus n calendar months, day clamped to the month end."""
    return F.add_months(d, -int(months))


def month_range(start: Column, end: Column) -> Column:
    """Inclusive array of 'YYYYMM' between two dates."""
    seq = F.sequence(F.trunc(start, "MM"), F.trunc(end, "MM"), F.expr("INTERVAL 1 MONTH"))
    return F.transform(seq, lambda m: F.date_format(m, "yyyyMM"))


# ---------------------------------------------------------------- investor / tax


def investor_level(target_investor: Column) -> Column:
    """X8: 'profissional' -> 2, 'qualificado' -> 1, anything else (NULL too) -> 0."""
    s = F.lower(F.coalesce(target_investor, F.lit("")))
    return (
        F.when(s.contains("profissional"), F.lit(2))
        .when(s.contains("qualificado"), F.lit(1))
        .otherwise(F.lit(0))
        .cast("int")
    )


def tax_rate(
    target_taxation: Column,
    fund_name: Column,
    rates_by_taxation: Mapping[str, float],
    exempt_keywords: Iterable[str],
    default_rate: float,
) -> Column:
    """Exact taxation match, else 0 when the upper-case name has an exempt keyword, else default."""
    exact = None
    for k, v in rates_by_taxation.items():
        cond = target_taxation == F.lit(k)
        exact = F.when(cond, F.lit(float(v))) if exact is None else exact.when(cond, F.lit(float(v)))
    upper_name = F.upper(F.coalesce(fund_name, F.lit("")))
    exempt = F.lit(False)
    for kw in exempt_keywords:
        exempt = exempt | upper_name.contains(kw)
    fallback = F.when(exempt, F.lit(0.0)).otherwise(F.lit(float(default_rate)))
    return F.coalesce(exact.otherwise(F.lit(None).cast("double")), fallback) if exact is not None else fallback


def net_return(gross: Column, rate: Column | float) -> Column:
    """G - max(g*rate, 0) written as (a - max((a-1)*rate, 0)) - 1 with a = 1 + g.
    Losses are not credited; NULL stays NULL."""
    rate_c = rate if isinstance(rate, Column) else F.lit(float(rate))
    a = F.lit(1.0) + gross
    tax = F.greatest((a - F.lit(1.0)) * rate_c, F.lit(0.0))
    return F.when(gross.isNull(), F.lit(None).cast("double")).otherwise((a - tax) - F.lit(1.0))


def net_value(gross: float, rate: float) -> float:
    """X10 on a driver-side scalar (the benchmark's one-row value)."""
    a = 1.0 + gross
    return (a - max((a - 1.0) * rate, 0.0)) - 1.0


# ---------------------------------------------------------------- scores


def span_score(span_days: Column, lam: float) -> Column:
    """1 - exp(-lambda * days / 365)."""
    return F.lit(1.0) - F.exp(F.lit(-float(lam)) * span_days / F.lit(365.0))


def liquidity_score(redemption_days: Column, lam: Column | float) -> Column:
    """exp(-lambda * redemption_days)."""
    lam_c = lam if isinstance(lam, Column) else F.lit(float(lam))
    return F.exp(-lam_c * redemption_days)


def accessibility_score(min_investment: Column, scale: float) -> Column:
    """exp(-min_investment / scale)."""
    return F.exp(-min_investment / F.lit(float(scale)))


def weighted_sum(terms: list[tuple[Column, Column]]) -> Column:
    """Sum of w_i * s_i folded left from 0.0, in the given order (stable floats)."""
    acc: Column = F.lit(0.0)
    for w, s in terms:
        acc = acc + w * s
    return acc


# ---------------------------------------------------------------- misc


def nan_to_null(c: Column) -> Column:
    """Never store NaN: NaN -> NULL."""
    return F.nanvl(c, F.lit(None).cast("double"))


def name_search(name: Column, needle: str) -> Column:
    """Case-insensitive substring match (ILIKE '%x%')."""
    escaped = needle.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
    return name.ilike(f"%{escaped}%")

