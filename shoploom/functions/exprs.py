"""Column expressions used by more than one plan. All run inside the JVM."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

EXACT = "decimal(20,6)"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- ratios ---------------------------------------------------------------


def rounded_ratio(num, den, times: int = 1, digits: int = 2, otherwise=None) -> Column:
    """`num / den * times`, rounded half away from zero, where `den > 0`; else `otherwise`.

    Computed on decimals so that ties round the same way whatever the summation order.
    A NULL `den` takes the `otherwise` arm; a NULL `num` over a positive `den` stays NULL.
    """
    n, d = col(num), col(den)
    quotient = n.cast(EXACT) * F.lit(times) / d.cast(EXACT)
    return F.when(d > 0, F.round(quotient, digits).cast("double")).otherwise(F.lit(otherwise).cast("double"))


def percent(num, den, otherwise=None) -> Column:
    return rounded_ratio(num, den, times=100, otherwise=otherwise)


def plain_ratio(num, den, otherwise=None) -> Column:
    """Unrounded `num / den` where `den > 0`; else `otherwise`."""
    n, d = col(num), col(den)
    return F.when(d > 0, n.cast("double") / d.cast("double")).otherwise(F.lit(otherwise).cast("double"))


def safe_divide(num, den) -> Column:
    """Unrounded `num / den`, NULL when `den` is zero."""
    return F.try_divide(col(num).cast("double"), col(den).cast("double"))


def relative_change(now, before) -> Column:
    """`(now - before) / |before|` as a fraction; NULL without a non-zero `before`."""
    n, b = col(now), col(before)
    return safe_divide(n - b, F.abs(b))


# --- flags, ladders, patterns ----------------------------------------------


def flag(condition: Column) -> Column:
    """1 where true, 0 where false or NULL."""
    return F.when(condition, 1).otherwise(0)


def like_any(value, patterns: Iterable[str]) -> Column:
    """True when `value` matches one of the LIKE patterns."""
    hit = F.lit(False)
    for pattern in patterns:
        hit = hit | col(value).like(pattern)
    return hit


def ladder(arms: Sequence[tuple[Column, object]], otherwise=None) -> Column:
    """First arm whose condition holds gives the value."""
    (first, value), *rest = arms
    out = F.when(first, F.lit(value))
    for condition, value in rest:
        out = out.when(condition, F.lit(value))
    return out.otherwise(otherwise if isinstance(otherwise, Column) else F.lit(otherwise))


def bucket(value, edges: Sequence[tuple[int, str]], above: str, missing: str | None = None) -> Column:
    """Label of the first upper edge not below `value`."""
    v = col(value)
    arms = [(v.isNull(), missing)] if missing is not None else []
    arms += [(v <= edge, label) for edge, label in edges]
    return ladder(arms, above)


def first_group(value, pattern: str) -> Column:
    """First capture group, NULL (not '') when the pattern does not match."""
    v = col(value)
    return F.when(v.rlike(pattern), F.regexp_extract(v, pattern, 1))


# --- time -------------------------------------------------------------------


def civil_time(instant, tz: str) -> Column:
    """Wall-clock time in `tz` of a UTC instant (TIMESTAMP in a UTC session, or TIMESTAMP_NTZ in UTC)."""
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), col(instant).cast("timestamp_ntz"))


def micros_to_utc(micros) -> Column:
    return F.timestamp_micros(col(micros)).cast("timestamp_ntz")


def iso_week_start(day) -> Column:
    """Monday of the week."""
    return F.trunc(col(day), "week")


def iso_week(day) -> Column:
    return F.weekofyear(col(day))


def iso_year(day) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), col(day))


def sunday_week_start(day) -> Column:
    """Sunday on or before the day."""
    return F.date_sub(col(day), F.dayofweek(col(day)) - 1)


def sunday_week_number(day) -> Column:
    """Week 0-53, weeks starting on Sunday, days before the first Sunday in week 0."""
    return F.floor((F.dayofyear(col(day)) + 7 - F.dayofweek(col(day))) / 7).cast("int")


def month_start(day) -> Column:
    return F.trunc(col(day), "month")


def month_gap(later, earlier) -> Column:
    """Number of month boundaries between two dates."""
    a, b = col(later), col(earlier)
    return (F.year(a) - F.year(b)) * 12 + F.month(a) - F.month(b)


def second_gap(later, earlier) -> Column:
    """Number of second boundaries between two civil times."""
    def whole(c):
        return F.date_trunc("second", col(c)).cast("timestamp_ntz")

    return F.timestamp_diff("SECOND", whole(earlier), whole(later))


def minutes_elapsed(later, earlier) -> Column:
    """Whole minutes elapsed."""
    return F.timestamp_diff("MINUTE", col(earlier), col(later))


# --- key/value arrays ---------------------------------------------------------


def param_value(params, key: str, kind: str) -> Column:
    """Typed value stored under `key`; NULL when the key is missing or holds another type."""
    entry = F.get(F.filter(col(params), lambda p: p["key"] == key), F.lit(0))
    return entry["value"][f"{kind}_value"]


# --- addresses ----------------------------------------------------------------

# Words shortened by the documented address standard, and the short form.
ADDRESS_WORDS = {
    "street": "st", "avenue": "ave", "drive": "dr", "road": "rd", "lane": "ln",
    "court": "ct", "circle": "cir", "place": "pl",
    "apartment": "apt", "suite": "ste", "building": "bldg",
    "north": "n", "south": "s", "east": "e", "west": "w",
}


def normalised_address(line, abbreviations: bool = False) -> Column:
    """Lower case, without `.,#-`, single spaces, trimmed; optionally with words shortened."""
    out = F.regexp_replace(F.lower(col(line)), "[.,#-]", "")
    out = F.trim(F.regexp_replace(out, r"\s+", " "))
    if abbreviations:
        for word, short in ADDRESS_WORDS.items():
            out = F.regexp_replace(out, rf"\b{word}\b", short)
    return out


def normalised_zip(zip_code, country, home: Sequence[str] = ("US", "United States")) -> Column:
    """First five digits at home; elsewhere lower case without spaces."""
    z = col(zip_code)
    return F.when(
        col(country).isin(*home), F.substring(F.regexp_replace(z, "[^0-9]", ""), 1, 5)
    ).otherwise(F.lower(F.regexp_replace(z, r"\s+", "")))


def household_key(address, zip_code) -> Column:
    return F.concat(F.coalesce(col(address), F.lit("")), F.lit("|"), F.coalesce(col(zip_code), F.lit("")))
