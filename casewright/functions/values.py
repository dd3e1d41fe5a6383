"""Numeric, date and code expressions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from casewright import schemas as S


def number_text(c: Column) -> Column:
    """Number left after dropping every sign but digits and dots; null if none."""
    return F.regexp_replace(c, r"[^0-9.]", "").try_cast("double")


def unit_factor(unit: Column, factors: dict[str, float], default: float) -> Column:
    """Factor of a unit code; ``default`` for a missing code, null for an unknown one."""
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(factors.items())])
    return F.when(unit.isNull() | (unit == ""), F.lit(float(default))).otherwise(
        F.try_element_at(table, unit)
    )


def age_in_days(age: Column, unit: Column, factors: dict[str, float] = S.AGE_FACTORS) -> Column:
    """Age in days; a decade count beyond 122 years is taken as the age itself."""
    days = F.rint(number_text(age) * unit_factor(unit, factors, factors["YR"]))
    return F.when(days > S.AGE_MAX_DAYS, F.when(unit == "DEC", days / factors["DEC"])).otherwise(days)


def age_in_years(days: Column) -> Column:
    return F.rint(days / F.lit(365.0))


def age_group(days: Column, years: Column) -> Column:
    return (
        F.when(years.isNull(), None)
        .when(days < 28, "N")
        .when(years < 2, "I")
        .when(years < 12, "C")
        .when(years < 18, "T")
        .when(years < 65, "A")
        .otherwise("E")
    )


def weight_in_kg(wt: Column, unit: Column, factors: dict[str, float] = S.WEIGHT_FACTORS) -> Column:
    kilos = F.rint(number_text(wt) * unit_factor(unit, factors, 1.0))
    return F.when(kilos <= S.WEIGHT_MAX_KG, kilos)


def duration_in_days(dur: Column, unit: Column, factors: dict[str, float] = S.AGE_FACTORS) -> Column:
    """Therapy length in days; a missing or unknown unit gives null."""
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(factors.items())])
    return F.rint(dur.try_cast("double") * F.try_element_at(table, unit))


def in_codes(c: Column, codes: list[str]) -> Column:
    """The code itself if it is listed, else null."""
    return F.when(c.isin(codes), c)


def std_sex(c: Column) -> Column:
    return in_codes(F.upper(F.trim(c)), S.SEX_CODES)


def std_occupation(c: Column) -> Column:
    return in_codes(c, S.OCCUPATION_CODES)


def std_outcome(c: Column) -> Column:
    return in_codes(c, list(S.OUTCOME_NAMES))


def outcome_name(c: Column) -> Column:
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(S.OUTCOME_NAMES.items())])
    return F.try_element_at(table, c)


def order_rank(c: Column, order: list[str]) -> Column:
    """1-based position in an ordered code list; null outside it."""
    return F.nullif(F.array_position(F.array(*[F.lit(x) for x in order]), c), F.lit(0)).cast("int")


def full_date(c: Column) -> Column:
    """Date of a complete ``YYYYMMDD`` value; partial dates give null."""
    text = c.cast("string")
    return F.when(F.length(text) == 8, F.try_to_date(text, "yyyyMMdd"))


def parse_date(c: Column) -> Column:
    """First of the three accepted notations that fits."""
    return F.coalesce(
        F.when(c.rlike(r"^\d{8}$"), F.try_to_date(c, "yyyyMMdd")),
        F.when(c.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.try_to_date(c, "yyyy-M-d")),
        F.when(c.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), F.try_to_date(c, "d/M/yyyy")),
    )


def std_numeric(value: Column, unit: Column | None = None) -> Column:
    """Number in kilograms where the unit is a known mass unit, else as given."""
    number = value.try_cast("double")
    if unit is None:
        return number
    name = F.lower(unit)
    return (
        F.when(name.isin("g", "grams"), number / 1000)
        .when(name.isin("mg", "milligrams"), number / 1000000)
        .otherwise(number)
    )


def success_rate(processed: Column, total: Column) -> Column:
    return F.when(total > 0, 100.0 * processed / total).otherwise(F.lit(0.0))
