"""Unit conversion and value cleaning, all as Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def f_to_c(fahrenheit: Column | str) -> Column:
    """Fahrenheit to Celsius, one decimal, half-even."""
    return F.bround((_c(fahrenheit).cast("double") - 32) * 5 / 9, 1)


def lb_to_kg(pounds: Column | str) -> Column:
    """Pounds to kilograms, one decimal, half-even."""
    return F.bround(_c(pounds).cast("double") / 2.205, 1)


def convert_when(applies: Column, factor: Column | str, value: Column | str, text: Column) -> tuple[Column, Column]:
    """(number, text) with a unit multiplier where ``applies``.

    The converted number also replaces the text; elsewhere both stay as they were.
    """
    scaled = _c(value) * _c(factor)
    hit = F.coalesce(applies, F.lit(False))
    return (
        F.when(hit, scaled).otherwise(_c(value)),
        F.when(hit, scaled.cast("string")).otherwise(text),
    )


def clean_fraction(value: Column | str) -> Column:
    """Inspired oxygen as a fraction: 20..100 is a percentage, (0.2, 1] a fraction, all else NULL."""
    v = _c(value)
    return F.when((v >= 20) & (v <= 100), v / 100).when((v > 0.2) & (v <= 1), v)


def impute_rate(
    rate: Column | str, rate_unit: Column | str, amount: Column | str, amount_unit: Column | str, minutes: Column | str
) -> tuple[Column, Column]:
    """Missing rate := amount per minute; missing unit := amount unit per minute."""
    return (
        F.coalesce(_c(rate), _c(amount) / _c(minutes)),
        F.coalesce(_c(rate_unit), F.concat(_c(amount_unit), F.lit("/min"))),
    )


def null_outside(value: Column | str, low: float, high: float) -> Column:
    """NULL for a value outside [low, high]."""
    v = _c(value)
    return F.when(v.between(low, high), v)


def coma_total(
    motor: Column, verbal: Column, eyes: Column, prev_motor: Column, prev_verbal: Column, prev_eyes: Column
) -> Column:
    """Coma-scale total with carry-forward from the previous reading.

    Verbal 0 marks an intubated patient: the total is then taken as normal (15). A reading that
    follows an intubated one is completed with normal values; any other is completed with the
    previous reading first.
    """
    # Normal component scores and the normal total.
    normal_motor, normal_verbal, normal_eyes, normal_total = 6.0, 5.0, 4.0, 15.0

    was_intubated = F.coalesce(prev_verbal == 0, F.lit(False))
    intubated = F.coalesce(verbal == 0, F.lit(False)) | (verbal.isNull() & was_intubated)

    def part(now: Column, before: Column, normal: float) -> Column:
        carried = F.when(~was_intubated, before)
        return F.coalesce(now, carried, F.lit(normal))

    total = (
        part(motor, prev_motor, normal_motor)
        + part(verbal, prev_verbal, normal_verbal)
        + part(eyes, prev_eyes, normal_eyes)
    )
    return F.when(intubated, F.lit(normal_total)).otherwise(total)
