"""Energy and money expressions.

Energy is summed as two BIGINTs, whole units of 0.0001 kWh and what is left of each
reading in units of 10^-12 kWh: the sum does not depend on the order of rows, stays in
hash aggregation with plain long buffers, and is rounded once, after summing. Readings
must be below 10^9 kWh, which the record contract sees to.
Totals and money are DECIMAL and become DOUBLE only when they leave the engine.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F

UNITS_PER_KWH = 10_000
KWH = "decimal(18,4)"
MONEY = "decimal(18,2)"
RATE = "decimal(9,2)"


FINE = "decimal(30,0)"
FINE_PER_UNIT = 100_000_000


def sum_fine(kwh) -> Column:
    """Sum of a kWh column in units of 10^-12 kWh, to be summed further."""
    col = F.col(kwh) if isinstance(kwh, str) else kwh
    units = col.cast("double") * UNITS_PER_KWH
    whole = F.floor(units)
    rest = F.rint((units - whole) * FINE_PER_UNIT).cast("bigint")
    return (F.sum(whole).cast("decimal(20,0)") * F.lit(Decimal(FINE_PER_UNIT)) + F.sum(rest).cast("decimal(20,0)")).cast(FINE)


def fine_to_kwh(fine: Column) -> Column:
    """Units of 10^-12 kWh as DECIMAL(18,4), half up."""
    units = F.floor((fine.cast(FINE) + F.lit(Decimal(FINE_PER_UNIT // 2))) / F.lit(Decimal(FINE_PER_UNIT)))
    return units_to_kwh(units)


def sum_kwh(kwh) -> Column:
    """Exact sum of a kWh column as DECIMAL(18,4), rounded half up after summing."""
    return fine_to_kwh(sum_fine(kwh))


def units_to_kwh(units: Column) -> Column:
    return (units.cast("decimal(18,0)") * F.lit(Decimal("0.0001"))).cast(KWH)


def share_pct(part: Column, whole: Column, places: int = 2, empty=0) -> Column:
    """``100 * part / whole`` rounded half up; ``empty`` where the whole is not positive.

    Worked out on DECIMAL(18,4) so the quotient keeps 20 digits and a rounding tie is
    decided on the true value. The share may pass 100 and is not clamped.
    """
    ratio = F.round(part.cast(KWH) / F.nullif(whole.cast(KWH), F.lit(0).cast(KWH)), places + 2)
    pct = (ratio * 100).cast(f"decimal(18,{places})")
    return F.when(whole > 0, pct).otherwise(F.lit(empty).cast(f"decimal(18,{places})"))


def renewable_pct(solar: Column, consumption: Column) -> Column:
    return share_pct(solar, consumption, 2)


def mean_kw_per_meter(kwh: Column, minutes, meters: Column) -> Column:
    """Mean draw per meter in kW over a window; 0 without meters or without a length."""
    minutes = minutes if isinstance(minutes, Column) else F.lit(minutes)
    hours = minutes.cast("double") / F.lit(60.0)
    return F.when(
        (meters > 0) & (minutes > 0),
        F.try_divide(F.try_divide(kwh.cast("double"), hours), meters.cast("double")),
    ).otherwise(F.lit(0.0))


def seconds_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("SECOND", start, end)


def avg_load_kw(kwh: Column, start: Column, end: Column, places: int = 3) -> Column:
    """Mean power of a window from its own bounds; null for a window of no length."""
    seconds = F.nullif(seconds_between(start, end), F.lit(0).cast("bigint"))
    load = kwh.cast(KWH) * F.lit(3600).cast("decimal(4,0)") / seconds.cast("decimal(10,0)")
    return F.round(load, places).cast(f"decimal(18,{places})")


def net_kwh(consumption: Column, solar: Column) -> Column:
    """Units to pay for when surplus is not paid out: never below zero."""
    return F.greatest(consumption.cast(KWH) - solar.cast(KWH), F.lit(0).cast(KWH)).cast(KWH)


def gross_amount(net: Column, rate: Column) -> Column:
    return F.round(net.cast(KWH) * rate.cast(RATE), 2).cast(MONEY)


def subsidy_amount(gross: Column, flag: Column, share) -> Column:
    """Rounded before it is subtracted, so gross - subsidy = net holds to the cent."""
    cut = F.round(gross.cast(MONEY) * F.lit(Decimal(str(share))), 2).cast(MONEY)
    return F.when(flag, cut).otherwise(F.lit(0).cast(MONEY))


def completeness_pct(stored: Column, expected: Column) -> Column:
    return share_pct(stored, expected, 1)


def difference_pct(base: Column, other: Column, places: int = 1) -> Column:
    """``100 * (base - other) / base``; 0 for a zero base, null when other is missing."""
    delta = (base.cast(KWH) - other.cast(KWH)).cast(KWH)
    ratio = F.round(delta / F.nullif(base.cast(KWH), F.lit(0).cast(KWH)), places + 2)
    return F.when(
        other.isNotNull(),
        F.coalesce((ratio * 100).cast(f"decimal(18,{places})"), F.lit(0)),
    ).cast(f"decimal(18,{places})")


def band(value: Column, *steps, base: str) -> Column:
    """Colour band: the last step whose lower bound is reached, ``base`` below all."""
    result = F.lit(base)
    for bound, name in sorted(steps):
        result = F.when(value >= F.lit(bound), F.lit(name)).otherwise(result)
    return result


def strict_bool(text: Column) -> Column:
    """True only for the word true, in any case and with blanks around it."""
    return F.lower(F.trim(text)) == "true"
