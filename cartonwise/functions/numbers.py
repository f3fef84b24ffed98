"""Percentages, rounding, bands and carton measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cartonwise.config import Rules


def percent(part: Column, whole: Column) -> Column:
    """part / whole * 100, null when whole is 0 or null."""
    return F.try_divide(part.cast("double"), whole.cast("double")) * 100


def rounded(value: Column, digits: int = 1) -> Column:
    """Round a double as it is stored, half to even. 0.05 is stored a little above its decimal form and gives 0.1 at
    one digit, where rounding its printed form (bround) would give 0.0; such near-ties are settled by the JVM's decimal
    formatter, which looks at the stored value, and all other values by plain arithmetic."""
    value = value.cast("double")
    scaled = value * 10**digits
    near_tie = F.abs(scaled - F.floor(scaled) - 0.5) < 1e-3
    exact = F.call_function("format_number", value, F.lit("0." + "0" * digits)).cast("double")
    return F.when(near_tie, exact).otherwise(F.rint(scaled) / 10**digits)


def percent_change(now: Column, before: Column) -> Column:
    """Whole-percent change; null without a base."""
    ratio = F.try_divide((now - before).cast("double"), before.cast("double"))
    return F.rint(ratio * 100).cast("bigint")


def mean_of_rounded(rate: Column, digits: int) -> Column:
    """Aggregate: mean of rates that are already rounded, summed as integers so that row order cannot matter."""
    steps = F.rint(rate * 10**digits).cast("bigint")
    return F.try_divide(F.sum(steps).cast("double"), F.count(rate) * 10**digits)


def rate_band(rate: Column, rules: Rules) -> Column:
    return F.when(rate >= rules.high_band, "high").when(rate >= rules.mid_band, "mid").otherwise("low")


def heat_band(rate: Column, rules: Rules) -> Column:
    """Shading of the yearly grid: unlike rate_band it has no high band and leaves blanks unshaded."""
    return F.when(rate.isNull(), "none").when(rate < rules.heat_low, "low").when(
        rate < rules.heat_mid, "mid").otherwise("none")


def carton_volume(length: Column, width: Column, height: Column) -> Column:
    """Cubic metres of a carton measured in millimetres; null if a side is missing."""
    return rounded((length / 1000) * (width / 1000) * (height / 1000), 4)


def carton_density(units: Column, cbm: Column) -> Column:
    """Units per cubic metre, from the rounded volume; null for a missing or zero volume."""
    return rounded(F.try_divide(units.cast("double"), cbm.cast("double")), 2)


# board_area() counts in this many parts of a square metre.
BOARD_UNITS = 1_000_000


def board_area(quantity: Column, length: Column, width: Column, height: Column) -> Column:
    """Corrugated board of a line's cartons, quantity * (length + 6 cm) * (width + height + 4 cm) * 2, as a whole
    number of square millimetres: exact, so that sums do not depend on row order."""
    side = (length.cast("bigint") + 60) * (width.cast("bigint") + height.cast("bigint") + 40) * 2
    return (quantity.cast("bigint") * side).cast("decimal(20,0)")
