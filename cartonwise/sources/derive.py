"""The derived columns of a line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartonwise.functions.numbers import carton_density, carton_volume
from cartonwise.schema import COMPLIANT, NON_COMPLIANT


def carton_type(matrix_code: Column) -> Column:
    # Texts that stand for a missing matrix code.
    coded = matrix_code.isNotNull() & ~matrix_code.isin("", "None", "nan")
    return F.when(coded, "Standard").otherwise("Custom")


def verdict(status: Column, handover: Column, updated: Column) -> Column:
    """Compliant if approved and last updated no later than the handover day. `updated` is wall-clock time:
    its date is compared as written, never shifted to another time zone."""
    in_time = (status == "Approved") & (updated.cast("date") <= handover)
    return F.when(F.coalesce(in_time, F.lit(False)), COMPLIANT).otherwise(NON_COMPLIANT)


def derive(lines: DataFrame, updated: Column | None) -> DataFrame:
    """Add the derived columns whose inputs are present (`updated` is the wall-clock update time, for the verdict);
    Catalyst drops those nobody reads."""
    have = set(lines.columns)
    sides = [F.col(f"carton_{side}_mm") for side in ("length", "width", "height")]
    added = {}
    if "carton_matrix_code" in have:
        added["carton_type"] = carton_type(F.col("carton_matrix_code"))
    if {"carton_length_mm", "carton_width_mm", "carton_height_mm"} <= have:
        cbm = carton_volume(*sides)
        added["cbm"] = cbm.try_cast("decimal(10,4)")
        if "units_per_carton" in have:
            added["density"] = carton_density(F.col("units_per_carton"), cbm).try_cast("decimal(10,2)")
    if {"packaging_status", "handover_date"} <= have and updated is not None:
        added["compliance_status"] = verdict(F.col("packaging_status"), F.col("handover_date"), updated)
    return lines.withColumns(added)
