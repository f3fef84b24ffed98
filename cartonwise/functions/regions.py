"""The two region rules: per country and per supplier."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cartonwise.config import Rules


def country_region(country: Column, rules: Rules) -> Column:
    """BD for a listed country, CN for any other and for a missing one."""
    return F.when(country.isin(*rules.bd_countries), "BD").otherwise("CN")


def supplier_region(country: Column, rules: Rules, without_country: str = "BD", skip_blank: bool = False) -> Column:
    """Aggregate: BD if every known country is a BD one. `without_country` is the region of a group whose
    countries are all missing: nothing contradicts BD, but report folders file such suppliers under CN.
    A blank country is one more non-BD country unless `skip_blank` treats it as missing."""
    named = F.trim(country)
    if skip_blank:
        named = F.nullif(named, F.lit(""))
    all_bd = F.bool_and(named.isin(*rules.bd_countries))
    return F.when(all_bd.isNull(), F.lit(without_country)).when(all_bd, "BD").otherwise("CN")
