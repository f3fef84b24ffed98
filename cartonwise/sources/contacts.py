"""Supplier contacts: import, replacement and export."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartonwise.config import materialized
from cartonwise.functions.text import matching_key, split_emails


class BadContacts(ValueError):
    """A contact file without the two columns it needs."""


def contact_columns(headers: list[str]) -> tuple[str, str]:
    """The supplier-name and e-mail headers, in any order and case."""
    plain = {h: h.strip().lower() for h in headers}
    names = [h for h, text in plain.items() if "supplier" in text and "name" in text]
    emails = [h for h, text in plain.items() if h not in names and "email" in text]
    if not names or not emails:
        raise BadContacts("needs the columns 'Supplier Name' and 'Email'")
    return names[-1], emails[-1]


def import_contacts(cells: DataFrame) -> DataFrame:
    """One row per supplier and address. Rows of a supplier combine whatever the case of its name; suppliers
    without an address do not appear."""
    name, email = (F.col(f"`{h}`") for h in contact_columns(cells.columns))
    named = cells.where(name.isNotNull() & (name != ""))
    return named.select(matching_key(name).alias("supplier_name"),
                        F.explode(split_emails(email)).alias("email")).distinct()


def replace_contacts(stored: DataFrame, given: DataFrame) -> DataFrame:
    """Stored contacts after replacing those of each supplier in `given`: one row per supplier and address, or one with a
    null address to remove a supplier's contacts. Suppliers not given keep theirs."""
    keyed = given.select(matching_key(F.col("supplier_name")).alias("supplier_name"), "email")
    kept = stored.join(keyed, "supplier_name", "left_anti").select("supplier_name", "email")
    return kept.unionByName(keyed.where(F.col("email").isNotNull())).distinct()


def typed_contacts(typed: DataFrame) -> DataFrame:
    """Addresses typed into one text field per supplier (supplier_name, emails), as replace_contacts takes them; a blank
    field removes the supplier's contacts."""
    return typed.select("supplier_name", F.explode_outer(split_emails(F.coalesce("emails", F.lit("")))).alias("email"))


def save_contacts(contacts: DataFrame, path: str) -> None:
    """Write contacts, which may have been read from the same path."""
    materialized(contacts).write.mode("overwrite").parquet(path)


def contacts_sheet(directory: DataFrame) -> DataFrame:
    """The directory in the layout that import_contacts reads, by name."""
    return directory.orderBy(F.lower("name"), "name").select(
        F.col("name").alias("Supplier Name"), F.col("emails").alias("Email"))
