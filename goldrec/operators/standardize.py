"""Nested registry documents to flat provider records."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldrec.functions.text import join_present, or_empty
from goldrec.schemas import ATTRIBUTES


@dataclass(frozen=True)
class Pick:
    """Which element of a repeated part feeds the flat record.

    None takes the first element. A SQL predicate over the element's fields, written with
    the element named ``x``, takes the first element that satisfies it.
    """

    addresses: str | None = None
    taxonomies: str | None = None
    identifiers: str | None = None


# Nested path of every attribute; FullName is composed.
SOURCE_PATHS = {
    "ProviderID": "number",
    "FirstName": "basic.first_name",
    "MiddleName": "basic.middle_name",
    "LastName": "basic.last_name",
    "Credential": "basic.credential",
    "Gender": "basic.sex",
    "Status": "basic.status",
    "EnumerationDate": "basic.enumeration_date",
    "LastUpdated": "basic.last_updated",
    "AddressLine1": "addresses.address_1",
    "City": "addresses.city",
    "State": "addresses.state",
    "PostalCode": "addresses.postal_code",
    "CountryCode": "addresses.country_code",
    "CountryName": "addresses.country_name",
    "PhoneNumber": "addresses.telephone_number",
    "FaxNumber": "addresses.fax_number",
    "TaxonomyCode": "taxonomies.code",
    "TaxonomyDescription": "taxonomies.desc",
    "LicenseNumber": "taxonomies.license",
    "LicenseState": "taxonomies.state",
    "Identifier": "identifiers.identifier",
    "IdentifierIssuer": "identifiers.issuer",
    "IdentifierType": "identifiers.desc",
}

NAME_PARTS = ("FirstName", "MiddleName", "LastName")


def explode_results(responses: DataFrame) -> DataFrame:
    """One row per provider; a response without results gives no row."""
    return responses.select(F.explode("results").alias("_p")).select("_p.*")


def primary(part: str, where: str | None = None) -> Column:
    """The first element of a repeated part, or the first one that satisfies ``where``."""
    if where is None:
        return F.get(F.col(part), F.lit(0))
    return F.expr(f"get(filter({part}, x -> {where}), 0)")


def flatten_providers(
    raw: DataFrame, pick: Pick = Pick(), carry: Sequence[str] = ()
) -> DataFrame:
    """The 25 attributes as strings; whatever is missing becomes the empty string.

    ``carry`` names further columns that pass through.
    """

    def value(path: str) -> Column:
        part, _, field = path.partition(".")
        if not field:
            return F.col(part)
        if part == "basic":
            return F.col(path)
        return primary(part, getattr(pick, part)).getField(field)

    values = {name: or_empty(value(path)) for name, path in SOURCE_PATHS.items()}
    values["FullName"] = join_present(" ", [values[n] for n in NAME_PARTS])
    return raw.select(*[values[a].alias(a) for a in ATTRIBUTES], *carry)


def standardised_count(records: DataFrame) -> DataFrame:
    return records.agg(F.count(F.lit(1)).alias("totalRecords"))
