"""Column contracts of every layer, and the declared match configuration."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# Attribute names of a flat provider record, in enterprise order.
ATTRIBUTES = [
    "ProviderID", "FirstName", "MiddleName", "LastName", "FullName",
    "Credential", "Gender", "Status", "EnumerationDate", "LastUpdated",
    "AddressLine1", "City", "State", "PostalCode", "CountryCode",
    "CountryName", "PhoneNumber", "FaxNumber", "TaxonomyCode",
    "TaxonomyDescription", "LicenseNumber", "LicenseState", "Identifier",
    "IdentifierIssuer", "IdentifierType",
]

# Attributes compared by similarity, with the required percentage.
FUZZY_PRECISION = {
    "FullName": 95,
    "AddressLine1": 90,
    "City": 90,
    "TaxonomyDescription": 90,
}

# The attributes a golden record publishes, in enterprise order.
PUBLISHED = [
    "ProviderID", "FullName", "Credential", "Gender", "Status",
    "AddressLine1", "City", "State", "PostalCode", "CountryCode",
    "PhoneNumber", "TaxonomyCode", "LicenseNumber", "Identifier",
]

FLAGS = ["BUSINESS_RULE_STATUS", "DATA_QUALITY_WARNING"]


@dataclass(frozen=True)
class FieldMatch:
    """How one payload field is to be compared downstream."""

    name: str
    method: str
    precision: int


FIELD_CONFIG = [
    FieldMatch(a, "FUZZY", FUZZY_PRECISION[a]) if a in FUZZY_PRECISION
    else FieldMatch(a, "EXACT", 100)
    for a in ATTRIBUTES
]


def _audit(timestamp: T.DataType) -> list[T.StructField]:
    text = ["SOURCE_SYSTEM", "PAYLOAD_FORMAT", "TARGET_SYSTEM"]
    return [
        *[T.StructField(n, T.StringType()) for n in text],
        T.StructField("LOAD_TIMESTAMP", timestamp),
        T.StructField("LOAD_DATE", T.DateType()),
        T.StructField("FILE_NAME", T.StringType()),
        T.StructField("BATCH_ID", T.StringType()),
    ]


AUDIT = [f.name for f in _audit(T.TimestampType())]

SILVER_COLUMNS = ATTRIBUTES + AUDIT
GOLD_COLUMNS = PUBLISHED + FLAGS + AUDIT

FLAT = _strings(*ATTRIBUTES)
BRONZE = T.StructType([T.StructField("PROVIDER_JSON", T.StringType()), *_audit(T.TimestampType())])
SILVER = T.StructType([*FLAT.fields, *_audit(T.TimestampType())])
# Landing and everything after it keep a wall-clock load time without a zone.
GOLD = T.StructType([*_strings(*PUBLISHED, *FLAGS).fields, *_audit(T.TimestampNTZType())])

PAYLOAD = T.StructType([
    T.StructField("resultSize", T.StringType()),
    T.StructField("entityType", T.StringType()),
    T.StructField("codBases", T.ArrayType(T.StringType())),
    T.StructField("fields", T.ArrayType(T.StructType([
        T.StructField("method", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("values", T.ArrayType(T.StringType())),
        T.StructField("fuzzyPrecision", T.IntegerType()),
    ]))),
])

EXPORT_LOG = T.StructType([
    T.StructField("EXPORT_ID", T.StringType(), False),
    T.StructField("BATCH_ID", T.StringType(), False),
    T.StructField("EXPORT_TIMESTAMP", T.TimestampType(), False),
    T.StructField("S3_PATH", T.StringType(), False),
    T.StructField("ROW_COUNT", T.LongType(), False),
    T.StructField("STATUS", T.StringType(), False),
    T.StructField("ERROR_MESSAGE", T.StringType()),
])

_ADDRESS = _strings(
    "address_1", "address_2", "address_purpose", "address_type", "city", "state",
    "postal_code", "country_code", "country_name", "telephone_number", "fax_number",
)
_TAXONOMY = _strings("code", "desc", "license", "state", "taxonomy_group").add(
    "primary", T.BooleanType()
)
RAW_PROVIDER = (
    T.StructType()
    .add("number", T.StringType())
    .add("enumeration_type", T.StringType())
    .add("created_epoch", T.StringType())
    .add("last_updated_epoch", T.StringType())
    .add("basic", _strings(
        "first_name", "middle_name", "last_name", "name_prefix", "name_suffix", "credential",
        "sex", "status", "sole_proprietor", "enumeration_date", "last_updated",
        "certification_date",
    ))
    .add("addresses", T.ArrayType(_ADDRESS))
    .add("practiceLocations", T.ArrayType(_ADDRESS))
    .add("taxonomies", T.ArrayType(_TAXONOMY))
    .add("identifiers", T.ArrayType(_strings("code", "desc", "identifier", "issuer", "state")))
    .add("other_names", T.ArrayType(_strings(
        "type", "code", "first_name", "middle_name", "last_name", "prefix", "suffix",
        "credential",
    )))
    .add("endpoints", T.ArrayType(_strings(
        "endpoint", "endpointType", "endpointTypeDescription", "endpointDescription",
        "affiliation", "useDescription", "contentTypeDescription", "address_type", "address_1",
        "city", "state", "postal_code", "country_code", "country_name",
    )))
)
RAW = T.StructType().add("result_count", T.IntegerType()).add(
    "results", T.ArrayType(RAW_PROVIDER)
)
