"""Match payloads: built from the field configuration, parsed back and reshaped."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldrec.functions.text import blank_to_null, lookup, or_empty, strip_whitespace
from goldrec.schemas import ATTRIBUTES, AUDIT, FIELD_CONFIG, PAYLOAD, SILVER_COLUMNS, FieldMatch
from goldrec.session import spread

# Code base of a country name; any other name falls back to US.
COUNTRY_CODE_BASE = {
    "india": "IN",
    "united states": "US",
    "usa": "US",
    "canada": "CA",
    "uk": "GB",
}

# Constants every payload carries.
RESULT_SIZE = "20"
ENTITY_TYPE = "Activity"


@dataclass(frozen=True)
class BatchStamp:
    """Identity of one load: the raw file, processed file and batch share a time stamp."""

    at: datetime
    target_system: str
    source_system: str = "NPPES"
    payload_format: str = "JISB"

    @property
    def stamp(self) -> str:
        return self.at.strftime("%Y%m%d_%H%M%S")

    @property
    def batch_id(self) -> str:
        return f"BATCH_{self.stamp}"

    @property
    def raw_file(self) -> str:
        return f"raw_{self.stamp}.json"

    @property
    def processed_file(self) -> str:
        return f"processed_{self.stamp}.json"

    def columns(self) -> list[Column]:
        at = F.lit(self.at)
        return [
            F.lit(self.source_system).alias("SOURCE_SYSTEM"),
            F.lit(self.payload_format).alias("PAYLOAD_FORMAT"),
            F.lit(self.target_system).alias("TARGET_SYSTEM"),
            at.cast("timestamp").alias("LOAD_TIMESTAMP"),
            at.cast("date").alias("LOAD_DATE"),
            F.lit(self.processed_file).alias("FILE_NAME"),
            F.lit(self.batch_id).alias("BATCH_ID"),
        ]


def batch_identity(at: Column) -> dict[str, Column]:
    """Batch id and file names derived from a load time column."""
    stamp = F.date_format(at, "yyyyMMdd_HHmmss")
    return {
        "BATCH_ID": F.concat(F.lit("BATCH_"), stamp),
        "RAW_FILE": F.concat(F.lit("raw_"), stamp, F.lit(".json")),
        "FILE_NAME": F.concat(F.lit("processed_"), stamp, F.lit(".json")),
    }


def code_base(country: Column) -> Column:
    return lookup(F.lower(strip_whitespace(or_empty(country))), COUNTRY_CODE_BASE, "US")


def payload_struct(config: Sequence[FieldMatch] = FIELD_CONFIG) -> Column:
    """The payload of a flat record, one field entry per configured attribute, in order."""
    fields = [
        F.struct(
            F.lit(f.method).alias("method"),
            F.lit(f.name).alias("name"),
            F.array(or_empty(F.col(f.name).cast("string"))).alias("values"),
            F.lit(f.precision).alias("fuzzyPrecision"),
        )
        for f in config
    ]
    return F.struct(
        F.lit(RESULT_SIZE).alias("resultSize"),
        F.lit(ENTITY_TYPE).alias("entityType"),
        F.array(code_base(F.col("CountryName"))).alias("codBases"),
        F.array(*fields).alias("fields"),
    )


def payload_json(config: Sequence[FieldMatch] = FIELD_CONFIG) -> Column:
    return F.to_json(payload_struct(config), {"ignoreNullFields": "false"})


def envelopes(flat: DataFrame, stamp: BatchStamp | None = None) -> DataFrame:
    """Payload text plus the seven audit columns, from the stamp or already on the rows."""
    audit = stamp.columns() if stamp else [F.col(c) for c in AUDIT]
    return flat.select(payload_json().alias("PROVIDER_JSON"), *audit)


def parse_payload(bronze: DataFrame) -> DataFrame:
    """Typed payload beside its text; malformed text gives a payload of NULLs.

    PAYLOAD_ID is a digest that stands for the text in grouping keys, so that the text
    itself is neither multiplied by the explode nor shuffled.
    """
    return bronze.withColumns({
        "provider": F.from_json("PROVIDER_JSON", PAYLOAD),
        "PAYLOAD_ID": F.sha2("PROVIDER_JSON", 256),
    })


def no_fields() -> Column:
    return F.coalesce(F.size("provider.fields"), F.lit(0)) <= 0


def explode_fields(parsed: DataFrame) -> DataFrame:
    """One row per payload field; a payload without fields gives no row.

    The condition inside the explode changes no row. It stands in for the filter Spark
    would infer, which would be pushed below the parse and parse every text twice.
    """
    fields = F.when(~no_fields(), F.col("provider.fields"))
    return parsed.select("*", F.posexplode(fields).alias("POSITION", "field"))


def fieldless(parsed: DataFrame) -> DataFrame:
    """The payloads ``explode_fields`` leaves out, kept for a reject table."""
    return parsed.filter(no_fields())


def flatten_fields(exploded: DataFrame) -> DataFrame:
    return exploded.select(
        "PROVIDER_JSON",
        "PAYLOAD_ID",
        "POSITION",
        F.col("field.name").alias("FIELD_NAME"),
        F.get("field.values", F.lit(0)).alias("FIELD_VALUE"),
        F.col("field.method").alias("MATCH_METHOD"),
        F.col("field.fuzzyPrecision").alias("FUZZY_PRECISION"),
        *AUDIT,
    )


def pivot_fields(fields: DataFrame) -> DataFrame:
    """Fields back to columns by a grouped pivot with the attribute names given.

    Shuffles one row per field; ``extract_fields`` gives the same rows and shuffles one
    row per payload.
    """
    return (
        fields.groupBy("PAYLOAD_ID", *AUDIT)
        .pivot("FIELD_NAME", ATTRIBUTES)
        .agg(F.min_by("FIELD_VALUE", "POSITION"))  # a repeated name keeps its first entry
        .select(*SILVER_COLUMNS)
    )


def extract_fields(parsed: DataFrame, count: int | None = None) -> DataFrame:
    """Same rows as explode and pivot, each read from its own payload.

    The only shuffle removes byte-identical payloads of one load; it carries a digest of
    the text instead of the text, and combines copies before shuffling, into as many tasks as the
    session sets. Given at most ``count`` payloads, they are dealt by their digest to tasks whose number
    grows with it, and all copies of one meet in its task.
    """
    names, values = F.col("provider.fields.name"), F.col("provider.fields.values")
    # Map keys must be unique and present: a repeated name keeps its first entry. Only
    # payloads with such names take the second branch.
    distinct = F.array_compact(F.array_distinct(names))
    firsts = F.transform(
        distinct, lambda name: F.get(values, (F.array_position(names, name) - 1).cast("int"))
    )
    by_name = F.when(
        F.size(distinct) == F.size(names), F.map_from_arrays(names, values)
    ).otherwise(F.map_from_arrays(distinct, firsts))
    # Exploding none or one map drops payloads without fields, as a filter would, but a
    # filter would be pushed below the parse, see above. It also fixes the map as a column,
    # so that it is built once per row and not once per attribute.
    kept = parsed.select(
        *AUDIT, "PAYLOAD_ID", F.explode(F.when(~no_fields(), F.array(by_name))).alias("_by_name")
    )
    found = [
        F.get(F.try_element_at("_by_name", F.lit(a)), F.lit(0)).alias(a) for a in ATTRIBUTES
    ]
    found_rows = kept.select(*found, *AUDIT, "PAYLOAD_ID")
    dealt = found_rows if count is None else spread(found_rows, count, F.col("PAYLOAD_ID"))
    return dealt.distinct().drop("PAYLOAD_ID")


def clean_strings(df: DataFrame) -> DataFrame:
    """Trim every string column and turn what is then empty into NULL."""
    return df.select(*[
        blank_to_null(F.col(f.name)).alias(f.name) if f.dataType.typeName() == "string"
        else F.col(f.name)
        for f in df.schema.fields
    ])


def silver(bronze: DataFrame, count: int | None = None) -> DataFrame:
    """Bronze envelopes, at most ``count`` if given, to clean standardised records."""
    return clean_strings(extract_fields(parse_payload(bronze), count))


def null_report(df: DataFrame) -> DataFrame:
    """Percentage of NULLs per column, one wide row from one pass."""
    share = [
        (F.try_divide(F.count_if(F.col(c).isNull()), F.count(F.lit(1))) * 100).alias(f"{c}_null_pct")
        for c in df.columns
    ]
    return df.agg(*share)
