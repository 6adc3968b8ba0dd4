"""Every operator as a query over the given tables: ``name -> f(spark, sf_dir)``."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from goldrec.operators import gates, matching, payload, rules, similar, standardize, survive
from goldrec.plans import marts, pipeline, reports
from goldrec.plans.provider_view import provider_count, provider_src, silver_shape
from goldrec.schemas import ATTRIBUTES, AUDIT, FUZZY_PRECISION, GOLD, GOLD_COLUMNS, PAYLOAD
from goldrec.session import scratch_dir
from goldrec.sources import export, files, footers, history, tables
from goldrec.streaming import cdc, ingest
from goldrec.streaming.keyed import KeyedTable, upsert

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

DONE = ["BATCH_1995", "BATCH_1996", "BATCH_1997", "BATCH_1998"]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _policy(compat: bool = False) -> survive.Survivorship:
    return survive.Survivorship(tie="SRC_KEY", compat=compat)


def golden(spark: SparkSession, sf: str, where: str = "true", compat: bool = False) -> DataFrame:
    return survive.golden_record(provider_src(spark, sf).filter(where), _policy(compat))


def _until(spark: SparkSession, sf: str) -> DataFrame:
    return golden(spark, sf, "BATCH_ID <= 'BATCH_1999'")


def _after(spark: SparkSession, sf: str) -> DataFrame:
    return golden(spark, sf, "BATCH_ID > 'BATCH_1999'")


# Raw documents: nested registry records derived from the provider view -----------------


def _part(**fields: Column) -> Column:
    return F.struct(*[value.alias(name) for name, value in fields.items()])


def _raw_provider() -> Column:
    """A nested record whose parts vary: address order, empty and missing lists."""
    c, none = F.col, F.lit(None).cast("string")
    location = _part(
        address_1=c("AddressLine1"), address_purpose=F.lit("LOCATION"), city=c("City"),
        state=c("State"), postal_code=c("PostalCode"), country_code=c("CountryCode"),
        country_name=F.lit("United States"), telephone_number=c("PhoneNumber"), fax_number=none,
    )
    mailing = _part(
        address_1=F.lit("PO BOX 1"), address_purpose=F.lit("MAILING"), city=F.lit("ELSEWHERE"),
        state=c("State"), postal_code=F.lit("00000"), country_code=c("CountryCode"),
        country_name=F.lit("United States"), telephone_number=none, fax_number=F.lit("410-0000"),
    )
    is_primary = c("SRC_KEY") % 5 == 0
    specialty = _part(
        code=c("TaxonomyCode"), desc=F.lit("Specialty"), license=c("LicenseNumber"),
        state=c("State"), primary=is_primary,
    )
    other = _part(
        code=F.lit("TX99"), desc=F.lit("Other"), license=none, state=c("State"), primary=~is_primary,
    )
    identifier = _part(
        code=F.lit("05"), desc=F.lit("MEDICAID"), identifier=c("Identifier"),
        issuer=F.lit("STATE"), state=c("State"),
    )
    return _part(
        number=c("ProviderID"),
        basic=_part(
            first_name=c("FirstName"), middle_name=c("MiddleName"), last_name=c("LastName"),
            credential=c("Credential"), sex=c("Gender"), status=c("Status"),
            enumeration_date=none, last_updated=c("LastUpdated"),
        ),
        addresses=F.when(c("SRC_KEY") % 4 == 0, F.array(mailing, location)).otherwise(
            F.array(location, mailing)
        ),
        taxonomies=F.filter(F.array(specialty, other), lambda _: c("TaxonomyCode").isNotNull()),
        identifiers=F.when(c("Identifier").isNotNull(), F.array(identifier)),
    )


def raw_rows(spark: SparkSession, sf: str) -> DataFrame:
    """One nested provider per source row, with the audit columns and SRC_KEY."""
    src = provider_src(spark, sf, heavy=True)
    return src.select(_raw_provider().alias("_p"), *AUDIT, "SRC_KEY").select("_p.*", *AUDIT, "SRC_KEY")


def responses(spark: SparkSession, sf: str) -> DataFrame:
    """One response document per source row: no results, one provider or two."""
    key, one = F.col("SRC_KEY"), _raw_provider()
    twin = one.withField("number", F.concat("ProviderID", F.lit("T")))
    results = F.when(key % 10 != 9, F.when(key % 3 == 0, F.array(one, twin)).otherwise(F.array(one)))
    document = F.struct(F.size(results).alias("result_count"), results.alias("results"))
    return provider_src(spark, sf, heavy=True).select(F.to_json(document).alias("value"))


def _write_responses(spark: SparkSession, sf: str, path: str) -> None:
    responses(spark, sf).write.option("maxRecordsPerFile", 1000).option("compression", "gzip").text(path)


def flat_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Flat records with the audit columns, as the payload builder takes them."""
    return silver_shape(provider_src(spark, sf, heavy=True))


def bronze_rows(spark: SparkSession, sf: str) -> DataFrame:
    return payload.envelopes(flat_rows(spark, sf))


# A. Sources, sinks, tables --------------------------------------------------------------


@query
def raw_provider_explode(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "responses")
    _write_responses(spark, sf, path)
    providers = files.read_registry(spark, path, multiline=False)
    return providers.select(
        F.col("number").alias("PROVIDER_ID"),
        F.col("basic.last_name").alias("LAST_NAME"),
        F.size("addresses").cast("long").alias("N_ADDRESSES"),
        F.size("taxonomies").cast("long").alias("N_TAXONOMIES"),
        F.coalesce(F.size("identifiers"), F.lit(0)).cast("long").alias("N_IDENTIFIERS"),
    )


@query
def raw_archive(spark: SparkSession, sf: str) -> DataFrame:
    path, archive = scratch_dir(spark, "responses"), scratch_dir(spark, "archive")
    _write_responses(spark, sf, path)
    files.archive_raw(spark, path, archive, "first")
    lines = files.read_archive(spark, archive).select(
        F.explode(F.split("RESPONSE", "\n")).alias("line")
    )
    return lines.filter("line <> ''").select(
        F.get_json_object("line", "$.results[0].number").alias("PROVIDER_ID"),
        F.get_json_object("line", "$.result_count").cast("long").alias("RESULT_COUNT"),
    )


@query
def envelope_build(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "envelopes")
    files.write_envelopes(bronze_rows(spark, sf), path)
    return _envelope_view(files.read_envelopes(spark, path))


def _envelope_view(bronze: DataFrame) -> DataFrame:
    """Engine-neutral view of envelopes: parsed fields instead of JSON text."""
    fields = F.col("provider.fields")
    return payload.parse_payload(bronze).select(
        F.get("provider.codBases", F.lit(0)).alias("CODE_BASE"),
        F.size(fields).cast("long").alias("N_FIELDS"),
        F.get(F.get(fields, F.lit(0))["values"], F.lit(0)).alias("PROVIDER_ID"),
        *[F.col(c) for c in AUDIT if c != "LOAD_TIMESTAMP"],
        F.col("LOAD_TIMESTAMP").cast("timestamp_ntz").alias("LOAD_TIMESTAMP"),
    )


@query
def bronze_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Two drops and three runs: every file is taken once."""
    root = scratch_dir(spark, "bronze")
    rows = bronze_rows(spark, sf)

    def run() -> None:
        ingest.ingest_files(spark, f"{root}/in", f"{root}/bronze", f"{root}/checkpoint")

    files.write_envelopes(rows.filter("BATCH_ID <= 'BATCH_1998'"), f"{root}/in/first")
    run()
    files.write_envelopes(rows.filter("BATCH_ID > 'BATCH_1998'"), f"{root}/in/second")
    run()
    run()
    return _envelope_view(ingest.read_bronze(spark, f"{root}/bronze"))


@query
def schema_contract(spark: SparkSession, sf: str) -> DataFrame:
    """A created table keeps its columns and rows when it is ensured again."""
    name = f"contract_{uuid.uuid4().hex}"
    path = scratch_dir(spark, "contract")
    tables.ensure_table(spark, name, GOLD, path)
    tables.append(golden(spark, sf), name)
    kept = tables.ensure_table(spark, name, GOLD, path)
    described = [
        F.struct(
            F.lit(i).cast("long").alias("POSITION"),
            F.lit(f.name).alias("COLUMN_NAME"),
            F.lit(f.dataType.simpleString()).alias("DATA_TYPE"),
            F.count(f.name).alias("N_VALUES"),
        )
        for i, f in enumerate(kept.schema.fields)
    ]
    return kept.agg(F.array(*described).alias("_c")).select(F.explode("_c").alias("_c")).select("_c.*")


@query
def export_batch_slice(spark: SparkSession, sf: str) -> DataFrame:
    result = export.export_batch(golden(spark, sf), "BATCH_1999", scratch_dir(spark, "export"))
    return spark.read.schema(GOLD).parquet(result.path)


@query
def export_log_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs of the pending export: the second finds nothing to do."""
    root, log_path = scratch_dir(spark, "exports"), scratch_dir(spark, "export-log")
    gold = golden(spark, sf)
    export.log_export(export.export_pending(gold, root), log_path)
    log = spark.read.schema(export.EXPORT_LOG).parquet(log_path)
    export.log_export(export.export_pending(gold, root, log), log_path)
    log = spark.read.schema(export.EXPORT_LOG).parquet(log_path)
    return log.select("BATCH_ID", "ROW_COUNT", "STATUS", "ERROR_MESSAGE")


def _stage_irregular(spark: SparkSession, sf: str, path: str) -> None:
    """Golden rows with other letter case, a missing, an extra and a partly bad column."""
    rows = golden(spark, sf)
    dates = F.when(F.col("PostalCode") == "10070", "not a date").otherwise(F.col("LOAD_DATE").cast("string"))
    odd = rows.withColumn("LOAD_DATE", dates).withColumn("EXTRA", F.lit(1)).drop("Identifier")
    odd.toDF(*[c.lower() for c in odd.columns]).write.parquet(path)


@query
def load_by_name(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_dir(spark, "by-name")
    _stage_irregular(spark, sf, f"{root}/staged")
    for _ in range(2):
        ingest.load_by_name(spark, f"{root}/staged", f"{root}/landing", f"{root}/checkpoint")
    return ingest.read_landing(spark, f"{root}/landing")


@query
def load_by_name_rejects(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_dir(spark, "by-name")
    _stage_irregular(spark, sf, f"{root}/staged")
    ingest.load_by_name(spark, f"{root}/staged", f"{root}/landing", f"{root}/checkpoint")
    rejects = ingest.read_rejects(spark, f"{root}/landing")
    return rejects.select(
        F.array_join("FAILED_COLUMNS", ",").alias("FAILED_COLUMNS"),
        F.get_json_object("ORIGINAL", "$.providerid").alias("PROVIDER_ID"),
        F.get_json_object("ORIGINAL", "$.load_date").alias("LOAD_DATE_TEXT"),
    )


def _stage_bad_files(spark: SparkSession, sf: str, path: str) -> None:
    """Good files, files with a column of another type, and files that aren't Parquet."""
    rows = golden(spark, sf)
    rows.filter("BATCH_ID < 'BATCH_1997'").coalesce(1).write.parquet(f"{path}/good")
    odd = rows.filter("BATCH_ID > 'BATCH_1997'").withColumn("LOAD_DATE", F.array(F.col("LOAD_DATE").cast("string")))
    odd.withColumn("LOAD_DATE", F.element_at("LOAD_DATE", 1)).coalesce(1).write.parquet(f"{path}/mistyped")
    broken = rows.filter("BATCH_ID = 'BATCH_1997'").select("BATCH_ID").distinct()
    broken.coalesce(1).write.text(f"{path}/text")
    system, place = _files(spark, path)
    for status in system.globStatus(place(f"{path}/text/part-*")):
        system.rename(status.getPath(), place(f"{path}/text/corrupt.parquet"))


def _files(spark: SparkSession, path: str):
    """The file system of the path, and what makes paths of it."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return place(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def _one_file(spark: SparkSession, rows: DataFrame, path: str) -> None:
    """The rows as one file under this very name, in place of what is there."""
    parts = scratch_dir(spark, "parts")
    rows.coalesce(1).write.parquet(parts)
    system, place = _files(spark, path)
    system.mkdirs(place(path).getParent())
    system.delete(place(path), False)
    for status in system.globStatus(place(f"{parts}/part-*")):
        system.rename(status.getPath(), place(path))


@query
def late_old_file(spark: SparkSession, sf: str) -> DataFrame:
    """A file staged last with the oldest time is loaded; new content under a known name is told, not loaded."""
    root, rows = scratch_dir(spark, "old-file"), golden(spark, sf)
    staged, landing = f"{root}/staged", f"{root}/landing"

    def run() -> None:
        ingest.load_by_name(spark, staged, landing, f"{root}/checkpoint")

    _one_file(spark, rows.filter("BATCH_ID > 'BATCH_1997'"), f"{staged}/a/new.parquet")
    run()
    _one_file(spark, rows.filter("BATCH_ID <= 'BATCH_1997'"), f"{staged}/b/old.parquet")
    system, place = _files(spark, staged)
    system.setTimes(place(f"{staged}/b/old.parquet"), 0, -1)
    _one_file(spark, rows.filter("BATCH_ID = 'BATCH_1999'"), f"{staged}/a/new.parquet")
    run()
    run()
    found = ingest.read_landing(spark, landing).groupBy("BATCH_ID").agg(F.count(F.lit(1)).alias("ROWS"))
    told = ingest.loaded_files(spark, landing).filter("STATUS = 'CHANGED'")
    return found.unionByName(told.groupBy(F.regexp_extract("FILE_PATH", "[^/]+$", 0).alias("BATCH_ID")).agg(F.count(F.lit(1)).alias("ROWS")))


@query
def load_replay_split(spark: SparkSession, sf: str) -> DataFrame:
    """A load that left one file out, made again under its name with that file mended: every row once."""
    root = scratch_dir(spark, "replay")
    _stage_bad_files(spark, sf, f"{root}/staged")
    ingest.load_by_name(spark, f"{root}/staged", f"{root}/landing", f"{root}/checkpoint")
    _one_file(spark, golden(spark, sf, "BATCH_ID = 'BATCH_1997'"), f"{root}/staged/text/corrupt.parquet")
    paths = [r["FILE_PATH"] for r in history.list_staged(spark, f"{root}/staged").collect()]
    for _ in range(2):
        ingest.load_paths(spark, paths, f"{root}/landing", "000000000000")
    return ingest.read_landing(spark, f"{root}/landing").groupBy("BATCH_ID").agg(F.count(F.lit(1)).alias("ROWS"))


@query
def load_by_name_bad_files(spark: SparkSession, sf: str) -> DataFrame:
    """One corrupt file stops nothing: the others are loaded and it is listed with the reason."""
    root = scratch_dir(spark, "bad-files")
    _stage_bad_files(spark, sf, f"{root}/staged")
    for _ in range(2):
        ingest.load_by_name(spark, f"{root}/staged", f"{root}/landing", f"{root}/checkpoint")
    found = ingest.read_landing(spark, f"{root}/landing").groupBy("BATCH_ID").agg(F.count(F.lit(1)).alias("ROWS"))
    bad = ingest.loaded_files(spark, f"{root}/landing").filter("STATUS = 'UNREADABLE'")
    return found.unionByName(bad.groupBy(F.regexp_extract("FILE_PATH", "[^/]+$", 0).alias("BATCH_ID")).agg(F.count(F.lit(1)).alias("ROWS")))


@query
def initial_load(spark: SparkSession, sf: str) -> DataFrame:
    """All landing rows, repeated ids included."""
    name = f"gold_{uuid.uuid4().hex}"
    tables.ensure_table(spark, name, GOLD, scratch_dir(spark, "initial"))
    rows = rules.quality_warning(rules.rule_status(provider_src(spark, sf)))
    tables.initial_load(rows, name)
    return spark.table(name)


@query
def backfill(spark: SparkSession, sf: str) -> DataFrame:
    """Files staged before the stream exists are loaded by its first run, once."""
    root = scratch_dir(spark, "backfill")
    rows = golden(spark, sf)

    def run() -> None:
        ingest.load_by_name(spark, f"{root}/staged", f"{root}/landing", f"{root}/checkpoint")

    rows.filter("BATCH_ID <= 'BATCH_1998'").write.parquet(f"{root}/staged/old")
    run()
    rows.filter("BATCH_ID > 'BATCH_1998'").write.parquet(f"{root}/staged/new")
    run()
    run()
    return ingest.read_landing(spark, f"{root}/landing")


@query
def load_history(spark: SparkSession, sf: str) -> DataFrame:
    """Rows loaded per staged drop; the drop staged last is not loaded yet."""
    root = scratch_dir(spark, "history")
    rows = golden(spark, sf).withColumn("drop", F.col("BATCH_ID"))
    last = "BATCH_ID = 'BATCH_2001'"
    rows.filter(f"NOT ({last})").write.partitionBy("drop").parquet(f"{root}/staged")
    ingest.load_by_name(spark, f"{root}/staged", f"{root}/landing", f"{root}/checkpoint", GOLD)
    rows.filter(last).write.mode("append").partitionBy("drop").parquet(f"{root}/staged")
    staged = history.list_staged(spark, f"{root}/staged")
    loads = history.load_history(staged, ingest.loaded_files(spark, f"{root}/landing"))
    drop = F.regexp_extract("FILE_PATH", "drop=([^/]+)", 1)
    return loads.groupBy(drop.alias("BATCH_ID")).agg(F.sum("ROWS").alias("ROWS_LOADED"))


# B. Standardise and build payloads ------------------------------------------------------


@query
def primary_element(spark: SparkSession, sf: str) -> DataFrame:
    return raw_rows(spark, sf).select(
        "SRC_KEY",
        standardize.primary("addresses")["city"].alias("FIRST_CITY"),
        standardize.primary("addresses", "x.address_purpose = 'LOCATION'")["city"].alias("LOCATION_CITY"),
        standardize.primary("taxonomies")["code"].alias("FIRST_TAXONOMY"),
        standardize.primary("taxonomies", "x.primary")["code"].alias("PRIMARY_TAXONOMY"),
        standardize.primary("identifiers")["identifier"].alias("FIRST_IDENTIFIER"),
    )


@query
def flatten_provider(spark: SparkSession, sf: str) -> DataFrame:
    return standardize.flatten_providers(raw_rows(spark, sf))


@query
def full_name_join(spark: SparkSession, sf: str) -> DataFrame:
    src = provider_src(spark, sf)
    first = F.when(F.col("SRC_KEY") % 5 == 0, "").otherwise(F.col("FirstName"))
    parts = [first, F.col("MiddleName"), F.col("LastName")]
    return src.select("SRC_KEY", standardize.join_present(" ", parts).alias("FULL_NAME"))


@query
def standardised_count(spark: SparkSession, sf: str) -> DataFrame:
    return standardize.standardised_count(standardize.flatten_providers(raw_rows(spark, sf)))


# Country spellings, by SRC_KEY modulo their number.
SPELLINGS = ["India", "  United States\t", "USA", "canada ", "UK", "", "GERMANY"]


@query
def codbase_lookup(spark: SparkSession, sf: str) -> DataFrame:
    spelled = F.get(F.array(*[F.lit(s) for s in SPELLINGS]), (F.col("SRC_KEY") % 7).cast("int"))
    country = F.when(F.col("SRC_KEY") % 11 != 0, spelled)
    return provider_src(spark, sf).select("SRC_KEY", payload.code_base(country).alias("CODE_BASE"))


@query
def payload_build(spark: SparkSession, sf: str) -> DataFrame:
    flat = flat_rows(spark, sf).select(
        *ATTRIBUTES, F.regexp_extract("FILE_NAME", "[0-9]+", 0).alias("LOAD_YEAR")
    )
    parsed = flat.select("LOAD_YEAR", F.from_json(payload.payload_json(), PAYLOAD).alias("p"))

    def joined(field: str) -> Column:
        return F.array_join(F.transform("p.fields", lambda f: f[field].cast("string")), ",")

    values = F.array_join(F.transform("p.fields", lambda f: F.get(f["values"], F.lit(0))), "|")
    return parsed.select(
        "LOAD_YEAR",
        F.col("p.resultSize").alias("RESULT_SIZE"),
        F.col("p.entityType").alias("ENTITY_TYPE"),
        F.array_join("p.codBases", ",").alias("CODE_BASES"),
        joined("name").alias("NAMES"),
        joined("method").alias("METHODS"),
        joined("fuzzyPrecision").alias("PRECISIONS"),
        values.alias("FIELD_VALUES"),
    )


@query
def payload_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Nested record to flat record to payload to standardised record, in one plan."""
    raw = raw_rows(spark, sf)
    flat = standardize.flatten_providers(raw, carry=AUDIT)
    return payload.silver(payload.envelopes(flat), provider_count(spark, sf))


@query
def batch_identity(spark: SparkSession, sf: str) -> DataFrame:
    loads = provider_src(spark, sf).select("LOAD_TIMESTAMP").distinct()
    named = payload.batch_identity(F.col("LOAD_TIMESTAMP"))
    return loads.select("LOAD_TIMESTAMP", *[c.alias(n) for n, c in named.items()])


# C. Silver ------------------------------------------------------------------------------


@query
def new_batch_anti(spark: SparkSession, sf: str) -> DataFrame:
    src = provider_src(spark, sf)
    done = src.filter(F.col("BATCH_ID").isin(DONE))
    return gates.new_batches(src, done).select("SRC_KEY", "BATCH_ID")


@query
def json_parse(spark: SparkSession, sf: str) -> DataFrame:
    """Every tenth text is cut short and so malformed."""
    events = spark.read.schema("event_id BIGINT, props STRING").parquet(f"{sf}/events.parquet")
    text = F.when(F.col("event_id") % 10 == 0, F.substring("props", 1, 4)).otherwise(F.col("props"))
    return events.select("event_id", F.from_json(text, "k BIGINT")["k"].alias("k"))


@query
def payload_parse(spark: SparkSession, sf: str) -> DataFrame:
    return _envelope_view(bronze_rows(spark, sf))


@query
def payload_explode(spark: SparkSession, sf: str) -> DataFrame:
    exploded = payload.explode_fields(payload.parse_payload(bronze_rows(spark, sf)))
    return exploded.groupBy("BATCH_ID", F.col("field.name").alias("FIELD_NAME")).agg(
        F.count(F.lit(1)).alias("N_ROWS")
    )


@query
def payload_flatten(spark: SparkSession, sf: str) -> DataFrame:
    parsed = payload.parse_payload(bronze_rows(spark, sf))
    fields = payload.flatten_fields(payload.explode_fields(parsed))
    return fields.select(
        "FIELD_NAME", "FIELD_VALUE", "MATCH_METHOD", "FUZZY_PRECISION", "FILE_NAME", "BATCH_ID"
    )


@query
def payload_pivot(spark: SparkSession, sf: str) -> DataFrame:
    parsed = payload.parse_payload(bronze_rows(spark, sf))
    return payload.pivot_fields(payload.flatten_fields(payload.explode_fields(parsed)))


@query
def payload_pivot_noshuffle(spark: SparkSession, sf: str) -> DataFrame:
    return payload.extract_fields(payload.parse_payload(bronze_rows(spark, sf)), provider_count(spark, sf))


@query
def clean_strings(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col
    padded = provider_src(spark, sf).select(
        "SRC_KEY",
        F.concat(F.lit("  "), c("FirstName"), F.lit(" ")).alias("FirstName"),
        F.when(c("SRC_KEY") % 3 == 0, "   ").otherwise(c("City")).alias("City"),
        F.coalesce("PhoneNumber", F.lit("")).alias("PhoneNumber"),
        "LOAD_DATE",
    )
    return payload.clean_strings(padded)


@query
def null_report(spark: SparkSession, sf: str) -> DataFrame:
    report = payload.null_report(flat_rows(spark, sf))
    return report.select(*[F.round(c, 6).alias(c) for c in report.columns])


@query
def null_report_footers(spark: SparkSession, sf: str) -> DataFrame:
    """The same report on the written layer, from its footers alone."""
    path = scratch_dir(spark, "silver")
    flat_rows(spark, sf).write.parquet(path)
    report = footers.footer_null_report(spark, path, spark.read.parquet(path))
    return report.select(*[F.round(c, 6).alias(c) for c in report.columns])


@query
def batch_presence(spark: SparkSession, sf: str) -> DataFrame:
    name = f"silver_{uuid.uuid4().hex}"
    rows = provider_src(spark, sf).drop("SRC_KEY")
    asked = ["BATCH_1996", "BATCH_1900"]
    before = gates.batch_presence(spark, name, asked[0])
    tables.ensure_table(spark, name, rows.schema, scratch_dir(spark, "presence"))
    tables.append(rows, name)
    found = [(b, before, gates.batch_presence(spark, name, b)) for b in asked]
    return spark.createDataFrame(found, "BATCH_ID string, ROWS_BEFORE long, ROWS_AFTER long")


@query
def batch_list(spark: SparkSession, sf: str) -> DataFrame:
    return gates.batch_list(provider_src(spark, sf))


# D. Gold --------------------------------------------------------------------------------


@query
def br_status(spark: SparkSession, sf: str) -> DataFrame:
    return rules.rule_status(provider_src(spark, sf)).select("SRC_KEY", "BUSINESS_RULE_STATUS")


@query
def br_status_compat(spark: SparkSession, sf: str) -> DataFrame:
    flagged = rules.rule_status(provider_src(spark, sf), rules.LENIENT_RULES)
    return flagged.select("SRC_KEY", "BUSINESS_RULE_STATUS")


@query
def br_message(spark: SparkSession, sf: str) -> DataFrame:
    return rules.rule_message(provider_src(spark, sf)).select("SRC_KEY", "BUSINESS_RULE_MESSAGE")


@query
def br_message_compat(spark: SparkSession, sf: str) -> DataFrame:
    flagged = rules.rule_message(provider_src(spark, sf), rules.LENIENT_RULES)
    return flagged.select("SRC_KEY", "BUSINESS_RULE_MESSAGE")


@query
def fullname_fill(spark: SparkSession, sf: str) -> DataFrame:
    return rules.fill_full_name(provider_src(spark, sf)).select("SRC_KEY", "FullName")


@query
def dq_warning(spark: SparkSession, sf: str) -> DataFrame:
    return rules.quality_warning(provider_src(spark, sf)).select("SRC_KEY", "DATA_QUALITY_WARNING")


@query
def exact_match(spark: SparkSession, sf: str) -> DataFrame:
    matched = matching.exact_match(provider_src(spark, sf).select("SRC_KEY", "ProviderID"))
    return matched.select("SRC_KEY", "EXACT_MATCH_COUNT", "EXACT_MATCH_STATUS")


@query
def duplicate_flag(spark: SparkSession, sf: str) -> DataFrame:
    flagged = matching.duplicate_flag(provider_src(spark, sf).select("SRC_KEY", "ProviderID"))
    return flagged.select("SRC_KEY", "DUPLICATE_COUNT", "DUPLICATE_STATUS")


@query
def field_match_score(spark: SparkSession, sf: str) -> DataFrame:
    """Nearly equal values of the FUZZY fields, within states: some blocks hold a fifth of all records."""
    return similar.score_fields(provider_src(spark, sf), block=("State",))


@query
def field_match_members(spark: SparkSession, sf: str) -> DataFrame:
    """Every record with the number of other records whose address passes."""
    return similar.similar_records(provider_src(spark, sf), "SRC_KEY", "AddressLine1", FUZZY_PRECISION["AddressLine1"], ("State",))


@query
def field_match_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Candidate pairs from equal phone and postal code, field by field: neighbouring records of a key."""
    rows = provider_src(spark, sf).filter("PhoneNumber IS NOT NULL")
    record = F.struct(*[c for c in ATTRIBUTES if c in rows.columns])
    after = Window.partitionBy("PhoneNumber", "PostalCode").orderBy("SRC_KEY")
    pairs = rows.select("SRC_KEY", record.alias("a"), F.lead(record).over(after).alias("b")).filter("b IS NOT NULL")
    scored = similar.score_pairs(pairs)
    return scored.select("SRC_KEY", *[F.array_join(c, ",").alias(c) for c in ("PASSED", "FAILED", "MISSING")])


FUZZY_COLUMNS = ["SRC_KEY", "FUZZY_MATCH_KEY", "FUZZY_MATCH_COUNT", "FUZZY_MATCH_STATUS"]


@query
def fuzzy_match(spark: SparkSession, sf: str) -> DataFrame:
    rows = provider_src(spark, sf).select("SRC_KEY", "PhoneNumber", "PostalCode")
    return matching.fuzzy_match(rows).select(*FUZZY_COLUMNS)


@query
def fuzzy_match_compat(spark: SparkSession, sf: str) -> DataFrame:
    rows = provider_src(spark, sf).select("SRC_KEY", "PhoneNumber", "PostalCode")
    return matching.fuzzy_match(rows, compat=True).select(*FUZZY_COLUMNS)


def _ranked(spark: SparkSession, sf: str, compat: bool) -> DataFrame:
    rows = provider_src(spark, sf).select("SRC_KEY", "ProviderID", "Status", "LastUpdated")
    return survive.survivor_rank(rows, _policy(compat)).drop("LastUpdated")


@query
def survivor_rank(spark: SparkSession, sf: str) -> DataFrame:
    return _ranked(spark, sf, False)


@query
def survivor_rank_compat(spark: SparkSession, sf: str) -> DataFrame:
    return _ranked(spark, sf, True)


@query
def golden_record(spark: SparkSession, sf: str) -> DataFrame:
    return golden(spark, sf)


@query
def golden_record_compat(spark: SparkSession, sf: str) -> DataFrame:
    return golden(spark, sf, compat=True)


@query
def gate_batch(spark: SparkSession, sf: str) -> DataFrame:
    rows = golden(spark, sf)
    held = provider_src(spark, sf).filter(F.col("BATCH_ID").isin(DONE))
    return gates.new_batches(rows, held)


def _daily(df: DataFrame) -> DataFrame:
    """One batch per load day instead of per year, so that some batches hold no known id."""
    return df.withColumn("BATCH_ID", payload.batch_identity(F.col("LOAD_TIMESTAMP"))["BATCH_ID"])


def _gate_sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Every golden record is a candidate; gold knows a fifth of the ids."""
    rows = golden(spark, sf)
    return _daily(rows), rows.filter("CAST(ProviderID AS INT) % 5 = 0")


@query
def gate_provider(spark: SparkSession, sf: str) -> DataFrame:
    return gates.gate_providers(*_gate_sides(spark, sf))


@query
def gate_provider_verdicts(spark: SparkSession, sf: str) -> DataFrame:
    return gates.known_providers(*_gate_sides(spark, sf))


@query
def gate_provider_anti(spark: SparkSession, sf: str) -> DataFrame:
    return gates.gate_providers(*_gate_sides(spark, sf), mode="anti")


@query
def gate_provider_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """All rows pass, and the newest row of an id is the one that counts."""
    rows, held = _gate_sides(spark, sf)
    return upsert(held, gates.gate_providers(rows, held, mode="upsert"), "ProviderID")


@query
def gate_poison(spark: SparkSession, sf: str) -> DataFrame:
    """A batch that is blocked for one known id keeps none of its other ids from later batches."""
    rows = provider_src(spark, sf)
    known = (F.col("BATCH_ID") < "BATCH_1997") & F.coalesce(F.col("ProviderID").cast("int") % 50 == 0, F.lit(False))
    held = survive.golden_record(rows.filter(known), _policy())
    # every other row is a candidate; in 1997 known ids come back, in other years they have ids of their own
    back = F.col("BATCH_ID") == "BATCH_1997"
    own = F.when(back | (F.col("ProviderID").cast("int") % 50 != 0), F.col("ProviderID")).otherwise(F.concat("ProviderID", F.lit("X")))
    fresh = rows.filter(~known).withColumn("ProviderID", own)
    best, _ = pipeline.decide(fresh, held, pipeline.Layout("unused", _policy()))
    return best


@query
def late_file_batch(spark: SparkSession, sf: str) -> DataFrame:
    """A batch comes in two files, the second one after silver has taken the first."""
    root, rows = scratch_dir(spark, "late"), bronze_rows(spark, sf)
    layout = pipeline.Layout(root)
    for drop, part in (("first", F.col("LOAD_DATE") < F.lit("1997-07-01")), ("second", F.col("LOAD_DATE") >= F.lit("1997-07-01"))):
        files.write_envelopes(rows.filter(part), f"{root}/in/{drop}")
        for _ in range(2):
            ingest.ingest_files(spark, f"{root}/in", layout.at("bronze"), layout.at("checkpoints/bronze"))
            pipeline.refine_silver(spark, layout)
    silver = pipeline.read_layer(spark, layout.at("silver"), pipeline.SILVER)
    return silver.groupBy("BATCH_ID").agg(F.count(F.lit(1)).alias("ROWS"), F.count("ProviderID").alias("IDS"))


@query
def gate_export(spark: SparkSession, sf: str) -> DataFrame:
    """The log is derived from the batches: early ones succeeded, one only failed."""
    rows = golden(spark, sf)
    status = F.when(F.col("BATCH_ID") == "BATCH_1998", "FAILED").otherwise("SUCCESS")
    log = gates.batch_list(provider_src(spark, sf).filter(F.col("BATCH_ID").isin(DONE)))
    return gates.gate_export(rows, log.withColumn("STATUS", status))


@query
def batch_consistency(spark: SparkSession, sf: str) -> DataFrame:
    rows = golden(spark, sf)
    found = []
    for batch in ("BATCH_1999", "BATCH_1900"):
        try:
            found.append((batch, gates.check_batch(rows, batch), True))
        except gates.BatchMismatch:
            found.append((batch, None, False))
    return spark.createDataFrame(found, "BATCH_ID string, TOTAL_RECORDS long, CONSISTENT boolean")


@query
def review_match(spark: SparkSession, sf: str) -> DataFrame:
    matched = matching.exact_match(provider_src(spark, sf))
    return reports.review_sample(matched, "match", order=("ProviderID", "SRC_KEY"))


@query
def review_fuzzy(spark: SparkSession, sf: str) -> DataFrame:
    matched = matching.fuzzy_match(provider_src(spark, sf))
    return reports.review_sample(matched, "fuzzy", order=("FUZZY_MATCH_KEY", "SRC_KEY"))


@query
def review_duplicate(spark: SparkSession, sf: str) -> DataFrame:
    flagged = matching.duplicate_flag(provider_src(spark, sf))
    return reports.review_sample(flagged, "duplicate", order=("ProviderID", "SRC_KEY"))


@query
def review_rules(spark: SparkSession, sf: str) -> DataFrame:
    flagged = rules.rule_message(rules.rule_status(provider_src(spark, sf)))
    return reports.review_sample(flagged, "rules", order=("SRC_KEY",))


@query
def review_quality(spark: SparkSession, sf: str) -> DataFrame:
    flagged = rules.quality_warning(rules.fill_full_name(provider_src(spark, sf)))
    return reports.review_sample(flagged, "quality", order=("SRC_KEY",))


@query
def review_survivors(spark: SparkSession, sf: str) -> DataFrame:
    flagged = survive.survivor_rank(matching.duplicate_flag(provider_src(spark, sf)), _policy())
    return reports.review_sample(flagged, "survivors", order=("ProviderID", "SURVIVOR_RANK"))


# E. Change capture and upsert -----------------------------------------------------------


def _landing_and_consumed(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    landing = golden(spark, sf)
    return landing, provider_src(spark, sf).filter(F.col("BATCH_ID").isin(DONE))


@query
def cdc_pending(spark: SparkSession, sf: str) -> DataFrame:
    return cdc.pending(*_landing_and_consumed(spark, sf))


@query
def cdc_pending_counts(spark: SparkSession, sf: str) -> DataFrame:
    return cdc.pending_counts(*_landing_and_consumed(spark, sf))


@query
def cdc_has_data(spark: SparkSession, sf: str) -> DataFrame:
    return cdc.has_data(*_landing_and_consumed(spark, sf))


@query
def cdc_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The change stream drained twice: rows come out once, in the order of arrival."""
    root = scratch_dir(spark, "changes")
    _land(spark, root, "old", _until(spark, sf))

    def drain() -> None:
        writer = cdc.changes(spark, f"{root}/landing").writeStream.format("parquet")
        ingest.start(writer.option("path", f"{root}/out"), f"{root}/reader")

    drain()
    _land(spark, root, "new", _after(spark, sf))
    drain()
    drain()
    return spark.read.schema(GOLD).parquet(f"{root}/out")


def _land(spark: SparkSession, root: str, drop: str, rows: DataFrame) -> None:
    rows.write.parquet(f"{root}/staged/{drop}")
    ingest.load_by_name(spark, f"{root}/staged", f"{root}/landing", f"{root}/loader", GOLD)


@query
def merge_upsert(spark: SparkSession, sf: str) -> DataFrame:
    return upsert(_until(spark, sf), _after(spark, sf), "ProviderID")


@query
def merge_replay(spark: SparkSession, sf: str) -> DataFrame:
    """The same commits made twice change nothing, also in the table that compaction makes."""
    table = KeyedTable(spark, scratch_dir(spark, "master"))
    for _ in range(2):
        table.load(_until(spark, sf))
        table.merge(_after(spark, sf), 1)
    smaller = table.compact(scratch_dir(spark, "master"))
    smaller.merge(_after(spark, sf).filter("ProviderID IS NOT NULL"), 1)
    return smaller.read()


def _written_table(spark: SparkSession, sf: str) -> KeyedTable:
    """Early golden records, then three commits of later ones: two settle into the base, one doesn't."""
    table = KeyedTable(spark, scratch_dir(spark, "master"))
    table.load(_until(spark, sf))
    table.settle()
    late = _after(spark, sf).withColumn("State", F.when(F.col("ProviderID").cast("int") % 3 == 0, "ASIA").otherwise(F.col("State")))
    for commit in (1, 2, 3):
        table.merge(late.filter(F.coalesce(F.col("ProviderID").cast("int") % 3 + 1, F.lit(1)) == commit), commit)
        table.settle(share=0.02 * commit)
    return table


@query
def merge_written(spark: SparkSession, sf: str) -> DataFrame:
    """Commits over a settled base: whatever was settled, reading gives the newest row of each id."""
    return _written_table(spark, sf).read()


@query
def mart_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """The state mart from cells that each commit adds to and takes back from; providers move between states."""
    table = _written_table(spark, sf)
    kept = marts.IncrementalMarts(table, scratch_dir(spark, "cells"))
    for _ in range(2):
        kept.refresh()
    return kept.read("mart_provider_state")


def _run_twice(spark: SparkSession, sf: str) -> tuple[KeyedTable, str]:
    root = scratch_dir(spark, "upsert")
    table = KeyedTable(spark, f"{root}/master")
    for drop, rows in (("old", _until(spark, sf)), ("new", _after(spark, sf))):
        _land(spark, root, drop, rows)
        for _ in range(2):  # the second run finds nothing pending
            cdc.run_upsert(spark, f"{root}/landing", table, f"{root}/merger", f"{root}/runs")
    return table, f"{root}/runs"


@query
def cdc_run(spark: SparkSession, sf: str) -> DataFrame:
    return _run_twice(spark, sf)[0].read()


@query
def run_history(spark: SparkSession, sf: str) -> DataFrame:
    runs = cdc.run_history(spark, _run_twice(spark, sf)[1])
    return runs.select("STATE", "SOURCE_ROWS", (F.col("FINISHED_AT") >= F.col("STARTED_AT")).alias("TIMED"))


@query
def cdc_gate(spark: SparkSession, sf: str) -> DataFrame:
    """The gate of the triggered task, told by listing and checkpoint, and the rows that its runs merged."""
    root = scratch_dir(spark, "gate")
    landing, table = f"{root}/landing", KeyedTable(spark, f"{root}/master")
    told = []
    for drop, rows in (("old", _until(spark, sf)), ("new", _after(spark, sf))):
        _land(spark, root, drop, rows)
        for _ in range(2):
            pending = cdc.has_pending(spark, landing, f"{root}/merger")
            told.append((len(told), pending, cdc.triggered_upsert(spark, landing, table, f"{root}/merger", f"{root}/runs")))
    steps = spark.createDataFrame(told, "STEP long, HAS_DATA boolean, RAN boolean")
    return steps.withColumn("MERGED", table.read().agg(F.count(F.lit(1)).alias("n")).scalar())


@query
def run_history_failed(spark: SparkSession, sf: str) -> DataFrame:
    """A run that fails because its folder can't be written is in the history, and the next one takes the same rows."""
    root = scratch_dir(spark, "failing")
    _land(spark, root, "old", _until(spark, sf))
    system, place = _files(spark, root)
    system.create(place(f"{root}/master"), False).close()  # a file where the table's folder is to be
    table = KeyedTable(spark, f"{root}/master")
    try:
        cdc.run_upsert(spark, f"{root}/landing", table, f"{root}/merger", f"{root}/runs")
    except Exception:
        system.delete(place(f"{root}/master"), False)
    cdc.run_upsert(spark, f"{root}/landing", table, f"{root}/merger", f"{root}/runs")
    runs = cdc.run_history(spark, f"{root}/runs")
    return runs.select("STATE", "SOURCE_ROWS", F.col("ERROR_MESSAGE").isNotNull().alias("TOLD"))


@query
def archive_digests(spark: SparkSession, sf: str) -> DataFrame:
    """Responses in pieces of a few hundred bytes: each file's digest is that of the file as Spark reads it whole."""
    root = scratch_dir(spark, "digests")
    _write_responses(spark, sf, f"{root}/raw")
    files.archive_raw(spark, f"{root}/raw", f"{root}/archive", "one", chunk=50_000)
    whole = spark.read.format("binaryFile").load(f"{root}/raw").select(F.col("path").alias("FILE_PATH"), F.sha2("content", 256).alias("_whole"))
    found = files.archive_digests(spark, f"{root}/archive").join(whole, "FILE_PATH", "full")
    rows = spark.read.text(f"{root}/raw").agg(F.count(F.lit(1))).scalar()
    return found.agg(F.bool_and(F.coalesce(F.col("SHA256") == F.col("_whole"), F.lit(False))).alias("EQUAL")).withColumn("RESPONSES", rows)


# F. Analyst questions -------------------------------------------------------------------

for _name, _report in reports.ANALYST.items():
    QUERIES[_name] = lambda spark, sf, report=_report: report(golden(spark, sf))


# G. Monitoring --------------------------------------------------------------------------


def landing_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Rows as landed: flagged but not reduced to survivors."""
    flagged = rules.quality_warning(rules.rule_status(provider_src(spark, sf)))
    return flagged.select(*GOLD_COLUMNS)


@query
def layer_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of every layer that a run of the whole job has written."""
    root = scratch_dir(spark, "layers")
    layout = pipeline.Layout(root)
    files.write_envelopes(bronze_rows(spark, sf), f"{root}/in")
    models = pipeline.run_all(spark, layout, f"{root}/in")
    return reports.layer_counts({
        "bronze": ingest.read_bronze(spark, layout.at("bronze")),
        "silver": pipeline.read_layer(spark, layout.at("silver"), pipeline.SILVER),
        "gold": pipeline.read_layer(spark, layout.at("gold"), GOLD),
        "landing": ingest.read_landing(spark, layout.at("landing")),
        "keyed table": pipeline.keyed_table(spark, layout).read(),
        "dimension": models["dim_provider"],
        "state mart": models["mart_provider_state"],
    })


@query
def layer_counts_footers(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of written layers, from their footers."""
    root = scratch_dir(spark, "layers")
    files_, rows = {}, {"bronze": bronze_rows(spark, sf), "silver": flat_rows(spark, sf), "gold": golden(spark, sf)}
    for name, layer in rows.items():
        files_[name] = f"{root}/{name}"
        layer.write.parquet(files_[name])
    return footers.footer_layer_counts(spark, files_)


@query
def sample_rows(spark: SparkSession, sf: str) -> DataFrame:
    return reports.sample_rows(golden(spark, sf))


@query
def latest_rows(spark: SparkSession, sf: str) -> DataFrame:
    return reports.newest_first(landing_rows(spark, sf))


@query
def latest_dimension_rows(spark: SparkSession, sf: str) -> DataFrame:
    return reports.newest_first(marts.dimension(golden(spark, sf)))


@query
def latest_batches(spark: SparkSession, sf: str) -> DataFrame:
    return reports.latest_batches(landing_rows(spark, sf))


@query
def landing_distributions(spark: SparkSession, sf: str) -> DataFrame:
    return reports.distributions(landing_rows(spark, sf))


@query
def duplicate_check(spark: SparkSession, sf: str) -> DataFrame:
    return reports.duplicate_ids(landing_rows(spark, sf))


@query
def dq_issue_rows(spark: SparkSession, sf: str) -> DataFrame:
    return reports.quality_issues(landing_rows(spark, sf))


@query
def dq_issue_rows_compat(spark: SparkSession, sf: str) -> DataFrame:
    return reports.quality_issues(landing_rows(spark, sf), compat=True)


@query
def failed_rule_rows(spark: SparkSession, sf: str) -> DataFrame:
    return reports.failed_rules(landing_rows(spark, sf))


@query
def export_audit(spark: SparkSession, sf: str) -> DataFrame:
    log_path = scratch_dir(spark, "export-log")
    export.log_export(export.export_pending(golden(spark, sf), scratch_dir(spark, "exports")), log_path)
    log = spark.read.schema(export.EXPORT_LOG).parquet(log_path)
    return reports.export_audit(log, "BATCH_1999").select("BATCH_ID", "ROW_COUNT", "STATUS")


@query
def export_audit_all(spark: SparkSession, sf: str) -> DataFrame:
    """The whole log, after an attempt that failed and two that did not, newest first."""
    log_path, root = scratch_dir(spark, "export-log"), scratch_dir(spark, "exports")
    gold = golden(spark, sf)
    failed = gates.batch_list(gold).select(
        F.lit("x").alias("EXPORT_ID"), "BATCH_ID", F.lit("2020-01-01").cast("timestamp").alias("EXPORT_TIMESTAMP"),
        F.lit("N/A").alias("S3_PATH"), F.lit(0).cast("long").alias("ROW_COUNT"), F.lit("FAILED").alias("STATUS"),
        F.lit("no space").alias("ERROR_MESSAGE"))
    export.log_export(failed, log_path)
    for _ in range(2):
        log = spark.read.schema(export.EXPORT_LOG).parquet(log_path)
        export.log_export(export.export_pending(gold, root, log), log_path)
    log = spark.read.schema(export.EXPORT_LOG).parquet(log_path)
    return reports.export_audit(log).select("BATCH_ID", "ROW_COUNT", "STATUS", "ERROR_MESSAGE")


@query
def export_replay(spark: SparkSession, sf: str) -> DataFrame:
    """An export made again under its name replaces itself; what is staged are the rows once."""
    root = scratch_dir(spark, "exports")
    for _ in range(2):
        export.export_pending(golden(spark, sf), root, run="one")
    ingest.load_by_name(spark, root, f"{root}-landing", f"{root}-checkpoint", GOLD)
    return ingest.read_landing(spark, f"{root}-landing")


@query
def audit_columns(spark: SparkSession, sf: str) -> DataFrame:
    return reports.audit_columns(flat_rows(spark, sf))


# H. Models, tests, reconciliation -------------------------------------------------------


def _on_dim(fn: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: fn(marts.dimension(golden(spark, sf)))


QUERIES.update({
    "dim_provider": _on_dim(lambda dim: dim),
    "mart_state": _on_dim(marts.mart_state),
    "mart_state_compat": _on_dim(lambda dim: marts.mart_state(dim, compat=True)),
    "mart_summary": _on_dim(marts.mart_summary),
    "mart_summary_compat": _on_dim(lambda dim: marts.mart_summary(dim, compat=True)),
    "mart_gender": _on_dim(marts.mart_gender),
    "mart_taxonomy": _on_dim(marts.mart_taxonomy),
    "mart_rules": _on_dim(marts.mart_rules),
    "mart_dq": _on_dim(marts.mart_quality),
    "test_not_null": _on_dim(lambda dim: marts.test_not_null(dim, "ProviderID").unionByName(
        marts.test_not_null(dim, "TaxonomyCode"))),
    "test_accepted_values": _on_dim(lambda dim: marts.test_accepted_values(dim, "CountryCode", ["US"])),
    "dim_cardinality": _on_dim(marts.cardinality),
    "dim_rule_summary": _on_dim(marts.dim_rule_summary),
    "dim_distincts": _on_dim(marts.dim_distincts),
    "mart_counts": _on_dim(marts.mart_counts),
    "kpi_row": _on_dim(marts.kpi_row),
    "kpi_row_compat": _on_dim(lambda dim: marts.kpi_row(dim, compat=True)),
    "kpi_sliced": _on_dim(lambda dim: marts.kpi_row(
        marts.slice_dimension(dim, ["ASIA", "EUROPE"], ["F"]))),
    "mart_sliced": _on_dim(lambda dim: marts.mart_taxonomy(
        marts.slice_dimension(dim, states=["AFRICA"]))),
    "cross_filter": _on_dim(lambda dim: marts.cross_filter(
        marts.mart_state(dim), marts.slice_dimension(dim, ["ASIA", "EUROPE"], ["F"]), "State")),
    "share_by_gender": _on_dim(lambda dim: marts.share(dim, "Gender")),
    "share_by_dq": _on_dim(lambda dim: marts.share(dim, "DATA_QUALITY_WARNING")),
    "top10_taxonomy": _on_dim(marts.top_taxonomies),
})


@query
def test_unique(spark: SparkSession, sf: str) -> DataFrame:
    return marts.test_unique(landing_rows(spark, sf), "ProviderID")


@query
def reconcile_counts(spark: SparkSession, sf: str) -> DataFrame:
    gold = golden(spark, sf)
    return marts.reconcile_counts(gold, marts.dimension(gold))


@query
def materialised_models(spark: SparkSession, sf: str) -> DataFrame:
    """Staging view, dimension and marts as tables, and their row counts."""
    prefix = f"m{uuid.uuid4().hex}_"
    models = marts.build_models(golden(spark, sf), scratch_dir(spark, "models"), prefix)
    return reports.layer_counts(models)
