"""Standardising, payloads and their way back."""

import gzip
import json
import hashlib
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from catalog.queries import QUERIES, bronze_rows, flat_rows
from goldrec import session
from goldrec.operators import payload as p
from goldrec.operators.standardize import Pick, explode_results, flatten_providers, standardised_count
from goldrec.plans.provider_view import provider_src
from goldrec.schemas import ATTRIBUTES, AUDIT, BRONZE, SILVER_COLUMNS
from goldrec.sources import files, footers
from goldrec.streaming.ingest import ingest_files, read_bronze
from tests.conftest import rows

DOC = {
    "result_count": 2,
    "results": [
        {
            "number": "10",
            "basic": {"first_name": "ANN", "middle_name": "", "last_name": "LEE", "sex": "F", "status": "A"},
            "addresses": [
                {"address_1": "BOX 1", "address_purpose": "MAILING", "city": "X"},
                {"address_1": "1 MAIN", "address_purpose": "LOCATION", "city": "Y", "state": "MD"},
            ],
            "taxonomies": [{"code": "T1", "primary": False}, {"code": "T2", "primary": True, "license": "L2"}],
            "identifiers": [{"identifier": "I1", "issuer": "S", "desc": "MEDICAID", "code": "05"}],
        },
        {"number": "11", "basic": {"first_name": None}, "addresses": [], "taxonomies": None},
    ],
}


@pytest.fixture
def folder(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "a.json").write_text(json.dumps(DOC, indent=2))
    (raw / "b.json").write_text(json.dumps({"result_count": 0}))
    (raw / "c.json").write_text(json.dumps({"result_count": 0, "results": []}))
    return raw


def test_flatten(spark, folder):
    raw = files.read_registry(spark, str(folder))
    flat = {r.ProviderID: r.asDict() for r in flatten_providers(raw).collect()}
    assert set(flat) == {"10", "11"}
    assert flat["10"]["FullName"] == "ANN LEE" and flat["10"]["AddressLine1"] == "BOX 1"
    assert (flat["10"]["TaxonomyCode"], flat["10"]["LicenseNumber"]) == ("T1", "")
    assert (flat["10"]["Gender"], flat["10"]["IdentifierType"]) == ("F", "MEDICAID")
    assert all(v == "" for k, v in flat["11"].items() if k != "ProviderID")
    assert standardised_count(flatten_providers(raw)).first().totalRecords == 2


def test_pick(spark, folder):
    pick = Pick(addresses="x.address_purpose = 'LOCATION'", taxonomies="x.primary")
    flat = flatten_providers(files.read_registry(spark, str(folder)), pick)
    first = flat.filter("ProviderID = '10'").first()
    assert (first.City, first.State, first.TaxonomyCode, first.LicenseNumber) == ("Y", "MD", "T2", "L2")
    assert flat.filter("ProviderID = '11'").first().City == ""


def test_archive_is_byte_for_byte_and_never_overwritten(spark, folder, tmp_path):
    archive = str(tmp_path / "archive")
    files.archive_raw(spark, str(folder), archive, "r1")
    kept = {r.FILE_PATH.rsplit("/", 1)[1]: r.RESPONSE for r in files.read_archive(spark, archive).collect()}
    assert kept == {f.name: f.read_text() for f in folder.iterdir()}
    with pytest.raises(Exception, match="already exists"):
        files.archive_raw(spark, str(folder), archive, "r1")
    files.archive_raw(spark, str(folder), archive, "r2")
    assert files.read_archive(spark, archive).count() == 6


def test_a_file_of_more_than_two_gigabytes_is_archived_in_pieces(spark, tmp_path):
    large = tmp_path / "in" / "large.json"
    large.parent.mkdir()
    with large.open("wb") as file:
        file.write(b"begin")
        file.truncate(2**31 + 12_345)  # a hole, so that it takes no disk
        file.seek(0, 2)
        file.write(b"end")
    (tmp_path / "in" / "none.json").write_text("")
    (tmp_path / "in" / "small.json").write_text("é" * 10)
    files.archive_raw(spark, str(large.parent), str(tmp_path / "archive"), "one")
    rows_ = spark.read.parquet(str(tmp_path / "archive"))
    assert rows_.filter("BYTES > 1000").count() == 513 and rows_.agg(F.max(F.length("content"))).first()[0] == files.CHUNK
    with large.open("rb") as file:
        digest = hashlib.file_digest(file, "sha256").hexdigest()
    found = {r.FILE_PATH.rsplit("/", 1)[1]: (r.BYTES, r.SHA256) for r in files.archive_digests(spark, str(tmp_path / "archive")).collect()}
    assert found["large.json"] == (2**31 + 12_348, digest)
    assert found["small.json"] == (20, hashlib.sha256(("é" * 10).encode()).hexdigest())
    texts = {r.FILE_PATH.rsplit("/", 1)[1]: r.RESPONSE for r in files.read_archive(spark, str(tmp_path / "archive")).collect()}
    assert texts["small.json"] == "é" * 10 and texts["large.json"] is None


def test_reports_from_footers(spark, tmp_path):
    rows_ = spark.createDataFrame([(1, "a", None), (None, "b", None), (3, None, None)], "x int, y string, z string")
    for n, part in enumerate((rows_, rows_.drop("z"), rows_.filter("x > 2"))):
        part.write.parquet(str(tmp_path / "layer" / f"p{n}"))
    layer = spark.read.option("recursiveFileLookup", True).schema("x int, y string, z string, missing string").parquet(str(tmp_path / "layer"))
    got = footers.footer_null_report(spark, str(tmp_path / "layer"), layer).first()
    assert [round(v, 6) for v in got] == [round(v, 6) for v in p.null_report(layer).first()]
    counts = footers.footer_layer_counts(spark, {"one": str(tmp_path / "layer"), "two": str(tmp_path / "layer" / "p2")})
    assert {r.LAYER: r.TOTAL_RECORDS for r in counts.collect()} == {"one": 7, "two": 1}


def test_extract_to_silver(spark, folder, tmp_path):
    stamp = p.BatchStamp(datetime(2026, 6, 28, 18, 25, 28), target_system="MDM")
    assert (stamp.batch_id, stamp.raw_file) == ("BATCH_20260628_182528", "raw_20260628_182528.json")
    files.extract(spark, str(folder), str(tmp_path / "processed"), stamp)
    args = (spark, str(tmp_path / "processed"), str(tmp_path / "bronze"), str(tmp_path / "ck"))
    for _ in range(2):
        ingest_files(*args)
    bronze = read_bronze(spark, str(tmp_path / "bronze"))
    assert bronze.count() == 2
    first = bronze.first()
    assert (first.FILE_NAME, first.BATCH_ID) == (stamp.processed_file, stamp.batch_id)
    assert first.LOAD_TIMESTAMP == datetime(2026, 6, 28, 18, 25, 28)
    silver = p.silver(bronze)
    assert silver.columns == SILVER_COLUMNS
    assert silver.filter("ProviderID = '10'").first().MiddleName is None
    assert silver.filter("ProviderID = '11'").first().FullName is None


def test_envelope_files_are_small_and_of_few_rows(spark, sf, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "ENVELOPE_ROWS", 200)
    given = bronze_rows(spark, sf).coalesce(1)
    files.write_envelopes(given, str(tmp_path / "in"))
    parts = sorted((tmp_path / "in").glob("part-*"))
    assert len(parts) >= 8 and all(len(gzip.open(x).read().splitlines()) <= 200 for x in parts)
    text = given.agg(F.sum(F.octet_length("PROVIDER_JSON"))).first()[0]
    assert sum(x.stat().st_size for x in parts) < text / 10
    assert rows(files.read_envelopes(spark, str(tmp_path / "in")), "PROVIDER_JSON", "BATCH_ID") == rows(given, "PROVIDER_JSON", "BATCH_ID")


def test_payload_work_is_dealt_by_rows_after_the_joins(spark, sf, monkeypatch):
    monkeypatch.setattr(session, "TASK_ROWS", 50)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        sizes = [r["count"] for r in bronze_rows(spark, sf).groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(sizes) >= 25 and max(sizes) < 100


@pytest.mark.parametrize("name", ["payload_pivot_noshuffle", "payload_roundtrip"])
def test_copies_of_payloads_are_removed_in_tasks_that_grow_with_the_rows(spark, sf, monkeypatch, name):
    monkeypatch.setattr(session, "TASK_ROWS", 50)
    sizes = [r["count"] for r in QUERIES[name](spark, sf).groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) >= 25 and max(sizes) < 100


def test_dealt_payloads_lose_only_their_copies(spark, sf):
    twice = p.parse_payload(bronze_rows(spark, sf).limit(300).union(bronze_rows(spark, sf)))
    assert rows(p.extract_fields(twice, 1_000)) == rows(p.extract_fields(twice))


def test_gzipped_responses_are_archived_as_they_are_and_read_as_text(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "TEXT_LIMIT", 5_000)
    text = "".join(f"{n} été\n" for n in range(400))
    given = {"one.gz": gzip.compress(text.encode()), "two.gz": gzip.compress(b"a") + gzip.compress(b"b"), "empty.gz": gzip.compress(b""),
             "long.gz": gzip.compress(b"x" * 5_001), "plain.json": text.encode()[:4_000]}
    (tmp_path / "in").mkdir()
    for name, content in given.items():
        (tmp_path / "in" / name).write_bytes(content)
    files.archive_raw(spark, str(tmp_path / "in"), str(tmp_path / "archive"), "r", chunk=100)
    found = {r.FILE_PATH.rsplit("/", 1)[1]: r.RESPONSE for r in files.read_archive(spark, str(tmp_path / "archive")).collect()}
    assert found == {"one.gz": text, "two.gz": "ab", "empty.gz": "", "long.gz": None, "plain.json": text.encode()[:4_000].decode()}
    kept = {r.FILE_PATH.rsplit("/", 1)[1]: r.SHA256 for r in files.archive_digests(spark, str(tmp_path / "archive")).collect()}
    assert kept == {name: hashlib.sha256(content).hexdigest() for name, content in given.items()}


def test_array_files_need_multiline(spark, tmp_path):
    entry = {"PROVIDER_JSON": "{}", "BATCH_ID": "B", "LOAD_DATE": "2026-01-01", "LOAD_TIMESTAMP": "2026-01-01T01:02:03"}
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.json").write_text(json.dumps([entry, entry], indent=2))
    assert files.read_envelopes(spark, str(tmp_path / "in"), multiline=True).filter("BATCH_ID = 'B'").count() == 2
    ingest_files(spark, str(tmp_path / "in"), str(tmp_path / "b"), str(tmp_path / "c"), multiline=True)
    assert rows(read_bronze(spark, str(tmp_path / "b")), "BATCH_ID", "PROVIDER_JSON") == [("B", "{}")] * 2


@pytest.mark.parametrize("country, base", [
    ("India", "IN"), (" United States\t", "US"), ("USA", "US"), ("CANADA\n", "CA"), (" uk ", "GB"),
    ("France", "US"), ("", "US"), (None, "US"), ("united  states", "US"),
])
def test_code_base(spark, country, base):
    df = spark.createDataFrame([(country,)], "c string")
    assert df.select(p.code_base(F.col("c"))).first()[0] == base


def bronze(spark, *texts):
    return spark.createDataFrame(
        [(t, "S", "P", "T", datetime(2026, 1, 1), datetime(2026, 1, 1).date(), "f", "B") for t in texts], BRONZE
    )


def field(name, *values):
    return {"method": "EXACT", "name": name, "values": list(values), "fuzzyPrecision": 100}


def test_odd_payloads(spark):
    texts = [
        "{bad", None, json.dumps({"fields": []}), json.dumps({"resultSize": "20"}),
        json.dumps({"fields": [field("ProviderID", "1"), field("ProviderID", "2"), field("Other", "x")]}),
        json.dumps({"fields": [field("ProviderID", "3"), {"name": "City", "values": []}]}),
        json.dumps({"fields": [field("ProviderID", " 4 ", "5"), field("City", "  ")]}),
    ]
    parsed = p.parse_payload(bronze(spark, *texts))
    assert p.fieldless(parsed).count() == 4
    assert p.explode_fields(parsed).count() == 7
    got = p.extract_fields(parsed)
    assert rows(got, "ProviderID", "City") == [(" 4 ", "  "), ("1", None), ("3", None)]
    pivoted = p.pivot_fields(p.flatten_fields(p.explode_fields(parsed)))
    assert rows(pivoted, "ProviderID", "City") == rows(got, "ProviderID", "City")
    assert rows(p.clean_strings(got), "ProviderID", "City") == [("1", None), ("3", None), ("4", None)]


def test_identical_payloads_of_a_load_collapse(spark):
    text = json.dumps({"fields": [field("ProviderID", "1")]})
    spaced = text.replace(":", ": ", 1)
    twice = bronze(spark, text, text, text.replace(":", ":  ", 1))
    assert p.extract_fields(p.parse_payload(twice)).count() == 2
    assert p.pivot_fields(p.flatten_fields(p.explode_fields(p.parse_payload(twice)))).count() == 2
    other = twice.withColumn("BATCH_ID", F.lit("C"))
    assert p.extract_fields(p.parse_payload(twice.union(other))).count() == 4
    assert spaced


def test_round_trip(spark, sf):
    flat = flat_rows(spark, sf)
    back = p.silver(bronze_rows(spark, sf))
    assert rows(back) == rows(p.clean_strings(flat).distinct())


def test_pivot_twins(spark, sf):
    parsed = p.parse_payload(bronze_rows(spark, sf))
    assert rows(p.extract_fields(parsed)) == rows(
        p.pivot_fields(p.flatten_fields(p.explode_fields(parsed)))
    )


def test_text_is_parsed_once_and_not_shuffled(spark, sf, tmp_path):
    bronze_rows(spark, sf).write.parquet(str(tmp_path / "b"))
    stored = spark.read.parquet(str(tmp_path / "b"))
    parsed = p.parse_payload(stored)
    pivoted = p.pivot_fields(p.flatten_fields(p.explode_fields(parsed)))
    for df in (p.extract_fields(parsed), pivoted):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("from_json") == 1
        exchange = [line for line in plan.splitlines() if "Exchange" in line]
        assert len(exchange) == 1 and "PROVIDER_JSON" not in exchange[0]
        generate = [line for line in plan.splitlines() if "Generate" in line]
        assert len(generate) == 1 and "PROVIDER_JSON" not in generate[0]


def test_null_report_of_empty_frame(spark, sf):
    empty = provider_src(spark, sf).filter("false")
    assert set(p.null_report(empty).first().asDict().values()) == {None}


def test_clean_strings_leaves_other_types(spark):
    df = spark.createDataFrame([(" a ", 1, ["  x "])], "s string, n int, a array<string>")
    assert tuple(p.clean_strings(df).first()) == ("a", 1, ["  x "])


def test_flatten_without_results(spark, folder):
    responses = files.read_responses(spark, str(folder))
    assert responses.count() == 3 and explode_results(responses).count() == 2
    assert set(ATTRIBUTES + AUDIT) == set(SILVER_COLUMNS)
