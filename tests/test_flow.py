"""Gates, exports, landing loads, upserts and the whole job: each run twice."""

import os
from datetime import date, datetime

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from goldrec.operators import gates
from goldrec.operators.survive import Survivorship, golden_record
from goldrec.plans import marts, pipeline, reports
from goldrec.plans.provider_view import provider_src
from goldrec.schemas import BRONZE, EXPORT_LOG, GOLD, GOLD_COLUMNS
from goldrec.sources import export, files, history, tables
from goldrec.streaming import cdc, ingest
from goldrec.streaming.ledger import FileLedger, drain, has_files
from goldrec.streaming.keyed import KeyedTable, merge_into, newest_per_key, upsert
from catalog.queries import bronze_rows
from tests.conftest import rows


def gold_rows(spark, *specs):
    """Golden rows from (id, batch, day, city)."""
    data = []
    for pid, batch, day, city in specs:
        row = dict.fromkeys(GOLD_COLUMNS)
        row.update(ProviderID=pid, BATCH_ID=batch, City=city, LOAD_TIMESTAMP=datetime(2026, 1, day),
                   LOAD_DATE=date(2026, 1, day), BUSINESS_RULE_STATUS="PASS")
        data.append(tuple(row[c] for c in GOLD_COLUMNS))
    return spark.createDataFrame(data, GOLD)


@pytest.fixture(scope="module")
def gold(spark, sf):
    cached = golden_record(provider_src(spark, sf), Survivorship(tie="SRC_KEY")).persist()
    yield cached
    cached.unpersist()


# Gates


def test_known_id_blocks_only_its_own_batch(spark):
    held = gold_rows(spark, ("1", "OLD", 1, "a"))
    fresh = gold_rows(spark, ("1", "B1", 2, "b"), ("2", "B1", 2, "b"), ("3", "B2", 2, "b"), (None, "B2", 2, "b"))
    assert rows(gates.gate_providers(fresh, held), "ProviderID", "BATCH_ID") == [("3", "B2"), (None, "B2")]
    assert rows(gates.gate_providers(fresh, held, "anti"), "ProviderID") == [("2",), ("3",), (None,)]
    assert gates.gate_providers(fresh, None).count() == gates.gate_providers(fresh, held, "upsert").count() == 4
    with pytest.raises(ValueError):
        gates.gate_providers(fresh, held, "other")


def test_null_batches_are_set_aside(spark):
    held = gold_rows(spark, ("1", None, 1, "a"), ("1", "OLD", 1, "a"))
    src = gold_rows(spark, ("1", None, 1, "a"), ("2", "OLD", 1, "a"), ("3", "NEW", 1, "a"))
    assert rows(gates.new_batches(src, held), "ProviderID") == [("3",)]
    assert gates.new_batches(src, None).count() == 2
    assert gates.unbatched(src).count() == 1


def test_batch_check(spark):
    rows_ = gold_rows(spark, ("1", "B", 1, "a"))
    assert gates.check_batch(rows_, "B") == 1
    for frame in (rows_, rows_.filter("false")):
        with pytest.raises(gates.BatchMismatch):
            gates.check_batch(frame, "C")


# Exports


def test_export_branches(spark, gold, tmp_path):
    out, log_path = str(tmp_path / "out"), str(tmp_path / "log")
    done = export.export_batch(gold, "BATCH_1999", out)
    empty = export.export_batch(gold, "BATCH_1900", out)
    assert done.status == "SUCCESS" and (empty.rows, empty.path) == (0, "N/A")
    assert spark.read.parquet(done.path).count() == done.rows
    export.log_export(export.log_rows(spark, [done, empty]), log_path)
    log = spark.read.schema(EXPORT_LOG).parquet(log_path)
    assert rows(log, "BATCH_ID", "ROW_COUNT", "STATUS", "ERROR_MESSAGE") == [
        ("BATCH_1900", 0, "SUCCESS", None), ("BATCH_1999", done.rows, "SUCCESS", None),
    ]
    again = export.export_batch(gold, "BATCH_1999", out, log)
    assert again.skipped and export.log_rows(spark, [again]).count() == 0


def test_failed_export_is_logged_and_retried(spark, gold, tmp_path):
    (tmp_path / "file").write_text("in the way")
    failed = export.export_batch(gold, "BATCH_1999", str(tmp_path / "file"))
    assert failed.status == "FAILED" and failed.error
    log = export.log_rows(spark, [failed])
    assert export.export_batch(gold, "BATCH_1999", str(tmp_path / "ok"), log).status == "SUCCESS"


def test_export_pending_covers_every_batch_once(spark, gold, tmp_path):
    first = export.export_pending(gold, str(tmp_path / "out")).persist()
    assert {r.BATCH_ID for r in first.collect()} == {r[0] for r in gates.batch_list(gold).collect()}
    assert first.agg(F.sum("ROW_COUNT")).first()[0] == gold.count()
    assert export.export_pending(gold, str(tmp_path / "out"), first).count() == 0
    files_ = spark.read.option("recursiveFileLookup", True).schema(GOLD).parquet(str(tmp_path / "out"))
    assert rows(files_) == rows(gold)


def test_export_log_names_the_real_folder(spark, tmp_path):
    odd = gold_rows(spark, ("1", "B 2024/01:05+1%", 1, "a"))
    [done] = export.export_pending(odd, str(tmp_path / "out")).collect()
    assert spark.read.schema(GOLD).parquet(done.S3_PATH).count() == done.ROW_COUNT == 1


# Tables and landing


def test_ensure_table_keeps_rows(spark, gold, tmp_path):
    tables.ensure_table(spark, "keep_me", GOLD, str(tmp_path / "t"))
    tables.append(gold.select(*reversed(GOLD_COLUMNS)), "keep_me")
    assert rows(tables.ensure_table(spark, "keep_me", GOLD, str(tmp_path / "t"))) == rows(gold)
    assert gates.batch_presence(spark, "keep_me", "BATCH_1999") > 0
    assert gates.batch_presence(spark, "no_such_table", "BATCH_1999") == 0


def test_conform(spark):
    df = spark.createDataFrame(
        [("1", "2026-01-01", 5), ("2", "bad", 6), (None, None, 7)],
        "PROVIDERID string, load_date string, X int",
    ).withColumn("Load_Timestamp", F.lit(datetime(2026, 1, 2, 3, 4, 5)).cast("timestamp"))
    got = tables.conform(df, GOLD)
    assert {r.LOAD_TIMESTAMP for r in got.collect()} == {datetime(2026, 1, 2, 3, 4, 5)}
    good = got.filter(F.size("FAILED_COLUMNS") == 0)
    assert rows(good, "ProviderID", "LOAD_DATE", "City") == [("1", date(2026, 1, 1), None), (None, None, None)]
    [bad] = got.filter(F.size("FAILED_COLUMNS") > 0).collect()
    assert bad.FAILED_COLUMNS == ["LOAD_DATE"] and '"bad"' in bad.ORIGINAL


def test_load_history(spark, gold, tmp_path):
    staged, landing = str(tmp_path / "s"), str(tmp_path / "l")
    gold.coalesce(1).write.parquet(staged)
    for _ in range(2):
        ingest.load_by_name(spark, staged, landing, str(tmp_path / "c"))
    assert ingest.read_landing(spark, landing).count() == gold.count()
    gold.limit(1).coalesce(1).write.mode("append").parquet(staged)
    loads = history.load_history(history.list_staged(spark, staged), ingest.loaded_files(spark, landing))
    assert sorted((r.ROWS or 0) for r in loads.collect()) == [0, gold.count()]
    old = ingest.loaded_files(spark, landing).withColumn("LOADED_AT", F.lit("2020-01-01").cast("timestamp"))
    assert history.load_history(history.list_staged(spark, staged), old).count() == 1


def test_a_backlog_takes_several_micro_batches(spark, gold, tmp_path):
    staged, landing = str(tmp_path / "s"), str(tmp_path / "l")
    gold.repartition(6).write.parquet(staged)
    assert ingest.load_by_name(spark, staged, landing, str(tmp_path / "c"), pace=20_000) > 1
    assert spark.read.schema(ingest.LANDING).parquet(landing).select("LOAD").distinct().count() > 1
    assert rows(ingest.read_landing(spark, landing)) == rows(gold)


def test_unreadable_files_are_listed_and_can_be_tried_again(spark, gold, tmp_path):
    staged, landing = tmp_path / "s", str(tmp_path / "l")
    gold.coalesce(1).write.parquet(str(staged / "good"))
    gold.limit(3).withColumn("City", F.lit(5)).write.parquet(str(staged / "other types"))
    (staged / "bad.parquet").write_text("not a table")
    for _ in range(2):
        ingest.load_by_name(spark, str(staged), landing, str(tmp_path / "c"))
    assert ingest.read_landing(spark, landing).count() == gold.count() + 3
    [bad] = ingest.loaded_files(spark, landing).filter("STATUS <> 'LOADED'").collect()
    assert bad.FILE_PATH.endswith("bad.parquet") and bad.REASON and bad.ROWS == 0
    (staged / "bad.parquet").unlink()
    gold.limit(2).coalesce(1).write.parquet(str(staged / "bad.parquet"))
    ingest.load_paths(spark, [bad.FILE_PATH], landing, "again")
    assert ingest.read_landing(spark, landing).count() == gold.count() + 5


def test_an_unwritable_landing_raises_and_loses_nothing(spark, gold, tmp_path):
    staged, landing, checkpoint = str(tmp_path / "s"), tmp_path / "l", str(tmp_path / "c")
    gold.repartition(4).write.parquet(staged)
    landing.write_text("in the way")
    with pytest.raises(Exception):
        ingest.load_by_name(spark, staged, str(landing), checkpoint)
    landing.unlink()
    assert ingest.load_by_name(spark, staged, str(landing), checkpoint) == 1
    assert rows(ingest.read_landing(spark, str(landing))) == rows(gold)
    assert ingest.loaded_files(spark, str(landing)).filter("STATUS <> 'LOADED'").count() == 0


def test_a_replay_lands_equal_rows(spark, gold, tmp_path):
    """A load that had groups and a broken file, then the same load with other files, then the first again."""
    staged, landing = tmp_path / "s", str(tmp_path / "l")
    gold.repartition(2).write.parquet(str(staged / "good"))
    gold.limit(3).withColumn("City", F.lit(5)).coalesce(1).write.parquet(str(staged / "other"))
    (staged / "bad.parquet").write_bytes(b"PAR1 but nothing more PAR1")
    paths = [r.FILE_PATH for r in history.list_staged(spark, str(staged)).collect()]
    for some in (paths, paths[:1], paths, paths):
        ingest.load_paths(spark, some, landing, "x")
    assert ingest.read_landing(spark, landing).count() == gold.count() + 3
    assert rows(ingest.loaded_files(spark, landing).filter("STATUS = 'UNREADABLE'"), "REASON") == [("BROKEN_FOOTER",)]


def test_files_of_any_age_and_changed_ones(spark, gold, tmp_path):
    staged, landing, checkpoint = tmp_path / "s", str(tmp_path / "l"), str(tmp_path / "c")
    gold.coalesce(1).write.parquet(str(staged / "a"))
    ingest.load_by_name(spark, str(staged), landing, checkpoint)
    gold.limit(5).coalesce(1).write.parquet(str(staged / "b"))
    [old] = (staged / "b").glob("*.parquet")
    old.rename(staged / "b" / "odd [1] {x} +%.parquet")
    os.utime(staged / "b" / "odd [1] {x} +%.parquet", (0, 0))
    assert ingest.load_by_name(spark, str(staged), landing, checkpoint) == 1
    assert ingest.read_landing(spark, landing).count() == gold.count() + 5
    [known] = (staged / "a").glob("*.parquet")
    gold.limit(2).coalesce(1).write.parquet(str(tmp_path / "again"))
    [other] = (tmp_path / "again").glob("*.parquet")
    other.replace(known)
    for expected in (1, 0):  # told once
        assert ingest.load_by_name(spark, str(staged), landing, checkpoint) == expected
    assert ingest.read_landing(spark, landing).count() == gold.count() + 5
    ledger = FileLedger(spark, f"{checkpoint}/files")
    assert ledger.changed().count() == ingest.loaded_files(spark, landing).filter("STATUS = 'CHANGED'").count() == 1


def test_a_listing_is_taken_page_by_page(spark, gold, tmp_path):
    """Files of one time and of others, two at a time; a step that fails is made again under its number."""
    source = tmp_path / "s"
    gold.repartition(5).write.parquet(str(source))
    for n, f in enumerate(sorted(source.glob("*.parquet"))):
        os.utime(f, (1_000 + n // 3, 1_000 + n // 3))
    ledger, taken = FileLedger(spark, str(tmp_path / "c")), {}

    def take(files, epoch):
        if epoch == 2 and 2 not in taken:
            taken[2] = None
            raise OSError("no room")
        taken[epoch] = [f.path for f in files]

    args = (spark, str(source), ledger, take, "*.parquet")
    with pytest.raises(OSError):
        drain(*args, page=2)
    assert drain(*args, page=2) == 1 and drain(*args, page=2) == 0
    assert [len(taken[e]) for e in sorted(taken)] == [2, 2, 1] and len({f for fs in taken.values() for f in fs}) == 5
    assert not has_files(spark, str(source), ledger, "*.parquet")


def test_many_files_cost_one_probe_and_one_load(spark, gold, tmp_path):
    staged, landing = tmp_path / "s", str(tmp_path / "l")
    gold.repartition(60).write.parquet(str(staged))
    for n in range(1, 20):
        (staged / f"bad{n:02d}.parquet").write_text("x" * n)
    assert ingest.load_by_name(spark, str(staged), landing, str(tmp_path / "c")) == 1
    listed = ingest.loaded_files(spark, landing)
    assert rows(ingest.read_landing(spark, landing)) == rows(gold)
    assert rows(listed.filter("STATUS <> 'LOADED'").groupBy("REASON").count()) == [("NOT_PARQUET", 19)]
    assert len(list((tmp_path / "l").glob("LOAD=*"))) == 1


def test_broken_pages_leave_only_their_own_file_out(spark, gold, tmp_path):
    staged, landing = tmp_path / "s", str(tmp_path / "l")
    gold.repartition(3).write.parquet(str(staged))
    broken = sorted(staged.glob("*.parquet"))[1]
    data = bytearray(broken.read_bytes())
    data[4:400] = bytes(396)
    broken.write_bytes(data)
    (staged / f".{broken.name}.crc").unlink()  # else the local file system itself refuses the file
    lost = pq.read_metadata(broken).num_rows
    assert ingest.load_by_name(spark, str(staged), landing, str(tmp_path / "c")) == 1
    assert ingest.read_landing(spark, landing).count() == gold.count() - lost
    assert rows(ingest.loaded_files(spark, landing).filter("STATUS <> 'LOADED'"), "REASON") == [("BROKEN_PAGES",)]


def test_columns_that_differ_make_groups():
    a, b, c = '[["X", "int64"], ["Y", "string"]]', '[["X", "int64"], ["Z", "string"]]', '[["x", "int64"]]'
    assert ingest.readable_together([("1", a), ("2", b), ("3", c), ("4", a)]) == [["1", "2", "4"], ["3"]]


# Keyed table


def test_merge_cases(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"))
    assert table.read().count() == 0
    start = gold_rows(spark, ("1", "A", 1, "old"), ("2", "A", 1, "keep"), (None, "A", 1, "none"), ("4", "A", 1, "x"), ("4", "A", 1, "y"))
    assert table.load(start) == 5
    change = gold_rows(
        spark, ("1", "B", 2, "older"), ("1", "B", 3, "new"), ("3", "B", 2, "add"), (None, "B", 2, "more")
    )
    want = [("1", "new"), ("2", "keep"), ("3", "add"), ("4", "x"), ("4", "y"), (None, "more"), (None, "none")]
    for _ in range(2):  # a replay
        assert table.merge(change, 1) == 3
        assert rows(table.read(), "ProviderID", "City") == want
    assert table.merge(change.filter("false"), 2) == 0  # empty source
    assert rows(table.read(), "ProviderID", "City") == want
    assert rows(upsert(start, change, "ProviderID"), "ProviderID", "City") == want
    assert rows(table.read(until=0), "ProviderID", "City") == rows(start, "ProviderID", "City")
    smaller = table.compact(str(tmp_path / "smaller"))
    assert rows(smaller.read(), "ProviderID", "City") == want
    assert smaller.merge(gold_rows(spark, ("2", "C", 4, "last")), 3) == 1
    assert rows(smaller.read().filter("ProviderID = '2'"), "City") == [("last",)]


def test_a_commit_writes_only_its_own_rows(spark, gold, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"))
    table.load(gold)
    before = sorted(p.name for p in (tmp_path / "t" / "COMMIT=0").iterdir())
    assert table.merge(gold_rows(spark, ("77", "B", 2, "new")), 1) == 1
    assert sorted(p.name for p in (tmp_path / "t" / "COMMIT=0").iterdir()) == before
    assert table.changes().filter("COMMIT = 1").count() == 1


def test_many_commits_settle_and_reading_stays_cheap(spark, gold, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"))
    assert not table.settle() and table.read().count() == 0 and not (tmp_path / "t").exists()
    table.load(gold)
    assert table.settle() and not table.settle()
    want = {r.ProviderID: r.City for r in gold.filter("ProviderID IS NOT NULL").collect()}
    for n in range(1, 9):
        change = gold_rows(spark, *[(str(k), "B", 2, f"c{n}") for k in range(n * 30, n * 30 + 60)], (None, "B", 2, "none"))
        table.merge(change, n)
        want.update({str(k): f"c{n}" for k in range(n * 30, n * 30 + 60)})
        table.settle()
    assert 1 < len(table.bases()) < 9
    before = sorted(str(p) for p in (tmp_path / "t").rglob("*"))
    read = table.read()
    assert {r.ProviderID: r.City for r in read.filter("ProviderID IS NOT NULL").collect()} == want
    assert read.filter("ProviderID IS NULL").count() == gold.filter("ProviderID IS NULL").count() + 8
    newer = [c for c in table.commits() if c > max(table.bases())]
    assert not any("COMMIT=" in f and int(f.split("COMMIT=")[1].split("/")[0]) not in newer for f in read.inputFiles())
    assert sorted(str(p) for p in (tmp_path / "t").rglob("*")) == before  # reading writes nothing
    table.settle(share=0)
    table.merge(change, 9)
    again = KeyedTable(spark, str(tmp_path / "t"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = again.read()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    base = plan[plan.index("LeftAnti"):plan.index("Bucketed: true")]
    assert "FileScan" in base and "Exchange" not in base  # the settled rows are not shuffled


def test_a_base_keeps_repeated_ids_of_a_first_load(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"))
    table.load(gold_rows(spark, ("4", "A", 1, "x"), ("4", "A", 1, "y"), (None, "A", 1, "n"), (None, "A", 1, "n"), ("5", "A", 1, "z")))
    table.settle(buckets=3)
    assert rows(table.read(), "ProviderID", "City") == [("4", "x"), ("4", "y"), ("5", "z"), (None, "n"), (None, "n")]
    table.merge(gold_rows(spark, ("4", "B", 2, "new")), 1)
    for _ in range(2):
        assert rows(table.read(), "ProviderID", "City") == [("4", "new"), ("5", "z"), (None, "n"), (None, "n")]
        table.settle(share=0)
    assert rows(table.read(until=0), "ProviderID", "City")[:2] == [("4", "x"), ("4", "y")]


def test_merge_into_needs_a_format_that_can(spark, gold, tmp_path):
    tables.ensure_table(spark, "plain", GOLD, str(tmp_path / "t"))
    with pytest.raises(Exception, match="MERGE|merge"):
        merge_into(gold, "plain", "ProviderID")


def test_incremental_marts_equal_a_rebuild(spark, gold, tmp_path):
    """Providers move between states, change, repeat and appear; a commit is made again."""
    table = KeyedTable(spark, str(tmp_path / "t"))
    kept = marts.IncrementalMarts(table, str(tmp_path / "cells"))
    table.load(gold)
    assert kept.refresh() == [0]
    for n in (1, 2):
        moved = gold.filter(F.pmod(F.xxhash64("ProviderID"), F.lit(4)) == n).withColumn("State", F.lit("NEW")).withColumn("TaxonomyCode", F.lit(f"T{n}"))
        table.merge(moved, n)
        table.settle(share=0)
        assert kept.refresh() == [n] and kept.refresh() == []
        table.merge(moved, n)
    for name, mart in marts.MARTS.items():
        assert rows(kept.read(name)) == rows(mart(table.read())), name
    assert kept.read("mart_provider_state").filter("State = 'NEW'").first().TOTAL_SPECIALIZATIONS == 2


def test_newest_per_key_is_total(spark):
    df = gold_rows(spark, ("1", "A", 1, "x"), ("1", "A", 1, "y"), (None, "A", 1, "x"), (None, "A", 1, "x"))
    once = rows(newest_per_key(df, "ProviderID"))
    assert len(once) == 3 and once == rows(newest_per_key(df.repartition(3), "ProviderID"))


def test_upsert_stream(spark, gold, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"))
    staged, landing, runs = (str(tmp_path / n) for n in ("staged", "landing", "runs"))

    def step():
        ingest.load_by_name(spark, staged, landing, str(tmp_path / "c1"), GOLD)
        cdc.run_upsert(spark, landing, table, str(tmp_path / "c2"), runs)

    gold.write.parquet(f"{staged}/a")
    step()
    step()
    assert rows(table.read()) == rows(gold)
    gold_rows(spark, ("1", "B", 2, "new")).write.parquet(f"{staged}/b")
    step()
    assert table.read().filter("City = 'new'").count() == 1
    assert [r.SOURCE_ROWS for r in cdc.run_history(spark, runs).collect()] == [1, gold.count()]
    assert cdc.has_data(gold, gold).first().HAS_DATA is False
    assert cdc.has_data(gold, None).first().HAS_DATA is True


def test_the_gate_reads_no_data_file(spark, gold, tmp_path):
    staged, landing, checkpoint = (str(tmp_path / n) for n in ("staged", "l +% x", "c2"))
    table, runs = KeyedTable(spark, str(tmp_path / "t")), str(tmp_path / "runs")
    gold.write.parquet(f"{staged}/a")
    ingest.load_by_name(spark, staged, landing, str(tmp_path / "c1"), GOLD)
    assert cdc.triggered_upsert(spark, landing, table, checkpoint, runs)
    assert not cdc.triggered_upsert(spark, landing, table, checkpoint, runs)
    gold.limit(3).write.parquet(f"{staged}/b")
    ingest.load_by_name(spark, staged, landing, str(tmp_path / "c1"), GOLD)
    [new] = [f for f in (tmp_path / "l +% x").rglob("*.parquet") if "LOAD=000000000001" in str(f)]
    held = new.read_bytes()
    new.write_bytes(b"x" * len(held))  # what can't be read can still be pending
    (new.parent / f".{new.name}.crc").unlink()
    assert cdc.has_pending(spark, landing, checkpoint)
    new.write_bytes(held)
    assert cdc.triggered_upsert(spark, landing, table, checkpoint, runs)
    assert [r.SOURCE_ROWS for r in cdc.run_history(spark, runs).collect()] == [3, gold.count()]


def test_upsert_at_an_interval_until_stopped(spark, gold, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"))
    args = (spark, str(tmp_path / "landing"), table, str(tmp_path / "c2"), str(tmp_path / "runs"))
    gold.write.parquet(str(tmp_path / "staged"))
    ingest.load_by_name(spark, str(tmp_path / "staged"), str(tmp_path / "landing"), str(tmp_path / "c1"), GOLD)
    query = cdc.run_upsert(*args, every="1 second")
    query.processAllAvailable()
    query.stop()  # suspended; the next run resumes from the checkpoint
    cdc.run_upsert(*args)
    assert rows(table.read()) == rows(gold)
    assert cdc.run_history(spark, str(tmp_path / "runs")).count() == 1


# Whole job


def test_pipeline_twice(spark, sf, tmp_path):
    layout = pipeline.Layout(str(tmp_path / "root"))
    processed = str(tmp_path / "processed")
    early = bronze_rows(spark, sf).filter("BATCH_ID <= 'BATCH_1997'")
    files.write_envelopes(early, f"{processed}/first")
    broken = early.limit(2).withColumn("PROVIDER_JSON", F.lit("{bad"))
    broken = broken.withColumn("BATCH_ID", F.when(F.monotonically_increasing_id() == 0, F.col("BATCH_ID")))
    files.write_envelopes(broken, f"{processed}/broken")
    models = pipeline.run_all(spark, layout, processed)
    assert rows(pipeline.read_layer(spark, layout.at("rejects"), BRONZE), "PROVIDER_JSON") == [("{bad",)]
    silver = pipeline.read_layer(spark, layout.at("silver"), pipeline.SILVER)
    held = pipeline.read_layer(spark, layout.at("gold"), GOLD)
    assert silver.count() == early.count()
    assert held.count() == silver.select("ProviderID").distinct().count()
    assert rows(models["dim_provider"]) == rows(held)
    counts = [df.count() for df in models.values()]

    models = pipeline.run_all(spark, layout, processed)  # nothing new
    assert pipeline.read_layer(spark, layout.at("unbatched"), BRONZE).count() == 1
    assert [df.count() for df in models.values()] == counts
    log = pipeline.read_layer(spark, layout.at("export_log"), EXPORT_LOG)
    assert rows(log, "BATCH_ID") == rows(gates.batch_list(held))

    late = bronze_rows(spark, sf).filter("BATCH_ID > 'BATCH_1997'")
    files.write_envelopes(late, f"{processed}/second")
    pipeline.run_all(spark, layout, processed)  # known ids hold these batches back
    verdicts = pipeline.read_layer(spark, layout.at("verdicts"), pipeline.VERDICTS)
    assert rows(verdicts.filter("VERDICT = 'blocked'"), "BATCH_ID") == rows(gates.batch_list(late))
    assert pipeline.read_layer(spark, layout.at("gold"), GOLD).count() == held.count()
    known = pipeline.known_ids(spark, layout)
    assert rows(known.read()) == rows(held.select("ProviderID").filter("ProviderID IS NOT NULL").distinct())
    assert known.bases()  # settled, so that the gate doesn't shuffle it
    unseen = pipeline.Layout(str(tmp_path / "unseen"), gate="anti")
    models = pipeline.run_all(spark, unseen, processed)
    dim = models["dim_provider"]
    assert dim.filter("ProviderID IS NOT NULL").groupBy("ProviderID").count().filter("count > 1").count() == 0
    everyone = provider_src(spark, sf).select("ProviderID").filter("ProviderID IS NOT NULL").distinct()
    assert dim.select("ProviderID").filter("ProviderID IS NOT NULL").count() == everyone.count()


def test_run_can_be_repeated_after_a_crash_in_any_step(spark, sf, tmp_path, monkeypatch):
    """Each step fails once after it has written; the next run gives the tables of an undisturbed one."""
    processed, drops = str(tmp_path / "processed"), bronze_rows(spark, sf)
    calm, shaken = (pipeline.Layout(str(tmp_path / n), gate="upsert") for n in ("calm", "shaken"))

    def tables_of(layout):
        master = pipeline.keyed_table(spark, layout).read()
        return [rows(df) for df in (pipeline.read_layer(spark, layout.at("gold"), GOLD), ingest.read_landing(spark, layout.at("landing")), master)]

    places = [
        ("goldrec.plans.pipeline.write_epoch", 3), ("goldrec.plans.pipeline.write_epoch", 4), ("goldrec.plans.pipeline.log_export", 1),
        ("goldrec.streaming.ingest.load_files", 1), ("goldrec.streaming.keyed.KeyedTable.merge", 1), ("goldrec.plans.pipeline.refresh_models", 1),
    ]
    for n, (name, nth) in enumerate(places):
        files.write_envelopes(drops.filter(F.pmod(F.xxhash64("PROVIDER_JSON"), F.lit(len(places))) == n), f"{processed}/{n}")
        module, _, attribute = name.rpartition(".")
        owner = KeyedTable if module.endswith("KeyedTable") else __import__(module, fromlist=["x"])
        real, calls = getattr(owner, attribute), []

        def failing(*args, _real=real, _calls=calls, _nth=nth, **kwargs):
            result = _real(*args, **kwargs)
            _calls.append(1)
            if len(_calls) == _nth:
                raise RuntimeError("crash")
            return result

        with monkeypatch.context() as m:
            m.setattr(owner, attribute, failing)
            with pytest.raises(Exception):
                pipeline.run_all(spark, shaken, processed)
        pipeline.run_all(spark, shaken, processed)
        pipeline.run_all(spark, calm, processed)
    assert tables_of(shaken) == tables_of(calm)
    assert pipeline.keyed_table(spark, shaken).read().filter("ProviderID IS NULL").count() > 1


# Models


def test_mart_totals_add_up(gold):
    dim = marts.dimension(gold)
    for build in marts.MARTS.values():
        assert build(dim).agg(F.sum("TOTAL_PROVIDERS")).first()[0] == dim.count()
    summary = marts.mart_summary(dim)
    assert summary.filter("BUSINESS_RULE_PASS + BUSINESS_RULE_FAIL <> TOTAL_PROVIDERS").count() == 0


def test_reports_are_ordered(gold):
    counts = [r.TOTAL_PROVIDERS for r in reports.ANALYST["q07_city"](gold).collect()]
    assert counts == sorted(counts, reverse=True)
    stamps = [r.LOAD_TIMESTAMP for r in reports.ANALYST["q14_recent"](gold).collect()]
    assert stamps == sorted(stamps, reverse=True)
    assert "TakeOrderedAndProject" in reports.newest(gold)._jdf.queryExecution().executedPlan().toString()


def test_share_is_hundred_percent(gold):
    assert marts.share(gold, "Gender").agg(F.sum("PERCENT")).first()[0] == pytest.approx(100)
    assert marts.share(gold.filter("false"), "Gender").count() == 0
