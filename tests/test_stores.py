from __future__ import annotations

import json
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import relist.plans.archive as archive_plan
from relist.operators import archiving
from relist.plans.archive import run_archive
from relist.plans.full_run import full_run, run_stages
from relist.runtime import shared_dir
from relist.schemas import CURSOR_SCHEMA, SITE_RUN_SCHEMA
from relist.sources import feed, state, tables
from relist.streaming.ingest import ingest, load_cursors, load_faults, persist_batch
from tests.builders import rows_of


def ntz(value: datetime):
    return F.lit(value).cast("timestamp_ntz")


# --- archive -----------------------------------------------------------------------------------

NOW = datetime(2026, 5, 3, 12)
RAW_DDL = "raw_id string, ingested_at timestamp_ntz, payload string"


def raw_rows(spark, *rows):
    return spark.createDataFrame([(i, t, json.dumps({"value": i})) for i, t in rows], RAW_DDL)


def archive(spark, raw, out, **options):
    return run_archive(spark, raw, str(out), ntz(NOW), 1, options.pop("batch_rows", 5000), "raw", **options)


JANUARY, FEBRUARY, FRESH = datetime(2026, 1, 10), datetime(2026, 2, 3), datetime(2026, 5, 3, 11)


def test_archive_keeps_fresh_rows(spark, tmp_path):
    run = archive(spark, raw_rows(spark, ("a", JANUARY), ("b", JANUARY), ("c", FRESH)), tmp_path, run_id="r")
    entry = run.ledger.first()
    assert (entry["status"], entry["documents_count"], entry["archived_at"]) == ("success", 2, NOW)
    assert entry["s3_path"] == "raw/2026/01/part-r-0-202601.jsonl.gz"
    assert rows_of(run.remaining, "raw_id") == {("c",)}
    files = [p for p in Path(tmp_path).rglob("*.gz")]
    assert len(files) == 1 and "year=2026/month=1" in str(files[0])


def test_archive_splits_months_and_chunks(spark, tmp_path):
    rows = raw_rows(spark, ("a", JANUARY), ("b", JANUARY), ("c", FEBRUARY))
    run = archive(spark, rows, tmp_path, run_id="r")
    assert sorted(r["documents_count"] for r in run.ledger.collect()) == [1, 2]
    small = archive(spark, rows, tmp_path / "small", run_id="r", batch_rows=2)
    assert {(r["id"], r["documents_count"]) for r in small.ledger.collect()} == {("r-0-202601", 2), ("r-1-202602", 1)}
    assert state.archive_high_water_mark(run.ledger).first()[0] == FEBRUARY


def test_archive_replay_adds_objects(spark, tmp_path):
    """The same ad delivered again is another raw row, archived into an object of its own."""
    first, second = (archive(spark, raw_rows(spark, (delivery, JANUARY)), tmp_path) for delivery in ("a", "a again"))
    assert second.ledger.count() == 2
    assert len({r["s3_path"] for r in second.ledger.collect()}) == 2
    assert first.remaining.count() == second.remaining.count() == 0


def test_failed_write_keeps_rows_and_marks_ledger(spark, tmp_path, monkeypatch):
    def broken(rows, path):
        raise OSError("no space")

    monkeypatch.setattr(archive_plan, "write_batches", broken)
    with pytest.raises(OSError, match="no space"):
        archive(spark, raw_rows(spark, ("a", JANUARY)), tmp_path, run_id="r")
    entry = state.ledger_current(spark.read.parquet(f"{tmp_path}/ledger")).first()
    assert (entry["status"], entry["documents_count"], entry["s3_path"], entry["archived_at"]) == ("failed", 0, None, None)


def test_unverified_batch_is_not_deleted(spark, tmp_path, monkeypatch):
    stored = archive_plan.read_batches
    monkeypatch.setattr(
        archive_plan, "read_batches", lambda s, p: stored(s, p).where(~F.col("value").contains('"raw_id":"c"'))
    )
    run = archive(spark, raw_rows(spark, ("a", JANUARY), ("c", FEBRUARY), ("d", FEBRUARY)), tmp_path, run_id="r")
    assert rows_of(run.ledger, "id", "status") == {("r-0-202601", "success"), ("r-0-202602", "failed")}
    assert rows_of(run.remaining, "raw_id") == {("c",), ("d",)}


def test_nothing_expired(spark, tmp_path):
    run = archive(spark, raw_rows(spark, ("c", FRESH)), tmp_path)
    assert run.ledger.count() == 0 and run.remaining.count() == 1


def test_cutoff_is_strict(spark):
    rows = raw_rows(spark, ("a", NOW - timedelta(days=1)), ("b", NOW - timedelta(days=1, microseconds=1)))
    assert rows_of(archiving.expired(rows, archiving.cutoff(ntz(NOW), 1)), "raw_id") == {("b",)}


def test_row_numbers_survive_one_shared_time(spark):
    rows = spark.range(1000).select(F.format_string("%04d", "id").alias("raw_id"), ntz(JANUARY).alias("ingested_at"))
    numbered = archiving.number_rows(rows.repartition(7), "ingested_at", "raw_id")
    assert {(int(r["raw_id"]), r["row_index"]) for r in numbered.collect()} == {(i, i) for i in range(1000)}


# --- cursors -----------------------------------------------------------------------------------

T0 = datetime(2026, 1, 1)
T = [T0 + timedelta(seconds=5 * i) for i in range(4)]


def test_max_checked_rejects_unreadable_times(spark):
    ads = spark.createDataFrame([("s", "2026-01-01 00:00:05"), ("s", "2026-01-01 00:00:10")], "site string, checked string")
    assert feed.max_checked(ads, F.col("checked")).first()["ts"] == T[2]
    with pytest.raises(Exception, match="without a valid 'checked'"):
        feed.max_checked(ads.withColumn("checked", F.lit("later")), F.col("checked")).collect()


def test_backfill_progress(spark):
    stored = spark.createDataFrame([], "site string, next_from timestamp_ntz, reset_completed boolean, updated_at timestamp_ntz")
    seen = spark.createDataFrame([("s", None, None)], "site string, next_from timestamp_ntz, reset_completed boolean")
    row = state.advance_backfill(stored, seen, ntz(NOW)).first()
    assert (row["next_from"], row["reset_completed"], row["updated_at"]) == (datetime(2024, 7, 10), False, NOW)


# --- feed and ingestion ------------------------------------------------------------------------


def test_feed_shapes(spark):
    pages = spark.createDataFrame([('[{"a":1},"x",[2],null,{}]',), ('{"ads":[{"a":2}],"n":1}',), ("[]",)], "body string")
    ads = feed.flatten_pages(pages).select(F.to_json("payload").alias("p"), "position")
    assert rows_of(ads, "p", "position") == {('{"a":1}', 0), ("{}", 4), ('{"a":2}', 0)}
    for bad in ('{"items":[]}', "5", "oops", '{"ads":{"a":1}}'):
        with pytest.raises(Exception, match="feed response must be"):
            feed.flatten_pages(spark.createDataFrame([(bad,)], "body string")).collect()


def test_whole_files_are_pages(spark, tmp_path):
    (tmp_path / "page.json").write_text('[\n {"a": 1},\n {"a": 2}\n]')
    assert feed.flatten_pages(feed.read_pages(spark, str(tmp_path))).count() == 2


def ad(unique, checked, **fields):
    return {"unique_id": unique, "checked": checked, "added": "2026-01-01", "price": "10"} | fields


def drop(landing, name, ads, site="drom"):
    folder = Path(landing) / f"site={site}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(json.dumps(ads) + "\n")


def run_ingest(spark, tmp_path):
    ingest(spark, f"{tmp_path}/landing", f"{tmp_path}/out", ntz(NOW)).awaitTermination()


def test_ingestion_overwrites_by_key_and_keeps_raw(spark, tmp_path):
    landing, out = f"{tmp_path}/landing", f"{tmp_path}/out"
    drop(landing, "1.json", [ad("1", "2026-01-01 00:00:05"), ad("2", "2026-01-01 00:00:05"), ad("1", "2026-01-01 00:00:05", price="11")])
    run_ingest(spark, tmp_path)
    drop(landing, "2.json", [ad("1", "2026-01-01 00:00:10", price="12")])
    run_ingest(spark, tmp_path)
    run_ingest(spark, tmp_path)
    assert spark.read.parquet(f"{out}/raw").count() == 4
    assert rows_of(tables.read_listings(spark, f"{out}/listings"), "doc_id", "latest_price") == {("[drom]1", 12.0), ("[drom]2", 10.0)}
    assert rows_of(load_cursors(spark, out), "site", "ts") == {("drom", T[2])}


def test_replayed_batch_leaves_no_second_copy(spark, tmp_path):
    out = str(tmp_path)
    pages = spark.createDataFrame([("drom", json.dumps([ad("1", "2026-01-01 00:00:05")]))], "site string, body string")
    for _ in range(2):
        persist_batch(pages, 0, out, ntz(NOW))
    assert spark.read.parquet(f"{out}/raw").count() == 1
    assert tables.read_listings(spark, f"{out}/listings").count() == 1


def page(site, *ads):
    return (site, json.dumps(list(ads)))


def persist(spark, out, batch_id, *pages, load_till=None):
    persist_batch(spark.createDataFrame(list(pages), "site string, body string"), batch_id, out, ntz(NOW), load_till=None if load_till is None else ntz(load_till))


def site_runs(spark, out, version):
    return {r["site"]: r for r in state.read_version(spark, f"{out}/site_runs", version, SITE_RUN_SCHEMA).collect()}


def test_faults_stop_their_site_alone(spark, tmp_path):
    out = str(tmp_path)
    sites = ("drom", "avto", "auto")
    persist(spark, out, 0, *(page(site, ad("1", "2026-01-01 00:00:05")) for site in sites))
    later = [ad("1", "2026-01-01 00:00:10", price="11"), ad("3", "2026-01-01 00:00:10")]
    faults = [page("drom", ad("2", "never")), ("avto", "no json"), ("avto", '{"ads": 5}'), ("none", None)]
    persist(spark, out, 1, *(page(site, *later) for site in sites), *faults)
    assert rows_of(load_cursors(spark, out), "site", "ts") == {("drom", T[1]), ("avto", T[1]), ("auto", T[2])}
    runs = site_runs(spark, out, 1)
    assert {site: (r["status"], r["pages"], r["ads"], r["faults"]) for site, r in runs.items()} == {
        "drom": ("failed", 2, 3, 1), "avto": ("failed", 3, 2, 2), "auto": ("ok", 1, 2, 0), "none": ("failed", 1, 0, 1),
    }
    assert runs["drom"]["error"] == feed.UNREADABLE and runs["avto"]["error"] == feed.BAD_PAGE
    found = load_faults(spark, out, 1)
    assert rows_of(found.where("site = 'avto'"), "content") == {("no json",), ('{"ads": 5}',)}
    assert found.count() == 4
    # what the failing sites delivered besides is kept, and a later sound batch moves them on
    listed = rows_of(tables.read_listings(spark, f"{out}/listings"), "doc_id", "latest_price")
    assert {(f"[{site}]{n}", price) for site in sites for n, price in ((1, 11.0), (3, 10.0))} | {("[drom]2", 10.0)} == listed
    persist(spark, out, 2, page("drom", ad("4", "2026-01-01 00:00:15")))
    assert ("drom", T[3]) in rows_of(load_cursors(spark, out), "site", "ts")


def test_a_site_at_the_bound_waits(spark, tmp_path):
    out = str(tmp_path)
    persist(spark, out, 0, page("drom", ad("1", "2026-01-01 00:00:10")), page("avto", ad("1", "2026-01-01 00:00:05")))
    persist(spark, out, 1, page("drom", ad("2", "2026-01-01 00:00:15")), page("avto", ad("2", "2026-01-01 00:00:15")), load_till=T[2])
    assert rows_of(load_cursors(spark, out), "site", "ts") == {("drom", T[2]), ("avto", T[3])}  # the last batch may pass the bound
    assert {site: r["status"] for site, r in site_runs(spark, out, 1).items()} == {"drom": "waiting", "avto": "ok"}
    persist(spark, out, 2, page("none"), load_till=T[2])
    persist(spark, out, 3, page("none"))
    assert rows_of(load_cursors(spark, out), "site", "ts") == {("drom", T[3]), ("avto", T[3])}
    assert rows_of(tables.read_listings(spark, f"{out}/listings"), "doc_id") == {(f"[{site}]{n}",) for site in ("drom", "avto") for n in (1, 2)}


def test_rows_keep_their_ids_in_a_replay_and_equal_pages_stay_apart(spark, tmp_path):
    out = str(tmp_path)
    pages = [page("drom", ad("1", "2026-01-01 00:00:05"), ad("1", "2026-01-01 00:00:05", price="12"))] * 2 + [page("drom")]
    ids = []
    for _ in range(2):
        persist(spark, out, 0, *pages)
        ids.append(rows_of(feed.read_raw(spark, f"{out}/raw"), "raw_id"))
    assert ids[0] == ids[1] and len(ids[0]) == 4
    assert rows_of(tables.read_listings(spark, f"{out}/listings"), "latest_price") == {(12.0,)}


def test_empty_landing_folder(spark, tmp_path):
    for landing in (tmp_path / "missing", tmp_path / "empty"):
        if landing.name == "empty":
            landing.mkdir()
        report = full_run(spark, str(landing), f"{tmp_path}/out-{landing.name}", 1, ntz(NOW))
        assert (report.done, report.failed) == (["ingest", "match", "archive"], None), report.error


def test_site_named_by_digits_stays_text(spark, tmp_path):
    out = str(tmp_path)
    pages = spark.createDataFrame([("007", json.dumps([ad("1", "2026-01-01 00:00:05")]))], "site string, body string")
    persist_batch(pages, 0, out, ntz(NOW))
    assert rows_of(tables.read_listings(spark, f"{out}/listings"), "doc_id") == {("[007]1",)}
    assert rows_of(load_cursors(spark, out), "site") == {("007",)}


def test_cursor_never_goes_back(spark, tmp_path):
    out = str(tmp_path)
    for batch, checked in enumerate(("2026-01-01 00:00:10", "2026-01-01 00:00:05")):
        pages = spark.createDataFrame([("drom", json.dumps([ad(str(batch), checked)]))], "site string, body string")
        persist_batch(pages, batch, out, ntz(NOW))
    assert rows_of(load_cursors(spark, out), "site", "ts") == {("drom", T[2])}
    assert tables.read_listings(spark, f"{out}/listings").count() == 2


def test_a_failed_first_batch_does_not_stop_later_ones(spark, tmp_path):
    out = str(tmp_path)
    (tmp_path / "cursors" / "version=0" / "_temporary").mkdir(parents=True)
    (tmp_path / "listings" / "version=0" / "_temporary").mkdir(parents=True)
    assert load_cursors(spark, out).count() == 0
    pages = spark.createDataFrame([("drom", json.dumps([ad("1", "2026-01-01 00:00:05")]))], "site string, body string")
    persist_batch(pages, 1, out, ntz(NOW))
    assert rows_of(load_cursors(spark, out), "site", "ts") == {("drom", T[1])}
    assert tables.read_listings(spark, f"{out}/listings").count() == 1


def test_state_reads_the_newest_finished_version(spark, tmp_path):
    path = str(tmp_path / "marks")
    for version, site in ((0, "a"), (1, "b"), (10, "c")):
        state.write_state(spark.createDataFrame([(site, T[0])], CURSOR_SCHEMA), path, version)
    (tmp_path / "marks" / "version=11").mkdir()
    assert rows_of(state.read_state(spark, path, CURSOR_SCHEMA), "site") == {("c",)}
    assert rows_of(state.read_state(spark, path, CURSOR_SCHEMA, below=10), "site") == {("b",)}
    assert state.read_state(spark, path, CURSOR_SCHEMA, below=0).count() == 0


def test_a_run_can_be_repeated_and_deletes_stay(spark, tmp_path):
    landing, out = f"{tmp_path}/landing", f"{tmp_path}/out"
    drop(landing, "1.json", [ad("1", "2026-01-01 00:00:05"), ad("2", "2026-01-01 00:00:05")])
    later = ntz(NOW + timedelta(days=400))
    for run_no, now in ((1, ntz(NOW)), (1, ntz(NOW)), (2, later), (2, later)):
        report = full_run(spark, landing, out, run_no, now)
        assert (report.done, report.failed) == (["ingest", "match", "archive"], None), report.error
    assert feed.live_raw(feed.read_raw(spark, f"{out}/raw"), archive_plan.archived_ids(spark, out)).count() == 0
    done = state.ledger_current(spark.read.parquet(f"{out}/ledger")).where("status = 'success'")
    assert done.agg(F.sum("documents_count")).first()[0] == 2


def test_rows_of_a_success_are_archived_once(spark, tmp_path):
    """What a run archived is deleted by its ledger alone, even if the run went no further."""
    old = spark.createDataFrame([(str(i), "s", NOW - timedelta(days=90), "{}", "{}") for i in range(5)], "raw_id string, source string, ingested_at timestamp_ntz, request_params string, payload string")
    first = run_archive(spark, old, str(tmp_path), ntz(NOW))
    assert first.archived.count() == 5
    second = run_archive(spark, old, str(tmp_path), ntz(NOW))
    assert second.archived.count() == 0 and second.remaining.count() == 0
    assert second.ledger.where("status = 'success'").agg(F.sum("documents_count")).first()[0] == 5


def test_upsert_protects_links_and_unknown_columns(spark):
    stored = spark.createDataFrame([("a", 1.0, "p", "s", True), ("b", 2.0, None, None, None)], "doc_id string, price double, predecessor_id string, successor_id string, is_duplicate boolean")
    incoming = spark.createDataFrame([("a", 5.0, "x", None), ("c", None, "y", "z")], "doc_id string, price double, predecessor_id string, successor_id string")
    out = tables.upsert_listings(stored, incoming, ntz(NOW))
    assert rows_of(out, "doc_id", "price", "predecessor_id", "successor_id", "is_duplicate", "updated_at") == {
        ("a", 5.0, "p", "s", True, NOW), ("b", 2.0, None, None, None, None), ("c", None, None, None, None, NOW),
    }


def test_copy_guards(spark, tmp_path):
    source = f"{tmp_path}/source"
    spark.range(3).write.parquet(source)
    for target, words in ((source, "same table"), (f"{tmp_path}/other", "must end with")):
        with pytest.raises(ValueError, match=words):
            tables.copy_table(spark, source, target)
    report = tables.copy_table(spark, source, f"{tmp_path}/other_test")
    assert rows_of(report, "name", "n", "copied") == {("source", 3, True), ("target", 3, True)}


# --- runs --------------------------------------------------------------------------------------


def test_stages_stop_at_the_first_failure():
    seen = []

    def fail():
        raise ValueError("no")

    report = run_stages({"ingest": lambda: seen.append(1), "match": fail, "archive": lambda: seen.append(3)})
    assert (seen, report.done, report.failed, report.error) == ([1], ["ingest"], "match", "no")


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
