import json

import pytest
from conftest import message, tuples
from pyspark.sql import functions as F

from chatloom.functions import year_frame
from chatloom.operators import audit, panel
from chatloom.plans import build_gold, build_silver, migrate_silver
from chatloom.schemas import GOLD, PANEL, PARTITIONS
from chatloom.sinks import (
    inspect,
    register_views,
    write_gold_csv,
    write_gold_parquet,
    write_legacy_csv,
    write_report,
    write_silver,
)
from chatloom.sources import (
    broken_files,
    list_raw_files,
    read_chat,
    read_gold,
    read_gold_csv,
    read_ledger,
    read_legacy_panel,
    read_silver,
    with_file_metadata,
)
from chatloom.streaming import ingest_stream

FILES = {
    "chan_2020_001_11": [message(["a", "b"], ["x"]), message(None)],
    "chan_2020_002_12": [message(["c"], author={"id": None}), message(["d"], author={"id": "abc"})],
    "chan_2020_003_13": "[]",
    "chan_2021_001_14": '[{"author": {"id',
    "chan_2021_002_15": [message([])],
    "chan_2021_3": [message(["old"])],
}


def scanned(spark, raw):
    return with_file_metadata(read_chat(spark, raw))


def status_of(spark, raw, before=None):
    broken = with_file_metadata(broken_files(read_chat(spark, raw)))
    return audit.file_status(list_raw_files(spark, raw), scanned(spark, raw), broken, before)


def test_file_status_and_lists(spark, land):
    raw = land(**FILES)
    status = status_of(spark, raw)
    assert tuples(status, "file_seq", "year", "message_rows", "emote_rows", "missing_user_rows", "status") == [
        (1, 2020, 2, 2, 0, "processed"),
        (1, 2021, 0, 0, 0, "failed"),
        (2, 2020, 2, 2, 1, "processed"),
        (2, 2021, 1, 0, 0, "no_emote"),
        (3, 2020, 0, 0, 0, "no_emote"),
        (3, 2021, 1, 1, 0, "processed"),
    ]
    assert tuples(audit.files_with_status(status), "vod_id", "listed_as") == [
        ("12", "missing_user"), ("13", "no_emote"), ("14", "failed"), ("15", "no_emote")
    ]
    report = audit.ingest_report(status, year_frame(spark, "2019,2020,2021"))
    assert [tuple(r) for r in report.collect()] == [
        (2019, 0, 0, 0, 0, 0, 0, 0), (2020, 3, 2, 1, 1, 0, 0, 1), (2021, 3, 1, 2, 1, 1, 0, 0)
    ]


def test_a_message_without_known_fields_fails_no_file(spark, land):
    raw = land(chan_2020_001_1=[message(["a"]), {"action_type": "x"}], chan_2020_002_2=[{"action_type": "x"}])
    assert tuples(status_of(spark, raw), "vod_id", "message_rows", "emote_rows", "status") == [
        ("1", 2, 1, "processed"), ("2", 1, 0, "no_emote")
    ]


def test_a_file_that_lands_after_the_scan_is_pending(spark, land):
    raw = land(chan_2020_001_1=[message(["a"])], chan_2020_002_2="[]")
    before, chat = list_raw_files(spark, raw), scanned(spark, raw)
    broken = with_file_metadata(broken_files(read_chat(spark, raw)))
    land(chan_2020_003_3=[message(["late"])])
    status = audit.file_status(list_raw_files(spark, raw), chat, broken, before)
    assert tuples(status, "vod_id", "status") == [("1", "processed"), ("2", "no_emote"), ("3", "pending")]
    report = audit.ingest_report(status, year_frame(spark, "2020")).first()
    assert (report.total_files, report.processed_files, report.unprocessed_files, report.pending_files) == (3, 1, 1, 1)


def test_silver_job(spark, land, tmp_path):
    raw = land(**FILES)
    silver = str(tmp_path / "silver")
    report, status = build_silver(spark, raw, str(tmp_path / "staged"), silver, "2020, 2022")
    assert [tuple(r)[:3] for r in report.collect()] == [(2020, 3, 2), (2022, 0, 0)]
    assert status.count() == 3
    assert tuples(read_silver(spark, silver), "vod_id", "k_emote_name") == [
        ("11", "a"), ("11", "b"), ("12", "c"), ("12", "d")
    ]


def test_silver_partitions_and_rerun(spark, land, tmp_path):
    silver = str(tmp_path / "silver")
    rows = panel.emote_panel(scanned(spark, land(**FILES)), keep=PARTITIONS)
    write_silver(rows, silver)
    before = tuples(read_silver(spark, silver))
    write_silver(rows, silver)
    assert tuples(read_silver(spark, silver)) == before and len(before) == 5
    write_silver(rows.filter("vod_id = '11'").withColumn("k_emote_name", F.lit("new")), silver)
    assert tuples(read_silver(spark, silver, "chan", "2020"), "vod_id", "k_emote_name") == [
        ("11", "new"), ("11", "new"), ("12", "c"), ("12", "d")
    ]
    assert tuples(read_silver(spark, silver, "chan", [2021]), "vod_id", "k_emote_name") == [(None, "old")]
    assert read_silver(spark, silver, "chan", "2030").count() == 0
    assert read_silver(spark, silver, years="none").count() == 0
    assert dict(read_silver(spark, silver).dtypes)["vod_id"] == "string"


def test_silver_by_year(spark, land, tmp_path):
    silver = str(tmp_path / "silver")
    rows = panel.emote_panel(scanned(spark, land(**FILES)), keep=PARTITIONS)
    write_silver(rows, silver, buckets=1)
    write_silver(rows.filter("year = 2021"), silver)
    names = [f.name for f in PANEL]
    assert tuples(read_silver(spark, silver), *names) == tuples(rows, *names)
    assert sorted(p.name for p in (tmp_path / "silver" / "channel=chan").iterdir()) == ["year=2020", "year=2021"]


def test_gold_job(spark, land, tmp_path):
    silver, gold, csv = (str(tmp_path / name) for name in ("silver", "gold", "csv"))
    write_silver(panel.emote_panel(scanned(spark, land(**FILES)), keep=PARTITIONS), silver)
    vods = spark.createDataFrame([(11, 'A, "B"')], "id long, title string")
    report = build_gold(spark, silver, vods, gold, "chan", "2019,2020", csv_path=csv, files=2)
    assert [tuple(r) for r in report.collect()] == [(2019, 0, 0, 0.0), (2020, 4, 2, 50.0)]
    rows = read_gold(spark, gold, "chan", "2020")
    assert set(rows.columns) == {f.name for f in GOLD} | set(PARTITIONS)
    assert tuples(rows, "vod_id", "match_title") == [("11", 'A, "B"')] * 2 + [("12", None)] * 2
    flat = spark.read.option("header", True).option("escape", '"').csv(csv)
    assert tuples(flat, "vod_id", "i_badge_names", "match_title") == [
        ("11", "x", 'A, "B"')] * 2 + [("12", None, None)] * 2
    assert build_gold(spark, silver, vods, str(tmp_path / "other"), "nobody", "2020").first()[1] == 0


def test_mixed_revisions_in_one_silver_table(spark, tmp_path):
    path = str(tmp_path / "mixed")
    new = spark.createDataFrame([(1, "a")], "i_user_id long, i_user_name string")
    old = spark.createDataFrame([(2, "b")], "i_user_id long, i_username string")
    new.write.parquet(path)
    old.write.mode("append").parquet(path)
    merged = spark.read.option("mergeSchema", True).parquet(path)
    assert tuples(panel.normalize_panel(merged), "i_user_id", "i_user_name") == [(1, "a"), (2, "b")]


def test_readers_map_old_column_names(spark, tmp_path):
    path = str(tmp_path / "table")
    for year, columns in ((2020, "i_user_name string, chat_message string"), (2021, "i_username string, message string")):
        rows = spark.createDataFrame([("ann", f"hi {year}")], columns)
        rows.withColumns({"channel": F.lit("chan"), "year": F.lit(year)}).write.mode("append").partitionBy(*PARTITIONS).parquet(path)
    want = [("ann", "hi 2020", 2020), ("ann", "hi 2021", 2021)]
    for read in (read_silver, read_gold):
        assert tuples(read(spark, path), "i_user_name", "chat_message", "year") == want


def test_old_files_without_vod_id_are_kept_and_replaced_one_by_one(spark, land, tmp_path):
    raw = land(chan_2020_001=[message(["a"])], chan_2020_002=[message(["b"])])
    build_silver(spark, raw, str(tmp_path / "staged"), str(tmp_path / "silver"), "2020")
    assert tuples(read_silver(spark, str(tmp_path / "silver")), "k_emote_name", "vod_id") == [("a", None), ("b", None)]
    fresh = tmp_path / "fresh"
    fresh.mkdir()
    (fresh / "chan_2020_002.json").write_text(json.dumps([message(["c"])]))
    build_silver(spark, str(fresh), str(tmp_path / "staged"), str(tmp_path / "silver"), "2020")
    assert tuples(read_silver(spark, str(tmp_path / "silver")), "k_emote_name") == [("a",), ("c",)]


def test_no_single_value_or_name_stops_the_silver_job(spark, land, tmp_path):
    raw = land(chan_2020_2493025305='[{"time_in_seconds": NaN, "emotes": [{"name": "x"}]}]', chan_2020_003_9=[message(["y"])])
    report, _ = build_silver(spark, raw, str(tmp_path / "staged"), str(tmp_path / "silver"), "2020")
    again, _ = build_silver(spark, raw, str(tmp_path / "staged"), str(tmp_path / "other"), "2021")
    assert report.first()["total_files"] == 2 and again.first()["total_files"] == 0
    assert tuples(read_silver(spark, str(tmp_path / "silver")), "k_emote_name") == [("x",), ("y",)]


def test_gold_report_leaves_out_rows_of_older_runs(spark, chat, tmp_path):
    rows = panel.emote_panel(chat(message(["a"])), keep=PARTITIONS)
    vods = spark.createDataFrame([(1, "t")], "id long, title string")
    gold = str(tmp_path / "gold")
    write_gold_parquet(rows.withColumn("match_title", F.lit("old")), gold)
    write_silver(rows.withColumn("year", F.lit(2021)), str(tmp_path / "silver"))
    report = build_gold(spark, str(tmp_path / "silver"), vods, gold, "chan", "2020,2021")
    assert [(r[0], r[1]) for r in report.collect()] == [(2020, 0), (2021, 1)]


def test_csv_keeps_microseconds(spark, chat, tmp_path):
    path = str(tmp_path / "legacy")
    write_legacy_csv(panel.legacy_panel(chat(message(badges=["x"])), "chan"), path)
    row = read_legacy_panel(spark, path).select("*", F.unix_micros("t_timestamp").alias("micros")).first()
    assert row.micros == 1_600_000_000_123_456
    assert json.loads(row.i_badges) == [{"name": "x", "title": "X", "version": "0"}]


def test_gold_csv_and_parquet_hold_the_same_rows(spark, chat, tmp_path):
    gold = panel.emote_panel(chat(message(["a", "b"], ["x", "y"])), keep=PARTITIONS).withColumn("match_title", F.lit("t"))
    write_gold_parquet(gold, str(tmp_path / "p"))
    write_gold_csv(gold, str(tmp_path / "c"), files=1)
    flat = spark.read.option("header", True).csv(str(tmp_path / "c"))
    assert read_gold(spark, str(tmp_path / "p")).count() == flat.count() == 2
    assert flat.first().i_badge_titles == "X,Y"


def test_report_headings(spark, tmp_path):
    path = str(tmp_path / "report")
    report = spark.createDataFrame([(2020, 5)], "year int, total_emote_records long")
    write_report(report, path, labels=True)
    assert spark.read.option("header", True).csv(path).columns == ["Year", "Total Emote Records"]
    write_report(report, path, format="parquet")
    assert spark.read.parquet(path).columns == ["year", "total_emote_records"]


def test_views_and_inspect(spark):
    rows = register_views(spark.range(5).toDF("n"), "numbers")
    assert spark.sql("SELECT sum(n) FROM numbers").first()[0] == 10
    seen = inspect(rows, 2)
    assert (seen.schema.names, seen.rows, seen.head.count()) == (["n"], 5, 2)


def folders(path):
    return sorted(str(p.relative_to(path)) for p in path.glob("channel=*/year=*/*"))


def test_silver_folders_do_not_grow_with_broadcasts(spark, chat, tmp_path):
    rows = panel.emote_panel(chat(message(["a"])), keep=PARTITIONS).crossJoin(spark.range(200).select(F.col("id").cast("string").alias("v")))
    rows = rows.withColumn("vod_id", F.col("v")).drop("v")
    write_silver(rows, str(tmp_path / "silver"), buckets=4)
    assert folders(tmp_path / "silver") == [f"channel=chan/year=2020/bucket={i}of4" for i in range(4)]
    assert read_silver(spark, str(tmp_path / "silver")).select("vod_id").distinct().count() == 200


def test_only_touched_buckets_are_written_again(spark, chat, tmp_path):
    path = tmp_path / "silver"
    rows = panel.emote_panel(chat(message(["a"])), keep=PARTITIONS).crossJoin(spark.range(40).select(F.col("id").cast("string").alias("v")))
    rows = rows.withColumn("vod_id", F.col("v")).drop("v")
    write_silver(rows, str(path))
    before = {p: p.stat().st_mtime_ns for p in path.rglob("*.parquet")}
    # Made from the table itself, and with another number of buckets than the table's.
    again = read_silver(spark, str(path)).filter("vod_id = '7'").withColumn("k_emote_name", F.lit("new"))
    write_silver(again, str(path), buckets=3)
    after = {p: p.stat().st_mtime_ns for p in path.rglob("*.parquet")}
    touched = {p.parent.name for p in after.keys() - before.keys()}
    assert len(touched) == 1 and {p.parent.name for p in before.keys() - after.keys()} == touched
    assert all(before[p] == after[p] for p in before.keys() & after.keys())
    got = tuples(read_silver(spark, str(path)), "vod_id", "k_emote_name")
    assert got == sorted([(str(i), "new" if i == 7 else "a") for i in range(40)], key=repr)
    assert not list(path.glob("_staged/*"))


def test_channels_that_look_like_numbers_keep_their_names(spark, chat, tmp_path):
    path = str(tmp_path / "silver")
    for emote in "ab":
        rows = panel.emote_panel(chat(message([emote]), channel="007"), keep=PARTITIONS)
        write_silver(rows.withColumn("vod_id", F.lit(emote)), path, buckets=1)
    assert tuples(read_silver(spark, path), "channel", "k_emote_name") == [("007", "a"), ("007", "b")]


def test_a_write_stopped_while_moving_is_finished_by_the_next(spark, chat, tmp_path, monkeypatch):
    from chatloom.sinks import tables

    path = tmp_path / "silver"
    rows = panel.emote_panel(chat(message(["old"])), keep=PARTITIONS).crossJoin(spark.range(20).select(F.col("id").cast("string").alias("v")))
    rows = rows.withColumn("vod_id", F.col("v")).drop("v")
    write_silver(rows, str(path), buckets=4)
    moved, whole = [], tables.Storage.replace

    def stop(self, name, by):
        if len(moved) == 2:
            raise OSError("stopped")
        moved.append(name)
        whole(self, name, by)

    monkeypatch.setattr(tables.Storage, "replace", stop)
    with pytest.raises(OSError):
        write_silver(rows.withColumn("k_emote_name", F.lit("new")), str(path))
    monkeypatch.undo()
    write_silver(rows.filter("vod_id = '3'").withColumn("k_emote_name", F.lit("last")), str(path))
    got = tuples(read_silver(spark, str(path)), "vod_id", "k_emote_name")
    assert got == sorted([(str(i), "last" if i == 3 else "new") for i in range(20)], key=repr)
    # A write that was stopped before it was whole leaves nothing.
    (path / "_staged" / "x" / "channel=chan").mkdir(parents=True)
    write_silver(rows.filter("vod_id = '3'"), str(path))
    assert not list(path.glob("_staged/*")) and read_silver(spark, str(path)).count() == 20


def test_tables_of_earlier_layouts_are_refused_and_migrated(spark, chat, tmp_path):
    old, new = str(tmp_path / "old"), str(tmp_path / "new")
    rows = panel.emote_panel(chat(message(["a"], ["x"]), vod_id="11"), keep=PARTITIONS)
    named = rows.withColumnsRenamed({"i_user_name": "i_username", "chat_message": "message"})
    rows.write.partitionBy(*PARTITIONS, "vod_id").parquet(old)
    by_file = rows.withColumns({"vod_id": F.lit(None).cast("string"), "k_emote_name": F.lit("b"), "source_file": F.lit("chan_2020_002.json")})
    by_file.write.mode("append").partitionBy(*PARTITIONS, "vod_id", "source_file").parquet(old)
    named.withColumn("vod_id", F.lit("12")).write.mode("append").partitionBy(*PARTITIONS).parquet(old)
    with pytest.raises(ValueError, match="migrate_silver"):
        write_silver(rows, old)
    migrate_silver(spark, old, new)
    assert tuples(read_silver(spark, new), "vod_id", "k_emote_name", "i_user_name") == [
        ("11", "a", "ann"), ("12", "a", "ann"), (None, "b", "ann")
    ]
    again = by_file.drop("source_file").withColumns({"file_name": F.lit("chan_2020_002.json"), "k_emote_name": F.lit("c")})
    write_silver(again, new)
    assert tuples(read_silver(spark, new), "vod_id", "k_emote_name") == [("11", "a"), ("12", "a"), (None, "c")]


def test_filters_reach_the_scan_of_each_revision(spark, tmp_path):
    path = str(tmp_path / "table")
    for year, name in ((2020, "i_user_name"), (2021, "i_username")):
        rows = spark.createDataFrame([("ann",), ("bob",)], f"{name} string").withColumns({"channel": F.lit("chan"), "year": F.lit(year)})
        rows.write.mode("append").partitionBy(*PARTITIONS).parquet(path)
    for read in (read_silver, read_gold):
        rows = read(spark, path).filter("i_user_name = 'ann'")
        assert tuples(rows, "i_user_name", "year") == [("ann", 2020), ("ann", 2021)]
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "EqualTo(i_user_name,ann)" in plan and "EqualTo(i_username,ann)" in plan
    plan = read_silver(spark, path, years="2020").filter("i_user_name is null")._jdf.queryExecution().executedPlan().toString()
    assert "IsNull(i_user_name)" in plan and "i_username" not in plan


def test_exact_gold_csv_gives_back_every_value(spark, tmp_path):
    texts = [None, "", "\\N", "\\", "\\n", "a\nb", "a\r\nb", ' "q", ', "\\\\n", ",", "  x  ", "#c", "\\E", "é\t"]
    lists = [None, [], [""], [None], ["a", None, ""], [","], ["\\,", "\\"], ["\\N", "\n"], ["a,b", "c"], ["\\E"]]
    rows = []
    for i in range(60):
        values = {f.name: None for f in GOLD}
        values.update(i_user_id=None if i % 7 == 0 else i, i_user_name=texts[i % len(texts)], chat_message=texts[-i % len(texts)])
        values.update(i_badge_names=lists[i % len(lists)], i_badge_titles=lists[-i % len(lists)], match_title=texts[i * 5 % len(texts)])
        rows.append((*values.values(), "chan", 2020 + i % 2))
    gold = spark.createDataFrame(rows, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in GOLD) + ", channel string, year int")
    path = tmp_path / "csv"
    write_gold_csv(gold, str(path), files=2, exact=True)
    assert tuples(read_gold_csv(spark, str(path))) == tuples(gold)
    assert tuples(read_gold_csv(spark, str(path), "chan", "2021")) == tuples(gold.filter("year = 2021"))
    lines = sum(len(p.read_bytes().splitlines()) for p in path.rglob("*.csv"))
    assert lines == 60 + len(list(path.rglob("*.csv")))


def test_gold_of_an_absent_year_is_cleared(spark, chat, tmp_path):
    silver, gold, csv = (str(tmp_path / name) for name in ("silver", "gold", "csv"))
    rows = panel.emote_panel(chat(message(["a"])), keep=PARTITIONS)
    vods = spark.createDataFrame([(1, "t")], "id long, title string")
    for year in (2020, 2021, 2022):
        old = rows.withColumns({"year": F.lit(year), "match_title": F.lit("old")})
        write_gold_parquet(old, gold)
        write_gold_csv(old, csv)
    write_silver(rows.withColumn("year", F.lit(2021)), silver)
    report = build_gold(spark, silver, vods, gold, "chan", "2020,2021", csv_path=csv, exact=True)
    assert [(r[0], r[1]) for r in report.collect()] == [(2020, 0), (2021, 1)]
    assert tuples(read_gold(spark, gold), "year", "match_title") == [(2021, "t"), (2022, "old")]
    assert sorted(p.name for p in (tmp_path / "csv" / "channel=chan").iterdir()) == ["year=2021", "year=2022"]


def ingest(spark, raw, tmp_path, **options):
    out = str(tmp_path / "out")
    ingest_stream(spark, raw, out, str(tmp_path / "checkpoint"), **options).awaitTermination()
    return tuples(read_silver(spark, out, streamed=True), *[f.name for f in PANEL])


def test_stream_equals_batch_and_reads_each_file_once(spark, land, tmp_path):
    raw = land(**FILES)
    out = str(tmp_path / "out")

    def batch():
        return tuples(panel.emote_panel(scanned(spark, raw)))

    first = ingest(spark, raw, tmp_path, files_per_batch=2)
    assert first == batch() and len(first) == 5
    assert ingest(spark, raw, tmp_path) == first
    land(chan_2022_001_20=[message(["new"])])
    assert ingest(spark, raw, tmp_path) == batch() and len(batch()) == 6
    assert tuples(read_silver(spark, out, "chan", "2022", streamed=True), "k_emote_name") == [("new",)]
    # What an attempt left behind whose ledger was never written does not count.
    stray = tmp_path / "out" / "panel" / "ingest=batch-000000000099" / "channel=chan" / "year=2022"
    stray.mkdir(parents=True)
    file = next((tmp_path / "out" / "panel").glob("*/channel=chan/year=2022/*.parquet"))
    (stray / "part-stray.parquet").write_bytes(file.read_bytes())
    assert ingest(spark, raw, tmp_path) == batch()


def test_ledger_has_every_file_and_equals_the_audit(spark, land, tmp_path):
    raw = land(**FILES)
    ingest(spark, raw, tmp_path, files_per_batch=4)
    columns = ["file_name", "vod_id", "message_rows", "emote_rows", "missing_user_rows", "status"]
    ledger = read_ledger(spark, str(tmp_path / "out"))
    assert tuples(ledger, *columns) == tuples(status_of(spark, raw), *columns)
    assert tuples(ledger, "file_name") == tuples(list_raw_files(spark, raw), "file_name")
    assert ledger.filter("length <= 0 or modified is null or recorded is null").count() == 0


def test_repaired_and_changed_files_are_offered_again(spark, land, tmp_path):
    raw = land(**FILES)
    ingest(spark, raw, tmp_path)
    out = str(tmp_path / "out")
    status = lambda: dict(tuples(read_ledger(spark, out), "vod_id", "status"))
    assert status()["14"] == "failed"
    land(chan_2021_001_14=[message(["mended"])], chan_2020_001_11=[message(["other"])])
    rows = ingest(spark, raw, tmp_path)
    assert rows == tuples(panel.emote_panel(scanned(spark, raw)))
    assert status()["14"] == "processed" and read_ledger(spark, out).count() == len(FILES)
    land(chan_2021_001_14="[{")
    assert ingest(spark, raw, tmp_path, files_per_batch=1) == tuples(panel.emote_panel(scanned(spark, raw)))
    assert status()["14"] == "failed"


def test_a_batch_that_runs_again_counts_once(spark, land, tmp_path):
    from chatloom.sources import list_files
    from chatloom.streaming.ingest import take_up

    raw, out = land(**FILES), str(tmp_path / "out")
    for _ in range(2):
        take_up(list_files(spark, raw), out, "batch-000000000000")
    assert tuples(read_silver(spark, out, streamed=True), *[f.name for f in PANEL]) == tuples(panel.emote_panel(scanned(spark, raw)))
    assert read_ledger(spark, out).count() == len(FILES)
    assert read_ledger(spark, str(tmp_path / "nothing")).count() == 0
