"""Plans and writes as they would be with large inputs: no broadcast, tiny size targets, a hot key."""

import os

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from chatloom.operators import badges, catalog, gold, panel
from chatloom.plans import badge_report
from chatloom.schemas import PANEL, PARTITIONS
from chatloom.sinks import write_silver
from chatloom.sources import read_silver

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


@pytest.fixture
def small(spark):
    for key, value in SMALL.items():
        spark.conf.set(key, value)
    yield
    for key in SMALL:
        spark.conf.unset(key)


def hot(spark, rows=60_000):
    """Panel rows of which a third belong to one VOD and one user."""
    n = F.col("id")
    third = n % 3 == 0
    base = spark.range(0, rows, 1, 8).select(
        F.when(third, 0).otherwise(n % 50).cast("bigint").alias("i_user_id"),
        F.when(third, "hot").otherwise(F.concat(F.lit("u"), n % 50)).alias("i_user_name"),
        F.array(F.lit("x"), F.lit("y")).alias("i_badge_names"),
        F.array(F.lit("X"), F.lit("Y")).alias("i_badge_titles"),
        F.array(F.lit("1"), F.lit("2")).alias("i_badge_versions"),
        F.sha2(n.cast("string"), 256).alias("chat_message"),
        F.when(third, "0").otherwise((n % 200).cast("string")).alias("vod_id"),
        F.lit("chan").alias("channel"),
        F.lit(2020).alias("year"),
    )
    return panel.normalize_panel(base)


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_vod_is_split_in_a_shuffled_title_join(spark, small):
    vods = spark.range(0, 200).select("id", F.concat(F.lit("t"), "id").alias("title"))
    joined = gold.attach_titles(hot(spark), vods).select("vod_id", "chat_message", "match_title")
    plan = executed(joined)
    assert "BroadcastHashJoin" not in plan and "skew=true" in plan
    counts = dict(map(tuple, joined.groupBy("match_title").count().collect()))
    assert sum(counts.values()) == 60_000 and counts["t0"] >= 20_000


def test_hot_vod_is_written_by_several_tasks(spark, small, tmp_path):
    path = str(tmp_path / "silver")
    rows = hot(spark)
    write_silver(rows, path)
    folders = (tmp_path / "silver" / "channel=chan" / "year=2020").iterdir()
    hot_one = max(folders, key=lambda folder: sum(f.stat().st_size for f in folder.glob("*.parquet")))
    assert len(list(hot_one.glob("*.parquet"))) > 1
    names = [f.name for f in PANEL]
    back = read_silver(spark, path).select(*names)
    assert back.count() == rows.count() and back.exceptAll(rows.select(*names)).count() == 0


def test_broadcast_of_a_small_catalogue_leaves_the_panel_in_place(spark, small):
    vods = spark.range(0, 200).select("id", F.concat(F.lit("t"), "id").alias("title"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "32m")
    plan = executed(gold.attach_titles(hot(spark), vods))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


@pytest.fixture
def stored(spark, tmp_path):
    path = str(tmp_path / "silver")
    write_silver(hot(spark, 3_000), path)
    return read_silver(spark, path, "chan", "2020")


def scans(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in text.splitlines() if "FileScan" in line]


def test_badge_report_reads_two_columns_once(spark, stored):
    (scan,) = scans(badge_report(stored))
    assert "ReadSchema: struct<i_user_name:string,i_badge_names:array<string>>" in scan


def test_filters_and_partitions_reach_the_scan(spark, stored):
    (scan,) = scans(stored.filter("i_user_id is null").select("vod_id"))
    assert "PushedFilters: [IsNull(i_user_id)]" in scan
    (scan,) = scans(stored.filter("i_user_name is null").select("vod_id"))
    assert "PushedFilters: [IsNull(i_user_name)]" in scan
    (scan,) = scans(stored.filter("vod_id = '7' and year = 2020").select("k_emote_name"))
    assert "EqualTo(vod_id,7)" in scan and "year" in scan.split("PartitionFilters")[1].split("]")[0]


def test_cross_frequency_makes_no_product_rows(spark, stored):
    plan = badges.badge_name_frequency(stored, "cross")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Generate explode") == 1


def test_aggregates_combine_before_the_shuffle(spark, stored):
    for df in (
        panel.record_count(stored, ["vod_id"]),
        badges.distinct_users(stored),
        badges.badge_name_frequency(stored),
        badges.distinct_badges(stored),
    ):
        lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
        deepest = max(i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line)
        assert "HashAggregate" in lines[deepest + 1]


def test_silver_table_has_its_partitions_as_columns(stored):
    assert set(PARTITIONS) < set(stored.columns)
    assert tuples(stored, "channel", "year")[0] == ("chan", 2020)


def test_manifest_of_one_crowded_instant(spark):
    from chatloom.functions import year_frame

    vods = spark.range(0, 5000).select(
        "id", F.concat(F.lit("t"), "id").alias("title"), F.lit("u").alias("url"),
        F.expr("timestamp'2020-05-01 10:00:00' + make_dt_interval(0, 0, 0, if(id % 3 = 0, 0, id))").alias("created_at"),
    )
    manifest = catalog.download_manifest(vods, "chan", year_frame(spark, [2020]))
    got = [r.vod_id for r in manifest.orderBy("file_number").collect()]
    expected = sorted(range(5000), key=lambda i: (0 if i % 3 == 0 else i, i))
    assert got == [str(i) for i in expected]
    assert manifest.agg(F.min("file_number"), F.max("file_number")).first() == (0, 4999)


def test_the_first_layout_has_a_file_a_broadcast(spark, tmp_path):
    from workload import adapter

    rows = spark.range(0, 800, 1, 8).selectExpr(
        "id", "'chan' as channel", "cast(2020 + id % 2 as int) as year", "cast(id % 20 as string) as vod_id"
    )
    adapter.write_first_layouts(rows, str(tmp_path / "old"))
    assert len(list((tmp_path / "old").glob("*/*/vod_id=*/*.parquet"))) == 10
    assert spark.read.option("recursiveFileLookup", True).parquet(str(tmp_path / "old")).count() == 800


def test_many_ranges_of_long_files_are_one_task(spark, land, monkeypatch):
    import json

    from conftest import message

    from chatloom.sources import read_chat, split

    raw = land(**{f"chan_2020_{i:03d}_{i}": json.dumps([message(message="}{" * i)] * 40) for i in range(8)})
    seen = []

    def spy(self, run, schema):
        if schema == split.RANGES:
            seen.append(self.rdd.getNumPartitions())
        return in_arrow(self, run, schema)

    kind = type(spark.range(1))
    in_arrow = kind.mapInArrow
    monkeypatch.setattr(kind, "mapInArrow", spy)
    assert read_chat(spark, raw, 500).count() == 8 * 40
    assert seen and seen[0] <= spark.sparkContext.defaultParallelism + 1


def test_a_gold_folder_is_dealt_to_more_tasks_as_it_grows(spark, tmp_path):
    from chatloom.sinks import write_gold_parquet

    rows = spark.range(0, 60_000, 1, 8).selectExpr(
        "id", "sha2(cast(id as string), 256) as text", "concat('chan', id % 6) as channel", "cast(2020 + id % 2 as int) as year"
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_gold_parquet(rows, str(tmp_path / "gold"), files=3)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    folders = [list(folder.glob("*.parquet")) for folder in (tmp_path / "gold").glob("*/*")]
    assert len(folders) == 6 and all(1 <= len(files) <= 3 for files in folders)
    assert max(spark.read.parquet(str(f)).count() for files in folders for f in files) < 60_000 / 6 + 1
    assert spark.read.parquet(str(tmp_path / "gold")).count() == 60_000


def test_legacy_csv_is_cut_by_rows(spark, tmp_path, monkeypatch):
    from chatloom.sinks import tables

    monkeypatch.setattr(tables, "ROWS_PER_UNSPLIT_FILE", 100)
    rows = spark.range(0, 1000, 1, 1).select(F.col("id").cast("string").alias("i_user_id"), F.lit("a\nb").alias("message"))
    tables.write_legacy_csv(rows, str(tmp_path / "legacy"))
    assert len(list((tmp_path / "legacy").glob("*.csv"))) == 10
    assert spark.read.option("header", True).option("multiLine", True).csv(str(tmp_path / "legacy")).count() == 1000


def test_numbering_hands_no_table_to_the_driver(spark):
    from chatloom.functions import numbered

    rows = spark.range(0, 1000).selectExpr("id", "id % 3 as g")
    result = numbered(rows, "n", ["g"], [F.expr("id div 100"), F.expr("id div 10")], ["id"])
    assert "Broadcast" not in executed(result)
    assert all(r.n == r.id // 3 + 1 for r in result.collect())


def test_a_stream_reads_no_texts_of_files(spark, land, tmp_path, monkeypatch):
    from conftest import message

    from chatloom.streaming import ingest

    plans = []
    monkeypatch.setattr(ingest, "take_up", lambda files, *_: plans.append(files.sparkSession))
    run = ingest.ingest_stream(spark, land(chan_2020_001_1=[message()]), str(tmp_path / "out"), str(tmp_path / "cp"))
    run.awaitTermination()
    text = run._jsq.explainInternal(False)
    assert plans and "binaryFile" in text and "content" not in text


def test_landed_chat_is_compressed_a_file_a_broadcast(spark, tmp_path):
    from workload import adapter

    chat = spark.range(0, 400, 1, 8).selectExpr(
        "named_struct('id', 'a') as author", "array(named_struct('name', 'e')) as emotes", "id as timestamp", "'0:01' as time_text",
        "1.5D as time_in_seconds", "'m' as message", "'chan' as channel", "2020 as year", "cast(id % 10 * 21 as string) as vod_id",
    )
    adapter.write_chat(chat, str(tmp_path / "raw"))
    files = list((tmp_path / "raw").glob("source=chan_*/part-*"))
    assert len(files) == 10 and all(f.name.endswith(".gz") for f in files)


def test_landed_chat_is_written_by_the_tasks_alone(spark, tmp_path):
    """Spark's writer starts processes for each local file and leaves a checksum file beside it."""
    from workload import adapter

    from chatloom.sources import read_chat

    chat = spark.range(0, 400, 1, 8).selectExpr(
        "named_struct('id', 'a') as author", "array(named_struct('name', 'e')) as emotes", "id as timestamp", "'0:01' as time_text",
        "1.5D as time_in_seconds", "'m' as message", "if(id < 200, 'a=b/c', 'chan') as channel", "2020 as year",
        "cast(id % 10 * 21 as string) as vod_id",
    )
    for kind in ("gzip", "none"):
        raw = tmp_path / kind
        adapter.write_chat(chat, str(raw), kind)
        assert {f.parent.name for f in raw.rglob("*") if f.is_file()} == {f.name for f in raw.iterdir()}
        assert len([f for f in raw.rglob("*") if f.is_file()]) == 20 + len(adapter.EDGE_FILES)
        assert len(list(raw.glob("source=a%3Db%2Fc_*"))) == 10
        read = read_chat(spark, str(raw)).filter("message = 'm' and time_text = '0:01' and timestamp < 400")
        assert sorted(r.timestamp for r in read.select("timestamp").collect() if r.timestamp != 1) == [0, *range(2, 400)]


def test_day_numbers_list_the_files_once(spark, land):
    from conftest import message

    from chatloom.sources import list_raw_files

    files = list_raw_files(spark, land(chan_2020_001_1=[message()], chan_2020_007_2=[message()], chan_2020_007_3=[]))
    numbers = catalog.day_number(files)
    assert "binaryFile" not in executed(numbers)
    assert tuples(numbers, "file_seq", "day_number") == [(1, 1), (7, 2), (7, 2)]


def test_split_read_lands_plain_files_share_by_share(spark, tmp_path, monkeypatch):
    """Each share of the broadcasts is landed, read and deleted before the next; no row is lost or doubled."""
    from workload import adapter
    from workload.queries import QUERIES

    tables = {
        "region": "select 0 as r_regionkey, 'ASIA' as r_name union all select 1, 'MIDDLE EAST' union all select 2, 'EUROPE' union all select 3, 'AFRICA' union all select 4, 'AMERICA'",
        "customer": "select id as c_custkey, concat('C', id) as c_name, 'S' as c_mktsegment from range(20)",
        "part": "select id as p_partkey, 'b' as p_brand, 't' as p_type, concat('p', id) as p_name from range(30)",
        "orders": "select id as o_orderkey, id % 20 as o_custkey from range(1400)",
        "lineitem": "select id % 1400 as l_orderkey, id % 30 as l_partkey, 40.0 as l_quantity, cast(id % 7 as int) as l_linenumber, 'N' as l_returnflag, date'2020-01-01' as l_shipdate from range(4200)",
    }
    for name, sql in tables.items():
        spark.sql(sql).write.parquet(str(tmp_path / f"{name}.parquet"))
    whole = sorted(map(tuple, QUERIES["read_chat_split"](spark, str(tmp_path)).collect()), key=str)
    landed, write = [], adapter.write_chat
    before = []

    def seen(chat, path, *rest):
        before.append([p for p in landed if os.path.exists(p)])
        landed.append(path)
        write(chat, path, *rest)

    monkeypatch.setattr(adapter, "write_chat", seen)
    monkeypatch.setattr(adapter, "SHARE_MESSAGES", 1000)
    shared = sorted(map(tuple, QUERIES["read_chat_split"](spark, str(tmp_path)).collect()), key=str)
    assert shared == whole and len(whole) == 4200 + 3
    assert len(landed) == 5 and before == [[]] * 5 and not any(map(os.path.exists, landed))


def test_facts_of_paths_take_no_pattern_per_row(spark):
    from chatloom.functions.columns import may_be_of_years, plain_path

    paths = ["file:///a/x%20y+z.json", "file:/a/b", "file:////a%25", "s3a://b/c%2B", "file:/", "/plain+", None, "hdfs://h/file:/x"]
    rows = spark.createDataFrame([(p,) for p in paths], "p string")
    old = F.regexp_replace(F.url_decode(F.replace("p", F.lit("+"), F.lit("%2B"))), "^file:/+", "file:/")
    assert all(r.new == r.old for r in rows.select(plain_path(F.col("p")).alias("new"), old.alias("old")).collect())
    assert "regexp" not in executed(rows.select(plain_path(F.col("p"))))
    names = spark.createDataFrame([("d/source=c_2020_1_2.json/part",), ("d/c_2020_2021_3.json",), ("d/c_2019_1.json",)], "p string")
    assert [r[0] for r in names.select(may_be_of_years(F.col("p"), [2020, 2022])).collect()] == [True, True, False]
    assert not any(r[0] for r in names.select(may_be_of_years(F.col("p"), [])).collect())


def test_silver_opens_no_file_of_other_years_and_takes_names_once(spark, land, tmp_path, monkeypatch):
    from conftest import message

    from chatloom.plans import build_silver, silver

    raw = land(chan_2020_001_1=[message(["e"])], chan_2019_002_2=[message(["e"])], chan_2021_2020_3=[message(["e"])])
    plans, named = [], silver.with_file_metadata

    def seen(df, *args, **kwargs):
        plans.append(df)
        return named(df, *args, **kwargs)

    monkeypatch.setattr(silver, "with_file_metadata", seen)
    report, status = build_silver(spark, raw, str(tmp_path / "staged"), str(tmp_path / "silver"), "2020")
    assert "split" not in executed(plans[0]) and "2019" not in "".join(plans[0].select("_metadata.file_path").distinct().toPandas()["file_path"])
    assert [(r.year, r.total_files, r.processed_files) for r in report.collect()] == [(2020, 1, 1)]
    assert [r.file_name for r in status.collect()] == ["chan_2020_001_1.json"]
    assert read_silver(spark, str(tmp_path / "silver")).select("vod_id").collect() == [("1",)]
