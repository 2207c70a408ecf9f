import random

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from chatloom.functions import numbered, year_frame
from chatloom.operators import catalog, gold
from chatloom.schemas import VOD

ROWS = [
    (3, "DreamLeague S1", "2020-05-01 10:00:00", "1h", "u3"),
    (1, "Other", "2020-05-01 09:00:00", "1h", "u1"),
    (2, "the dreamers", "2021-12-31 23:59:59", "1h", "u2"),
    (4, "Late", "2020-05-01 10:00:00", "1h", "u4"),
]


@pytest.fixture
def vods(spark):
    raw = spark.createDataFrame(ROWS, "id long, title string, created_at string, duration string, url string")
    return raw.withColumn("created_at", F.col("created_at").cast("timestamp")).to(VOD)


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(
        [("1", 1, "a"), ("1", None, "a"), ("9", 2, "b"), (None, 3, None), ("x1", 4, "d")],
        "vod_id string, i_user_id long, i_user_name string",
    )


def test_titles_are_attached_by_text(rows, vods):
    joined = gold.attach_titles(rows, vods)
    assert joined.columns == [*rows.columns, "match_title"]
    assert tuples(joined, "vod_id", "match_title") == [
        ("1", "Other"), ("1", "Other"), ("9", None), ("x1", None), (None, None)
    ]


def test_unique_catalogue_keeps_the_row_count_and_doubled_ids_multiply(rows, vods):
    assert gold.attach_titles(rows, vods).count() == rows.count()
    assert gold.attach_titles(rows, vods.union(vods.filter("id = 1"))).count() == rows.count() + 2


def test_building_a_title_join_runs_no_job_and_forces_no_broadcast(spark, rows, vods):
    tracker, group = spark.sparkContext.statusTracker(), "building"
    spark.sparkContext.setJobGroup(group, group)
    joined = gold.attach_titles(rows, vods)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert list(tracker.getJobIdsForGroup(group)) == []
    assert "ResolvedHint" not in joined._jdf.queryExecution().analyzed().toString()


def test_records_per_title(rows, vods):
    counted = gold.records_per_title(gold.attach_titles(rows, vods))
    assert tuples(counted) == [("Other", 2, 1), (None, 3, 1)]


def test_gold_report_has_a_row_for_every_year(spark):
    rows = spark.createDataFrame(
        [(2020, 1, "a"), (2020, None, "a"), (2020, 1, None), (2021, 1, "a"), (2019, 1, "a")],
        "year int, i_user_id long, i_user_name string",
    )
    report = gold.gold_report(rows, year_frame(spark, "2020, 2021, 2022"))
    assert [tuple(r) for r in report.collect()] == [(2020, 3, 2, 66.67), (2021, 1, 0, 0.0), (2022, 0, 0, 0.0)]


def test_title_search(vods):
    assert tuples(catalog.search_titles(vods, "Dream"), "id") == [(2,), (3,)]
    assert tuples(catalog.search_titles(vods, "Dream", case_sensitive=True), "id") == [(3,)]
    assert [r.id for r in catalog.search_titles(vods, "e", by_date=True).collect()] == [1, 3, 4, 2]
    assert catalog.search_titles(vods, "%").count() == 0


def test_years(vods):
    assert tuples(catalog.vods_of_year(vods, 2021)) == [(2, "the dreamers")]
    assert [tuple(r) for r in catalog.vods_per_year(vods).collect()] == [(2020, 3), (2021, 1)]
    assert [r.id for r in catalog.sort_vods(vods).collect()] == [1, 3, 4, 2]


def test_manifest_numbers_from_zero_by_time(spark, vods):
    manifest = catalog.download_manifest(vods, "chan", year_frame(spark, [2020, 2021]), root="bronze")
    assert tuples(manifest, "file_name", "key", "url") == [
        ("chan_2020_000_1.json", "bronze/chan/2020/chan_2020_000_1.json", "u1"),
        ("chan_2020_001_3.json", "bronze/chan/2020/chan_2020_001_3.json", "u3"),
        ("chan_2020_002_4.json", "bronze/chan/2020/chan_2020_002_4.json", "u4"),
        ("chan_2021_000_2.json", "bronze/chan/2021/chan_2021_000_2.json", "u2"),
    ]
    assert catalog.download_manifest(vods, "chan", year_frame(spark, [2019])).count() == 0


def test_numbering_equals_one_big_sort(spark):
    random.seed(3)
    rows = [(random.choice("ab"), random.randrange(500), i) for i in range(2000)]
    table = spark.createDataFrame(rows, "g string, k int, id int")
    result = numbered(table, "n", ["g"], [F.expr("k div 70"), F.expr("k div 7"), F.struct("k", F.expr("id div 10"))], ["k", "id"], start=0)
    for group in "ab":
        ordered = sorted((k, i) for g, k, i in rows if g == group)
        got = {(r.k, r.id): r.n for r in result.filter(F.col("g") == group).collect()}
        assert got == {key: n for n, key in enumerate(ordered)}


@pytest.fixture
def files(spark):
    return spark.createDataFrame(
        [("c_2020_10_1.json", "c", 2020, 10, "1"), ("c_2020_2_3.json", "c", 2020, 2, "3"),
         ("c_2020_2500_4.json", "c", 2020, 2500, None), ("d_2020_7_9.json", "d", 2020, 7, "9")],
        "file_name string, channel string, year int, file_seq bigint, vod_id string",
    )


def test_files_in_numeric_order_and_day_numbers(files):
    assert [r.file_seq for r in catalog.order_files(files).collect()] == [2, 10, 2500, 7]
    assert tuples(catalog.day_number(files), "channel", "file_seq", "day_number") == [
        ("c", 10, 2), ("c", 2, 1), ("c", 2500, 3), ("d", 7, 1)
    ]


def test_missing_files_and_report(spark, vods, files):
    assert tuples(catalog.missing_raw_files(vods, files)) == [(2020, "4", "Late"), (2021, "2", "the dreamers")]
    report = catalog.download_report(vods, files, year_frame(spark, "2020,2021,2022"))
    assert [tuple(r) for r in report.collect()] == [(2020, 3, 2, 1), (2021, 1, 0, 1), (2022, 0, 0, 0)]


def test_files_of_the_oldest_form_are_found_by_number(spark, vods):
    files = spark.createDataFrame(
        [("c_2020_1.json", "c", 2020, 1, None), ("d_2020_2.json", "d", 2020, 2, None), ("c_2021_5.json", "c", 2021, 5, None),
         ("c_2020_001_1.json", "c", 2020, 1, "1")],
        "file_name string, channel string, year int, file_seq bigint, vod_id string",
    )
    # By time the broadcasts of 2020 are 1, 3 and 4, numbered from 0.
    assert tuples(catalog.missing_raw_files(vods, files), "vod_id") == [("2",)]
    assert tuples(catalog.missing_raw_files(vods, files, channel="c"), "vod_id") == [("2",), ("4",)]
    report = catalog.download_report(vods, files, year_frame(spark, "2020,2021"), channel="c")
    assert [tuple(r) for r in report.collect()] == [(2020, 3, 2, 1), (2021, 1, 0, 1)]
