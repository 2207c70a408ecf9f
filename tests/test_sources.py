import pytest
from conftest import message, tuples
from pyspark.sql import functions as F

from chatloom.functions import parse_years, safe_title
from chatloom.operators import panel
from chatloom.schemas import CORRUPT
from chatloom.sources import broken_files, is_blank, list_raw_files, read_catalog, read_chat, read_legacy_panel, with_file_metadata


def test_reads_whole_file_arrays_of_all_files(spark, land):
    raw = land(chan_2020_001_11=[message(["a"]), message(["b", "c"])], chan_2020_002_12=[message(["d"])])
    rows = panel.emote_panel(with_file_metadata(read_chat(spark, raw)))
    assert tuples(rows, "vod_id", "k_emote_name") == [("11", "a"), ("11", "b"), ("11", "c"), ("12", "d")]
    assert {r.j_streamer for r in rows.collect()} == {"chan"}


def test_file_without_any_emotes_and_file_without_filled_badges(spark, land):
    raw = land(chan_2020_001_11=[message(None), message(None)], chan_2020_002_12=[message(["e"], badges=[])])
    rows = panel.emote_panel(with_file_metadata(read_chat(spark, raw)))
    assert tuples(rows, "vod_id", "i_badge_names", "i_badge_versions") == [("12", [], [])]


def test_broken_file_gives_one_marked_row(spark, land):
    raw = land(chan_2020_001_11='[{"author": {"id": "1"}, "emotes": [{"na', chan_2020_002_12=[message()])
    rows = with_file_metadata(read_chat(spark, raw))
    broken = rows.filter(F.col(CORRUPT).isNotNull())
    assert [r.vod_id for r in broken.collect()] == ["11"]
    assert tuples(rows.filter(is_blank()), "vod_id") == [("11",)]
    assert panel.emote_panel(rows).count() == 1


def test_one_odd_value_is_one_null(spark, land):
    raw = land(
        chan_2020_001_11=[message(["a"]), message(["b"], timestamp="abc", time_in_seconds={}), message(["c"])],
        chan_2020_002_12=[message(["d"], timestamp=None, time_in_seconds="x"), message(["e"], author={"id": 5})],
        chan_2020_003_13=[message(["f"]), message("x", author={"badges": "none"})],
    )
    chat = with_file_metadata(read_chat(spark, raw))
    rows = panel.emote_panel(chat).withColumn("micros", F.unix_micros("t_timestamp"))
    plain = 1_600_000_000_123_456
    assert tuples(rows, "k_emote_name", "i_user_id", "micros", "t_seconds") == [
        ("a", 1, plain, 10), ("b", 1, None, None), ("c", 1, plain, 10),
        ("d", 1, None, None), ("e", 5, plain, 10), ("f", 1, plain, 10), ("x", 1, plain, 10),
    ]
    assert chat.filter(is_blank()).count() == 0


def test_a_single_object_is_one_message_and_a_list_of_other_things_is_broken(spark, land):
    raw = land(chan_2020_001_11=message(["a"]), chan_2020_002_12=[message(["b"]), "junk"])
    chat = with_file_metadata(read_chat(spark, raw))
    assert tuples(chat.filter(is_blank()), "vod_id") == [("12",)]
    assert tuples(panel.emote_panel(chat), "vod_id") == [("11",)]


def test_listing_sees_files_that_hold_nothing(spark, land):
    raw = land(big_games2_2020_033_123="[]", big_games2_2020_34=[message()], notes="[]")
    assert read_chat(spark, raw).filter(F.col("message").isNotNull()).count() == 1
    files = tuples(list_raw_files(spark, raw), "file_name", "channel", "year", "file_seq", "vod_id", "parts")
    assert files == [
        ("big_games2_2020_033_123.json", "big_games2", 2020, 33, "123", 1),
        ("big_games2_2020_34.json", "big_games2", 2020, 34, None, 1),
    ]


def test_a_broadcast_may_be_a_folder_of_parts(spark, tmp_path):
    import json

    folder = tmp_path / "source=chan_2021_007_99.json"
    folder.mkdir()
    for part in range(3):
        (folder / f"part-{part}.txt").write_text(json.dumps([message(["e"] * part)]))
    files = list_raw_files(spark, str(tmp_path))
    assert tuples(files, "file_name", "vod_id", "parts") == [("chan_2021_007_99.json", "99", 3)]
    rows = panel.emote_panel(with_file_metadata(read_chat(spark, str(tmp_path))))
    assert tuples(rows, "vod_id") == [("99",)] * 3


@pytest.mark.parametrize(
    "path, expected",
    [
        ("s3://b/c/big_games2_2020_033_123.json", ("big_games2", 2020, 33, "123")),
        ("big_games2_2020_33.json", ("big_games2", 2020, 33, None)),
        ("/x/one_two_three_2013_1000_9000000000.json", ("one_two_three", 2013, 1000, "9000000000")),
        ("/x/chan_1234_2020_033_5.json", ("chan_1234", 2020, 33, "5")),
        ("/x/source=chan_2020_001_7.json/part-1.txt", ("chan", 2020, 1, "7")),
        ("/x/readme.json", (None, None, None, None)),
        ("/x/chan_2020_001_7.json.gz", (None, None, None, None)),
    ],
)
def test_file_name_parts(spark, path, expected):
    row = with_file_metadata(spark.createDataFrame([(path,)], "path string"), F.col("path")).first()
    assert (row.channel, row.year, row.file_seq, row.vod_id) == expected
    assert (row.file_name is None) == (expected[0] is None)


def test_only_the_wanted_years_files_are_opened(spark, land):
    raw = land(**{f"chan_{2015 + i}_001_{i}": [message()] for i in range(6)})
    rows = with_file_metadata(read_chat(spark, raw)).filter(F.col("year").isin(2016, 2017)).select("message", "year")
    assert rows.count() == 2
    rows.collect()
    node = rows._jdf.queryExecution().executedPlan()
    while node.children().size():
        node = node.children().apply(0)
    assert node.metrics().apply("numFiles").value() == 2


def test_catalog_titles_keep_commas_and_doubled_quotes(spark, tmp_path):
    path = tmp_path / "vods.csv"
    path.write_text(
        "id,title,created_at,duration,url\n"
        '2493025305,"A, B - C",2025-06-22T16:35:24Z,6h26m37s,https://videos.example/2493025305\n'
        '7,"say ""hi"", all",2024-12-31T23:59:59Z,45m2s,u\n'
    )
    rows = read_catalog(spark, str(path))
    assert tuples(rows, "id", "title") == [(2493025305, "A, B - C"), (7, 'say "hi", all')]
    assert tuples(rows, F.year("created_at")) == [(2024,), (2025,)]


def test_legacy_panel_in_both_forms(spark, tmp_path):
    first = tmp_path / "one.csv"
    first.write_text(
        "i_user_id,i_username,i_display_color,i_badges,j_streamer,k_emote_name,t_timestamp,t_time_text,t_seconds,message\n"
        "1,ann,,\"[{'name': 'x', 'version': 1}]\",chan,e,2024-02-25 10:00:00.123456,0:01,1,\"two\nlines\"\n"
    )
    second = tmp_path / "two.csv"
    second.write_text(first.read_text().replace("two\nlines", "one"))
    rows = read_legacy_panel(spark, [str(first), str(second)])
    assert tuples(rows, "i_user_id", "i_display_color", "i_badges", "message") == [
        ("1", None, "[{'name': 'x', 'version': 1}]", "one"),
        ("1", None, "[{'name': 'x', 'version': 1}]", "two\nlines"),
    ]
    assert rows.select(F.unix_micros("t_timestamp") % 1_000_000).first()[0] == 123456


def test_parse_years():
    assert parse_years(" 2020, 21,abcd ,2022,20222") == [2020, 2022]
    assert parse_years(["2020", 2021, " 2022 "]) == [2020, 2021, 2022]
    assert parse_years(2020) == [2020]


def test_safe_title(spark):
    row = spark.createDataFrame([("É A, B - C/1", "x" * 80)], "a string, b string")
    assert tuple(row.select(safe_title(F.col("a")), safe_title(F.col("b"))).first()) == ("É_A__B_-_C_1", "x" * 50)


def test_verdict_on_files_with_a_blank_row(spark, land):
    raw = land(
        chan_2020_001_1='[{"action_type": "x"}]',
        chan_2020_002_2='[{"message": "m", "emotes": [{"name": "e"}]}, {"action_type": "x"}]',
        chan_2020_003_3='[{"message": "m"}, {"mess',
        chan_2020_004_4='[{"time_in_seconds": "often"}]',
        chan_2020_006_6='[{"message": "m"}, "junk"]',
        chan_2020_007_7='{"time_in_seconds": "often"}',
        **{"a b+c%[x]_2020_005_5": "[{"},
    )
    found = with_file_metadata(broken_files(read_chat(spark, raw)))
    assert tuples(found, "vod_id") == [("3",), ("5",), ("6",)]
    assert broken_files(read_chat(spark, land(chan_2020_003_3="[]", chan_2020_006_6="[]", **{"a b+c%[x]_2020_005_5": "[]"}))).count() == 0


def test_longest_known_channel_decides(spark):
    names = ["chan_2020_2021_33.json", "chan_2020_2021_033_7.json", "chan_2020_007_1.json", "other_2020_1.json"]
    rows = spark.createDataFrame([(n,) for n in names], "path string")
    parts = lambda channels: [tuple(r)[2:] for r in with_file_metadata(rows, F.col("path"), channels).collect()]
    assert parts([]) == [("chan", 2020, 2021, "33"), ("chan_2020", 2021, 33, "7"), ("chan", 2020, 7, "1"), ("other", 2020, 1, None)]
    assert parts(["chan", "chan_2020"]) == [
        ("chan_2020", 2021, 33, None), ("chan_2020", 2021, 33, "7"), ("chan", 2020, 7, "1"), ("other", 2020, 1, None)
    ]


def odd_messages(n, seed=4):
    import random

    rng = random.Random(seed)
    odd = ['{"', "}", '"}', "\\", '\\"', "[{", "é}", "\n", "a", " ", "{{", "}}", '\\\\"{']
    return [
        message([rng.choice(odd)], ["x"] * rng.randrange(3), message="".join(rng.choices(odd, k=rng.randrange(30))), other={"deep": [{}, {"a": "}"}]})
        for _ in range(n)
    ]


@pytest.mark.parametrize("split_bytes", [40, 100, 1000, 10_000_000])
@pytest.mark.parametrize("indent", [None, 1])
def test_a_long_file_is_read_by_several_tasks(spark, tmp_path, split_bytes, indent):
    import json

    raw = tmp_path / "raw"
    raw.mkdir()
    for i in range(3):
        (raw / f"chan_2020_{i:03d}_{i}.json").write_text(json.dumps(odd_messages(60, i), indent=indent))
    (raw / "chan_2020_004_4.json").write_text("[]" + " " * 200)
    (raw / "chan_2020_005_5.json").write_text(json.dumps(odd_messages(60))[:-9])
    (raw / "chan_2020_006_6.json").write_text(json.dumps([message(message="x" * 5000)]))
    whole = with_file_metadata(read_chat(spark, str(raw)))
    split = with_file_metadata(read_chat(spark, str(raw), split_bytes))
    columns = [F.to_json(F.struct("author", "emotes", "timestamp", "time_text", "time_in_seconds", "message")).alias("m"), "vod_id"]
    assert tuples(split, *columns) == tuples(whole, *columns)
    assert split.count() == 3 * 60 + 1 + 1
    assert tuples(with_file_metadata(broken_files(split)), "vod_id") == [("5",)]


def test_ranges_of_a_long_file_are_tasks_of_their_own(spark, tmp_path):
    import json

    from chatloom.sources import split

    path = tmp_path / "chan_2020_001_1.json"
    path.write_text(json.dumps(odd_messages(400)))
    records = split.split_records(spark, [str(path)], 10_000)
    assert records.count() == 400
    ranges = path.stat().st_size // 10_000
    assert ranges > 5 and spark.read.option("lineSep", "}").text(str(path)).count() > 400
