import datetime as dt

from conftest import message, tuples
from pyspark.sql import functions as F

from chatloom.operators import panel
from chatloom.schemas import GOLD, PANEL


def test_one_row_per_emote_with_all_badges(chat):
    rows = panel.emote_panel(chat(message(["a", "b"], ["x", "y", "z"])), "chan").collect()
    assert [r.k_emote_name for r in rows] == ["a", "b"]
    assert all(r.i_badge_names == ["x", "y", "z"] and r.i_badge_titles == ["X", "Y", "Z"] for r in rows)
    assert all(r.i_badge_versions == ["0", "1", "2"] for r in rows)


def test_panel_columns_and_types(chat):
    rows = panel.emote_panel(chat(message()), "chan")
    assert [(f.name, f.dataType) for f in rows.schema] == [(f.name, f.dataType) for f in PANEL]
    row = rows.first()
    assert row.i_user_id == 1 and row.j_streamer == "chan" and row.i_user_status is None
    assert row.t_seconds == 10 and row.vod_id == "1" and row.chat_message == "hello"
    text = rows.select(F.date_format("t_timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS")).first()[0]
    assert text == "2020-09-13 12:26:40.123456"


def test_empty_or_absent_emotes_give_no_rows(chat):
    messages = chat(message([]), message(None), message(["a"]))
    assert panel.with_emotes(messages).count() == 2
    assert panel.explode_emotes(messages).count() == 1
    assert panel.emote_panel(messages).count() == 1


def test_absent_badges_stay_null_and_empty_stay_empty(chat):
    rows = panel.badge_arrays(chat(message(badges=None), message(badges=[])))
    assert tuples(rows, "i_badge_names", "i_badge_versions") == [(None, None), ([], [])]


def test_missing_and_non_numeric_user_ids(chat):
    messages = chat(
        message(author={"id": None}), message(author={"id": "abc"}), message(author={"name": None}), message()
    )
    rows = panel.emote_panel(messages)
    assert tuples(rows, "i_user_id") == [(1,), (1,), (None,), (None,)]
    assert panel.missing_users(rows).count() == 3


def test_panel_rows_equal_sum_of_emote_list_sizes(chat):
    messages = chat(*[message(["e"] * n) for n in range(7)])
    assert panel.emote_panel(messages).count() == sum(range(7))


def test_legacy_panel_keeps_badges_as_they_are(chat):
    row = panel.legacy_panel(chat(message(badges=["x"])), "chan").first()
    assert row.i_badges[0].asDict() == {"name": "x", "title": "X", "version": "0"}
    assert row.i_username == "ann" and row.j_streamer == "chan"


def test_drop_incomplete_drops_null_and_empty_but_not_the_word_null(spark):
    rows = spark.createDataFrame(
        [("1", "a"), ("", "a"), (None, "a"), ("1", ""), ("1", None), ("2", "null"), ("3", "NA")],
        "i_user_id string, k_emote_name string",
    )
    assert tuples(panel.drop_incomplete(rows)) == [("1", "a"), ("2", "null"), ("3", "NA")]


def test_flatten_badges(spark):
    rows = spark.createDataFrame(
        [(["a", None, "b"],) * 3, (None,) * 3, ([],) * 3],
        "i_badge_names array<string>, i_badge_titles array<string>, i_badge_versions array<string>",
    )
    assert [r[0] for r in panel.flatten_badges(rows).collect()] == ["a,b", "", ""]
    assert panel.flatten_badges(rows, ", ").first()[1] == "a, b"


def test_normalize_panel_maps_old_names_and_prefers_the_filled_one(spark):
    old = spark.createDataFrame([("5", "bob", "hey")], "i_user_id string, i_username string, message string")
    assert tuples(panel.normalize_panel(old), "i_user_id", "i_user_name", "chat_message", "vod_id") == [
        (5, "bob", "hey", None)
    ]
    mixed = spark.createDataFrame(
        [("a", None, 2020), (None, "b", 2021)], "i_username string, i_user_name string, year int"
    )
    fixed = panel.normalize_panel(mixed)
    assert tuples(fixed, "i_user_name", "year") == [("a", 2020), ("b", 2021)]
    assert fixed.columns == [f.name for f in PANEL] + ["year"]
    gold = panel.normalize_panel(mixed.withColumn("match_title", F.lit("t")))
    assert gold.columns[: len(GOLD)] == [f.name for f in GOLD]


def test_union_panels_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "i_user_id int, k_emote_name string")
    b = spark.createDataFrame([("y", 2)], "k_emote_name string, i_user_id int")
    c = spark.createDataFrame([(3,)], "i_user_id int")
    assert tuples(panel.union_panels([a, b, c]), "i_user_id", "k_emote_name") == [(1, "x"), (2, "y"), (3, None)]


def test_micros_survive_to_the_last_digit(chat):
    rows = panel.emote_panel(chat(message(timestamp=1_751_234_567_000_001), message(timestamp=None)))
    assert sorted(r[0] or 0 for r in rows.select(F.unix_micros("t_timestamp")).collect()) == [0, 1_751_234_567_000_001]
    assert rows.filter("t_timestamp is null").count() == 1
    assert isinstance(rows.first().t_timestamp, dt.datetime)
