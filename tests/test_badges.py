
import pytest
from conftest import message, tuples
from pyspark.sql import functions as F

from chatloom.operators import badges, legacy, panel, users
from chatloom.plans import badge_report


@pytest.fixture
def worn(spark):
    """Rows of (user, names, titles, versions)."""

    def build(*rows):
        return spark.createDataFrame(
            rows,
            "i_user_name string, i_badge_names array<string>, i_badge_titles array<string>, "
            "i_badge_versions array<string>",
        ).withColumn("t_timestamp", F.current_timestamp())

    return build


def same(user, *names):
    return (user, list(names), [n and n.title() for n in names], [str(i) for i in range(len(names))])


def bare(user):
    return (user, None, None, None)


def exploded(rows):
    """The three chained explodes, as brute force."""
    return [(n, t, v) for _, names, titles, versions in rows for n in names or [] for t in titles for v in versions]


def test_badge_counts_raw_clean_and_legacy(worn):
    rows = badges.clean_badge_count(badges.with_badge_count(worn(same("a", "x", "y"), same("b"), bare("c"))))
    assert tuples(rows, "i_user_name", "badges_count", "badges_count_tf") == [("a", 2, 2), ("b", 0, 0), ("c", -1, 0)]
    assert tuples(badges.with_badge_count(worn(bare("c")), missing=0), "badges_count") == [(0,)]


def test_raw_count_does_not_depend_on_ansi_mode(spark, worn):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert tuples(badges.with_badge_count(worn(bare("c"))), "badges_count") == [(-1,)]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_messages_with_more_than_n_badges(chat):
    rows = badges.users_with_badges_over(chat(message(badges=list("abcd")), message(badges=list("abc")), message()), 3)
    assert tuples(rows) == [("1", "ann", 4)]


def test_users_without_badges_first_names_then_most_badges(worn):
    rows = [bare("b"), same("b", "x"), same("b", "x", "y"), bare("a"), bare("c"), same("c", *"wxyz"), same("d", *"vwxyz")]
    counted = badges.with_badge_count(worn(*rows))
    best = badges.badges_of_users_without_badges(counted, k=2, users=2).collect()
    assert [(r.i_user_name, r.i_badge_names) for r in best] == [("b", ["x", "y"]), ("b", ["x"])]
    everybody = badges.badges_of_users_or_not(counted, "d", k=2, users=2).collect()
    assert [r.i_user_name for r in everybody] == ["c", "b"]
    only_chosen = badges.badges_of_users_or_not(counted, "b", k=10, users=2).collect()
    assert len(only_chosen) == 7 and only_chosen[0].i_user_name == "d"


def test_row_without_name_is_never_selected(worn):
    counted = badges.with_badge_count(worn(bare(None), same(None, "x"), bare("a"), same("z", "x")))
    assert {r.i_user_name for r in badges.badges_of_users_without_badges(counted).collect()} == {"a"}
    assert {r.i_user_name for r in badges.badges_of_users_or_not(counted, "z").collect()} == {"a"}


def test_distribution_counts_the_nameless_group_in_the_whole_only(worn):
    rows = worn(same("a", "x"), same("a", "x", "y"), bare("b"), bare(None), same("c", "x", "y"))
    expected = [(0, 1, 25.0), (2, 2, 50.0)]
    assert [tuple(r) for r in badge_report(rows).collect()] == expected
    per_user = badges.max_badges_per_user(badges.clean_badge_count(badges.with_badge_count(rows)))
    assert [tuple(r) for r in per_user.collect()] == [("a", 2), ("c", 2), ("b", 0), (None, 0)]
    assert [tuple(r) for r in badges.badge_distribution_subquery(per_user).collect()] == expected


def test_frequency_zip_and_cross(worn):
    rows = [same("a", "x", "y", "z"), same("b", "x"), same("c"), bare("d"), same("e", None, "x")]
    table = worn(*rows)
    assert tuples(badges.badge_name_frequency(table)) == [("x", 3), ("y", 1), ("z", 1), (None, 0)]
    cross = exploded(rows)
    for column, frequency in ((0, badges.badge_name_frequency), (1, badges.badge_title_frequency)):
        values = [r[column] for r in cross]
        expected = {v: values.count(v) if v is not None else 0 for v in values}
        assert dict(map(tuple, frequency(table, "cross").collect())) == expected


def test_one_user_with_three_badges_counts_27_against_3(worn):
    table = worn(same("a", "x", "y", "z"))
    assert sum(r.tot_count for r in badges.badge_name_frequency(table, "cross").collect()) == 27
    assert sum(r.tot_count for r in badges.badge_name_frequency(table, "zip").collect()) == 3


def test_zip_and_cross_agree_for_at_most_one_badge(worn):
    table = worn(same("a", "x"), same("b", "y"), same("c"), bare("d"))
    assert tuples(badges.badge_name_frequency(table)) == tuples(badges.badge_name_frequency(table, "cross"))


def test_unknown_mode_is_refused(worn):
    with pytest.raises(ValueError):
        badges.badge_name_frequency(worn(bare("a")), "both")


def test_distinct_badges_counts_null_as_one(worn):
    assert tuples(badges.distinct_badges(worn(same("a", "x", "y"), same("b", "x", None), bare("c")))) == [(3, 3)]
    assert tuples(badges.distinct_badges(worn(bare("c")))) == [(0, 0)]


def test_colour_shares(spark):
    rows = spark.createDataFrame(
        [(1, "red"), (1, None), (2, None), (3, "blue"), (None, "blue")], "i_user_id long, i_display_color string"
    )
    assert users.colour_share_rows(rows).first()[0] == 0.6
    total, coloured, share = users.colour_share_users(rows).first()
    assert (total, coloured, round(share, 6)) == (3, 2, 66.666667)
    assert tuple(users.colour_share_users(rows.limit(0)).first()) == (0, 0, None)


def test_badge_version_counts(worn):
    table = worn(same("a", "x", "y"), same("b", "x", "y"), same("c", "x"), same("d"), bare("e"))
    assert [tuple(r) for r in users.badge_version_counts(table).collect()] == [("0, 1", 2), ("0", 1)]


def test_top_k_breaks_ties(spark):
    rows = spark.createDataFrame([("b", 1), ("a", 1), ("c", 2)], "name string, n int")
    assert [r.name for r in users.top_k(rows, "n", 2, ties=["name"]).collect()] == ["c", "a"]


LEGACY_BADGES = [
    ("[{'name': 'sub', 'title': 'Sub', 'version': 12}, {'name': 'p', 'title': None, 'version': None}]",
     ("sub, p", "Sub, ", "12, None")),
    ("[{'name': 'x', 'flag': True, 'other': False, 'title': \"it's\", 'version': '3'}]", ("x", "it's", "3")),
    ("[{'name': 'x', 'icons': [{'id': 'a', 'url': None}], 'title': 'T', 'version': 1}]", ("x", "T", "1")),
    ("[{'title': 'only'}]", ("", "only", "")),
    ("[{'name': 'None of it', 'title': 'True, North', 'version': 1}]", ("None of it", "True, North", "1")),
    ("[{'name': 'a\\xa0b', 'title': 'c\\'d\"e', 'version': 1}]", ("a\xa0b", "c'd\"e", "1")),
    ("[{'name': 'x, None, y', 'title': \"a: True, it's\", 'version': None}]", ("x, None, y", "a: True, it's", "None")),
    ("[]", ("", "", "")),
    ("zzz", ("", "", "")),
    ("None", ("", "", "")),
    (None, ("", "", "")),
]


@pytest.mark.parametrize("text, expected", LEGACY_BADGES)
def test_legacy_badge_text(spark, text, expected):
    row = legacy.legacy_badge_info(spark.createDataFrame([(text,)], "i_badges string")).first()
    assert (row.i_badge_names, row.i_badge_titles, row.i_badge_versions) == expected


def test_distinct_users(worn):
    assert tuples(badges.distinct_users(worn(bare("a"), bare("a"), bare(None)))) == [("a",), (None,)]
    assert panel.select_badge_columns(worn(bare("a"))).columns[:2] == ["i_user_name", "t_timestamp"]


def test_random_list_text_is_read_as_it_was_written(spark):
    """Text of random badge lists against the lists themselves."""
    import random

    random.seed(11)
    letters = list("abc ,:'\"\\{}[]/é\n\t\xa0\x07ß") + ["None", "True", "x41", "u00e9", "\u200b", "😀"]

    def word():
        return "".join(random.choice(letters) for _ in range(random.randrange(6)))

    def badge():
        fields = {"name": word(), "title": word(), "version": random.choice([1, 22, None, word()])}
        return {k: fields[k] for k in fields if random.random() < 0.9} | {"new": True, "icons": [{"id": None}]}

    lists = [[badge() for _ in range(random.randrange(4))] for _ in range(400)]
    table = spark.createDataFrame([(i, str(badges)) for i, badges in enumerate(lists)], "i int, i_badges string")
    for row in legacy.legacy_badge_info(table).collect():
        fields = [[str(b.get(f, "")) for b in lists[row.i]] for f in ("name", "title", "version")]
        assert [row.i_badge_names, row.i_badge_titles, row.i_badge_versions] == [", ".join(f) for f in fields], lists[row.i]
