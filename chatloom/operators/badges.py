"""Badge statistics on the panel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatloom.functions.columns import badge_count

USER = "i_user_name"


def with_badge_count(panel: DataFrame, missing: int = -1) -> DataFrame:
    """Add ``badges_count``; ``missing`` stands for a row without badge list."""
    count = badge_count(F.col("i_badge_names"))
    if missing != -1:
        count = F.when(count == -1, F.lit(missing)).otherwise(count)
    return panel.withColumn("badges_count", count)


def clean_badge_count(counted: DataFrame) -> DataFrame:
    """Add ``badges_count_tf``: as ``badges_count``, but 0 for rows without badge list."""
    absent = F.col("i_badge_names").isNull()
    return counted.withColumn("badges_count_tf", F.when(absent, F.lit(0)).otherwise(F.col("badges_count")))


def users_with_badges_over(chat: DataFrame, n: int) -> DataFrame:
    """Messages whose author wears more than ``n`` badges."""
    badges = F.col("author.badges")
    total = F.when(badges.isNull(), F.lit(0)).otherwise(F.size(badges))
    return chat.select(
        F.col("author.id").alias("i_user_id"),
        F.col("author.name").alias("i_username"),
        total.alias("tot_badges"),
    ).filter(F.col("tot_badges") > n)


def distinct_users(panel: DataFrame) -> DataFrame:
    """Distinct user names."""
    return panel.select(USER).distinct()


def _some_users_without_badges(counted: DataFrame, users: int) -> DataFrame:
    """The first ``users`` names, in name order, with a row that has no badge list."""
    bare = distinct_users(counted.filter(F.col("badges_count") == -1))
    return bare.orderBy(F.col(USER).asc_nulls_last()).limit(users)


def _most_badges(counted: DataFrame, k: int) -> DataFrame:
    """The first k rows by badge count, ties broken by all output columns."""
    columns = [USER, "i_badge_names", "i_badge_titles", "i_badge_versions"]
    ties = [F.col(c).asc_nulls_last() for c in columns]
    return counted.orderBy(F.col("badges_count").desc(), *ties).limit(k).select(*columns)


def badges_of_users_without_badges(counted: DataFrame, k: int = 10, users: int = 10) -> DataFrame:
    """Rows of some users who appear without badges, most badges first."""
    chosen = _some_users_without_badges(counted, users)
    return _most_badges(counted.join(chosen, USER, "left_semi"), k)


def badges_of_users_or_not(counted: DataFrame, user: str, k: int = 10, users: int = 10) -> DataFrame:
    """As above, but rows of anybody other than ``user`` count as well."""
    chosen = _some_users_without_badges(counted, users).withColumn("_chosen", F.lit(True))
    marked = counted.join(chosen, USER, "left")
    return _most_badges(marked.filter(F.col("_chosen") | (F.col(USER) != user)), k)


def max_badges_per_user(cleaned: DataFrame) -> DataFrame:
    """Highest cleaned badge count of each user name, highest first."""
    return (
        cleaned.groupBy(USER)
        .agg(F.max("badges_count_tf").alias("badge_count"))
        .orderBy(F.col("badge_count").desc(), F.col(USER).asc_nulls_last())
    )


def _users_per_count(per_user: DataFrame) -> DataFrame:
    """Per badge count: named users, and all groups including the one without a name."""
    return per_user.groupBy("badge_count").agg(
        F.count(USER).alias("users_volume_count"), F.count(F.lit(1)).alias("_groups")
    )


def _distribution(counts: DataFrame, total: Column) -> DataFrame:
    return counts.select(
        F.col("badge_count").alias("number_of_badges_per_user"),
        "users_volume_count",
        F.round(100 * F.col("users_volume_count") / total, 2).alias("users_volume_percentage"),
    ).orderBy("number_of_badges_per_user")


def badge_distribution(per_user: DataFrame) -> DataFrame:
    """Users per badge count and their share of all users, from :func:`max_badges_per_user`.

    The group without a name is not counted as a user but is part of the whole, so the shares
    may add up to less than 100. The total is a window over the finished counts, one row per
    badge count, so the panel is read once.
    """
    return _distribution(_users_per_count(per_user), F.sum("_groups").over(Window.partitionBy()))


def badge_distribution_subquery(per_user: DataFrame) -> DataFrame:
    """The same result with the total as a scalar subquery.

    It adds up the counts rather than the users, so both sides share one shuffle of the users.
    """
    counts = _users_per_count(per_user)
    return _distribution(counts, counts.select(F.sum("_groups")).scalar())


def _frequency(panel: DataFrame, column: str, alias: str, mode: str) -> DataFrame:
    """Uses per value of one badge array.

    ``zip`` counts a badge once per row that wears it. ``cross`` counts what exploding names,
    titles and versions one after the other counts: each value once per combination of the
    other two, which is a product of sizes and needs no such rows.
    """
    others = [c for c in ("i_badge_names", "i_badge_titles", "i_badge_versions") if c != column]
    if mode == "zip":
        values = panel.select(F.explode(column).alias(alias), F.lit(1).cast("bigint").alias("_uses"))
    elif mode == "cross":
        product = F.size(others[0]).cast("bigint") * F.size(others[1])
        values = panel.filter(product > 0).select(F.explode(column).alias(alias), product.alias("_uses"))
    else:
        raise ValueError(f"mode must be 'zip' or 'cross', not {mode!r}")
    uses = F.when(F.col(alias).isNotNull(), F.col("_uses")).otherwise(F.lit(0))
    return (
        values.groupBy(alias)
        .agg(F.sum(uses).alias("tot_count"))
        .orderBy(F.col("tot_count").desc(), F.col(alias).asc_nulls_last())
    )


def badge_name_frequency(panel: DataFrame, mode: str = "zip") -> DataFrame:
    """Uses per badge name, most used first. NULL is a group of its own with count 0."""
    return _frequency(panel, "i_badge_names", "badge_names", mode)


def badge_title_frequency(panel: DataFrame, mode: str = "zip") -> DataFrame:
    """Uses per badge title, most used first. NULL is a group of its own with count 0."""
    return _frequency(panel, "i_badge_titles", "badge_titles", mode)


def distinct_badges(panel: DataFrame) -> DataFrame:
    """Number of distinct badge names and titles; NULL counts as one of each.

    Equal badges are merged before the shuffle; only the few distinct ones are counted.
    """
    badges = panel.select(F.inline(F.arrays_zip("i_badge_names", "i_badge_titles")))
    seen = badges.toDF("name", "title").distinct()
    missing = {c: F.coalesce(F.bool_or(F.col(c).isNull()), F.lit(False)).cast("bigint") for c in seen.columns}
    return seen.agg(
        (F.count_distinct("name") + missing["name"]).alias("distinct_names"),
        (F.count_distinct("title") + missing["title"]).alias("distinct_titles"),
    )
