"""Gold panel to badge distribution."""

from pyspark.sql import DataFrame

from chatloom.operators.badges import badge_distribution, clean_badge_count, max_badges_per_user, with_badge_count
from chatloom.operators.panel import select_badge_columns


def badge_report(panel: DataFrame) -> DataFrame:
    """Users per badge count, from panel rows to report in one plan."""
    counted = clean_badge_count(with_badge_count(select_badge_columns(panel)))
    return badge_distribution(max_badges_per_user(counted))
