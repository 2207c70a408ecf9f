from chatloom.plans.badges import badge_report
from chatloom.plans.gold import build_gold
from chatloom.plans.silver import build_silver, migrate_silver

__all__ = ["badge_report", "build_gold", "build_silver", "migrate_silver"]
