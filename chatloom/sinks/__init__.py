from chatloom.sinks.tables import (
    Inspection,
    inspect,
    register_views,
    write_gold_csv,
    write_gold_parquet,
    write_legacy_csv,
    write_report,
    write_silver,
)

__all__ = [
    "Inspection",
    "inspect",
    "register_views",
    "write_gold_csv",
    "write_gold_parquet",
    "write_legacy_csv",
    "write_report",
    "write_silver",
]
