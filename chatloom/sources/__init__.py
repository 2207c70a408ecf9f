from chatloom.sources.catalog import read_catalog
from chatloom.sources.chat import broken_files, is_blank, list_files, list_raw_files, read_chat, with_file_metadata
from chatloom.sources.panels import read_gold, read_gold_csv, read_ledger, read_legacy_panel, read_silver

__all__ = [
    "broken_files",
    "is_blank",
    "list_files",
    "list_raw_files",
    "read_catalog",
    "read_chat",
    "read_gold",
    "read_gold_csv",
    "read_ledger",
    "read_legacy_panel",
    "read_silver",
    "with_file_metadata",
]
