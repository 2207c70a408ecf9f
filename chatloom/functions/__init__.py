from chatloom.functions.columns import (
    badge_count,
    badge_field,
    chat_file_name,
    chat_file_tokens,
    micros_to_timestamp,
    percentage,
    safe_title,
    user_status_placeholder,
)
from chatloom.functions.frames import numbered, parse_years, year_frame

__all__ = [
    "badge_count",
    "badge_field",
    "chat_file_name",
    "chat_file_tokens",
    "micros_to_timestamp",
    "numbered",
    "parse_years",
    "percentage",
    "safe_title",
    "user_status_placeholder",
    "year_frame",
]
