from earshot.functions.columns import (
    age_group,
    duration_min_sec,
    duration_s,
    flag_to_int,
    is_new_weekly,
    tempo_level,
)

__all__ = [
    "age_group",
    "duration_min_sec",
    "duration_s",
    "flag_to_int",
    "is_new_weekly",
    "tempo_level",
]
