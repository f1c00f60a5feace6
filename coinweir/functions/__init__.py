from coinweir.functions.columns import (
    blank_to_null,
    category_label,
    clock_micros,
    hours_crossed,
    iso_text,
    lit_time,
    major_units,
    month_key,
    month_start,
    month_text,
    partition_number,
    path_date,
    path_id,
    path_month,
    wall_time,
    year_key,
)

__all__ = [
    "blank_to_null",
    "category_label",
    "clock_micros",
    "hours_crossed",
    "iso_text",
    "lit_time",
    "major_units",
    "month_key",
    "month_start",
    "month_text",
    "partition_number",
    "path_date",
    "path_id",
    "path_month",
    "wall_time",
    "year_key",
]
