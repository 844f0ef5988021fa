from martloom.functions.dates import (
    as_of_date, date_key, day_window, month_start, month_window, next_month, ym, ym_back,
)
from martloom.functions.numbers import AMOUNT, divide, parse_number
from martloom.functions.text import collate_text, concat_blank, fold_key, trimmed

__all__ = [
    "AMOUNT", "as_of_date", "collate_text", "concat_blank", "date_key", "day_window",
    "divide", "fold_key", "month_start", "month_window", "next_month", "parse_number",
    "trimmed", "ym", "ym_back",
]
