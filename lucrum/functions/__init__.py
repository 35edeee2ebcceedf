"""Scalar column functions (money, time, paths)."""
from .money import difference, money_round, nullif_zero, safe_ratio, times, to_money  # noqa: F401
from .paths import date_from_path, partition_parts, window_label  # noqa: F401
from .time import (day_floor, default, earliest, format_ts, local_date_of,  # noqa: F401
                   month_start, parse_instant, plus_days)
