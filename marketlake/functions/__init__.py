"""Column-expression functions: text cleaning, boundary date math, exact rounding."""

from marketlake.functions.dates import (add_days, add_minutes, date_from_key, date_key,
                                        day_diff, day_name, is_weekend, minute_diff,
                                        month_diff, month_name, month_start, us_week,
                                        weekday_mon0, year_month)
from marketlake.functions.nulls import (eq_flag, ne_flag, null_if_negative,
                                        null_if_nonpositive, null_if_sentinel)
from marketlake.functions.numeric import (MONEY, half_up_ratio, money, money_mean,
                                          unscaled)
from marketlake.functions.text import (ACCENTED, PLAIN, default_unknown, fold_accents,
                                       text_len, trim_lower, trim_upper, untrimmed)

__all__ = [n for n in dir() if not n.startswith("_")]
