"""Column-level functions: pure expressions, no shuffles."""

from panelcast.functions.text import (coerce_numeric, null_sentinels, parse_day_first,
                                      split_list, strip, title_case)
from panelcast.functions.calendar import (first_of_month, month_cos, month_sin,
                                          season_four_way, season_two_way)

__all__ = ["coerce_numeric", "null_sentinels", "parse_day_first", "split_list", "strip",
           "title_case", "first_of_month", "month_cos", "month_sin", "season_four_way",
           "season_two_way"]
