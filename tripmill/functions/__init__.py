from tripmill.functions.clock import (
    in_own_month,
    local_to_instant,
    month_text,
    seconds_between,
    weekday_name,
    weekday_number,
)
from tripmill.functions.identity import IDENTITY_COLUMNS, derived_id, instant_text, trip_id
from tripmill.functions.numbers import (
    half_away,
    mean_decimal,
    mean_minutes,
    round_half_away,
    exact_mean,
    exact_sum,
    settled,
    share_pct,
    to_integer,
    to_money,
)

__all__ = [
    "IDENTITY_COLUMNS",
    "derived_id",
    "half_away",
    "in_own_month",
    "instant_text",
    "local_to_instant",
    "mean_decimal",
    "mean_minutes",
    "month_text",
    "round_half_away",
    "seconds_between",
    "exact_mean",
    "exact_sum",
    "settled",
    "share_pct",
    "to_integer",
    "to_money",
    "trip_id",
    "weekday_name",
    "weekday_number",
]
