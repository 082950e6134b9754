from pulsekit.functions.columns import (
    count_nonnull_if,
    safe_div,
    round_half_even,
    ts_literal,
    time_range,
    day_range,
    quarter_hour,
    hour_minute,
    fmt_fixed,
    fmt_percent,
)
from pulsekit.functions.hashing import md5_mod, ab_split, uniform01, hash_bucket
from pulsekit.functions.stats import (
    t_two_sided_p,
    normal_two_sided_p,
    welch_columns,
    poisson_draw,
)
