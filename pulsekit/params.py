"""Job parameters.

The reference evaluated ``today()`` / ``now()`` on its server; here every job
takes an explicit ``as_of`` so re-runs are deterministic.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Params:
    # report day: "yesterday" is as_of - 1, the trailing week is as_of-7 .. as_of-1
    as_of: dt.date = dt.date(2024, 1, 15)
    # wall clock of the alert run; the open 15-minute bucket is excluded
    as_of_ts: dt.datetime = dt.datetime(2024, 1, 15, 11, 7, 0)
    # experiment window (inclusive days)
    exp_start: dt.date = dt.date(2024, 1, 1)
    exp_end: dt.date = dt.date(2024, 1, 30)
    # salted split
    split_salt: str = "exp_mess_1"
    split_groups: int = 5
    # anomaly band
    band_a: float = 3.0
    band_n: int = 5
    # smoothing / buckets / resampling
    smooth_alpha: float = 5.0
    n_buckets: int = 50
    bucket_quantile: float = 0.9
    n_bootstrap: int = 2000
    n_aa_sims: int = 10000
    # resampled histories of the daily view counts
    n_day_reps: int = 50
    # users drawn from each group in an A/A run
    aa_sample_size: int = 500
    # at most this share of the smaller group, for tables whose groups are smaller
    aa_most_share: float = 0.6
    n_pair_draws: int = 10000
    alpha: float = 0.05
    seed: int = 20240115
    hist_bins: int = 20
    # experiment comparisons used by the notebooks
    aa_groups: tuple = (2, 3)
    ab_groups: tuple = (1, 2)
    welch_pairs: tuple = ((2, 3), (1, 2), (0, 3))
    lin_pairs: tuple = ((0, 3), (1, 2))
    # control group whose global CTR linearizes each group
    lin_control: dict = field(default_factory=lambda: {0: 0, 3: 0, 1: 1, 2: 1})


DEFAULT_PARAMS = Params()
