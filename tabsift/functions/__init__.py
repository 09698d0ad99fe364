from tabsift.functions.columns import (
    closed_right_bin,
    linear_probs,
    pearson,
    ratio,
    round_half_even,
)
from tabsift.functions.pvalues import chi2_sf, f_sf

__all__ = [
    "chi2_sf",
    "closed_right_bin",
    "f_sf",
    "linear_probs",
    "pearson",
    "ratio",
    "round_half_even",
]
