"""Column expressions shared by the models."""

from lendscope.functions.banding import (
    age_band,
    credit_limit_band,
    education_level,
    marital_status,
    region,
    sex,
)
from lendscope.functions.masking import mask
from lendscope.functions.rounding import guarded_ratio, round_half_away, round_half_even, to_int_half_even

__all__ = [
    "age_band",
    "credit_limit_band",
    "education_level",
    "guarded_ratio",
    "marital_status",
    "mask",
    "region",
    "round_half_away",
    "round_half_even",
    "sex",
    "to_int_half_even",
]
