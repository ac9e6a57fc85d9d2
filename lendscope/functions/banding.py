"""Labels and bands of the borrower dimension.

NULL never matches a condition, so it takes the last label of each column.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Code -> label, and the label of every other code.
SEX_LABELS = {1: "male", 2: "female"}
SEX_OTHER = "unknown"
EDUCATION_LABELS = {1: "graduate_school", 2: "university", 3: "high_school"}
EDUCATION_OTHER = "other_unknown"
MARITAL_LABELS = {1: "married", 2: "single", 3: "other"}
MARITAL_OTHER = "unknown"

# Exclusive upper edge -> band, and the band above the last edge.
AGE_EDGES = {30: "<30", 40: "30-39", 50: "40-49", 60: "50-59"}
AGE_TOP = "60+"
LIMIT_EDGES = {50_000: "<50k", 150_000: "50k-150k", 300_000: "150k-300k"}
LIMIT_TOP = "300k+"

# Remainder of the client id by 4 -> region.
REGION_LABELS = {0: "north", 1: "south", 2: "east"}
REGION_OTHER = "west"
REGIONS = ("north", "south", "east", "west")


def _first_match(branches: list[tuple[Column, str]], other: str) -> Column:
    start = F.when(*branches[0])
    return reduce(lambda chain, branch: chain.when(*branch), branches[1:], start).otherwise(other)


def _label(code: Column, labels: dict[int, str], other: str) -> Column:
    return _first_match([(code == key, text) for key, text in labels.items()], other)


def _band(value: Column, edges: dict[int, str], top: str) -> Column:
    return _first_match([(value < edge, text) for edge, text in edges.items()], top)


def sex(code: Column) -> Column:
    return _label(code, SEX_LABELS, SEX_OTHER)


def education_level(code: Column) -> Column:
    return _label(code, EDUCATION_LABELS, EDUCATION_OTHER)


def marital_status(code: Column) -> Column:
    return _label(code, MARITAL_LABELS, MARITAL_OTHER)


def age_band(age: Column) -> Column:
    return _band(age, AGE_EDGES, AGE_TOP)


def credit_limit_band(limit: Column) -> Column:
    return _band(limit, LIMIT_EDGES, LIMIT_TOP)


def region(client_id: Column) -> Column:
    """Region by remainder; 3, negative remainders and NULL are all the last one."""
    return _label(client_id % 4, REGION_LABELS, REGION_OTHER)
