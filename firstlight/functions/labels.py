"""Texts of the result rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Ids and display names of the KPI rows.
KPI_NAMES = {"dau": "新增日活", "new_mid": "新增设备"}

# Age bands and gender names of the shares.
AGE_UNDER_20 = "20岁以下"
AGE_20_TO_30 = "20-30岁"
AGE_OVER_30 = "30岁以上"
GENDER_NAMES = {"M": "男", "F": "女"}

# Edges of the six colour bands of the regional map.
REGION_SPLITS = (0, 100, 200, 300, 400, 500, 600)

# Page sizes offered by the order grid, and its default date.
PAGE_SIZES = (10, 20, 50, 100)
DEFAULT_SALE_DATE = "2019-03-04"


def age_band(age: Column) -> Column:
    """Under 20, 20 to 30 inclusive, over 30; NULL stays NULL."""
    return (
        F.when(age < 20, AGE_UNDER_20).when(age <= 30, AGE_20_TO_30).when(age > 30, AGE_OVER_30)
    )


def gender_name(gender: Column) -> Column:
    return F.when(gender == "M", GENDER_NAMES["M"]).when(gender == "F", GENDER_NAMES["F"])


def thousands(n: Column) -> Column:
    """A count as shown on a tile: 2702 as 2,702."""
    return F.format_number(n, 0)
