"""Lateral unnest of nested columns.

J1: ``LEFT JOIN UNNEST(person_id.email) AS e ... WHERE e.primary = TRUE`` keeps
only rows with a primary element, so it is an inner explode of the filtered
array (Spark keeps ``Generate outer=true`` under such a filter, so we write the
inner form ourselves). Two primary elements give two rows.
J2: ``LEFT JOIN UNNEST(arr) AS x`` keeps the parent row when the array is NULL
or empty (x NULL): ``explode_outer``. J3 adds the element offset.
All are narrow (no shuffle): Generate runs inside the scan stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def primary_elements(arr: Column, flag: str = "primary") -> Column:
    """Elements whose ``flag`` field is TRUE (NULL flag counts as not primary)."""
    return F.filter(arr, lambda e: e[flag])


def explode_primary(df: DataFrame, array_path: str = "person_id.email", value_field: str = "value",
                    out: str = "email", flag: str = "primary", with_offset: str | None = None) -> DataFrame:
    """J1 (+J3): one row per primary element; ``out`` = element[value_field]."""
    elems = primary_elements(F.col(array_path), flag)
    if with_offset:
        exploded = df.select("*", F.posexplode(elems).alias(with_offset, "__elem"))
    else:
        exploded = df.select("*", F.explode(elems).alias("__elem"))
    return exploded.withColumn(out, F.col("__elem")[value_field]).drop("__elem")


def explode_keep_empty(df: DataFrame, array_col: str, out: str, with_offset: str | None = None) -> DataFrame:
    """J2 (+J3): one row per element; a NULL/empty array gives one row with NULL."""
    if with_offset:
        return df.select("*", F.posexplode_outer(array_col).alias(with_offset, out))
    return df.select("*", F.explode_outer(array_col).alias(out))
