"""A1-A3: string aggregation, re-grouping and distinct pairs.

A1+A2 in the source: unnest a city array (one row per city), then GROUP BY all
other columns with STRING_AGG(city). Grouping the *exploded* rows ships every
row once per city through the shuffle. We group the *unexploded* rows instead
and merge their (non-NULL) city arrays: same groups (all grouping columns are
per-row), same multiset of cities per group, fewer shuffled rows. The collect is
partially aggregated map-side; the merged list per group is exactly what the
output string holds. Result order is sorted (the source leaves it
unspecified), NULL when the group has no city -- as STRING_AGG, not ''.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def non_null_elements(arr: Column) -> Column:
    """Elements that are not NULL; a NULL array counts as empty."""
    return F.filter(F.coalesce(arr, F.array().cast("array<string>")), lambda x: x.isNotNull())


def joined_or_null(arr: Column, sep: str = ",") -> Column:
    """Sorted, ``sep``-joined; NULL for an empty list."""
    return F.when(F.size(arr) > 0, F.array_join(F.array_sort(arr), sep))


def regroup_string_agg(df: DataFrame, keys: list[Column | str], array_col: str, out: str,
                       sep: str = ",") -> DataFrame:
    """GROUP BY ``keys`` with STRING_AGG over the elements of ``array_col`` of every row."""
    per_row = "__agg_elems"
    staged = df.withColumn(per_row, non_null_elements(F.col(array_col)))
    grouped = staged.groupBy(*keys).agg(F.flatten(F.collect_list(per_row)).alias(per_row))
    return grouped.withColumn(out, joined_or_null(F.col(per_row), sep)).drop(per_row)


def string_agg(col: str, sep: str = ",") -> Column:
    """A1 as an aggregate over already-exploded rows: sorted, NULLs skipped, NULL if none."""
    return F.expr(f"listagg({col}, '{sep}') WITHIN GROUP (ORDER BY {col})")


def distinct_pairs(df: DataFrame, *cols: str) -> DataFrame:
    """A3: SELECT DISTINCT cols (hash aggregate with map-side pre-aggregation)."""
    return df.select(*cols).distinct()
