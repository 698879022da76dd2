"""Join helpers for the enrichment side.

Join strategy is not hinted here: AQE re-plans each join from the runtime size
of its shuffled inputs (broadcast below ``spark.sql.adaptive.autoBroadcastJoinThreshold``,
sort-merge or shuffled hash otherwise) and splits skewed partitions of the
streamed side. The helper below covers the one case AQE cannot split: a hot
key on the *right* side of a LEFT join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from .reconcile import _K, _keyed, _null_side, shared_keys


def left_join_split(df: DataFrame, other: DataFrame, df_key: str, other_key: str,
                    shared: DataFrame | None = None) -> DataFrame:
    """``df`` LEFT JOIN ``other`` ON df_key = other_key, same rows, hot keys split on both sides.

    Written as INNER JOIN plus the rows of ``df`` without a partner (LEFT ANTI the
    keys that both sides have): AQE splits either side of the inner join and
    the streamed side of the anti join, and rows with a NULL key spread evenly
    (see ``full_outer_reconcile``). ``shared``: these keys, if the caller has them
    (``shared_keys``). Column names must be disjoint.
    """
    left, right = _keyed(df, df_key, "l"), _keyed(other, other_key, "r")
    if shared is None:
        shared = shared_keys(df.select(df_key), other.select(other_key))
    matched = left.join(right, _K).select(*df.columns, *other.columns)
    alone = left.join(shared, _K, "left_anti").drop(_K)
    return matched.unionByName(_null_side(alone, other))
