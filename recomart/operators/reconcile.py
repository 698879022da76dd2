"""Full outer reconciliation of two sources on one key (N:M kept).

``left FULL OUTER JOIN right`` is written as three joins Spark can split when a key
is hot, which it cannot do for FULL OUTER itself:

* matched pairs: ``left INNER JOIN right``; AQE splits a skewed partition of either side;
* rows of either side without a partner: that side LEFT ANTI the keys that both sides have. These
  come from one table of keys with a bit per side (partially aggregated ``bit_or``), so both anti
  joins read the same small exchange; AQE splits the streamed side.

The joins use one text key per row that is never NULL: the key behind ``=``, or for a NULL
key a side tag and a hash of the row. So NULL keys match nothing, spread evenly and
need no branch of their own, and as no NULL filter separates the branches, each
side's exchange is the same plan in both of its uses and is computed once (Spark
reuses it). There is one plan at every size: no thresholds, no caps, no list of hot keys,
no job while the plan is built. The keys may come from a cheaper source than the side itself.
(Identical rows with a NULL key share one hash. They are still split, as AQE splits the streamed side of a
join by rows of map tasks, not by key.)

Output = the same multiset of rows as ``left.join(right, lk == rk, "full")`` for keys of
string, integer, date or boolean type.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_K = "__rk_key"


def _null_side(df: DataFrame, like: DataFrame) -> DataFrame:
    """Rows of ``df`` padded with typed NULL columns of ``like``."""
    simple = all(not isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)) for f in like.schema.fields)
    if simple:  # one parsed projection
        pads = [f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name.replace('`', '``')}`"
                for f in like.schema.fields]
        return df.selectExpr("*", *pads)
    return df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in like.schema.fields])


def _matching(key: Column) -> Column:
    return F.concat(F.lit("="), key.cast("string"))


def _keyed(df: DataFrame, key: str, side: str, spread: Sequence[str] | None = None) -> DataFrame:
    """``df`` plus the join key; a NULL key becomes the side's tag and a hash of the row, or of its columns ``spread``."""
    hashed = [F.col(f"`{f.name}`") for f in df.schema.fields
              if (spread is None or f.name in spread) and "map<" not in f.dataType.simpleString()]
    alone = F.concat(F.lit(side), F.xxhash64(*hashed).cast("string"))
    return df.withColumn(_K, F.coalesce(_matching(F.col(key)), alone))


def shared_keys(left_keys: DataFrame, right_keys: DataFrame) -> DataFrame:
    """The join keys that both one-column inputs have, from one table of keys with a bit per side."""
    def side(keys: DataFrame, bit: int) -> DataFrame:
        col = F.col(keys.columns[0])
        return keys.where(col.isNotNull()).select(_matching(col).alias(_K), F.lit(bit).alias("__bit"))

    presence = side(left_keys, 1).unionAll(side(right_keys, 2)).groupBy(_K).agg(F.bit_or("__bit").alias("__bits"))
    return presence.where("__bits = 3").select(_K)


def without_shared(df: DataFrame, key: str, shared: DataFrame) -> DataFrame:
    """Rows whose key is NULL or not among ``shared``."""
    return _keyed(df, key, "r").join(shared, _K, "left_anti").drop(_K)


def reconcile_parts(left: DataFrame, right: DataFrame, left_key: str, right_key: str, *,
                    left_keys: DataFrame | None = None, right_keys: DataFrame | None = None,
                    left_spread: Sequence[str] | None = None,
                    right_spread: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three parts of ``full_outer_reconcile``: matched pairs, rows of ``left`` alone and rows of ``right`` alone,
    all with the columns of both sides."""
    overlap = set(left.columns) & set(right.columns)
    if overlap:
        raise ValueError(f"column names must be disjoint, both sides have {sorted(overlap)}")
    cols = left.columns + right.columns
    lt, rt = _keyed(left, left_key, "l", left_spread), _keyed(right, right_key, "r", right_spread)
    shared = shared_keys(left.select(left_key) if left_keys is None else left_keys,
                         right.select(right_key) if right_keys is None else right_keys)
    # one narrow row per key: looked up in a hash table, so the wide rows are sorted for the inner join only
    shared = shared.hint("shuffle_hash")
    matched = lt.join(rt, _K).select(*cols)
    left_only = _null_side(lt.join(shared, _K, "left_anti").drop(_K), right)
    right_only = _null_side(rt.join(shared, _K, "left_anti").drop(_K), left)
    return matched, left_only, right_only


def full_outer_reconcile(left: DataFrame, right: DataFrame, left_key: str, right_key: str, *,
                         left_keys: DataFrame | None = None, right_keys: DataFrame | None = None,
                         left_spread: Sequence[str] | None = None, right_spread: Sequence[str] | None = None) -> DataFrame:
    """``left`` FULL OUTER JOIN ``right`` ON left_key = right_key, skew-safe.

    Column names of the two sides must be disjoint. ``left_keys`` / ``right_keys``:
    optional one-column DataFrames with exactly the side's set of keys, for sides
    whose keys are known before a long join chain. ``left_spread`` / ``right_spread``: columns by which
    the rows with a NULL key are dealt, instead of all (which then all have to be read and carried up to here).
    """
    matched, left_only, right_only = reconcile_parts(
        left, right, left_key, right_key, left_keys=left_keys, right_keys=right_keys, left_spread=left_spread,
        right_spread=right_spread)
    return matched.unionByName(left_only).unionByName(right_only)
