"""Look-up of a text in a dictionary table by a join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A dictionary of at most so many entries is sent to every task; a longer one is left to the planner.
BROADCAST_ENTRIES = 10_000

_KEY, _VALUE = "__dict_key", "__dict_value"


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def with_lookup(df: DataFrame, key: str, pairs: Sequence[tuple[str, str]], out: str, then=None) -> DataFrame:
    """``df`` with ``out``: the value of the entry whose key equals ``key`` (code point for code point), or NULL.

    ``then(found)`` turns the found value into the final expression. One hash probe a row; the dictionary
    is part of the query text, so its size is known and checked. Keys must be distinct, so that no
    row is repeated."""
    if len({k for k, _ in pairs}) != len(pairs):
        raise ValueError("a key occurs twice in the dictionary")
    found: Column = F.col(_VALUE)
    if pairs:
        rows = ", ".join(f"({_literal(k)}, {_literal(v)})" for k, v in pairs)
        table = df.sparkSession.sql(f"SELECT * FROM VALUES {rows} AS t({_KEY}, {_VALUE})")
        if len(pairs) <= BROADCAST_ENTRIES:
            table = F.broadcast(table)
        joined = df.join(table, F.col(key) == F.col(_KEY), "left")
    else:
        joined, found = df, F.lit(None).cast("string")
    return joined.withColumn(out, then(found) if then else found).drop(_KEY, _VALUE)
