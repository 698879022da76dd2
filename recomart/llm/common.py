"""Helpers shared by the operators: text access, whole-group streams, hot-key
splitting, local union-find and distributed connected components."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: ASCII white space that separates words everywhere in this subpackage
#: (``bytes.split()`` splits on exactly these).
WORD = r"[^\x20\x09-\x0D]+"


#: Folder that holds the package.
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def workers_find_package(spark: SparkSession) -> None:
    """Let Python workers import the package from where the driver has it, whatever folder the driver
    was started in. It matters on one machine or a shared installation; elsewhere the package is
    shipped as usual (``--py-files``)."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])


def map_arrow(df: DataFrame, run: Callable, schema) -> DataFrame:
    """``df.mapInArrow`` with workers that can import this package."""
    workers_find_package(df.sparkSession)
    return df.mapInArrow(run, schema)


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and cut its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def as_bytes(col: pa.Array) -> list:
    """UTF-8 bytes (or None) of a string column, without decoding."""
    kind = pa.large_binary() if pa.types.is_large_string(col.type) else pa.binary()
    return col.cast(kind).to_pylist()


def held_out(key: str, modulus: int, remainder: int) -> Column:
    """TRUE where crc32(key as text) mod ``modulus`` is ``remainder``; a NULL key counts as FALSE."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % F.lit(modulus) == F.lit(remainder), F.lit(False))


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str], rows: int) -> Iterator[pa.Table]:
    """Tables of about ``rows`` rows that never cut a group; batches come sorted by ``keys``."""
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        count += batch.num_rows
        if count < rows:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        starts = group_starts(table, keys)
        last = int(starts[-1])
        if last:
            yield table.slice(0, last)
            table = pa.concat_tables([table.slice(last)]).combine_chunks()
        held, count = table.to_batches(), table.num_rows
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def group_starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Row numbers at which a new key begins."""
    change = np.zeros(table.num_rows, dtype=bool)
    change[0] = True
    for k in keys:
        v = table[k].to_numpy()
        change[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(change)


def split_hot(entries: DataFrame, key: str, row_id: str, block_rows: int) -> DataFrame:
    """Cut the buckets of ``entries`` into comparison units of at most about ``2 * block_rows`` rows.

    A bucket of n rows has ceil(n / block_rows) blocks; a row's block is a hash
    of ``row_id``. Each unordered pair of blocks is a unit ``__unit``
    (low block * 2^31 + high block), so every two rows of a bucket meet in
    exactly one unit and no task ever holds a whole hot bucket. Adds
    ``__block`` and ``__unit``; buckets of one row are dropped.
    """
    size = entries.groupBy(key).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")
    blocks = F.ceil(F.col("__n") / F.lit(block_rows)).cast("long")
    e = entries.join(size, key).withColumn("__blocks", blocks).drop("__n")
    e = e.withColumn("__block", F.pmod(F.xxhash64(row_id), F.col("__blocks")))
    e = e.withColumn("__other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__blocks") - 1)))
    unit = F.least("__block", "__other") * F.lit(1 << 31) + F.greatest("__block", "__other")
    return e.withColumn("__unit", unit).drop("__other", "__blocks")


def find_roots(parent: np.ndarray) -> np.ndarray:
    """Pointer jumping until every entry of ``parent`` is a root."""
    while True:
        up = parent[parent]
        if np.array_equal(up, parent):
            return parent
        parent = up


def union(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``parent`` (all roots) after joining the sets of a[i] and b[i]; the smallest index is the root."""
    while len(a):
        ra, rb = parent[a], parent[b]
        differ = ra != rb
        if not differ.any():
            break
        a, b, ra, rb = a[differ], b[differ], ra[differ], rb[differ]
        np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))
        parent = find_roots(parent)
    return parent


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable from each id that has an edge.

    ``edges`` has long columns ``a`` and ``b``. Alternating large-star and
    small-star rounds (Kiveris et al., 2014): minima are partially aggregated
    before each shuffle, the rows of a hub are joined to its one minimum (a
    join that AQE can split), and each round is written to the checkpoint
    folder. Only a row count and a checksum reach the driver. Ends when a round
    leaves the edges unchanged; every edge then points at its component's
    smallest id.
    """
    e = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = _checksum(e)
    while seen[0]:
        e = cut(_star(_star(e, large=True), large=False))
        now = _checksum(e)
        if now == seen:
            break
        seen = now
    return (e.select(F.col("a").alias("id"), F.col("b").alias("component"))
            .unionByName(e.select(F.col("b").alias("id"), F.col("b").alias("component"))).distinct())


def _star(e: DataFrame, large: bool) -> DataFrame:
    """One round over edges (a > b): neighbours of each node are linked to its smallest neighbour or itself."""
    if large:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        out = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # a node's own edge to its minimum is kept so that no set is torn apart
        out = out.unionByName(low.where("m < a").select("a", F.col("m").alias("b")))
    else:
        low = e.groupBy("a").agg(F.min("b").alias("m"))
        out = e.join(low, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        out = out.unionByName(low.select("a", F.col("m").alias("b")))
    return out.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _checksum(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())
