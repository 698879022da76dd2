"""Exact top-k inner-product search with MaxScore.

Vectors become integer term weights; a dimension is a term, and what a candidate adds to a query's
score there is its contribution. Queries are dealt into blocks and candidates into lanes; a
(block, lane) unit is one piece of work. A unit holds its queries and reads its candidates in
shards of ``SHARD_ROWS`` rows, so neither side is broadcast and no task holds more than a block and a
shard. Lanes and blocks grow with the tables up to a bound, so the copies made for dealing
stay few: at 10^8 rows, of which one in 50 is a query, a row is dealt to 31 blocks and a query to 1526 lanes.

Per shard, each term has a posting list: the candidates ordered by weight, read from the end that
adds most for the sign of the query's weight. For each query:

* Terms are taken in order of their bounds, the most that any candidate of the shard can add. The
  longest tail of terms whose bounds together stay below the threshold (the k-th best
  score of the unit so far) is non-essential: no candidate enters the result by it alone.
* Essential postings are traversed by falling contribution, to the depth at which a candidate not met yet
  cannot reach the threshold any more (the contributions at that depth and the bounds of the tail together).
* Candidates met are probed in the other terms, a few at a time, only while their score so far plus the
  remaining bounds reaches the threshold.

The threshold rises with every shard. Candidates that tie with it stay, as ties go to the
smaller id. The lanes' lists are merged by a ranked window over k rows per query and lane.

Sums of products below 2^53 are computed in doubles, which is exact; vectors with larger weights are
scored in whole numbers of any size. Defined results: vectors that are NULL or hold NULL or
non-finite components, and rows with a NULL id take no part; vectors of different
lengths do not meet; equal rows count once; an id with several vectors gets one list; a query with fewer candidates gets them all; scores beyond a long
are ranked exactly and returned as the nearest long. An empty table gives no rows; further columns
play no part.
"""

from __future__ import annotations

import heapq
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

SHARD_ROWS = 4096
LANE_ROWS = 1 << 16    # candidates of a lane once there are MANY_LANES
MANY_LANES = 16
BLOCK_QUERIES = 1 << 16
DEPTHS = (16, 64, 256, 1024)  # of a shard's postings, before all are read
PROBE_TERMS = 8
HUGE = 2.0 ** 1000     # a larger component may leave the doubles when scaled: it is sent unscaled
UNIT = ["dim", "block", "lane"]


def integers(vectors: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """(id, dim, huge, w array<double>) of the usable vectors, each once: w = floor(scale * component), or the
    components themselves in vectors marked ``huge``."""
    v = F.col("vec")
    fine = F.forall(v, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec")).where(
        F.col("id").isNotNull() & v.isNotNull()).where(fine)

    def whole(x):
        y = x * F.lit(float(scale))
        return F.when(F.abs(y) < 2.0 ** 53, F.floor(y).cast("double")).otherwise(y)  # larger doubles are whole

    huge = F.exists(v, lambda x: F.abs(x) > HUGE)
    w = F.when(huge, v).otherwise(F.transform(v, whole))
    return rows.select("id", F.size(v).alias("dim"), huge.alias("huge"), w.alias("w")).distinct()


class Shard:
    """Candidates of one shard, sorted by id, with bounds and posting lists of every term."""

    def __init__(self, x: np.ndarray, ids: np.ndarray):
        self.x, self.ids = x, ids
        self.columns = np.ascontiguousarray(x.T)
        self.posting = np.argsort(self.columns, axis=1, kind="stable")     # rising weight
        self.ranked = np.take_along_axis(self.columns, self.posting, axis=1)
        self.depths = [d for d in DEPTHS if d < len(x)]

    def bounds(self, q: np.ndarray) -> np.ndarray:
        return np.maximum(q * self.ranked[:, 0], q * self.ranked[:, -1])

    def met(self, q: np.ndarray, terms: np.ndarray, tail: float, threshold: float) -> np.ndarray | None:
        """Candidates met in the postings of the essential ``terms`` before no other can reach the threshold
        any more; None if that takes all."""
        up = q[terms] > 0
        for d in self.depths:
            at = np.where(up, len(self.x) - 1 - d, d)
            if float((q[terms] * self.ranked[terms, at]).sum()) + tail < threshold:
                lists = [self.posting[t, -d:] if u else self.posting[t, :d] for t, u in zip(terms.tolist(), up.tolist())]
                return np.unique(np.concatenate(lists))
        return None

    def search(self, q: np.ndarray, threshold: float | None, own: int):
        """(rows, scores) of candidates that may enter the result of a query with id ``own``."""
        bound = self.bounds(q)
        order = np.argsort(-bound, kind="stable")
        tail = np.concatenate((np.cumsum(bound[order][::-1])[::-1], [0]))    # tail[j]: terms j and later
        dim, essential = len(q), len(q)
        if threshold is not None and (tail < threshold).any():
            essential = int(np.argmax(tail < threshold))
        terms, alive = order[:essential], None
        if threshold is not None:
            if not essential:
                return np.zeros(0, np.int64), np.zeros(0)
            alive = self.met(q, terms, tail[essential], threshold)
        if alive is None:
            alive = np.arange(len(self.x))
            score = q[terms] @ self.columns[terms] if essential else np.zeros(len(self.x))
        else:
            score = self.x[alive][:, terms] @ q[terms]
        if threshold is not None:
            keep = score + tail[essential] >= threshold
            alive, score = alive[keep], score[keep]
        for j in range(essential, dim, PROBE_TERMS):
            if not len(alive):
                break
            terms = order[j:j + PROBE_TERMS]
            score = score + q[terms] @ self.columns[terms][:, alive]
            keep = score + tail[min(j + PROBE_TERMS, dim)] >= threshold
            alive, score = alive[keep], score[keep]
        mine = self.ids[alive] != own
        return alive[mine], score[mine]


class Unit:
    """The queries of a block and their best candidates so far; ``add`` reads one shard after the other."""

    def __init__(self, ids: np.ndarray, huge: np.ndarray, w: np.ndarray, k: int, scale: int):
        self.ids, self.k, self.scale, self.dim = ids, k, scale, w.shape[1]
        self.limit = float(np.floor(np.sqrt(2.0 ** 53 / max(self.dim, 1)))) - 1.0  # products of smaller weights are exact
        self.small = self._small(huge, w)
        self.w, self.exact = w, {i: self._whole(huge[i], w[i]) for i in np.flatnonzero(~self.small).tolist()}
        self.best: list[list[tuple[int, int]]] = [[] for _ in ids]       # heaps of (score, -id)

    def _small(self, huge, w):
        return ~huge & (np.abs(w).max(axis=1, initial=0.0) < self.limit)

    def _whole(self, huge, w) -> list[int]:
        return [int(Fraction(x) * self.scale // 1) for x in w.tolist()] if huge else [int(x) for x in w.tolist()]

    def _offer(self, i: int, scores, ids) -> None:
        heap = self.best[i]
        for s, c in zip(scores, ids):
            if len(heap) < self.k:
                heapq.heappush(heap, (s, -c))
            elif (s, -c) > heap[0]:
                heapq.heapreplace(heap, (s, -c))

    def add(self, ids: np.ndarray, huge: np.ndarray, w: np.ndarray) -> None:
        small = self._small(huge, w)
        if small.any() and self.small.any():
            shard = Shard(w[small], ids[small])
            for i in np.flatnonzero(self.small).tolist():
                heap = self.best[i]
                rows, scores = shard.search(self.w[i], float(heap[0][0]) if len(heap) == self.k else None, int(self.ids[i]))
                if len(rows) > self.k:
                    top = np.lexsort((shard.ids[rows], -scores))[:self.k]
                    rows, scores = rows[top], scores[top]
                self._offer(i, map(int, scores.tolist()), shard.ids[rows].tolist())
        if not small.all() or self.exact:
            numbers = None
            for i in range(len(self.ids)):
                rows = np.flatnonzero(~small) if self.small[i] else np.arange(len(ids))
                if not len(rows):
                    continue
                if numbers is None:
                    every = range(len(ids)) if self.exact else np.flatnonzero(~small).tolist()
                    numbers = {r: self._whole(huge[r], w[r]) for r in every}
                q = [int(x) for x in self.w[i].tolist()] if self.small[i] else self.exact[i]
                rows = [r for r in rows.tolist() if ids[r] != self.ids[i]]
                self._offer(i, [sum(a * b for a, b in zip(q, numbers[r])) for r in rows], ids[rows].tolist())

    def result(self):
        """Query ids, candidate ids and exact scores."""
        found = [(int(q), -c, s) for q, heap in zip(self.ids, self.best) for s, c in heap]
        return zip(*found) if found else ((), (), ())


def order_key(score: int) -> bytes:
    """Bytes that sort like the whole numbers."""
    raw = abs(score).to_bytes((abs(score).bit_length() + 7) // 8, "big")
    key = len(raw).to_bytes(2, "big") + raw
    return b"\x01" + key if score >= 0 else b"\x00" + bytes(255 - x for x in key)


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
          scale: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of every query row, all rows being candidates.

    ``is_query`` is a condition on the column ``id``."""
    w = C.cut(integers(vectors, id_col, vec_col, scale).withColumn("query", F.coalesce(is_query, F.lit(False))))
    n, m = w.agg(F.count(F.lit(1)), F.count_if("query")).first()
    lanes = max(1, min(MANY_LANES, -(-n // SHARD_ROWS)), -(-n // LANE_ROWS))
    blocks = max(1, -(-m // BLOCK_QUERIES))
    lane = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(lanes))
    block = F.pmod(F.xxhash64("id", F.lit(2)), F.lit(blocks))
    every = lambda count: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long")))
    cand = w.select("dim", every(blocks).alias("block"), lane.alias("lane"), F.lit(1).alias("side"), "id", "huge", "w")
    ask = w.where("query").select("dim", block.alias("block"), every(lanes).alias("lane"), F.lit(0).alias("side"),
                                  "id", "huge", "w")
    dealt = cand.unionByName(ask).repartition(*UNIT).sortWithinPartitions(*UNIT, "side", "id")

    def run(batches):
        unit, name, waiting = None, None, []

        def shard():
            if waiting and unit is not None:
                unit.add(*(np.concatenate(x) for x in zip(*waiting)))
            waiting.clear()

        asked: list = []
        for side, table in sides(batches):
            here, (ids, huge, w) = tuple(table[c][0].as_py() for c in UNIT), _arrays(table)
            if here != name:
                shard()
                if unit is not None:
                    yield _found(unit)
                unit, name, asked = None, here, []
            if side == 0:
                asked.append((ids, huge, w))
                continue
            if asked:
                unit, asked = Unit(*(np.concatenate(x) for x in zip(*asked)), k, scale), []
            for a in range(0, len(ids), SHARD_ROWS):
                waiting.append((ids[a:a + SHARD_ROWS], huge[a:a + SHARD_ROWS], w[a:a + SHARD_ROWS]))
                if sum(len(x[0]) for x in waiting) >= SHARD_ROWS:
                    shard()
        shard()
        if unit is not None:
            yield _found(unit)

    found = C.map_arrow(dealt, run, "query_id long, vec_id long, score long, key binary")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("key").desc(), "vec_id"))
    return (found.withColumn("rank", rank).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def sides(batches):
    """(side, rows) of one unit and side at a time, in order; a large side comes in several parts."""
    for batch in batches:
        if batch.num_rows:
            table = pa.Table.from_batches([batch])
            starts = C.group_starts(table, [*UNIT, "side"])
            for a, b in zip(starts, [*starts[1:], table.num_rows]):
                part = table.slice(a, b - a)
                yield part["side"][0].as_py(), part


def _arrays(table: pa.Table):
    ids, dim = table["id"].to_numpy(), table["dim"][0].as_py()
    w = table["w"].combine_chunks().flatten().to_numpy().reshape(-1, dim) if dim else np.zeros((len(ids), 0))
    return ids, table["huge"].to_numpy().astype(bool), w


def _found(unit: Unit) -> pa.RecordBatch:
    query, vec, score = (list(x) for x in unit.result())
    near = [max(-(1 << 63), min((1 << 63) - 1, s)) for s in score]
    return pa.RecordBatch.from_arrays([pa.array(query, pa.int64()), pa.array(vec, pa.int64()), pa.array(near, pa.int64()),
                                       pa.array([order_key(s) for s in score], pa.binary())],
                                      ["query_id", "vec_id", "score", "key"])


#: The query over ``embeddings`` for DuckDB.
ORACLE = """
WITH v AS (
  SELECT DISTINCT vec_id, [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.w, c.w) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.w) = len(c.w)),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
