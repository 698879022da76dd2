"""Embedding near-duplicates by cross-polytope hashing.

Each table rotates the unit vectors by three rounds of random signs and a fast
Hadamard transform and takes the nearest vertex of the cross-polytope (the
coordinate of largest magnitude, with its sign); a key joins ``hashes`` such
vertices. A vector is at home in the bucket of its nearest vertices and also
probes the next likely buckets. Two vectors are compared, in double precision,
where one is at home and the other at home or probing, and each pair counts at the
first such meeting only, so no list of pairs is formed or shuffled.

* Equal vectors collapse to one before hashing and are counted by multiplicity.
* Hot buckets are cut into blocks and compared block against block; a unit
  gives a link count per vector and the edges of a spanning forest, not pairs.
* Buckets are sized on narrow rows; only entries with a mate carry the vector and its codes, once.
* ``plan`` picks the number of vertices a key from the number of vectors (random
  bucket mates stay few) and the number of tables from the chance that a pair exactly
  at the threshold meets, so that a pair is missed with probability 1 - ``recall``
  at most; closer pairs are missed less.

Defined results: vectors that are NULL, zero, empty or hold NULL or non-finite
components, and rows with a NULL id, link with nothing (their component is
their own id); vectors of different lengths never link; a repeated row counts as a
vector of its own; an empty table gives no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as C

SEED = 20240501
ALTERNATIVES = 4     # vertices of each hash that probes may combine
BLOCK_ROWS = 2048
MATES = 64           # random bucket mates to expect at most
RARE = 0.02  # least chance to meet in a table
UNIT = ["dim", "t", "code", "__unit"]


@dataclass(frozen=True)
class Plan:
    hashes: int
    tables: int
    probes: int


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows, scaled to keep lengths (width a power of two)."""
    n, m = x.shape
    h = 1
    while h < m:
        y = x.reshape(n, m // (2 * h), 2, h)
        x = np.stack((y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]), axis=2).reshape(n, m)
        h *= 2
    return x / math.sqrt(m)


def codes(x: np.ndarray, plan: Plan) -> np.ndarray:
    """(rows, tables, probes) bucket numbers of unit vectors; the first probe is the home bucket."""
    n, dim = x.shape
    m = 1 << max(1, (dim - 1).bit_length())
    x = np.hstack([x, np.zeros((n, m - dim))])
    out = np.zeros((n, plan.tables, plan.probes), dtype=np.int64)
    alt = min(ALTERNATIVES, 2 * m)
    for t in range(plan.tables):
        cost, code = np.zeros((n, 1)), np.zeros((n, 1), dtype=np.int64)
        for h in range(plan.hashes):
            rng = np.random.default_rng((SEED, t, h))
            y = x
            for _ in range(3):
                y = hadamard(y * rng.choice([-1.0, 1.0], size=m))
            y = np.hstack([y, -y])
            near = np.argsort(-y, axis=1, kind="stable")[:, :alt]
            value = np.take_along_axis(y, near, axis=1)
            loss = (value[:, :1] - value) ** 2
            cost = (cost[:, :, None] + loss[:, None, :]).reshape(n, -1)
            code = (code[:, :, None] * (2 * m) + near[:, None, :]).reshape(n, -1)
            best = np.argsort(cost, axis=1, kind="stable")[:, :plan.probes]  # later hashes only add cost
            cost, code = np.take_along_axis(cost, best, axis=1), np.take_along_axis(code, best, axis=1)
        out[:, t, :code.shape[1]] = code
        out[:, t, code.shape[1]:] = code[:, :1]
    return out


def plan(n: int, dim: int, threshold: float, recall: float = 0.999, probes: int = 2, trials: int = 2000) -> Plan:
    """Parameters for ``n`` vectors; the chance to meet is measured on random pairs exactly at the threshold.

    Where it is below RARE, a key has fewer hashes; ValueError if it still is with one, as too many tables
    would be needed for the recall."""
    m = 1 << max(1, (dim - 1).bit_length())
    hashes = max(1, math.ceil(math.log(max(n / MATES, 1.0)) / math.log(2 * m)))
    rng = np.random.default_rng(SEED)
    a, b = rng.normal(size=(2, trials, dim))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.maximum(np.linalg.norm(b, axis=1, keepdims=True), 1e-12)
    b = threshold * a + math.sqrt(max(0.0, 1 - threshold ** 2)) * b
    while True:
        one = Plan(hashes, 1, probes)
        ca, cb = codes(a, one)[:, 0], codes(b, one)[:, 0]
        meet = min(float(((ca[:, :1] == cb) | (cb[:, :1] == ca)).any(axis=1).mean()), 0.995)
        if meet >= RARE:
            break
        if hashes == 1:
            raise ValueError(f"vectors at cosine {threshold} meet in {meet:.2%} of tables only; recall {recall} is out of reach")
        hashes -= 1
    return Plan(hashes, max(2, math.ceil(math.log(1 - recall) / math.log(1 - meet))), probes)


def _hash_rows(chosen: dict, kind):
    """mapInArrow function: (node, copies, vec) -> with dim and bucket numbers of all tables."""

    def run(batches):
        for b in batches:
            col = b.column("vec")
            sizes = np.diff(col.offsets.to_numpy())
            for dim in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == dim)
                x = col.take(pa.array(rows)).flatten().to_numpy().reshape(len(rows), dim)
                found = codes(unit(x), chosen[dim])
                width = found.shape[1] * found.shape[2]
                at = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * width)
                yield pa.RecordBatch.from_arrays(
                    [b.column("node").take(pa.array(rows)), b.column("copies").take(pa.array(rows)),
                     pa.array(np.full(len(rows), dim, dtype=np.int32)),
                     pa.array([r.tobytes() for r in np.ascontiguousarray(x.astype(kind))], pa.binary()),
                     pa.ListArray.from_arrays(at, pa.array(found.reshape(-1)))],
                    ["node", "copies", "dim", "raw", "codes"])

    return run


def unit(x: np.ndarray) -> np.ndarray:
    """Rows as unit vectors in double precision; scaled first, so that squares neither overflow nor vanish."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _compare(threshold: float, chosen: dict, kind):
    """mapInArrow function: rows sorted by UNIT -> (node, links, root) of each row that links."""

    def first_meeting(code, t, here, i, j):
        """Whether table t and bucket ``here`` are the first place where rows i and j may be compared."""
        ci, cj = code[i], code[j]                      # (pairs, tables, probes)
        i_home = (ci[:, :, :1] == cj).any(axis=2)      # i's home is probed by j (or j's home too)
        j_home = (cj[:, :, :1] == ci).any(axis=2)
        table = np.arange(code.shape[1])[None, :]
        ok = ~((i_home | j_home) & (table < t[:, None])).any(axis=1)
        r = np.arange(len(i))
        hi, hj = ci[r, t, 0], cj[r, t, 0]
        place = np.minimum(np.where(i_home[r, t], hi, hj), np.where(j_home[r, t], hj, hi))
        return ok & (place == here) & (i_home[r, t] | j_home[r, t])

    def run(batches):
        for table in C.whole_groups(batches, UNIT, 1 << 12):
            starts = C.group_starts(table, UNIT)
            sizes = np.diff(np.append(starts, table.num_rows))
            n = table.num_rows
            dims = table["dim"].to_numpy()
            node, copies = table["node"].to_numpy(), table["copies"].to_numpy()
            t, here, block = table["t"].to_numpy(), table["code"].to_numpy(), table["__block"].to_numpy()
            cross = table["__unit"].to_numpy() % (1 << 31) != table["__unit"].to_numpy() >> 31
            group = np.repeat(np.arange(len(starts)), sizes)
            links, parent = np.zeros(n, dtype=np.int64), np.arange(n)
            raw, listed = table["raw"].to_pylist(), table["codes"].combine_chunks()
            for dim in np.unique(dims).tolist():
                mine = np.flatnonzero(dims == dim)     # sorted by dim first: one stretch of rows
                lo, hi = int(mine[0]), int(mine[-1]) + 1
                p = chosen[dim]
                x = unit(np.frombuffer(b"".join(raw[lo:hi]), dtype=kind).reshape(-1, dim))
                code = listed.slice(lo, hi - lo).flatten().to_numpy().reshape(-1, p.tables, p.probes)
                for i, j in _linked(x, group[lo:hi], threshold):
                    a, b = i + lo, j + lo
                    keep = ~cross[a] | (block[a] != block[b])
                    i, j, a, b = i[keep], j[keep], a[keep], b[keep]
                    keep = first_meeting(code, t[a], here[a], i, j)
                    a, b = a[keep], b[keep]
                    np.add.at(links, a, copies[b])
                    np.add.at(links, b, copies[a])
                    parent = C.union(parent, a, b)
            rows = np.flatnonzero(links)
            if len(rows):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node[rows]), pa.array(links[rows]), pa.array(node[parent[rows]])],
                    ["node", "links", "root"])

    return run


def _linked(x: np.ndarray, group: np.ndarray, threshold: float, pairs: int = 1 << 18):
    """Yield (i, j), i < j, of rows of one group with cosine >= threshold, a bounded number at a time."""
    n = len(x)
    sizes = np.bincount(group - group[0])
    start = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    small = np.repeat(sizes <= 32, sizes)
    for s in range(1, int(min(32, sizes.max()))):
        i = np.flatnonzero((group[:-s] == group[s:]) & small[:-s])
        if len(i):
            ok = np.einsum("ij,ij->i", x[i], x[i + s]) >= threshold
            yield i[ok], i[ok] + s
    for g in np.flatnonzero(sizes > 32):
        a, b = int(start[g]), int(start[g] + sizes[g])
        step = max(1, pairs // (b - a))
        for k in range(a, b, step):
            near = x[k:min(k + step, b)] @ x[a:b].T >= threshold
            i, j = np.nonzero(near)
            i, j = i + k, j + a
            yield i[i < j], j[i < j]


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = 0.95,
                    recall: float = 0.999, probes: int = 2) -> DataFrame:
    """One row per row of ``vectors``: id, n_links, component_id (smallest id reachable by links), kept."""
    v = F.col("vec")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    usable = F.coalesce(F.col("id").isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec")).withColumn("ok", usable)
    good = rows.where("ok").select("id", "vec")
    single = isinstance(vectors.schema[vec_col].dataType.elementType, T.FloatType)
    kind = np.float32 if single else np.float64
    nodes = C.cut(good.groupBy("vec").agg(F.min("id").alias("node"), F.count(F.lit(1)).alias("copies")))
    # one row per vector length: a handful, unless every vector has a length of its own
    chosen = {r["dim"]: plan(r["n"], r["dim"], threshold, recall, probes)
              for r in nodes.groupBy(F.size("vec").alias("dim")).agg(F.count(F.lit(1)).alias("n")).collect()}
    hashed = C.cut(C.map_arrow(nodes, _hash_rows(chosen, kind),
                               "node long, copies long, dim int, raw binary, codes array<long>"))
    # buckets are sized and cut on narrow rows; a vector and its codes are joined to the entries that have mates,
    # and cross one shuffle only
    entries = (hashed.select("node", "dim", F.posexplode("codes").alias("pos", "code"))
               .select("node", F.struct("dim", F.floor(F.col("pos") / F.lit(probes)).cast("int").alias("t"), "code").alias("key")))
    units = C.split_hot(entries, "key", "node", BLOCK_ROWS).select("key.*", "__unit", "__block", "node")
    dealt = units.join(hashed.drop("dim"), "node").repartition(*UNIT).sortWithinPartitions(*UNIT)
    found = C.cut(C.map_arrow(dealt, _compare(threshold, chosen, kind), "node long, links long, root long"))
    comp = C.connected_components(found.select(F.col("node").alias("a"), F.col("root").alias("b")).distinct())
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    known = (nodes.join(links, "node", "left").join(comp, F.col("node") == F.col("id"), "left").drop("id")
             .select("vec", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                     F.coalesce("component", "node").alias("component_id")))
    linked = good.join(known, "vec").select("id", "n_links", "component_id")
    alone = rows.where("NOT ok").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)))


#: The query over ``embeddings`` for DuckDB: all pairs, and reachability step by step.
ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x for x in embedding if x <> 0]) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
      ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95),
r AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a AS vec_id, min(b) AS component_id FROM r GROUP BY a),
n AS (SELECT a AS vec_id, count(*) AS n FROM l GROUP BY a)
SELECT c.vec_id, coalesce(n.n, 0) AS n_links, c.component_id, c.vec_id = c.component_id AS kept
FROM c LEFT JOIN n USING (vec_id)
"""
