"""SimHash near-duplicate groups with bit-sliced comparison.

Fingerprints are computed per document; equal fingerprints collapse to one node
(so exact copies never meet as pairs). Nodes whose fingerprints differ in at most
``max_bits`` bits are linked. Candidates come from the pigeonhole principle: the
64 bits are cut into ``parts`` pieces, and two fingerprints within the distance
agree on at least ``parts - max_bits`` of them, so every choice of that many
pieces is one table of buckets. This is exact for every number of parts; more
parts give longer keys and smaller buckets. Buckets are cut into bounded units
and each unit is compared bit-sliced: bit j of all fingerprints is stored as one
plane of 64-bit words, 64 neighbouring offsets are compared at a time, the
differing bits are added up with carry-save counters, and words whose lanes have
all passed the radius are abandoned.

Defined results: a NULL or empty text, or one without words, has fingerprint 0,
which links like any other; NULL ids never become a component id unless a group
has no other; repeated rows get equal results; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

SEED = 42
BITS = 64
BLOCK_ROWS = 4096     # fingerprints per block of a hot bucket
HASH_CHUNK = 1 << 18  # shingles hashed before their bits are counted
UNIT = ["t", "v", "__unit"]
_ONE = np.uint64(1)


def shingle_hashes(text: bytes | None, length: int):
    """Arrays of XXH64 values of the text's word shingles, at most HASH_CHUNK each."""
    words = (text or b"").lower().split()
    if not words:
        return
    if len(words) <= length:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], dtype=np.uint64)
        return
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[: len(words) - length + 1]
    ends = ends[length - 1:]
    digest = xxhash.xxh64_intdigest
    for k in range(0, len(starts), HASH_CHUNK):
        pairs = zip(starts[k:k + HASH_CHUNK].tolist(), ends[k:k + HASH_CHUNK].tolist())
        n = min(HASH_CHUNK, len(starts) - k)
        yield np.fromiter((digest(joined[a:b], SEED) for a, b in pairs), dtype=np.uint64, count=n)


def fingerprints(texts: list, length: int) -> np.ndarray:
    """One unsigned 64-bit fingerprint per text."""
    counts = np.zeros((len(texts), BITS), dtype=np.int64)
    totals = np.zeros(len(texts), dtype=np.int64)
    pending: list[np.ndarray] = []
    owners: list[int] = []
    held = 0

    def add():
        nonlocal held
        if pending:
            h = np.concatenate(pending)
            bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            at = np.concatenate(([0], np.cumsum([len(p) for p in pending])[:-1]))
            np.add.at(counts, owners, np.add.reduceat(bits, at, axis=0, dtype=np.int32))
        pending.clear()
        owners.clear()
        held = 0

    for i, text in enumerate(texts):
        for h in shingle_hashes(text, length):
            totals[i] += len(h)
            pending.append(h)
            owners.append(i)
            held += len(h)
            if held >= HASH_CHUNK:
                add()
    add()
    packed = np.packbits(2 * counts > totals[:, None], axis=1, bitorder="little")
    return packed.view(np.uint64).reshape(-1)


def with_fingerprint(docs: DataFrame, id_col: str, text_col: str, length: int) -> DataFrame:
    """(id, text_hash, fp long) per row; fp holds the unsigned bits."""
    src = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"),
                      F.col(text_col).alias("text"))
    kind = src.schema["id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            for k in range(0, b.num_rows, 1024):
                part = b.slice(k, 1024)
                fp = fingerprints(C.as_bytes(part.column("text")), length).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("text_hash"), pa.array(fp)],
                                                 ["id", "text_hash", "fp"])

    return C.map_arrow(src, run, f"id {kind}, text_hash long, fp long")


def planes(fp: np.ndarray) -> np.ndarray:
    """(64, words) bit planes: bit i of word w in plane j is bit j of fp[64 w + i]."""
    n = len(fp)
    words = -(-n // 64) + 1
    bits = np.unpackbits(fp.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    flat = np.zeros((BITS, words * 64), dtype=np.uint8)
    flat[:, :n] = bits.T
    return np.packbits(flat, axis=1, bitorder="little").view(np.uint64).reshape(BITS, words)


def close_pairs(fp: np.ndarray, group: np.ndarray, radius: int):
    """Yield arrays (i, j), i < j, of rows of one group whose distance is at most ``radius``.

    ``group`` is sorted. All pairs at offsets 64 q ... 64 q + 63 are compared
    together; memory is bounded by 64 lanes a row.
    """
    n = len(fp)
    p = planes(fp)
    words = p.shape[1] - 1
    sizes = np.diff(np.append(np.flatnonzero(np.append(True, group[1:] != group[:-1])), n))
    counters = max(1, int(radius).bit_length())
    padded = np.zeros((words + 1) * 64, dtype=np.uint8)
    for q in range(0, -(-int(sizes.max()) // 64)):
        lanes = []
        for b in range(64):
            s = 64 * q + b
            if s == 0 or s >= n:
                lanes.append(np.zeros(words, dtype=np.uint64))
                continue
            padded[:] = 0
            padded[: n - s] = group[: n - s] == group[s:]
            lanes.append(np.packbits(padded, bitorder="little").view(np.uint64)[:words])
        alive = np.concatenate(lanes)
        at = np.flatnonzero(alive)
        alive = alive[at]
        off, w = (at // words).astype(np.uint64), at % words
        count = [np.zeros(len(at), dtype=np.uint64) for _ in range(counters)]
        for j in range(BITS):
            if not len(at):
                break
            row = p[j]
            hi = row[np.minimum(w + q + 1, words)]
            d = row[w] ^ ((row[np.minimum(w + q, words)] >> off) | ((hi << _ONE) << (np.uint64(63) - off)))
            for c in count:  # carry-save: add one bit to the counter of every lane
                c_new = c & d
                c ^= d
                d = c_new
            alive &= ~d      # the counters ran over: beyond the radius
            if j % 8 == 7:   # abandon words without a lane in reach
                keep = np.flatnonzero(alive)
                if len(keep) < len(at):
                    at, off, w, alive = at[keep], off[keep], w[keep], alive[keep]
                    count = [c[keep] for c in count]
        if not len(at):
            continue
        value = np.unpackbits(alive.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(bool)
        distance = sum(np.unpackbits(c.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little") << k
                       for k, c in enumerate(count))
        r, lane = np.nonzero(value & (distance <= radius))
        i = w[r] * 64 + lane
        yield i, i + off[r].astype(np.int64) + 64 * q


def _link_units(radius: int):
    """mapInArrow function: rows sorted by UNIT -> star edges of each unit's linked sets."""

    def links(fp, group):
        parent = np.arange(len(fp))
        for i, j in close_pairs(fp, group, radius):
            parent = C.union(parent, i, j)
        moved = np.flatnonzero(parent != np.arange(len(fp)))
        return fp[moved].view(np.int64), fp[parent[moved]].view(np.int64)

    def run(batches):
        for table in C.whole_groups(batches, UNIT, 1 << 15):
            starts = C.group_starts(table, UNIT)
            sizes = np.diff(np.append(starts, table.num_rows))
            fp = table["fp"].to_numpy().view(np.uint64)
            group = np.repeat(np.arange(len(starts)), sizes)
            small = np.repeat((sizes > 1) & (sizes <= 64), sizes)
            found = [links(fp[small], group[small])] if small.any() else []
            for g in np.flatnonzero(sizes > 64):
                found.append(links(fp[starts[g]:starts[g] + sizes[g]], np.zeros(sizes[g], dtype=np.int64)))
            for a, b in found:
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return run


def parts_for(n: int, max_bits: int) -> int:
    """Fewest pieces of the fingerprint whose tables keep about 1024 or fewer random entries a bucket."""
    for parts in range(max_bits + 1, BITS + 1):
        key_bits = (parts - max_bits) * BITS // parts
        if n <= 1024 << key_bits:
            return parts
    return BITS


def bucket_entries(nodes: DataFrame, max_bits: int, parts: int) -> DataFrame:
    """(key, fp): one row per fingerprint and table; key = (table number t, the chosen pieces' bits v)."""
    edge = [BITS * k // parts for k in range(parts + 1)]
    masks = []
    for pick in combinations(range(parts), parts - max_bits):
        m = sum(((1 << (edge[k + 1] - edge[k])) - 1) << edge[k] for k in pick)
        masks.append(m - (1 << 64) if m >= 1 << 63 else m)
    table = F.explode(F.array(*[F.struct(F.lit(t).alias("t"), F.lit(m).cast("long").alias("m"))
                                for t, m in enumerate(masks)]))
    return nodes.select("fp", table.alias("x")).select(
        F.struct(F.col("x.t").alias("t"), F.col("fp").bitwiseAND(F.col("x.m")).alias("v")).alias("key"), "fp")


def groups(fps: DataFrame, max_bits: int = 3, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(fp, root): the linked set of every distinct fingerprint, named by one of its fingerprints.

    ``fps`` has a long column ``fp`` and should be materialised: it is read twice.
    """
    nodes = fps.select("fp").distinct()
    parts = parts_for(nodes.count(), max_bits)
    entries = bucket_entries(nodes, max_bits, parts)
    units = C.split_hot(entries, "key", "fp", block_rows).select("key.t", "key.v", "__unit", "fp")
    dealt = units.repartition(*UNIT).sortWithinPartitions(*UNIT)
    edges = C.map_arrow(dealt, _link_units(max_bits), "a long, b long")
    comp = C.connected_components(edges)
    return (nodes.join(comp, nodes["fp"] == comp["id"], "left")
            .select("fp", F.coalesce("component", "fp").alias("root")))


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                   max_bits: int = 3) -> DataFrame:
    """One row per row of ``docs``: id, text_hash, fp, root (names the group), component_id (its smallest id)."""
    fps = C.cut(with_fingerprint(docs, id_col, text_col, shingle))
    # labels are made per fingerprint, so that a group's rows meet only through their fingerprint
    known = fps.groupBy("fp").agg(F.min("id").alias("low")).join(groups(fps, max_bits), "fp")
    label = known.groupBy("root").agg(F.min("low").alias("component_id"))
    known = known.select("fp", "root").join(label, "root")
    return fps.join(known, "fp").select("id", "text_hash", "fp", "root", "component_id")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                     max_bits: int = 3) -> DataFrame:
    """``docs`` with one row of each group: smallest id (NULL last), then fingerprint, then text hash.

    Rows repeated exactly leave one row. All columns are kept; the text crosses
    one shuffle (the join with the keepers)."""
    fps = C.cut(with_fingerprint(docs, id_col, text_col, shingle))
    order = F.struct(F.col("id").isNull().alias("none"), "id", "fp", "text_hash")
    first = fps.groupBy("fp").agg(F.min(order).alias("k"))  # per fingerprint, then per group
    keep = (first.join(groups(fps, max_bits), "fp").groupBy("root").agg(F.min("k").alias("k"))
            .select(F.col("k.id").alias("__keep_id"), F.col("k.text_hash").alias("__keep_hash")))
    kept = docs.withColumn("__hash", F.xxhash64(text_col)).join(
        keep, F.col(id_col).eqNullSafe(F.col("__keep_id")) & (F.col("__hash") == F.col("__keep_hash")), "left_semi")
    return kept.dropDuplicates([id_col, "__hash"]).drop("__hash")
