"""Periodic runs of words by recursive frequency splitting and a lag scan.

A run is a stretch of words in which words ``period`` apart are identical, of at
least ``least`` words and ``times`` periods, with its smallest period, that no
neighbouring word extends.

1. Splitting. Every word of a run occurs at least ``times`` times in it. So a word
   that occurs more rarely within a segment (at first: the text) lies in none of
   its runs: it splits the segment. Each part is counted anew until no part has a
   rare word; parts shorter than ``least`` go.
2. Lag scan of what is left, one octave of lags at a time. For the lags in
   (2^(k-1), 2^k] the blocks of 2^k words get names (pairs of names of blocks half
   as long), and a block's lag is the distance to its next occurrence in the
   segment. Inside a run of period q in this octave every such lag is exactly q
   (a smaller one would give the run a smaller period), and it is not q at the two
   neighbouring places, as the run cannot be extended. So stretches of equal lag
   that are long enough are the runs, and the scan of a segment of m words takes
   O(m log m) per octave instead of one comparison for every lag and place.

All documents of a slice of text are handled in the same arrays; nothing is
shuffled and no task holds more than a batch.

Defined results: NULL or empty texts have no words and no runs, and ``collapsed``
is empty. Repeated rows and NULL ids are rows like others. A very long text is
handled whole, in memory proportional to it. ``collapsed`` separates kept words by
one space. Further columns of the input play no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C
from .chunks import row_slices

RUN = "struct<start:bigint,length:bigint,period:bigint>"


def ranks(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order that sorts ``keys`` and keeps ties in place, TRUE where a new key begins in that order)."""
    order = np.argsort(keys, kind="stable")
    new = np.ones(len(keys), bool)
    new[1:] = keys[order[1:]] != keys[order[:-1]]
    return order, new


def frequent_segments(words: np.ndarray, doc: np.ndarray, least: int, times: int) -> list[np.ndarray]:
    """Positions that survive the splitting; each array is one round's stable segments, whose
    positions follow one another without a gap only inside a segment of one document."""
    stable = []
    pos, seg = np.arange(len(words)), doc.astype(np.int64)
    while len(pos):
        order, new = ranks(seg * (int(words.max()) + 1) + words[pos])
        kind = np.cumsum(new) - 1
        rare = np.empty(len(pos), bool)
        rare[order] = np.bincount(kind)[kind] < times
        seg = np.cumsum(np.r_[0, seg[1:] != seg[:-1]])
        split = np.bincount(seg, weights=rare) > 0
        stable.append(pos[~split[seg]])
        go = split[seg] & ~rare
        pos, seg = pos[go], seg[go]
        if not len(pos):
            break
        seg = np.cumsum(np.r_[0, (np.diff(pos) > 1) | (seg[1:] != seg[:-1])])
        go = np.bincount(seg)[seg] >= least
        pos, seg = pos[go], seg[go]
    return stable


def lag_scan(words: np.ndarray, seg: np.ndarray, least: int, times: int):
    """(start, length, period) arrays of all runs of the segments; ``seg`` numbers them, rising."""
    found = []
    place = np.arange(len(words))
    name = seg * (int(words.max(initial=0)) + 1) + words
    block = 1
    while len(place):
        low = block // 2 + 1                       # lags low .. block
        size = np.bincount(seg)
        long = size[seg] >= max(least, times * low)
        place, name, seg = place[long], name[long], seg[long]
        if not len(place):
            break
        end = np.cumsum(np.bincount(seg))[seg]     # index after the segment's last place
        begins = np.flatnonzero(np.arange(len(place)) + block <= end)
        order, new = ranks(name[begins])
        at = begins[order]
        lag = np.zeros(len(place), np.int64)
        same = ~new[1:]
        lag[at[:-1][same]] = (at[1:] - at[:-1])[same]
        lag[(lag < low) | (lag > block)] = 0
        edge = np.flatnonzero(np.r_[True, (lag[1:] != lag[:-1]) | (seg[1:] != seg[:-1])])
        count, period = np.diff(np.r_[edge, len(lag)]), lag[edge]
        length = count - 1 + block + period
        good = (period > 0) & (length >= np.maximum(least, times * period))
        found.append((place[edge[good]], length[good], period[good]))
        ids = np.cumsum(new) - 1                   # names of blocks twice as long
        half = np.full(len(place) + block, -1, np.int64)
        half[at] = ids
        name = half[:len(place)] * (len(place) + 1) + half[block:block + len(place)]
        block *= 2
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 3


def find_runs(words: np.ndarray, doc: np.ndarray, least: int = 6, times: int = 4):
    """(start, length, period) of all runs, by start, then period; starts are places in ``words``."""
    if times < 3:
        raise ValueError("a run needs at least three periods")
    live = np.concatenate([*frequent_segments(words, doc, least, times), np.zeros(0, np.int64)])
    live.sort()
    if not len(live):
        return (np.zeros(0, np.int64),) * 3
    seg = np.cumsum(np.r_[0, (np.diff(live) > 1) | (doc[live[1:]] != doc[live[:-1]])])
    start, length, period = lag_scan(words[live].astype(np.int64), seg, least, times)
    start = live[start]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 6, times: int = 4) -> DataFrame:
    """One row per document: id, n_words, runs (start, length and period in words, by start, then period)
    and collapsed, the text without the words that lie in a run after its first period."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = src.schema["id"].dataType.simpleString()

    def run(batches):
        for b in row_slices(batches, "text"):
            texts = [(t or b"").split() for t in C.as_bytes(b.column("text"))]
            count = np.fromiter(map(len, texts), np.int64, len(texts))
            first = np.cumsum(count) - count
            every = [w for t in texts for w in t]
            number = dict.fromkeys(every)
            number.update(zip(number, range(len(number))))
            words = np.fromiter(map(number.__getitem__, every), np.int64, len(every))
            doc = np.repeat(np.arange(len(texts)), count)
            start, length, period = find_runs(words, doc, least, times)
            owner = doc[start]
            cover = np.zeros(len(every) + 1, np.int64)
            np.add.at(cover, start + period, 1)
            np.add.at(cover, start + length, -1)
            gone = np.cumsum(cover[:-1]) > 0
            kept = texts
            if gone.any():
                kept = list(texts)
                for d in np.unique(owner).tolist():
                    f = first[d]
                    kept[d] = [texts[d][i] for i in np.flatnonzero(~gone[f:f + count[d]]).tolist()]
            found = pa.StructArray.from_arrays([pa.array(start - first[owner], pa.int64()), pa.array(length, pa.int64()),
                                                pa.array(period, pa.int64())], ["start", "length", "period"])
            at = np.searchsorted(owner, np.arange(len(texts) + 1)).astype(np.int32)
            collapsed = pa.array([b" ".join(k) for k in kept], pa.large_binary()).cast(pa.large_string()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(count), pa.ListArray.from_arrays(pa.array(at), found),
                                              collapsed], ["id", "n_words", "runs", "collapsed"])

    return C.map_arrow(src, run, f"id {kind}, n_words bigint, runs array<{RUN}>, collapsed string")


def strongest(found: Column) -> Column:
    """Of an array of runs, the one with the greatest exact length / period (ties: smallest start, then
    period, which is the order of the array); NULL if it is empty."""
    none = F.lit(None).cast(RUN)
    return F.aggregate(found, none, lambda best, r: F.when(
        best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best))


def with_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with a tenth of the texts, chosen by crc32 of the id, turned into periodic ones: with
    h the checksum, g = floor(h / 10) and n words, the words from a = g mod n on repeat the
    p = 1 + floor((n - a) / (3 + g mod 8)) words from a; words are then joined by one space.
    Texts without words and rows without an id stay as they are. DataFrame functions only."""
    h = F.crc32(F.col(id_col).cast("string"))
    chosen = docs.withColumns({
        "__words": F.when(h % 10 == 0, F.regexp_extract_all(text_col, F.lit(C.WORD), F.lit(0))),
        "__g": F.floor(h / 10).cast("long")})
    n = F.size("__words")
    n_a = chosen.withColumn("__n", n).withColumn("__a", F.when(F.col("__n") > 0, F.pmod("__g", "__n")).cast("int"))
    left = F.col("__n") - F.col("__a")
    p = n_a.withColumn("__p", (1 + F.floor(left / (3 + F.pmod(F.col("__g"), F.lit(8))))).cast("int"))
    cycle = F.slice("__words", F.col("__a") + 1, F.col("__p"))
    many = F.flatten(F.array_repeat(cycle, F.ceil(left / F.col("__p")).cast("int")))
    periodic = F.concat_ws(" ", F.concat(F.slice("__words", F.lit(1), F.col("__a")), F.slice(many, F.lit(1), left)))
    text = F.when(F.col("__a").isNotNull(), periodic).otherwise(F.col(text_col))
    return p.withColumn(text_col, text).drop("__words", "__g", "__n", "__a", "__p")


def digest(found: DataFrame) -> DataFrame:
    """Counts, the strongest run and checksums of ``runs`` results."""
    best = strongest(F.col("runs"))
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.when(F.size("runs") > 0, F.concat(F.array_join(line, "\n"), F.lit("\n"))).otherwise("")
    out = found.select("id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
                       F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    milli = F.expr("1000 * best.length div best.period")
    return out.select("id", "n_runs", "best.start", "best.length", "best.period", milli.alias("exponent_milli"),
                      "runs_sha256", "collapsed_sha256")


#: The same rows by plain comparison: every pair of equal words up to a quarter of the text apart, and
#: stretches of pairs of one lag. crc32 is worked out bit by bit (a step of -1 is one shift).
ORACLE = """
WITH hashed AS (
    SELECT row_number() OVER () AS rid, doc_id, coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) AS w,
           xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
               lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
               lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END),
               4294967295::BIGINT) AS h
    FROM documents),
sized AS (SELECT *, len(w) AS n, h // 10 AS g, h % 10 = 0 AND len(w) > 0 AS chosen FROM hashed),
begun AS (SELECT *, CASE WHEN chosen THEN g % n ELSE 0 END AS a FROM sized),
cycled AS (SELECT *, CASE WHEN chosen THEN 1 + (n - a) // (3 + g % 8) ELSE 1 END AS p FROM begun),
texts AS (SELECT rid, doc_id, n, CASE WHEN chosen THEN list_transform(range(n),
                 lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) ELSE w END AS w FROM cycled),
words AS (SELECT rid, n, unnest(w) AS word, unnest(range(n)) AS i FROM texts),
pairs AS (SELECT x.rid, x.i, y.i - x.i AS q FROM words x JOIN words y
          ON x.rid = y.rid AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
islands AS (SELECT rid, q, i, i - row_number() OVER (PARTITION BY rid, q ORDER BY i) AS island FROM pairs),
stretches AS (SELECT rid, min(i) AS s, count(*) + q AS len, q FROM islands GROUP BY rid, q, island),
runs AS (SELECT rid, s, len, min(q) AS q FROM stretches WHERE len >= 6 AND len >= 4 * q GROUP BY rid, s, len),
dropped AS (SELECT DISTINCT rid, unnest(range(s + q, s + len)) AS i FROM runs),
kept AS (SELECT words.rid, string_agg(word, ' ' ORDER BY words.i) AS txt
         FROM words LEFT JOIN dropped USING (rid, i) WHERE dropped.i IS NULL GROUP BY words.rid),
listed AS (SELECT rid, count(*) AS n_runs, string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q) AS lines
           FROM runs GROUP BY rid),
ranked AS (SELECT a.rid, a.s, a.len, a.q FROM runs a WHERE NOT EXISTS (
               SELECT 1 FROM runs b WHERE b.rid = a.rid AND (b.len * a.q > a.len * b.q
                   OR b.len * a.q = a.len * b.q AND (b.s < a.s OR b.s = a.s AND b.q < a.q))))
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, ranked.s AS start, ranked.len AS length, ranked.q AS period,
       1000 * ranked.len // ranked.q AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
       sha256(coalesce(txt, '')) AS collapsed_sha256
FROM texts LEFT JOIN listed USING (rid) LEFT JOIN ranked USING (rid) LEFT JOIN kept USING (rid)
"""
