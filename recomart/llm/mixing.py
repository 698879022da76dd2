"""Mixing sources to target weights by weighted fair queueing.

Documents of a source are shuffled by a hash and queue up; a source may be read
up to ``epochs`` times. Each copy of a document gets a virtual finish time:
source words up to and including it, over all its earlier copies, divided by
the source's target. All copies, globally ordered by finish time, are taken
until their words reach the total budget. Sources then share the budget in
proportion to their targets at every point of the order, and at its end.

Only DataFrame functions run here. No window ever covers a whole source: the
hash order is cut into bins of about ``BIN_ROWS`` rows of the source, bins get
their starting sums from a window over bin totals, and rows only a window within
their bin. No window covers all sources either: they are range-sorted, and sums run within ranges
and over the ranges' totals. The place in the global order where the budget ends is found from counts per
range of virtual time, cut finer until the range with the end is small, and is one
(finish time, order key), put into the plan as two literals. ``mixed_documents`` range-sorts all copies up to
there by finish time, so the parts of its result follow one another in the order of the queue,
and sources are interleaved. Sizes, keys and starting sums are written once to the
checkpoint folder.

Targets: weights ``WEIGHTS`` repeat over the sources in code point order, NULL
last; a target stops at ``epochs`` times its source's words, and what that frees
is shared by weight among the others until none is above its limit (solved at
once as a water level, since limits are reached in order of words per weight).

Defined results: NULL text has size 0, documents of size 0 are never taken; a
source without words has target 0; repeated rows queue up one by one; NULL ids
and sources are ordinary values; copies that finish together are ordered by their key; a very long text is
counted whole; an empty table gives no rows; further columns play no part, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, cut

WEIGHTS = (1, 2, 3)
EPOCHS = 3
BIN_ROWS = 4096
EDGE_ROWS = 1 << 16   # copies ordered one by one where the budget ends


def word_count(col: Column) -> Column:
    return F.coalesce(F.regexp_count(col, F.lit(WORD)), F.lit(0)).cast("long")


def running(rows: DataFrame, order: list, sums: dict) -> DataFrame:
    """``rows`` plus, for each name and column of ``sums``, the sum over all rows up to and including this one in
    ``order``, without a window over all rows: sums run within the parts of a range sort, and the
    parts' totals (a row per part) are summed over the parts."""
    parts = cut(rows.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()))
    totals = parts.groupBy("__part").agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("__part", *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"__{n}") for n in sums])
    inside = Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    found = parts.withColumns({n: F.sum(c).over(inside) for n, c in sums.items()}).join(starts, "__part")
    return found.withColumns({n: F.col(n) + F.col(f"__{n}") for n in sums}).drop("__part", *[f"__{n}" for n in sums])


def source_targets(narrow: DataFrame, weights=WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """(source, source_no, source_size, source_rows, budget, target) per source of ``narrow``."""
    per = narrow.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_rows"))
    by_source = F.col("source").asc_nulls_last()
    per = running(per, [by_source], {"source_no": F.lit(1).cast("long")})
    cycle = F.array(*[F.lit(float(x)) for x in weights])
    per = (per.withColumn("weight", F.element_at(cycle, (F.pmod(F.col("source_no") - 1, F.lit(len(weights))) + 1).cast("int")))
           .withColumn("limit", F.col("source_size") * F.lit(epochs)))
    per = running(per, [F.col("limit") / F.col("weight"), by_source],
                  {"place": F.lit(1).cast("long"), "full": F.col("limit"), "passed": F.col("weight")})
    budget, weight = per.agg(F.sum("source_size"), F.sum("weight")).first()
    # level: where the water stands if all sources before this one are at their limits; the
    # first source in this order that it does not fill ends the sharing
    budget, weight = F.lit(budget).cast("long"), F.lit(weight).cast("double")
    level = (budget - (F.col("full") - F.col("limit"))) / (weight - F.col("passed") + F.col("weight"))
    per = per.withColumn("budget", budget).withColumn("level", level)
    first = per.where(F.col("level") * F.col("weight") < F.col("limit")).agg(F.min(F.struct("place", "level")).alias("e")).first()["e"]
    water = F.lit(first["level"] if first else None).cast("double")
    target = F.least(F.col("limit").cast("double"), water * F.col("weight"))
    return per.select("source", F.col("source_no").cast("int").alias("source_no"), "source_size", "source_rows", "budget",
                      target.alias("target"))


def order_key(id_col: str, source_col: str, text_col: str) -> Column:
    """MD5 of id, source and text: the shuffled order of a source, the same in every run."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (id_col, source_col)]
    return F.md5(F.concat_ws(":", *parts, F.md5(F.coalesce(F.col(text_col), F.lit("")))))


def with_source(rows: DataFrame, targets: DataFrame, broadcast: bool) -> DataFrame:
    """``rows`` (source, size, __key, ...) with their source's figures and their bin of the source's order."""
    t = targets.withColumnRenamed("source", "__t_source")
    t = F.broadcast(t) if broadcast else t
    rows = rows.join(t, F.col("source").eqNullSafe(F.col("__t_source"))).drop("__t_source")
    # the first 8 hex digits of the key, scaled to the source's number of bins
    place = F.conv(F.substring("__key", 1, 8), 16, 10).cast("long")
    bins = F.ceil(F.col("source_rows") / F.lit(BIN_ROWS))
    return rows.withColumn("__bin", F.floor(place * bins / F.lit(1 << 32)).cast("long")).drop("source_rows")


def bin_starts(rows: DataFrame) -> DataFrame:
    """(source_no, __bin, __start): the source's words before each bin."""
    sums = rows.groupBy("source_no", "__bin").agg(F.sum("size").alias("__w"))
    before = Window.partitionBy("source_no").orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select("source_no", "__bin", F.coalesce(F.sum("__w").over(before), F.lit(0)).alias("__start"))


def with_running_words(rows: DataFrame, starts: DataFrame) -> DataFrame:
    """``rows`` plus __cum, the source's words up to and including the row; one shuffle by (source, bin)."""
    inside = Window.partitionBy("source_no", "__bin").orderBy("__key", "size")
    run = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    return rows.join(starts, ["source_no", "__bin"]).withColumn("__cum", F.col("__start") + run).drop("__start")


def finish_time(epoch) -> Column:
    """Virtual finish time of the row's copy number ``epoch`` (from 0)."""
    return (F.lit(epoch) * F.col("source_size") + F.col("__cum")) / F.col("target")


def budget_end(rows: DataFrame, epochs: int = EPOCHS) -> tuple | None:
    """(finish, key) of the last copy, in global order, whose words still fit the budget; None if all fit.

    Copies are counted in ranges of virtual time (4096 to a unit up to 2, where
    the budget must end but for tiny tables, coarser after it). The range in which the budget ends is cut
    again, by time and for equal times by the key, until it has at most EDGE_ROWS copies; only these are
    ordered copy by copy. One row a cut reaches the driver."""
    c = rows.where("size > 0").select("__key", "size", "budget", F.explode(
        F.array(*[finish_time(e) for e in range(epochs)])).alias("finish"))
    late = F.lit(8192) + F.floor(F.log2("finish") * F.lit(16.0))
    ranges = F.when(F.col("finish") < 2, F.floor(F.col("finish") * F.lit(4096.0))).otherwise(late)
    edge = _edge(c, ranges, F.lit(0))
    if edge is None:
        return None
    open_ = c.where(ranges == F.lit(edge["r"]))
    while edge["n"] > EDGE_ROWS:
        low, high = edge["low"], edge["high"]
        if low["finish"] < high["finish"]:
            step = (high["finish"] - low["finish"]) / 4096
            ranges = F.least(F.floor((F.col("finish") - F.lit(low["finish"])) / F.lit(step)), F.lit(4095))
        else:  # equal times: by the first digits in which their keys differ
            same = next((i for i, (x, y) in enumerate(zip(low["key"], high["key"])) if x != y), None)
            if same is None:
                break  # copies of one row
            ranges = F.conv(F.substring("__key", same + 1, 3), 16, 10).cast("long")
        edge = _edge(open_, ranges, F.lit(edge["before"])) or edge
        open_ = open_.where(ranges == F.lit(edge["r"]))
    inner = Window.partitionBy("budget").orderBy("finish", "__key").rowsBetween(Window.unboundedPreceding, 0)
    last = (open_.withColumn("upto", F.lit(edge["before"]) + F.sum("size").over(inner)).where("upto <= budget")
            .agg(F.max(F.struct("finish", "__key")).alias("e")).first()["e"])
    if last is not None:
        return last["finish"], last["__key"]
    # nothing of that range fits: the end is the last copy before it
    low = edge["low"]
    earlier = (F.col("finish") < F.lit(low["finish"])) | ((F.col("finish") == F.lit(low["finish"])) & (F.col("__key") < F.lit(low["key"])))
    before = c.where(earlier).agg(F.max(F.struct("finish", "__key")).alias("e")).first()["e"]
    return (before["finish"], before["__key"]) if before is not None else (float("-inf"), "")


def _edge(copies: DataFrame, ranges: Column, before: Column):
    """The first range up to whose end the words, with those before, exceed the budget: r, n copies, words
    before, its first and last (finish, key)."""
    place = F.struct("finish", F.col("__key").alias("key"))
    per = copies.groupBy(ranges.alias("r")).agg(F.sum("size").alias("w"), F.count(F.lit(1)).alias("n"), F.max("budget").alias("budget"),
                                                F.min(place).alias("low"), F.max(place).alias("high"))
    upto = before + F.sum("w").over(Window.orderBy("r"))   # at most some thousand ranges
    return (per.withColumn("upto", upto).where("upto > budget")
            .agg(F.min(F.struct("r", "n", (F.col("upto") - F.col("w")).alias("before"), "low", "high")).alias("e")).first()["e"])


#: Sources up to this number are broadcast (some 100 bytes each); more are joined by shuffle.
BROADCAST_SOURCES = 100_000


class Mix:
    """The solved mix of a table: targets, starting sums and the point where the budget ends."""

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
                 weights=WEIGHTS, epochs: int = EPOCHS):
        self.columns, self.epochs = (id_col, source_col, text_col), epochs
        self.narrow = cut(self.sized(docs).select(F.col(id_col).alias("id"), "source", "size", "__key"))
        self.targets = cut(source_targets(self.narrow, weights, epochs))
        self.broadcast = self.targets.count() <= BROADCAST_SOURCES
        placed = with_source(self.narrow, self.targets, self.broadcast)
        self.starts = cut(bin_starts(placed))
        self.end = budget_end(with_running_words(placed, self.starts), epochs)

    def sized(self, docs: DataFrame) -> DataFrame:
        id_col, source_col, text_col = self.columns
        return docs.withColumns({"__key": order_key(id_col, source_col, text_col), "size": word_count(F.col(text_col)),
                                 "source": F.col(source_col)})

    def queued(self, rows: DataFrame) -> DataFrame:
        """``rows`` (source, size, __key, ...) plus their source's figures and running words."""
        return with_running_words(with_source(rows, self.targets, self.broadcast), self.starts)

    def fits(self, finish: Column) -> Column:
        """Whether a copy with this finish time lies before the end of the budget."""
        if self.end is None:
            return finish.isNotNull()
        last = F.lit(self.end[0])
        return (finish < last) | ((finish == last) & (F.col("__key") <= F.lit(self.end[1])))

    def take(self, rows: DataFrame) -> DataFrame:
        """``rows`` (source, size, __key, ...) plus source_size, target and taken."""
        rows = self.queued(rows)
        times = sum((F.when(self.fits(finish_time(e)), 1).otherwise(0) for e in range(self.epochs)), F.lit(0))
        taken = F.when(F.col("size") > 0, times * F.col("size")).otherwise(F.lit(0)).cast("long")
        return rows.withColumn("taken", taken).drop("__key", "__cum", "__bin", "source_no", "budget")


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
        weights=WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """(id, source, size, source_size, target, taken) per row; taken: words the mix takes of it, repeats counted."""
    m = Mix(docs, id_col, source_col, text_col, weights, epochs)
    return m.take(m.narrow)


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
                    weights=WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """The mixed corpus: the columns of ``docs``, each row as often as the mix takes it (at most ``epochs`` times),
    globally range-sorted by virtual finish time."""
    m = Mix(docs, id_col, source_col, text_col, weights, epochs)
    # columns of the input travel as one struct, so that their names never clash with the mix's
    base = docs.select(F.struct(*docs.columns).alias("__doc"), *[F.col(c).alias(c) for c in dict.fromkeys(m.columns)])
    rows = m.queued(m.sized(base).select("__doc", "source", "size", "__key")).where("size > 0")
    copies = rows.select("__doc", "__key", F.explode(F.array(*[finish_time(e) for e in range(epochs)])).alias("__finish"))
    taken = copies.where(m.fits(F.col("__finish")))
    return taken.repartitionByRange("__finish", "__key").sortWithinPartitions("__finish", "__key").select("__doc.*")


#: The query over ``documents`` for DuckDB: the same order keys, targets and cut.
ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5(concat_ws(':', coalesce(CAST(doc_id AS VARCHAR), ''), coalesce(source, ''), md5(coalesce(text, '')))) AS k
  FROM documents),
p AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
             CAST(1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS DOUBLE) AS weight
      FROM d GROUP BY source),
q AS (SELECT *, 3 * source_size AS lim, CAST(sum(source_size) OVER () AS BIGINT) AS budget,
             coalesce(sum(3 * source_size) OVER (ORDER BY 3 * source_size / weight, source NULLS LAST
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_before,
             sum(weight) OVER (ORDER BY 3 * source_size / weight, source NULLS LAST
                      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight
      FROM p),
l AS (SELECT *, CAST(budget - full_before AS DOUBLE) / open_weight AS level FROM q),
t AS (SELECT source, source_size, budget,
             least(CAST(lim AS DOUBLE), weight * (SELECT arg_min(level, (lim / weight, source IS NULL, coalesce(source, '')))
                                                  FROM l WHERE level * weight < lim)) AS target
      FROM l),
c AS (SELECT d.doc_id, d.size, d.k, t.source_size, t.target, t.budget,
             CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.size
                                    ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cum
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
f AS (SELECT c.*, e, CAST(e * source_size + cum AS DOUBLE) / target AS finish
      FROM c, (VALUES (0), (1), (2)) AS v(e) WHERE size > 0),
g AS (SELECT doc_id, k, size, cum, e,
             sum(size) OVER (ORDER BY finish, k ROWS UNBOUNDED PRECEDING) <= budget AS fits FROM f),
n AS (SELECT doc_id, k, cum, count(*) FILTER (WHERE fits) AS times FROM g GROUP BY doc_id, k, cum)
SELECT c.doc_id, c.size, c.source_size, c.target, CAST(c.size * coalesce(n.times, 0) AS BIGINT) AS taken
FROM c LEFT JOIN n ON c.size > 0 AND c.doc_id IS NOT DISTINCT FROM n.doc_id AND c.k = n.k AND c.cum = n.cum
"""
