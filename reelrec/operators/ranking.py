"""Row numbers inside few, large, skewed groups, and rank bands.

``row_number() over (partition by rating order by userId)`` puts each rating value (about
ten of them, one possibly a third of the table) into one task.  ``row_number_by_group``
gives the same numbers with balanced tasks:

1. identical rows collapse into one row with a weight ``_w`` (map-side partial count,
   so a hot duplicate never travels as many rows), written once;
2. the distinct rows are range-partitioned on (group, order, rest) into parts of about
   ``PART_ROWS`` rows, so parts grow in number and not in size, and sorted there;
3. a row of weight w expands into w rows where it lies, numbered in the order of the part and
   written (fixed partitions, lineage cut): no window and no further shuffle of rows;
4. per (part, group) the first number and the count, at most parts plus groups rows, give the
   offset that turns a row's number into its rank.

If a row's weight is over ``EXPAND_CHUNK`` the rows are not expanded in their part: a running weight
sum inside (part, group) plus the part's offset numbers every distinct row, which expands in
chunks spread over tasks.

Ties on the full key are identical rows, so any order among them is the same answer.

The same plan runs at every size.  ``size`` adds the number of rows of the group, from the same
totals, so rank bands need no second aggregate and no join (null groups included).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelrec.session import stored

EXPAND_CHUNK = 1_000_000
PART_ROWS = 1_000_000
OFFSETS_BROADCAST = 200_000          # rows of offsets that are sent to every task


def _partitions(df: DataFrame, requested: int | None, rows: int) -> int:
    if requested:
        return requested
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism, -(-rows // PART_ROWS))


def row_number_by_group(df: DataFrame, group: list[str], order: list[str], out: str = "rank", *,
                        size: str | None = None, partitions: int | None = None,
                        expand_chunk: int = EXPAND_CHUNK) -> DataFrame:
    """Exact ``row_number() over (partition by group order by order)``; output = input
    columns + ``out`` (bigint), and with ``size`` the rows of the group in that column."""
    rest = [c for c in df.columns if c not in group and c not in order]
    key = list(group) + list(order) + rest
    result = [*df.columns, out, *([F.col("_size").alias(size)] if size else [])]
    distinct = stored(df.groupBy(*key).agg(F.count(F.lit(1)).alias("_w")), "distinct")
    max_w, rows = distinct.agg(F.max("_w"), F.sum("_w")).first()
    p = _partitions(df, partitions, rows or 0)
    parts = distinct.repartitionByRange(p, *key)
    if (max_w or 0) <= expand_chunk:
        return _expanded(parts, group, key, max_w or 0, out).select(*result)
    parts = stored(parts.withColumn("_pid", F.spark_partition_id()), "parts")
    totals = parts.groupBy("_pid", *group).agg(F.sum("_w").alias("_t"))
    before = Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_pid", *group, F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_off"),
                            F.sum("_t").over(Window.partitionBy(*group)).alias("_size"))

    cond = reduce(lambda a, b: a & b,
                  [parts["_pid"] == offsets["_pid"]] + [parts[g].eqNullSafe(offsets[g]) for g in group])
    joined = parts.join(offsets, cond, "inner").select(parts["*"], offsets["_off"], offsets["_size"])
    running = Window.partitionBy("_pid", *group).orderBy(*key).rowsBetween(Window.unboundedPreceding, 0)
    start = (F.col("_off") + F.sum("_w").over(running) - F.col("_w") + 1).cast("long")
    numbered = joined.select(*key, "_w", start.alias("_start"), "_size")
    # Hot duplicate rows: split the expansion into chunks and spread them over tasks.
    chunked = numbered.select(*key, "_w", "_start", "_size",
                              F.explode(F.sequence(F.lit(0).cast("long"),
                                                   F.floor((F.col("_w") - 1) / expand_chunk).cast("long"))).alias("_c"))
    chunked = chunked.repartition(p, *key, "_c")
    lo = F.col("_start") + F.col("_c") * expand_chunk
    hi = F.least(lo + expand_chunk - 1, F.col("_start") + F.col("_w") - 1)
    return chunked.select(*key, "_size", F.explode(F.sequence(lo, hi)).alias(out)).select(*result)


def _expanded(parts: DataFrame, group: list[str], key: list[str], max_w: int, out: str) -> DataFrame:
    """``key, out, _size`` of distinct rows with their weights in range partitions."""
    rows = parts.sortWithinPartitions(*key)
    if max_w > 1:
        rows = rows.withColumn("_w", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_w"))))
    # the part's number in the upper bits, the row's place in the part in the others
    rows = stored(rows.drop("_w").withColumn("_id", F.monotonically_increasing_id()), "parts").withColumn("_pid", F.shiftright("_id", 33))
    before = Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (rows.groupBy("_pid", *group).agg(F.count(F.lit(1)).alias("_t"), F.min("_id").alias("_first"))
               .select("_pid", *group, (F.coalesce(F.sum("_t").over(before), F.lit(0)) - F.col("_first") + 1).alias("_off"),
                       F.sum("_t").over(Window.partitionBy(*group)).alias("_size")))
    offsets = stored(offsets, "offsets")
    if offsets.count() <= OFFSETS_BROADCAST:
        offsets = F.broadcast(offsets)
    cond = reduce(lambda a, b: a & b, [rows["_pid"] == offsets["_pid"]] + [rows[g].eqNullSafe(offsets[g]) for g in group])
    return rows.join(offsets, cond, "inner").select(*(rows[c] for c in key), (F.col("_id") + F.col("_off")).cast("long").alias(out), "_size")


def rank_within_rating(ratings: DataFrame, **kw) -> DataFrame:
    """Row number per rating value, ordered by user (then movie, time: a total order
    so the answer is reproducible; the reference left ties arbitrary)."""
    return row_number_by_group(ratings, ["rating"], ["userId", "movieId", "ts"], "rank", **kw)


def rank_band_sample(ratings: DataFrame, bounds: tuple[int, int] | None = None, **kw) -> DataFrame:
    """Label each row with its band of the per-rating rank.

    Bands are disjoint and complete (D10): 1 = rank <= b1, 2 = b1 < rank <= b2, 3 = rank > b2.
    Default bounds are per-rating thirds, b1 = n/3 and b2 = 2*(n/3) with integer division
    (D11); pass absolute ``bounds`` to use the same two numbers for every rating.
    """
    ranked = rank_within_rating(ratings, size="_n", **kw)
    if bounds is None:
        third = F.floor(F.col("_n") / 3)
        ranked = ranked.withColumn("_b1", third).withColumn("_b2", third * 2)
    else:
        ranked = ranked.withColumn("_b1", F.lit(bounds[0])).withColumn("_b2", F.lit(bounds[1]))
    band = F.when(F.col("rank") <= F.col("_b1"), 1).when(F.col("rank") <= F.col("_b2"), 2).otherwise(3)
    return ranked.select("userId", "movieId", "rating", "rank", band.cast("int").alias("band"))


def banded(ratings: DataFrame, band: int, bounds: tuple[int, int] | None = None, **kw) -> DataFrame:
    """Rows of one band (1, 2 or 3) in the form of the ratings triple: sampled train/test tables."""
    return rank_band_sample(ratings, bounds, **kw).where(F.col("band") == band).select("userId", "movieId", "rating")
