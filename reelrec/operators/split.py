"""Exact first-k / last-k rows in a total order, without a global sort.

The reference sorts the whole ratings table by time and takes ``limit n`` (n up to 60 %
of the table), which Spark plans as one task merging n rows.  Here the k-th key is found
by histogram selection and the rows are then taken with a plain filter:

0. (chronological split) the first pass groups the key columns by day of ``ts``: count,
   null check and a first level for every cut at once, one row per day of the span;
1. per level, one aggregation ``groupBy(bucket(key_i)).agg(count, min, max)`` over the
   candidate rows of all pending cuts (a tagged union); at most ``buckets`` rows per cut
   come back to the driver;
2. the bucket where the running count reaches k becomes the new candidate range (its
   exact [min, max] is a pushdown-friendly range filter); when a bucket holds one value
   of key_i, that value is fixed and the next key column is bucketed;
3. once the candidates are at most ``exact_rows`` rows, a bounded ``row_number`` picks
   the k-th key K exactly;
4. output = rows with key < K (a filter, fully parallel) plus the needed copies of the
   K row (rows with equal full key are identical in the output columns).

Work: one scan per level over a shrinking candidate set, each returning a few thousand
counts.  No shuffle of rows, no single-task merge, same answer on any partitioning.
"""

from __future__ import annotations

import math
from contextlib import nullcontext
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelrec.session import held


DEFAULT_BUCKETS = 4096
DEFAULT_EXACT_ROWS = 200_000
COPIES_PER_TASK = 1_000_000
MAX_COARSE_GROUPS = 100_000   # first-level buckets the driver accepts (else plain stats)


@dataclass
class Cut:
    """The k-th key of a total order (normalised keys) and how many rows tie with it."""
    key: tuple
    copies: int          # rows with key == K that belong to the first k


def _and(conds: list[Column]) -> Column | None:
    return reduce(lambda a, b: a & b, conds) if conds else None


def _lex_less(cols: list[Column], vals: tuple) -> Column:
    expr = None
    for c, v in reversed(list(zip(cols, vals))):
        lit = F.lit(v)
        expr = (c < lit) if expr is None else ((c < lit) | ((c == lit) & expr))
    return expr


def _normalised(df: DataFrame, order: list[str], descending: bool) -> tuple[list[Column], list[bool]]:
    """Key expressions that sort ascending in the wanted direction (negated for desc)."""
    keys, integral = [], []
    for name in order:
        dtype = df.schema[name].dataType
        is_int = isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
        if not is_int and not isinstance(dtype, (T.FloatType, T.DoubleType)):
            raise TypeError(f"order column {name} must be numeric, got {dtype.simpleString()}")
        c = F.col(name).cast("long" if is_int else "double")
        keys.append(-c if descending else c)
        integral.append(is_int)
    return keys, integral


@dataclass
class KeyStats:
    n: int
    nulls: int
    lo: float | int | None      # min / max of the first order column (raw values)
    hi: float | int | None


def key_stats(df: DataFrame, order: list[str]) -> KeyStats:
    """One pass: row count, rows with a null order column, range of the first column."""
    first = F.col(order[0])
    row = df.agg(F.count(F.lit(1)).alias("n"),
                 F.count(F.when(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in order]), 1)).alias("nulls"),
                 F.min(first).alias("lo"), F.max(first).alias("hi")).first()
    return KeyStats(row["n"], row["nulls"], row["lo"], row["hi"])


@dataclass(eq=False)
class _Target:
    """Search state of one cut: candidates = rows matching ``conds``; the cut is the
    ``k``-th of them; columns before ``i`` are fixed, column ``i`` spans [lo, hi]."""
    k: int
    desc: bool
    count: int
    lo: float | int
    hi: float | int
    conds: list = field(default_factory=list)
    fixed: list = field(default_factory=list)
    i: int = 0
    cut: Cut | None = None


@dataclass
class CoarseHistogram:
    """First level of the selection, computed together with the key stats in one pass."""
    stats: KeyStats
    rows: list


def coarse_histogram(keys: DataFrame, order: list[str], coarse: Column) -> CoarseHistogram | None:
    """One pass: count, null rows and a histogram of the first order column over
    ``coarse``, an expression non-decreasing in that column (e.g. the day of an epoch
    time).  Its group count is bounded by the column's span (days in the data), not by
    the number of rows.  None when it has more than ``MAX_COARSE_GROUPS`` groups."""
    first = F.col(order[0])
    anynull = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in order])
    rows = (keys.groupBy(coarse.alias("_c"))
            .agg(F.count(F.lit(1)).alias("n"), F.count(F.when(anynull, 1)).alias("nulls"),
                 F.min(first).alias("lo"), F.max(first).alias("hi"))
            .limit(MAX_COARSE_GROUPS + 1).collect())
    if len(rows) > MAX_COARSE_GROUPS:
        return None
    n = sum(r["n"] for r in rows)
    nulls = sum(r["nulls"] for r in rows)
    rows = [r for r in rows if r["_c"] is not None]
    lo = min((r["lo"] for r in rows), default=None)
    hi = max((r["hi"] for r in rows), default=None)
    return CoarseHistogram(KeyStats(n, nulls, lo, hi), rows)


def select_kth(df: DataFrame, order: list[str], k: int, *, descending: bool = False, **kw) -> Cut:
    """Find the k-th (1-based) key of ``df`` in lexicographic ``order``."""
    return select_kths(df, order, [(k, descending)], **kw)[0]


def select_kths(df: DataFrame, order: list[str], targets: list[tuple[int, bool]], *,
                buckets: int = DEFAULT_BUCKETS, exact_rows: int = DEFAULT_EXACT_ROWS,
                stats: KeyStats | None = None, persist: bool = True,
                first_level: "CoarseHistogram | None" = None) -> list[Cut]:
    """Several cuts ``(k, descending)`` of one input by histogram refinement, in lockstep:
    each round runs at most three jobs (ranges, histograms, exact finishes) whatever the
    number of cuts, each a tagged union over the key columns.  The key columns are
    persisted for the duration (``persist=False`` when the caller already holds them)."""
    if not targets:
        return []
    keys = df.select(*order)
    with held(keys) if persist else nullcontext(keys) as keys:
        return _select(keys, order, targets, buckets, exact_rows, stats, first_level)


def _select(keys: DataFrame, order: list[str], targets: list[tuple[int, bool]], buckets: int,
            exact_rows: int, stats: KeyStats | None, first_level: "CoarseHistogram | None" = None) -> list[Cut]:
    names = [f"_k{i}" for i in range(len(order))]
    cols = [F.col(n) for n in names]
    views, integral = {}, None
    for desc in {d for _, d in targets}:
        exprs, integral = _normalised(keys, order, desc)
        views[desc] = keys.select(*[e.alias(n) for e, n in zip(exprs, names)])
    if first_level is not None:
        stats = first_level.stats
    stats = stats or key_stats(keys, order)
    if stats.nulls:
        raise ValueError(f"order columns {order} hold {stats.nulls} null rows; quarantine them first")
    cast = int if integral[0] else float
    state = []
    for k, desc in targets:
        if not 1 <= k <= stats.n:
            raise ValueError(f"k={k} must be in 1..{stats.n}")
        lo, hi = (cast(-stats.hi), cast(-stats.lo)) if desc else (cast(stats.lo), cast(stats.hi))
        t = _Target(k, desc, stats.n, lo, hi)
        if first_level is not None:      # start inside the coarse bucket that holds row k
            acc = 0
            for row in sorted(first_level.rows, key=lambda r: r["_c"], reverse=desc):
                if acc + row["n"] >= k:
                    t.k, t.count = k - acc, row["n"]
                    b_lo, b_hi = cast(row["lo"]), cast(row["hi"])
                    t.lo, t.hi = (-b_hi, -b_lo) if desc else (b_lo, b_hi)
                    t.conds.append(cols[0].between(F.lit(t.lo), F.lit(t.hi)))
                    break
                acc += row["n"]
        state.append(t)

    def tagged(ts: list[tuple[int, _Target]], build) -> DataFrame:
        parts = []
        for j, t in ts:
            cand = views[t.desc].where(_and(t.conds)) if t.conds else views[t.desc]
            parts.append(build(cand, t, j).withColumn("_t", F.lit(j)))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def value_cols(t: _Target) -> list[Column]:
        # exact values whatever the type: longs and doubles in separate columns
        c = cols[t.i]
        if integral[t.i]:
            return [c.alias("_vl"), F.lit(None).cast("double").alias("_vd")]
        return [F.lit(None).cast("long").alias("_vl"), c.alias("_vd")]

    def bounds(r, t: _Target) -> tuple:
        return (r["lo_l"], r["hi_l"]) if integral[t.i] else (r["lo_d"], r["hi_d"])

    minmax = [F.min("_vl").alias("lo_l"), F.max("_vl").alias("hi_l"),
              F.min("_vd").alias("lo_d"), F.max("_vd").alias("hi_d")]

    while any(t.cut is None for t in state):
        # 1. single-valued column: fix it and read the range of the next column (one job)
        while True:
            fixing = [(j, t) for j, t in enumerate(state) if t.cut is None and t.count > exact_rows and t.lo == t.hi]
            if not fixing:
                break
            nxt = []
            for j, t in fixing:
                t.fixed.append(t.lo)
                t.conds.append(cols[t.i] == F.lit(t.lo))
                t.i += 1
                if t.i == len(cols):      # every key column fixed: all candidates are identical
                    t.cut = Cut(tuple(t.fixed), copies=t.k)
                else:
                    nxt.append((j, t))
            if nxt:
                rng = tagged(nxt, lambda c, t, j: c.select(*value_cols(t)))
                for r in rng.groupBy("_t").agg(*minmax).collect():
                    t = state[r["_t"]]
                    t.lo, t.hi = bounds(r, t)
        # 2. bounded candidate sets: one window over all of them, read row k of each (one job)
        exact = [(j, t) for j, t in enumerate(state) if t.cut is None and t.count <= exact_rows]
        if exact:
            w = Window.partitionBy("_t").orderBy(*cols)
            ranked = tagged(exact, lambda c, t, j: c.select(*cols)).select(
                "_t", *cols, F.row_number().over(w).alias("_rn"), F.rank().over(w).alias("_rk"))
            want = F.lit(False)
            for j, t in exact:
                want = want | ((F.col("_t") == j) & (F.col("_rn") == t.k))
            for r in ranked.where(want).collect():
                t = state[r["_t"]]
                t.cut = Cut(tuple(r[n] for n in names), copies=t.k - r["_rk"] + 1)
        # 3. large candidate sets: one histogram per cut on its current column (one job)
        wide = [(j, t) for j, t in enumerate(state) if t.cut is None and t.count > exact_rows and t.lo != t.hi]
        if not wide:
            continue
        bucket_of = {}
        for j, t in wide:
            c = cols[t.i]
            if integral[t.i]:
                width = max(1, math.ceil((t.hi - t.lo + 1) / buckets))
                bucket_of[j] = F.floor((c - F.lit(t.lo)) / F.lit(width)).cast("long")
            else:
                width = (t.hi - t.lo) / buckets
                bucket_of[j] = F.least(F.floor((c - F.lit(t.lo)) / F.lit(width)).cast("long"), F.lit(buckets - 1))
        hist = tagged(wide, lambda c, t, j: c.select(bucket_of[j].alias("_b"), *value_cols(t)))
        rows = hist.groupBy("_t", "_b").agg(F.count(F.lit(1)).alias("n"), *minmax).collect()
        for j, t in wide:
            acc = 0
            for r in sorted((r for r in rows if r["_t"] == j), key=lambda r: r["_b"]):
                if acc + r["n"] >= t.k:
                    t.k -= acc
                    t.count = r["n"]
                    t.lo, t.hi = bounds(r, t)
                    t.conds.append(cols[t.i].between(F.lit(t.lo), F.lit(t.hi)))
                    break
                acc += r["n"]
            else:  # pragma: no cover - counts are consistent within one input
                raise RuntimeError("histogram did not reach k; input changed between passes")
    return [t.cut for t in state]


def first_k(df: DataFrame, order: list[str], k: int, *, descending: bool = False,
            output: list[str] | None = None, cut: Cut | None = None, **kw) -> DataFrame:
    """The first ``k`` rows of ``df`` in lexicographic ``order`` (ascending or descending).

    Rows with an equal full key are interchangeable, so ``output`` must be a subset of
    ``order`` (add columns to ``order`` to make it so).
    """
    output = list(output or order)
    missing = [c for c in output if c not in order]
    if missing:
        raise ValueError(f"output columns {missing} are not in the order key; rows tied on the key "
                         "could differ in them")
    schema = df.schema
    if k <= 0:
        return df.select(*output).where(F.lit(False))
    if cut is None:
        cut = select_kth(df, order, k, descending=descending, **kw)
    keys, _ = _normalised(df, order, descending)
    orig = {name: (-v if descending else v) for name, v in zip(order, cut.key)}
    # the raw first-key bound is implied by the lexicographic test; stated on the stored
    # column it can reach the Parquet scan (or the join side that holds the column)
    lead = F.col(order[0])
    bound = lead >= F.lit(orig[order[0]]) if descending else lead <= F.lit(orig[order[0]])
    below = df.where(bound & _lex_less(keys, cut.key)).select(*output)
    spark = df.sparkSession
    parts = max(1, math.ceil(cut.copies / COPIES_PER_TASK))
    ties = spark.range(0, cut.copies, 1, parts).select(
        *[F.lit(orig[c]).cast(schema[c].dataType).alias(c) for c in output])
    return below.unionByName(ties)


def chronological_split(ratings: DataFrame, fraction: float = 0.6, *,
                        order: tuple[str, ...] = ("ts", "userId", "movieId", "rating"),
                        output: tuple[str, ...] = ("userId", "movieId", "rating"),
                        time_bucket_seconds: int = 86400, persist: bool = True, **kw) -> tuple[DataFrame, DataFrame]:
    """Oldest ``int(n*fraction)`` rows = train, newest ``int(n*(1-fraction))`` = test.

    The total order ``(ts, userId, movieId, rating)`` breaks time ties (D1): test is the
    exact reverse order, so train and test never share a row position and at most one
    row is left over.  Counts use double arithmetic truncated toward zero, as the
    reference does.  The first pass counts rows per day of ``ts`` (at most one row per
    day in the data's span), which is also the first level of both selections.
    """
    order, output = list(order), list(output)
    # Selection passes read only the key columns, persisted once for both cuts (a stored table is as fast to read again).
    keys = ratings.select(*order)
    with held(keys) if persist else nullcontext(keys) as keys:
        days = coarse_histogram(keys, order, F.floor(F.col(order[0]) / F.lit(time_bucket_seconds)))
        stats = days.stats if days else key_stats(keys, order)
        n = stats.n
        k_train = int(n * fraction)
        k_test = int(n * (1 - fraction))
        wanted = [(k, d) for k, d in ((k_train, False), (k_test, True)) if k]
        cuts = dict(zip(wanted, select_kths(keys, order, wanted, stats=stats, first_level=days,
                                                    persist=False, **kw)))
        cut_train, cut_test = cuts.get((k_train, False)), cuts.get((k_test, True))
    empty = ratings.select(*output).where(F.lit(False))
    train = first_k(ratings, order, k_train, output=output, cut=cut_train) if k_train else empty
    test = first_k(ratings, order, k_test, descending=True, output=output, cut=cut_test) if k_test else empty
    return train, test
