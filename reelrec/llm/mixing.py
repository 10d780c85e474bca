"""Mixing sources to target weights by capped water-filling.

Every source has a weight and a size (words).  The mix shares ``share`` times all words over
the sources in proportion to their weights, but no source may go beyond ``max_epochs`` times
its own size: such a source is clamped there and its excess is shared by the others in
proportion to their weights, until no target is above its cap.

The fixed point has a closed form.  With the sources sorted by cap / weight, the clamped ones
are a prefix: source i is clamped iff ``weight_i * level_i >= cap_i``, where ``level_i`` is what is
left of the share per unit of weight once all sources before i are clamped.  All others get
``weight * level`` with the level of the first of them.

Inside a source every document is taken ``floor(target / size)`` times whole.  The rest of the
target goes to documents in the order of a seeded hash: whole repetitions, and a fractional one
for the document in which the target is reached.  So the words taken from a source are its
target, rounded, whatever the sizes of its documents.

Scale: one pass over the texts writes (id, source, size, key); everything else works on that
narrow table.  A hot source is dealt into hash buckets, whose sums give the bucket in which the
target is reached; running sums are then taken per (source, bucket), never per source.

Defined results: null texts have size 0; a null source is a source of its own, last in order;
documents of size 0 are kept in the result with taken 0; rows with the same id are separate
documents (exact repeats are interchangeable); an empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelrec.llm.common import word_count, written

WEIGHTS = (5, 2, 1)          # by rank of the source, repeating
SHARE = 1.5
MAX_EPOCHS = 2.0
SEED = 17
BUCKET_DIGITS = 4            # hex digits of the key: 65,536 buckets a source


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE,
                   max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """``source, source_size`` -> the same with ``weight`` and ``target``.

    One row per source goes through one task: the number of sources, not of documents."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    pattern = F.array(*[F.lit(float(w)) for w in weights])
    s = sizes.withColumn("_rank", F.row_number().over(by_name))
    s = s.withColumn("weight", F.get(pattern, (F.col("_rank") - 1) % len(weights)))
    s = s.withColumn("_cap", F.col("source_size") * F.lit(float(max_epochs)))
    s = s.withColumn("_total", F.sum("source_size").over(everything) * F.lit(float(share)))
    s = s.withColumn("_weights", F.sum("weight").over(everything))
    before = (Window.orderBy(F.col("_cap") / F.col("weight"), "_rank")
              .rowsBetween(Window.unboundedPreceding, -1))
    left = F.col("_total") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    open_weight = F.col("_weights") - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    s = s.withColumn("_level", left / open_weight)
    s = s.withColumn("_clamped", F.col("weight") * F.col("_level") >= F.col("_cap"))
    # levels fall after the first source that isn't clamped, so its level is the largest
    s = s.withColumn("_water", F.max(F.when(~F.col("_clamped"), F.col("_level"))).over(everything))
    return s.select("source", "source_size", "weight",
                    F.when(F.col("_clamped"), F.col("_cap")).otherwise(F.col("weight") * F.col("_water")).alias("target"))


def seeded_key(doc_id: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))).cast("binary"))


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE,
        max_epochs: float = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """``doc_id, text, source`` -> ``doc_id, source, size, source_size, target, taken``, one row
    per document.  ``taken`` counts repeated words: ``taken / size`` is the number of epochs."""
    base = written(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"),
                               seeded_key(F.col("doc_id"), seed).alias("_key")), "mix")
    base = base.withColumn("_bucket", F.substring("_key", 1, BUCKET_DIGITS))
    buckets = base.groupBy("source", "_bucket").agg(F.sum("size").alias("_bsize"))
    sizes = buckets.groupBy("source").agg(F.sum("_bsize").alias("source_size"))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    targets = (source_targets(sizes, weights, share, max_epochs)
               .withColumn("_whole", whole)
               .withColumn("_rest", F.floor(F.col("target") - F.col("_whole") * F.col("source_size") + 0.5)))
    t = targets.withColumnRenamed("source", "_src")
    same = F.col("source").eqNullSafe(F.col("_src"))
    # the bucket in which the rest of the target is used up, with the words before it
    run = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    edge = (buckets.withColumn("_before", F.coalesce(F.sum("_bsize").over(run), F.lit(0)))
            .join(t.select("_src", "_rest"), same)
            .where((F.col("_before") <= F.col("_rest")) & (F.col("_before") + F.col("_bsize") > F.col("_rest")))
            .groupBy("_src").agg(F.min("_bucket").alias("_edge"), F.min("_before").alias("_before")))
    plan = t.join(edge.withColumnRenamed("_src", "_src2"), F.col("_src").eqNullSafe(F.col("_src2")), "left").drop("_src2")
    # documents meet their source's plan by (source, bucket), so a hot source is many keys
    dealt = (buckets.select(F.col("source").alias("_bsrc"), F.col("_bucket").alias("_b")).join(plan, F.col("_bsrc").eqNullSafe(F.col("_src")))
             .drop("_src"))
    d = base.join(dealt, F.col("source").eqNullSafe(F.col("_bsrc")) & (F.col("_bucket") == F.col("_b")))
    inside = (Window.partitionBy("source", "_bucket").orderBy("_key", "doc_id", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    d = d.withColumn("_in", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("_rest") - F.col("_before") - F.col("_in")))
    extra = (F.when(F.col("_rest") >= F.col("source_size"), F.col("size"))    # rounded up to the whole source: no edge
             .when(F.col("_edge").isNull(), F.lit(0))
             .when(F.col("_bucket") < F.col("_edge"), F.col("size"))
             .when(F.col("_bucket") == F.col("_edge"), part).otherwise(F.lit(0)))
    return d.select("doc_id", "source", "size", "source_size", "target",
                    (F.col("_whole") * F.col("size") + extra).cast("long").alias("taken"))


def op7_mixing(spark, sf_dir: str) -> DataFrame:
    from reelrec.llm.common import table
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


ORACLE_SQL = r"""
with d as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
         md5('17:' || coalesce(doc_id::varchar, 'null')) as k from documents),
s as (select source, sum(size)::bigint as source_size from d group by source),
r as (select *, row_number() over (order by source asc nulls last) as rk from s),
w as (select *, case (rk - 1) % 3 when 0 then 5.0::double when 1 then 2.0::double else 1.0::double end as weight,
             source_size * 2.0::double as cap from r),
v as (select *, coalesce(sum(cap) over o, 0.0::double) as cb, coalesce(sum(weight) over o, 0.0::double) as wb,
             sum(source_size) over () * 1.5::double as total, sum(weight) over () as weights
      from w window o as (order by cap / weight, rk rows between unbounded preceding and 1 preceding)),
l as (select *, (total - cb) / (weights - wb) as level from v),
c as (select *, weight * level >= cap as clamped from l),
t as (select *, case when clamped then cap else
        weight * max(case when not clamped then level end) over () end as target from c),
e as (select source, source_size, target,
        case when source_size > 0 then floor(target / source_size) else 0 end as whole from t),
f as (select *, floor(target - whole * source_size + 0.5::double) as rest from e),
g as (select d.doc_id, d.size, f.source_size, f.target, f.whole, f.rest,
        coalesce(sum(d.size) over (partition by d.source order by d.k, d.doc_id, d.size
                                   rows between unbounded preceding and 1 preceding), 0) as before
      from d join f on d.source is not distinct from f.source)
select doc_id, size, source_size, target,
       (whole * size + greatest(0, least(size, rest - before)))::bigint as taken from g
"""
