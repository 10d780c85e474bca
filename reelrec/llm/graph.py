"""Connected components of an edge table, by hooking and pointer jumping.

``labels`` holds a component per vertex (its smallest member so far).  A round hooks every component
that has a smaller neighbour below the smallest of them, then follows the hooks to their ends.  Edges
and labels stay tables; only counts reach the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelrec.llm.common import release, written


def merge(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """``v, c`` and ``a, b`` (vertices) -> ``v, c`` with the components that the edges join made one.
    A vertex that ``labels`` lacks is its own component and stays out unless an edge has it."""
    ends = edges.select(F.col("a").alias("v")).unionByName(edges.select(F.col("b").alias("v"))).distinct()
    known = labels.unionByName(ends.join(labels, "v", "left_anti").select("v", F.col("v").alias("c")))
    known = written(known, "labels")
    a = known.select(F.col("v").alias("a"), F.col("c").alias("ca"))
    b = known.select(F.col("v").alias("b"), F.col("c").alias("cb"))
    left = written(edges.join(a, "a").join(b, "b").where("ca <> cb").select("ca", "cb").distinct(), "edges")
    while not left.isEmpty():
        hooks = (left.select(F.greatest("ca", "cb").alias("c"), F.least("ca", "cb").alias("to"))
                 .groupBy("c").agg(F.min("to").alias("to")))
        hooks = written(hooks, "hooks")
        while True:                          # a hook's end may be hooked itself
            on = hooks.select(F.col("c").alias("to"), F.col("to").alias("next"))
            jumped = hooks.join(on, "to", "left")
            after = written(jumped.select("c", F.coalesce("next", "to").alias("to"), F.col("next").isNotNull().alias("moved")), "hooks")
            release(hooks)
            more = not after.where("moved").isEmpty()
            hooks = after.drop("moved")
            hooks.written_path = after.written_path
            if not more:
                break
        before = known
        known = written(before.join(hooks, "c", "left").select("v", F.coalesce("to", "c").alias("c")), "labels")
        release(before)
        ha, hb = hooks.select(F.col("c").alias("ca"), F.col("to").alias("ta")), hooks.select(F.col("c").alias("cb"), F.col("to").alias("tb"))
        rest = written(left.join(ha, "ca", "left").join(hb, "cb", "left")
                       .select(F.coalesce("ta", "ca").alias("ca"), F.coalesce("tb", "cb").alias("cb"))
                       .where("ca <> cb").distinct(), "edges")
        release(left, hooks)
        left = rest
    release(left)
    return known
