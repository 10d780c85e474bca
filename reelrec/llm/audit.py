"""Filter interaction audit: what each filter removes, in every order of the filters, from sorted posting lists.

Each document's failures are found once.  Documents that agree in part, id, failures and labels are one entry with a
weight.  Entries are dealt by ranges of (part, id) and sorted, so a task holds a range of ids of each part; it reads
them in stretches of ``STRETCH`` entries of one part.  In a stretch every filter has the sorted list of the entries that fail it,
and so have the good and the toxic documents.  A k-way galloping merge (``gallop.merge``) gives the union of the
lists of each set of filters, a galloping search how much of it is good or toxic; sizes are sums of
weights.  Sizes of disjoint stretches add up, so Spark sums them per part, and everything asked of an order of filters is a
difference of two sizes:
removed = union(before + own) - union(before), redundant = own + union(before) - union(before + own),
unique = union(all) - union(all but own).

Equal texts are compared by 128 bits of hashes: a text fails if a smaller id has it.  The least id of every text that
occurs twice is aggregated before it is shuffled; texts with at least one of ``HOT`` parts of all rows are at most ``HOT`` in
number and go to every task, the other repeated ones meet the documents by a shuffle join.

Scale: one pass over the texts writes a narrow row per document; nothing after it has texts.  A stretch bounds a task's
memory whatever the ids or parts are, repeated ids add weight to an entry, and only sums leave a task.

Defined results: null and empty texts have no words, letters or symbols, and are equal to each other; a null lang is the
part ``''``; a null id is never smaller and has no labels; rows with one id are documents of their own; a document is good
(toxic) if any label row of its id says so; a part has all orders and steps, zeros included; an empty table has no parts.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelrec.llm import gallop
from reelrec.llm.common import by_value, table, written
from reelrec.llm.words import block_words, blocks, byte_table

by_value(__name__)

FILTERS = "ABCDE"
SYMBOLS = b"#$%&*|"
STRETCH = 1 << 16            # entries of one part that are merged together
HOT = 100_000                # repeated texts that are sent to every task, at most

_CASED = byte_table(31)      # A-Z are not a-z here
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(SYMBOLS)] = True


def _per_row(flags: np.ndarray, edges: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return sums[edges[1:]] - sums[edges[:-1]]


def _failures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds ``fails``: a bit per filter A to D.  Words are told apart by 64-bit hashes."""
    for batch in batches:
        for first, last, data, edges in blocks(batch.column("text")):
            rows = last - first
            h, doc = block_words(data, edges, _CASED)
            n = np.bincount(doc, minlength=rows)
            order = np.lexsort((h, doc))
            h, doc = h[order], doc[order]
            new = np.ones(len(h), dtype=bool)
            new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
            distinct = np.bincount(doc[new], minlength=rows)
            capitals = _per_row((data >= 65) & (data <= 90), edges)
            points = _per_row((data & 0xC0) != 0x80, edges)
            fails = ((n < 200) * 1 | (100 * distinct < 50 * n) * 2 | (100 * capitals > 3 * points) * 4
                     | (_per_row(_SYMBOL[data], edges) > 0) * 8)
            part = batch.slice(first, rows)
            yield pa.RecordBatch.from_arrays(
                [part.column(c) for c in ("doc_id", "part", "h1", "h2")] + [pa.array(fails.astype(np.int32))],
                names=["doc_id", "part", "h1", "h2", "fails"])


def _repeats(docs: DataFrame, hot: int) -> DataFrame:
    """Sets the bit of E: a smaller id has the text."""
    total = docs.count()
    own = F.when(F.col("doc_id") > F.col("_least"), 16).otherwise(0)
    repeated = written(docs.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("_n"), F.min("doc_id").alias("_least"),
                                                    F.max("doc_id").alias("_most"))
                       .where(F.col("_least") < F.col("_most")), "repeated")
    frequent = F.col("_n") * hot >= total
    often = repeated.where(frequent).select("h1", "h2", F.col("_least").alias("_often"))
    seldom = repeated.where(~frequent).select("h1", "h2", "_least")
    d = docs.join(F.broadcast(often), ["h1", "h2"], "left")
    settled = d.where("_often is not null").withColumn("_least", F.col("_often"))
    open_ = d.where("_often is null").join(seldom, ["h1", "h2"], "left")
    both = settled.select("doc_id", "part", "fails", "_least").unionByName(open_.select("doc_id", "part", "fails", "_least"))
    return both.select("doc_id", "part", F.col("fails").bitwiseOR(own).alias("fails"))


def failures(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """``doc_id, text, lang`` -> ``doc_id, part, fails``: a bit for each of the filters A to E, one row per row."""
    text = F.coalesce("text", F.lit(""))
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit("")).alias("part"), text.alias("text"),
                    F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2"))
    return _repeats(written(d.mapInArrow(_failures, "doc_id long, part string, h1 long, h2 long, fails int"), "failures"), hot)


def _sizes_task(filters: int, stretch: int):
    """Sorted rows ``part, doc_id, fails, good, toxic, weight`` -> per part and set of filters the sizes of its union."""
    def sizes(rows: dict[str, np.ndarray]) -> np.ndarray:
        weight = np.concatenate([[0], np.cumsum(rows["weight"])])
        every = np.arange(len(rows["fails"]))

        def size(at):
            return int((weight[at + 1] - weight[at]).sum())

        lists = [np.flatnonzero(rows["fails"] & 1 << k) for k in range(filters)]
        marked = [np.flatnonzero(rows[c]) for c in ("good", "toxic")]
        out = np.zeros((1 << filters, 4), dtype=np.int64)
        for chosen in range(1 << filters):
            union = gallop.merge([x for k, x in enumerate(lists) if chosen >> k & 1])
            out[chosen] = size(every), size(union), *(size(union[gallop.common(union, m)[0]]) for m in marked)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}

        def sent():
            parts = sorted(total)
            rows = [[p, chosen, *total[p][chosen].tolist()] for p in parts for chosen in range(1 << filters)]
            total.clear()
            return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["part", "chosen", "docs", "failing", "good", "toxic"])

        for batch in batches:
            parts = batch.column("part").to_pylist()
            columns = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("fails", "good", "toxic", "weight")}
            edges = [i for i in range(len(parts)) if i == 0 or parts[i] != parts[i - 1]] + [len(parts)]
            for lo, hi in zip(edges[:-1], edges[1:]):
                for at in range(lo, hi, stretch):
                    own = {c: x[at:min(at + stretch, hi)] for c, x in columns.items()}
                    total[parts[lo]] = total.get(parts[lo], 0) + sizes(own)
                if len(total) > 256:
                    yield sent()
        if total:
            yield sent()
    return run


def union_sizes(failing: DataFrame, labels: DataFrame, filters: int, stretch: int = STRETCH) -> DataFrame:
    """``doc_id, part, fails`` -> ``part, chosen, docs, failing, good, toxic``: for every set of filters (bits of ``chosen``)
    how many documents of the part there are, fail any of them, and of those are good and toxic."""
    entries = failing.groupBy("part", "doc_id", "fails").agg(F.count(F.lit(1)).alias("weight"))
    marks = (labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")))
    no = F.lit(False)
    e = (entries.join(marks, "doc_id", "left")
         .select("part", "doc_id", "fails", F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic"), "weight")
         .repartitionByRange("part", "doc_id").sortWithinPartitions("part", "doc_id", "fails"))
    schema = "part string, chosen long, docs long, failing long, good long, toxic long"
    return (e.mapInArrow(_sizes_task(filters, stretch), schema).groupBy("part", "chosen")
            .agg(*(F.sum(c).alias(c) for c in ("docs", "failing", "good", "toxic"))))


def orders(filters: Sequence[str]) -> list[tuple[str, int, int, int, int]]:
    """``filter_order, step, own, before, after`` (sets as bits) of every step of every order."""
    out = []
    for order in permutations(range(len(filters))):
        before = 0
        for step, k in enumerate(order, 1):
            out.append(("".join(filters[i] for i in order), step, 1 << k, before, before | 1 << k))
            before |= 1 << k
    return out


COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def interactions(sizes: DataFrame, filters: Sequence[str]) -> DataFrame:
    """A row per part, order and step from the sizes of the unions."""
    every = (1 << len(filters)) - 1
    steps = F.array(*[F.struct(F.lit(o).alias("filter_order"), F.lit(s).alias("step"), F.lit(own).alias("own"), F.lit(b).alias("before"),
                               F.lit(a).alias("after")) for o, s, own, b, a in orders(filters)])
    size = F.map_from_entries(F.collect_list(F.struct(F.col("chosen").cast("int"), F.struct("docs", "failing", "good", "toxic"))))
    per_part = sizes.groupBy("part").agg(size.alias("size")).select("part", "size", F.explode(steps).alias("s")).select("part", "size", "s.*")

    def of(chosen, what="failing"):
        return F.col("size")[chosen][what]

    out = per_part.select(
        "part", "filter_order", "step", "own",
        (of(F.lit(0), "docs") - of(F.col("after"))).alias("kept"),
        (of(F.col("after")) - of(F.col("before"))).alias("removed"),
        (of(F.col("own")) + of(F.col("before")) - of(F.col("after"))).alias("redundant"),
        (of(F.lit(every)) - of(F.lit(every).bitwiseXOR(F.col("own")))).alias("unique_fails"),
        (of(F.col("after"), "good") - of(F.col("before"), "good")).alias("good_lost"),
        (of(F.col("after"), "toxic") - of(F.col("before"), "toxic")).alias("toxic_lost"))
    shapley = out.groupBy("part", "own").agg(F.sum("removed").alias("shapley"))
    return out.join(shapley, ["part", "own"]).select("part", "filter_order", "step", *COUNTS)


def audit(docs: DataFrame, labels: DataFrame, stretch: int = STRETCH, hot: int = HOT) -> DataFrame:
    """What filters A to E do to ``docs`` in each part and order."""
    return interactions(union_sizes(failures(docs, hot), labels, len(FILTERS), stretch), FILTERS)


def op13_filter_audit(spark, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


_BIT = "case " + " ".join(f"when '{f}' then {1 << k}" for k, f in enumerate(FILTERS)) + " end"

ORACLE_SQL = r"""
with recursive d as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text from documents
), w as (
  select doc_id, part, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as words,
         min(doc_id) over (partition by text) as least from d
), f as (
  select doc_id, part,
         (case when len(words) < 200 then 1 else 0 end)
         + (case when 100 * len(list_distinct(words)) < 50 * len(words) then 2 else 0 end)
         + (case when 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) then 4 else 0 end)
         + (case when regexp_matches(text, '[#$%&*|]') then 8 else 0 end)
         + (case when doc_id > least then 16 else 0 end) as fails
  from w
), l as (
  select doc_id, max(case when quality = 1 then 1 else 0 end) as good, max(case when toxic = 1 then 1 else 0 end) as toxic
  from labels where doc_id is not null group by doc_id
), g as (
  select part, fails, count(*) as n, sum(coalesce(good, 0)) as good, sum(coalesce(toxic, 0)) as toxic
  from f left join l using (doc_id) group by part, fails
), p(filter_order, step, own, before) as (
  select l, 1, l, '' from (values ('A'), ('B'), ('C'), ('D'), ('E')) v(l)
  union all
  select filter_order || l, step + 1, l, filter_order from p, (values ('A'), ('B'), ('C'), ('D'), ('E')) v(l)
  where position(l in filter_order) = 0
), s as (
  select o.filter_order, p.step, BIT(p.own) as own,
         BITS(p.before) as before
  from p join p as o on o.step = 5 and starts_with(o.filter_order, p.filter_order)
), c as (
  select part, filter_order, step, own,
         sum(case when fails & (before | own) = 0 then n else 0 end) as kept,
         sum(case when fails & before = 0 and fails & own <> 0 then n else 0 end) as removed,
         sum(case when fails & before <> 0 and fails & own <> 0 then n else 0 end) as redundant,
         sum(case when fails = own then n else 0 end) as unique_fails,
         sum(case when fails & before = 0 and fails & own <> 0 then good else 0 end) as good_lost,
         sum(case when fails & before = 0 and fails & own <> 0 then toxic else 0 end) as toxic_lost
  from s cross join g group by part, filter_order, step, own
)
select part, filter_order, step::int as step, kept::bigint as kept, removed::bigint as removed, redundant::bigint as redundant,
       unique_fails::bigint as unique_fails, good_lost::bigint as good_lost, toxic_lost::bigint as toxic_lost,
       (sum(removed) over (partition by part, own))::bigint as shapley
from c
""".replace("BITS(p.before)", " + ".join(f"(case when position('{f}' in p.before) > 0 then {1 << k} else 0 end)" for k, f in enumerate(FILTERS))
            ).replace("BIT(p.own)", _BIT.replace("case ", "case p.own ", 1))
