"""Benchmark decontamination by a prefix-filtered containment join, in DataFrame functions only.

A benchmark item is cut into windows of ``width`` consecutive words (an item of fewer words is one
window).  A document contains a window only if it contains all its word shingles, so it is enough to
look for one of them, the necessary prefix for containment 1.  The shingles are ordered by rarity,
counted over all documents, and the rarest of each window is its prefix token: frequent phrases are
hardly ever looked up.

Plan: (1) one pass over the documents counts the benchmark's shingles; (2) a second pass joins every
document position with the prefix tokens, applies the length and positional bounds (the window must
begin at or after the first word and end at or before the last), and compares the whole window word by
word.  Both are broadcast joins inside the stage that splits the text, so words are never shuffled;
only hits are, by document.  A task aggregates before it shuffles.  Tokens are hashed in lower case (any
letter); the comparison lowers A-Z alone.

What is broadcast is bounded: windows and shingles go out in blocks of at most ``block`` rows, one pass
over the documents a block.

Rows of a document are told apart by (doc_id, two hashes of the text).  Hits of a document are merged by a running maximum of
their ends, so memory follows the document, not the number of windows.

Defined results: null texts have no words, no hits and are clean; an item without words has no window;
items with a null id make hits but are not listed; exact repeats of a row each get the same result, as do
rows with the same id and other texts, each by its own text; empty tables give no windows or no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from reelrec.llm.common import ascii_lower, table, written

WIDTH = 10
SHINGLE = 3
BLOCK = 200_000              # windows or shingles broadcast at once (about 60 MB)
WORDS = r"[\p{Alnum}\P{ASCII}]+"      # 0-9, A-Z, a-z and code points above 0x7F
TAIL = -7046029254386353131             # token of the row that stands for a document's end


def words_of(text: Column) -> Column:
    """Runs of digits, letters a-z in either case and code points above 0x7F."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(WORDS), F.lit(0)), F.array().cast("array<string>"))


def windows(benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """``item_id, text`` -> ``item_id, wid, gram`` (gram: the words of the window)."""
    b = benchmark.select("item_id", words_of(ascii_lower(F.col("text"))).alias("_w")).where(F.size("_w") > 0)
    last = F.greatest(F.size("_w") - width, F.lit(0))
    b = b.select("item_id", "_w", F.explode(F.sequence(F.lit(0), last)).alias("_i"))
    gram = F.slice("_w", F.col("_i") + 1, F.least(F.size("_w"), F.lit(width)))
    return (b.select("item_id", gram.alias("gram"))
            .withColumn("wid", F.md5(F.array_join("gram", " ").cast("binary"))).distinct())


def _token(word_at, k: int) -> Column:
    """Hash of k words in any case: equal words have equal hashes, the comparison comes later."""
    return F.xxhash64(*[F.lower(word_at(j)) for j in range(k)])


def _shingles(grams: DataFrame, shingle: int) -> DataFrame:
    """``wid, gram`` -> ``wid, k, off, token``: the shingles of each window (k words each)."""
    parts = []
    for k in range(1, shingle + 1):
        g = grams.where(F.size("gram") >= k if k == shingle else F.size("gram") == k)
        g = g.select("wid", "gram", F.explode(F.sequence(F.lit(0), F.size("gram") - k)).alias("off"))
        parts.append(g.select("wid", F.lit(k).alias("k"), "off",
                              _token(lambda j: F.get("gram", F.col("off") + j), k).alias("token")))
    return reduce(DataFrame.unionByName, parts)


def _positions(docs: DataFrame, k: int, tail: bool = False) -> DataFrame:
    """Every word position of every document with the token of the k words from there; with ``tail``
    also a row after the last word of each document."""
    d = docs.select(*_key(docs), words_of(F.col("text")).alias("_w"))
    each = F.concat("_w", F.array(F.lit(None).cast("string"))) if tail else F.col("_w")
    d = d.select("_id", "_h1", "_h2", "_w", F.posexplode_outer(each).alias("_pos", "_word"))
    token = _token(lambda j: F.col("_word") if j == 0 else F.get("_w", F.col("_pos") + j), k)
    if tail:
        token = F.when(F.col("_pos") == F.size("_w"), F.lit(TAIL)).otherwise(token)
    return d.select("_id", "_h1", "_h2", "_w", "_pos", token.alias("token"))


def _key(docs: DataFrame) -> list[Column]:
    return [F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_h1"), F.xxhash64(F.lit(1), F.col("text")).alias("_h2")]


def _blocks(df: DataFrame, rows: int, key: str, block: int) -> list[DataFrame]:
    n = max(1, -(-rows * 5 // (block * 4))) if rows > block else 1     # a margin for uneven hashes
    return [df] if n == 1 else [df.where(F.pmod(F.xxhash64(F.lit("block"), F.col(key)), F.lit(n)) == i) for i in range(n)]


def prefix_tokens(docs: DataFrame, grams: DataFrame, shingle: int, block: int) -> DataFrame:
    """``wid, gram, k, off, token`` with the rarest shingle of each window, by its number of
    occurrences in all documents."""
    sh = written(_shingles(grams, shingle), "shingles")
    tokens = sh.select("k", "token").distinct().groupBy("k").count().collect()     # a row for each k up to ``shingle``
    counted = []
    for k, n in sorted((r["k"], r["count"]) for r in tokens):
        own = sh.where(F.col("k") == k).select("token").distinct()
        for part in _blocks(own, n, "token", block):
            counted.append(_positions(docs, k).select("token").join(F.broadcast(part), "token")
                           .groupBy("token").agg(F.count(F.lit(1)).alias("n")).withColumn("k", F.lit(k)))
    if not counted:                                  # no window at all
        return grams.join(sh, "wid").select("wid", "gram", "k", "off", "token")
    n = reduce(DataFrame.unionByName, counted)
    best = (sh.join(n, ["k", "token"], "left").groupBy("wid")
            .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token", "off", "k")).alias("_b")))
    return grams.join(best, "wid").select("wid", "gram", "_b.k", "_b.off", "_b.token")


def occurrences(docs: DataFrame, grams: DataFrame, shingle: int = SHINGLE, block: int = BLOCK) -> DataFrame:
    """``_id, _h1, _h2, start, len, wid``: every occurrence of a window in a document, and a row per
    document with a null ``wid`` that starts after its last word."""
    prefix = written(prefix_tokens(docs, grams, shingle, block), "prefix")
    sizes = {r["k"]: r["count"] for r in prefix.groupBy("k").count().collect()} or {shingle: 0}
    end = docs.sparkSession.range(1).select(F.lit(None).cast("string").alias("wid"), F.array().cast("array<string>").alias("gram"),
                                            F.lit(0).alias("off"), F.lit(TAIL).alias("token"))
    found = []
    for k, n in sorted(sizes.items()):
        own = prefix.where(F.col("k") == k).select("wid", "gram", "off", "token")
        for part in _blocks(own, n, "wid", block):
            tail = not found
            j = _positions(docs, k, tail).join(F.broadcast(part.unionByName(end) if tail else part), "token")
            start, size = F.col("_pos") - F.col("off"), F.size("gram")
            inside = (start >= 0) & (start + size <= F.size("_w"))             # positional and length bounds
            # built of functions with generated code, so the position's row is never copied with its words
            there = ascii_lower(F.array_join(F.slice("_w", F.greatest(start, F.lit(0)) + 1, size), " "))
            whole = F.col("wid").isNotNull() | (start == F.size("_w"))
            found.append(j.where(inside & whole).where(there == F.array_join("gram", " "))
                         .select("_id", "_h1", "_h2", start.alias("start"), size.alias("len"), "wid"))
    return reduce(DataFrame.unionByName, found)


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, shingle: int = SHINGLE,
                  block: int = BLOCK) -> DataFrame:
    """``doc_id, text`` and ``item_id, text`` -> ``doc_id, n_words, n_hit, n_items, items_sha256,
    contaminated``, one row per document row; ``spans`` lists the hit word ranges."""
    docs = docs.select("doc_id", "text")
    w = written(windows(benchmark.select("item_id", "text"), width), "windows")
    found = written(occurrences(docs, w.select("wid", "gram").dropDuplicates(["wid"]), shingle, block), "hits")
    base = found.where("wid is null").select("_id", "_h1", "_h2", F.col("start").cast("long").alias("n_words"))
    hits = found.where("wid is not null").distinct()
    doc = ["_id", "_h1", "_h2"]
    longest = hits.groupBy(*doc, "start").agg(F.max(F.col("start") + F.col("len")).alias("end"))
    before = Window.partitionBy(*doc).orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.coalesce(F.max("end").over(before), F.lit(-1))
    covered = longest.withColumn("from", F.greatest(F.col("start"), reached)).where("`end` > `from`")
    n_hit = covered.groupBy(*doc).agg(F.sum(F.col("end") - F.col("from")).cast("long").alias("n_hit"),
                                      F.sort_array(F.collect_list(F.struct("from", F.col("end").alias("to")))).alias("spans"))
    items = (hits.select(*doc, "wid").distinct().join(w.select("wid", F.col("item_id").cast("string").alias("item")), "wid")
             .groupBy(*doc).agg(F.sort_array(F.collect_set("item")).alias("_items")))
    null_safe = lambda a, b: [a[c].eqNullSafe(b[c]) for c in doc]
    both = n_hit.join(items, null_safe(n_hit, items), "left").select(
        *[n_hit[c] for c in doc], "n_hit", "spans", "_items")
    out = base.join(both, null_safe(base, both), "left")
    ids = F.coalesce("_items", F.array().cast("array<string>"))
    return out.select(base["_id"].alias("doc_id"), "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                      F.size(ids).cast("long").alias("n_items"),
                      F.sha2(F.array_join(ids, ",").cast("binary"), 256).alias("items_sha256"),
                      F.col("n_hit").isNotNull().alias("contaminated"),
                      F.coalesce("spans", F.array().cast("array<struct<from:int,to:int>>")).alias("spans"))


def contaminated(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, shingle: int = SHINGLE, block: int = BLOCK) -> DataFrame:
    """``_id, _h1, _h2`` (id and text hashes) of the documents with a hit, one row each."""
    w = written(windows(benchmark.select("item_id", "text"), width), "windows")
    found = occurrences(docs.select("doc_id", "text"), w.select("wid", "gram").dropDuplicates(["wid"]), shingle, block)
    return written(found.where("wid is not null").select("_id", "_h1", "_h2").distinct(), "contaminated")


def op3_decontaminate(spark, sf_dir: str) -> DataFrame:
    out = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


ORACLE_SQL = r"""
with b as (select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
bi as (select item_id, w, least(10, len(w)) as l, unnest(range(1, len(w) - least(10, len(w)) + 2)) as i from b where len(w) > 0),
iw as (select distinct item_id, l, w[i:i + l - 1] as g from bi),
d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
dl as (select d.doc_id, d.w, x.l, unnest(range(1, len(d.w) - x.l + 2)) as i from d, (select distinct l from iw) x),
dg as (select doc_id, l, i, w[i:i + l - 1] as g from dl),
h as (select dg.doc_id, dg.i, dg.l, iw.item_id from dg join iw on dg.l = iw.l and dg.g = iw.g),
p as (select doc_id, count(distinct p)::bigint as n_hit from (select doc_id, unnest(range(i, i + l)) as p from h) group by doc_id),
t as (select doc_id, count(*)::bigint as n_items, sha256(string_agg(item, ',' order by item)) as items_sha256
      from (select distinct doc_id, item_id::varchar as item from h) group by doc_id)
select d.doc_id, len(d.w)::bigint as n_words, coalesce(p.n_hit, 0)::bigint as n_hit, coalesce(t.n_items, 0)::bigint as n_items,
  coalesce(t.items_sha256, sha256('')) as items_sha256, coalesce(p.n_hit, 0) > 0 as contaminated
from d left join p on d.doc_id = p.doc_id left join t on d.doc_id = t.doc_id
"""
