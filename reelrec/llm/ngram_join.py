"""N-gram Jaccard join by vertical partitioning: which documents share 75 % of their word shingles.

Documents with the same shingle set are one class from the start (a 128-bit hash of the set).  The
global order of the shingles is cut into fragments, ranges of their hash.  Each class sends its segment
of every fragment, packed with the segments of its neighbours, to that fragment's task.  There a
shingle of one class only drops out; for the others the fragment answers each class with its partial
count of shared shingles and their frequency.  Summed over the fragments, a class with fewer than 75 %
shared shingles cannot have a partner and is done.  That leaves about a tenth of the classes.

For the rest, the shingles are ordered by frequency, rarest first (shingles of one class come first of
all), and each class keeps the prefix that any partner must share a shingle with.  Classes
that meet in a prefix shingle are candidates.  Their partial overlaps are counted fragment by fragment and
summed per pair; a pair is a link if 100 * overlap >= 75 * union.

Only components are asked for, so a group of n candidates is not expanded into n*n pairs.  It is
checked against a few pivots at a time (1, 16, 256, ...), and members that are already in one component
with a pivot are not compared with it.  Rounds go on until every group is either in one
component or fully compared, so no link between components is ever missed.

Scale and skew: shingles that a task finds in 1/250 of its classes, and that add up to 1/250 of all
documents, are "hot".  Their postings are not
sent to the fragments (they always count as shared, last in the order), so no fragment grows with a
passage that a third of the documents hold.  Copies collapse inside a task before anything is sent.
Fragments hold about ``FRAGMENT`` postings each; their number follows the input.  Hot candidate groups
go through map-side limits and skew joins.  Links, labels and groups stay tables.

Shingles are compared by 64-bit hashes in a class's signature and by fragment number and 40 bits in the fragments: two
texts of 10,000 words are off by a shingle with a probability of about 3e-6 at most, and fall on the
wrong side of the threshold only if they are within that one shingle of it.

Defined results: null, empty and blank texts have no shingles and link with nothing; a text of fewer than
five words is one shingle; copies share a component; the component is the smallest non-null doc_id; rows
with equal ids are separate documents with one id; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelrec.llm import graph
from reelrec.llm.common import by_value, release, table, trimmed, written
from reelrec.llm.packing import KEY_BITS, KEY_MASK, fragment_of, planes, starts, unplanes
from reelrec.llm.words import mix64, shingles, text_words

by_value(__name__)

PERCENT = 75
FRAGMENT = 1_500_000         # postings of a fragment
FLUSH = 1_000_000            # postings packed at once by a task
HOT_SHARE = 250
HOT_LEAST = 16
SENT_PAIRS = 500_000         # pairs whose ids are broadcast (16 MB at most)
MEMBERS = 5_000              # members of a candidate group in one array
PIECES = 4                   # segments in which an overlap is counted
HOT_DF = 65_535              # frequency given to hot shingles: last in the order


# --- signatures ------------------------------------------------------------------------------

def _set_hashes(doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows with shingles, the size of their sets, and two order-free hashes of each."""
    at = starts(doc)
    n = np.diff(np.append(at, len(doc)))
    if not len(at):
        zero = np.zeros(0, dtype=np.uint64)
        return doc, n, zero, zero
    s1 = np.add.reduceat(mix64(h ^ np.uint64(0xA5A5A5A5A5A5A5A5)), at)
    s2 = np.add.reduceat(mix64(h + np.uint64(0x1234567887654321)), at)
    return doc[at], n, mix64(s1 + n.astype(np.uint64)), s2


SIG_SCHEMA = "doc_id long, n long, cid long, check long, kind int"
DOC, HOT = 0, 1


def _sign_task(with_hot: bool = True):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, held, docs = set(), [], 0
        held_n = 0

        def rows(ids, n, cid, check, kind):
            return pa.RecordBatch.from_arrays(
                [ids, pa.array(n, pa.int64()), pa.array(cid.view(np.int64)), pa.array(check.view(np.int64)),
                 pa.array(np.full(len(n), kind, dtype=np.int32))], names=["doc_id", "n", "cid", "check", "kind"])

        def hot():
            """Shingles that many classes of this flush have."""
            h = np.sort(np.concatenate(held))
            at = starts(h)
            n = np.diff(np.append(at, len(h)))
            often = n >= max(HOT_LEAST, docs // HOT_SHARE)
            return rows(pa.nulls(int(often.sum()), pa.int64()), n[often], h[at][often],
                        np.full(int(often.sum()), docs, dtype=np.uint64), HOT)

        for batch in batches:
            ids = batch.column("doc_id")
            for first, last, words, doc in text_words(batch.column("text")):
                d, h = shingles(words, doc, last - first)
                row, n, s1, s2 = _set_hashes(d, h)
                size, cid, check = (np.zeros(last - first, dtype=t) for t in (np.int64, np.uint64, np.uint64))
                size[row], cid[row], check[row] = n, s1, s2
                yield rows(ids.slice(first, last - first), size, cid, check, DOC)
                if not with_hot:
                    continue
                at = np.append(starts(d), len(d))
                for k, c in enumerate(s1.tolist()):
                    if c not in seen:
                        seen.add(c)
                        held.append(h[at[k]:at[k + 1]])
                        held_n += int(n[k])
                        docs += 1
                if held_n >= FLUSH:
                    yield hot()
                    seen, held, held_n, docs = set(), [], 0, 0
        if held:
            yield hot()
    return run


def signatures(docs: DataFrame) -> DataFrame:
    """A row per document (kind 0: size and signature of its set), and rows of hot shingles (kind 1)."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return written(d.mapInArrow(trimmed(_sign_task()), SIG_SCHEMA), "sets")


# --- fragments ---------------------------------------------------------------------------------

def _segment_task(hot, fragments: int):
    """Texts -> per fragment the packed segments of a few thousand classes."""
    def pack(sets: list[tuple[int, np.ndarray]], hot_h: np.ndarray) -> Iterator[tuple]:
        cids = np.array([c for c, _ in sets], dtype=np.uint64)
        sizes = np.array([len(h) for _, h in sets], dtype="<u4")
        owner = np.repeat(np.arange(len(sets)), [len(h) for _, h in sets])
        h = np.concatenate([h for _, h in sets])
        is_hot = np.zeros(len(h), dtype=bool)
        if len(hot_h):
            at = np.minimum(np.searchsorted(hot_h, h), len(hot_h) - 1)
            is_hot = hot_h[at] == h
        # hot shingles go past the counting, as numbers in the hot list, to the class's own fragment
        home = np.full(len(h), 0, dtype=np.uint64)
        code = np.where(is_hot, at if len(hot_h) else 0, 0).astype(np.uint64) if len(hot_h) else home
        frag = np.where(is_hot, fragment_of(mix64(cids), fragments)[owner], fragment_of(h, fragments))
        key = np.where(is_hot, code, h & np.uint64(KEY_MASK))
        order = np.argsort((frag << np.uint64(KEY_BITS + 1)) | (is_hot.astype(np.uint64) << np.uint64(KEY_BITS)) | key, kind="stable")
        frag, key, owner, is_hot = frag[order], key[order], owner[order], is_hot[order]
        at = np.append(starts(frag), len(frag))
        for a, b in zip(at[:-1], at[1:]):
            m = int(np.count_nonzero(~is_hot[a:b]))
            local, index = np.unique(owner[a:b], return_inverse=True)
            k = key[a:b].copy()
            k[1:m] -= key[a:a + m - 1] if m > 1 else k[1:m]     # differences of the sorted keys
            wide = 2 if len(local) <= 0xFFFF else 4
            yield (int(frag[a]), len(local), b - a, m, cids[local].tobytes(), planes(k, 5), planes(index.astype(np.uint64), wide), b"", b"")
        # the size of a class goes to one fragment only
        place = fragment_of(mix64(cids), fragments)
        order = np.argsort(place, kind="stable")
        at = np.append(starts(place[order]), len(order))
        for a, b in zip(at[:-1], at[1:]):
            own = order[a:b]
            yield (int(place[own[0]]), 0, 0, 0, b"", b"", b"", cids[own].tobytes(), sizes[own].tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot_h = hot.value
        seen, sets, size = set(), [], 0

        def flush():
            cols = list(zip(*pack(sets, hot_h)))
            types = [pa.int32()] * 4 + [pa.binary()] * 5
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=SEGMENT_COLUMNS)

        for batch in batches:
            for first, last, words, doc in text_words(batch.column("text")):
                d, h = shingles(words, doc, last - first)
                _, n, cid, _ = _set_hashes(d, h)
                at = np.append(starts(d), len(d))
                for k, c in enumerate(cid.tolist()):
                    if c not in seen:
                        seen.add(c)
                        sets.append((c, h[at[k]:at[k + 1]]))
                        size += int(n[k])
                if size >= FLUSH:
                    yield flush()
                    seen, sets, size = set(), [], 0
        if sets:
            yield flush()
    return run


SEGMENT_COLUMNS = ["fragment", "classes", "postings", "cold", "cids", "keys", "owners", "home", "sizes"]
SEGMENT_SCHEMA = ("fragment int, classes int, postings int, cold int, cids binary, keys binary, owners binary, "
                  "home binary, sizes binary")
ANSWER_COLUMNS = ["bucket", "fragment", "cids", "counts", "keys", "dfs"]
ANSWER_SCHEMA = "bucket int, fragment int, cids binary, counts binary, keys binary, dfs binary"
HOT_ANSWER, SIZE_ANSWER = -1, -2     # in place of a fragment: hot shingles; sizes of classes in ``counts``


def _unique(key: list, cid: list) -> tuple[np.ndarray, np.ndarray]:
    if not key:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.uint64)
    key, cid = np.concatenate(key), np.concatenate(cid)
    order = np.lexsort((cid, key))
    key, cid = key[order], cid[order]
    keep = np.ones(len(key), dtype=bool)
    keep[1:] = (key[1:] != key[:-1]) | (cid[1:] != cid[:-1])
    return key[keep], cid[keep]


def _count_task(buckets: int):
    def run(t: pa.Table) -> pa.Table:
        """One fragment: the shingles that two classes or more have, packed per bucket of classes."""
        cold_part, hot_part, home = ([], []), ([], []), ([], [])
        columns = [t.column(c) for c in SEGMENT_COLUMNS]
        for r in range(t.num_rows):
            n, cold = columns[2][r].as_py(), columns[3][r].as_py()
            cids, keys, owners, own, sizes = (c[r].as_buffer() for c in columns[4:])
            if not n:
                home[0].append(np.frombuffer(sizes, dtype="<u4").astype(np.uint64))
                home[1].append(np.frombuffer(own, dtype=np.uint64))
                continue
            k = unplanes(keys, n, 5)
            k[:cold] = np.cumsum(k[:cold])
            cid = np.frombuffer(cids, dtype=np.uint64)[unplanes(owners, n, owners.size // n).astype(np.int32)]
            for part, a, b in ((cold_part, 0, cold), (hot_part, cold, n)):
                part[0].append(k[a:b])
                part[1].append(cid[a:b])
        fragment = t.column("fragment")[0].as_py()
        key, cid = _unique(*cold_part)
        del cold_part
        at = starts(key)
        df = np.diff(np.append(at, len(key)))
        df = np.repeat(np.minimum(df, HOT_DF - 1), df)
        shared = df >= 2
        rows = _answers(cid[shared], key[shared], df[shared], fragment, buckets)
        key, cid = _unique(*hot_part)
        rows += _answers(cid, key, np.full(len(key), HOT_DF), HOT_ANSWER, buckets)
        size, cid = _unique(*home)
        bucket = fragment_of(mix64(cid), buckets)
        order = np.argsort(bucket, kind="stable")
        edge = np.append(starts(bucket[order]), len(order))
        for a, b in zip(edge[:-1], edge[1:]):
            own = order[a:b]
            rows.append((int(bucket[own[0]]), SIZE_ANSWER, cid[own].tobytes(), size[own].astype("<u4").tobytes(), b"", b""))
        types = [pa.int32(), pa.int32()] + [pa.binary()] * 4
        return pa.Table.from_arrays([pa.array([r[c] for r in rows], k) for c, k in enumerate(types)], names=ANSWER_COLUMNS)
    return run


def _answers(cid, key, df, fragment: int, buckets: int) -> list[tuple]:
    bucket = fragment_of(mix64(cid), buckets)
    order = np.lexsort((cid, bucket))
    cid, key, df, bucket = (x[order] for x in (cid, key, df, bucket))
    edge = np.append(starts(bucket), len(bucket))
    out = []
    for a, b in zip(edge[:-1], edge[1:]):
        at = starts(cid[a:b])
        counts = np.diff(np.append(at, b - a))
        out.append((int(bucket[a]), fragment, cid[a:b][at].tobytes(), counts.astype("<u4").tobytes(),
                    planes(key[a:b], 5), planes(df[a:b].astype(np.uint64), 2)))
    return out


# --- prefixes ------------------------------------------------------------------------------------

PREFIX_SCHEMA = "cid long, n long, shared long, prefix array<long>, pieces array<array<long>>"


def _prefix_task(percent: int):
    def run(t: pa.Table) -> pa.Table:
        """One bucket of classes with all answers -> prefix and segments of those that may have a partner.
        A shingle's number is its fragment and key; hot ones have the top bit."""
        none = np.zeros(0, dtype=np.uint64)
        cid, tok, df, known, known_size = [none], [none], [np.zeros(0, dtype=np.uint16)], [none], [np.zeros(0, dtype=np.int64)]
        columns = [t.column(c) for c in ANSWER_COLUMNS]
        for r in range(t.num_rows):
            fragment = columns[1][r].as_py()
            cids, counts, keys, dfs = (c[r].as_buffer() for c in columns[2:])
            counts = np.frombuffer(counts, dtype="<u4")
            if fragment == SIZE_ANSWER:
                known.append(np.frombuffer(cids, dtype=np.uint64))
                known_size.append(counts.astype(np.int64))
                continue
            n = int(counts.sum())
            top = np.uint64(1 << 63) if fragment < 0 else np.uint64(fragment << KEY_BITS)
            cid.append(np.repeat(np.frombuffer(cids, dtype=np.uint64), counts))
            tok.append(unplanes(keys, n, 5) | top)
            df.append(unplanes(dfs, n, 2).astype(np.uint16))
        cid, tok, df, known, known_size = (np.concatenate(x) for x in (cid, tok, df, known, known_size))
        owner, index, shared = np.unique(cid, return_inverse=True, return_counts=True)
        order = np.argsort(known)
        n = known_size[order][np.searchsorted(known[order], owner)] if len(owner) else np.zeros(0, dtype=np.int64)
        need = -(-percent * n // 100)
        able = shared >= need
        keep = able[index]
        number = np.cumsum(able) - 1
        index, tok, df = number[index[keep]], tok[keep], df[keep]
        owner, n, need, shared = owner[able], n[able], need[able], shared[able]
        # shingles of this class alone come first in the order, so of the shared ones fewer are in the prefix
        order = np.lexsort((tok, df, index))
        place = np.arange(len(tok)) - np.repeat(np.cumsum(shared) - shared, shared)
        length = shared - need + 1
        first = place < length[index[order]]
        prefix = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(length)), pa.int32()), pa.array(tok[order][first].view(np.int64)))
        piece = index * PIECES + ((tok >> np.uint64(KEY_BITS - 2)) & np.uint64(PIECES - 1)).astype(np.int64)
        order = np.lexsort((tok, piece))
        inner = np.append(0, np.cumsum(np.bincount(piece, minlength=len(owner) * PIECES)))
        pieces = pa.ListArray.from_arrays(pa.array(np.arange(0, len(owner) * PIECES + 1, PIECES), pa.int32()),
                                          pa.ListArray.from_arrays(pa.array(inner, pa.int32()), pa.array(tok[order].view(np.int64))))
        return pa.table({"cid": pa.array(owner.view(np.int64)), "n": pa.array(n), "shared": pa.array(shared.astype(np.int64)),
                         "prefix": prefix, "pieces": pieces})
    return run


def candidates(docs: DataFrame, sets: DataFrame, percent: int, fragment: int = FRAGMENT) -> DataFrame:
    """Classes that may have a partner: ``cid, n, shared, prefix, pieces``."""
    total, rows = sets.where(f"kind = {DOC}").agg(F.sum("n"), F.count(F.lit(1))).first()
    total = total or 0
    # in 1 / HOT_SHARE of the documents each, so at most HOT_SHARE times the mean size of a set: bounded
    hot = (sets.where(f"kind = {HOT}").groupBy("cid").agg(F.sum("n").alias("n")).where(F.col("n") >= rows // HOT_SHARE)
           .select("cid").toPandas()["cid"].to_numpy(dtype=np.int64))
    fragments = max(1, -(-total // fragment))
    sent = docs.sparkSession.sparkContext.broadcast(np.sort(hot.view(np.uint64)))
    segments = docs.select("text").mapInArrow(trimmed(_segment_task(sent, fragments)), SEGMENT_SCHEMA)
    answers = segments.groupBy("fragment").applyInArrow(trimmed(_count_task(max(1, fragments // 2))), ANSWER_SCHEMA)
    return written(answers.groupBy("bucket").applyInArrow(trimmed(_prefix_task(percent)), PREFIX_SCHEMA), "prefixes")


# --- candidate groups, overlaps, links -----------------------------------------------------

def linked(pairs: DataFrame, segments: DataFrame, percent: int) -> DataFrame:
    """``a, b`` -> those pairs whose overlap, summed over the pieces, reaches the threshold."""
    if pairs.count() <= SENT_PAIRS:                 # few enough to be sent: the segments of others stay where they are
        ids = pairs.select(F.col("a").alias("cid")).unionByName(pairs.select(F.col("b").alias("cid"))).distinct()
        segments = segments.join(F.broadcast(ids), "cid", "left_semi")
    sa = segments.select(F.col("cid").alias("a"), F.col("n").alias("na"), "piece", F.col("toks").alias("ta"))
    sb = segments.select(F.col("cid").alias("b"), F.col("n").alias("nb"), "piece", F.col("toks").alias("tb"))
    partial = (pairs.join(sa, "a").join(sb, ["b", "piece"])
               .select("a", "b", "na", "nb", F.size(F.array_intersect("ta", "tb")).alias("o")))
    total = partial.groupBy("a", "b").agg(F.sum("o").alias("o"), F.max("na").alias("na"), F.max("nb").alias("nb"))
    return total.where(F.col("o") * 100 >= percent * (F.col("na") + F.col("nb") - F.col("o"))).select("a", "b")


def _meetings(g: DataFrame, pivots: DataFrame, percent: int, largest: int) -> DataFrame:
    """``a, b``: each pivot with the later members of its groups that are in another component.

    A pair may meet in many groups.  The members of a group go as arrays of at most about ``MEMBERS``,
    and the arrays of a pivot are made one before the pairs are rows, so there is a row per pair only."""
    parts = max(1, -(-largest // MEMBERS))
    key = ["tok"] if parts == 1 else ["tok", "part"]
    part = F.lit(0) if parts == 1 else F.pmod(F.xxhash64("cid"), F.lit(parts))
    member = F.struct("ord", "c", "n", "cid", "at", "shared")
    arrays = g.withColumn("part", part).groupBy(*key).agg(F.collect_list(member).alias("xs"))
    met = pivots.join(arrays, "tok").withColumn("xs", F.filter("xs", lambda x: (x["ord"] > F.col("oa")) & (x["c"] != F.col("ca"))))

    def may(x):
        """The common shingles before this one, this one, and those that can follow; and the sizes."""
        most = F.least(x["at"], F.col("ia")) + F.least(x["shared"] - x["at"], F.col("sa") - F.col("ia"))
        return ((most * (100 + percent) >= percent * (x["n"] + F.col("na")))
                & (F.least(x["n"], F.col("na")) * 100 >= F.greatest(x["n"], F.col("na")) * percent))

    ids = lambda keep: F.transform(F.filter("xs", keep), lambda x: x["cid"])
    met = met.where(F.size("xs") > 0).select("a", *key[1:], ids(may).alias("yes"), ids(lambda x: ~may(x)).alias("no"))
    # a pair that one common shingle rules out is out
    each = met.groupBy("a", *key[1:]).agg(F.array_except(F.flatten(F.collect_list("yes")), F.flatten(F.collect_list("no"))).alias("bs"))
    return each.select("a", F.explode("bs").alias("b"))


def components(cand: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``v, c``: component of each class that has a partner."""
    spark = cand.sparkSession
    # most of its shingles shared first: such a member links with most of its group
    order = F.struct(((F.col("n") - F.col("shared")) * 1000 / F.col("n")).cast("int").alias("u"), F.col("cid").alias("cid"))
    base = written(cand.select(F.posexplode("prefix").alias("at", "tok"), "cid", "n", "shared", order.alias("ord")), "groups")
    segments = cand.select("cid", "n", F.posexplode("pieces").alias("piece", "toks"))
    segments = written(segments.where(F.size("toks") > 0), "segments")
    release(cand)
    labels = spark.createDataFrame([], "v long, c long")
    done = pivots = 0
    while True:
        done, pivots = pivots, pivots * 16 + 1
        # a group of one component is finished, now and in all later rounds
        g = base.withColumn("c", F.col("cid")) if not done else (
            base.join(labels.withColumnRenamed("v", "cid"), "cid", "left").withColumn("c", F.coalesce("c", "cid")))
        open_groups = written(g.groupBy("tok").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count(F.lit(1)).alias("m"))
                              .where((F.col("lo") < F.col("hi")) & (F.col("m") > done + 1)).select("tok", "m"), "groups")
        largest = open_groups.agg(F.max("m")).first()[0]
        if largest is None:
            release(base, segments, open_groups)
            return labels
        g = written(g.join(open_groups.select("tok"), "tok"), "open")
        release(base, open_groups)
        base = g.drop("c")
        base.written_path = g.written_path
        rank = F.row_number().over(Window.partitionBy("tok").orderBy("ord"))
        p = (g.withColumn("k", rank).where(F.col("k") <= pivots).where(F.col("k") > done)
             .select("tok", F.col("cid").alias("a"), F.col("n").alias("na"), F.col("shared").alias("sa"), F.col("at").alias("ia"),
                     F.col("c").alias("ca"), F.col("ord").alias("oa")))
        pairs = written(_meetings(g, p, percent, largest).distinct(), "pairs")
        edges = written(linked(pairs, segments, percent), "links")
        if not edges.isEmpty():
            labels = graph.merge(labels, edges)
        release(pairs, edges)


def near_duplicates(docs: DataFrame, percent: int = PERCENT, fragment: int = FRAGMENT) -> DataFrame:
    """``doc_id, text`` -> ``doc_id, n_shingles, component_id, class_id`` for every row."""
    sets = signatures(docs)
    labels = components(candidates(docs, sets, percent, fragment), percent)
    own = sets.where(f"kind = {DOC}")
    classes = own.where("n > 0").groupBy("cid").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("m"))
    named = (classes.join(labels.withColumnRenamed("v", "cid"), "cid", "left")
             .select("cid", "m", "first", F.coalesce("c", "cid").alias("c"), F.col("c").isNotNull().alias("grouped")))
    named = named.where("grouped or m > 1")           # all others are alone
    root = named.groupBy("c").agg(F.min("first").alias("component_id"))
    names = named.join(root, "c").select("cid", "component_id")
    out = own.join(names, "cid", "left")
    # a row of no shingles has class 0 and is alone
    return out.select("doc_id", F.col("n").alias("n_shingles"),
                      F.when(F.col("n") > 0, F.coalesce("component_id", "doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
                      F.col("cid").alias("class_id"))


def op2_ngram_join(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


#: Shingle sets, pairs with a common shingle, and components by following the links.
ORACLE_SQL = r"""
WITH RECURSIVE split AS (
    SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), sets AS (
    SELECT doc_id, CASE WHEN coalesce(len(w), 0) = 0 THEN []
                        WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                        ELSE list_distinct([array_to_string(w[k:k + 4], ' ') FOR k IN range(1, len(w) - 3)]) END AS s
    FROM split
), shingles AS (
    SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets
), links AS (
    SELECT x.doc_id AS a, y.doc_id AS b
    FROM shingles x JOIN shingles y ON x.g = y.g AND x.doc_id <> y.doc_id
    GROUP BY x.doc_id, y.doc_id
    HAVING 100 * count(*) >= 75 * (min(x.n) + min(y.n) - count(*))
), reach AS (
    SELECT doc_id, doc_id AS c FROM sets
    UNION
    SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.c = l.a
), least AS (
    SELECT doc_id, min(c) AS component_id FROM reach GROUP BY doc_id
)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id FROM sets JOIN least USING (doc_id)
"""
