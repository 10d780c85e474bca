"""Quality rules: text statistics, and a hashed n-gram log-likelihood ratio between trusted
documents and the raw corpus.

Words and word pairs are hashed into ``2**bits`` bins.  Two multinomials over the bins are counted: the
raw one from every document, the target from the documents that the labels trust (quality 1), all of
them or, of more than ``TRUSTED``, about so many by a hash of their id.  A document's score is the sum of ``log(target / raw)`` over its words and pairs,
divided by their number.  The threshold is a fixed number for a given corpus: over the scores of all labelled
documents, in steps of 0.001, it maximises the low-quality documents below it minus ``keep_cost``
times the trusted ones below it.  Every document is kept or dropped by it, and by the base rule.

Scale: texts are never shuffled; the trusted ids are broadcast (bounded by ``TRUSTED``, 16 bytes each).  Each task adds its counts up in arrays
of a fixed length before it sends them, so at most ``2 * 2**bits`` rows leave a task, and the summed
bins (fixed number, 1 MB) are what the driver gets and sends out again.  Scores are written as a narrow
table.  No group of documents is ever formed, so copies and hot sources do not matter.

Defined results: null, empty or blank texts have no words, all counts 0, and fail the base rule; with no
trusted or no raw document all ratios are 0, and without low-quality labels no threshold applies; a
document with several labels is trusted if any of them says so and none says low quality; rows with repeated or null ids have
each its own result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelrec.llm.common import by_value, table, written
from reelrec.llm.words import BLOCK, NEWLINE, SPACE, block_words, blocks, byte_table, mix64, pieces, spans, windows, word_hashes

by_value(__name__)

BITS = 17
SMOOTH = 1.0                 # pseudo-counts per bin of the target, dealt like the raw corpus
KEEP_COST = 50.0
TRUSTED = 200_000            # trusted documents that the target is fitted on, at most (by hash of the id)
STEP = 0.001
SYMBOLS = b"#*$%&|<>"
WINDOW = 5

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(SYMBOLS)] = True
_CASED = byte_table(31)    # A-Z are not a-z here


def _bins(h: np.ndarray, doc: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and document of each word and each pair of neighbours."""
    pair = doc[1:] == doc[:-1]
    two = mix64(h[:-1][pair] * np.uint64(0x9E3779B97F4A7C15) + h[1:][pair])
    all_h = np.concatenate([h, two])
    return (all_h >> np.uint64(64 - bits)).astype(np.int64), np.concatenate([doc, doc[1:][pair]])


def _repeated_words(h: np.ndarray, doc: np.ndarray, rows: int) -> np.ndarray:
    """Per row: words in windows of five words that occur at least twice in the row."""
    m = len(h) - WINDOW + 1
    if m <= 0:
        return np.zeros(rows, dtype=np.int64)
    at = np.flatnonzero(doc[:m] == doc[WINDOW - 1:])
    key = windows(h, at, WINDOW)
    order = np.lexsort((key, doc[at]))
    k, d = key[order], doc[at][order]
    same = (k[1:] == k[:-1]) & (d[1:] == d[:-1])
    twice = np.zeros(len(k), dtype=bool)
    twice[1:] |= same
    twice[:-1] |= same
    marks = np.zeros(len(h) + 1, dtype=np.int64)
    hit = at[order][twice]
    np.add.at(marks, hit, 1)
    np.add.at(marks, hit + WINDOW, -1)
    return np.bincount(doc[np.cumsum(marks[:-1]) > 0], minlength=rows)


def _line_hashes(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of each line that has a word."""
    s, e = spans(data, edges, NEWLINE)
    inside = np.concatenate([[0], np.cumsum(~SPACE[data])])
    worded = inside[e] > inside[s]
    s, e = s[worded], e[worded]
    return word_hashes(data, s, e, _CASED) ^ mix64((e - s).astype(np.uint64)), s


def _per_row(flags: np.ndarray, edges: np.ndarray) -> np.ndarray:
    if len(edges) == 2:
        return np.array([np.count_nonzero(flags)])
    sums = np.concatenate([[0], np.cumsum(flags)])
    return sums[edges[1:]] - sums[edges[:-1]]


def _duplicate_lines(data: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Per row: lines with a word that equal an earlier line of the row."""
    rows = len(edges) - 1
    if rows == 1 and len(data) > BLOCK:            # a very long text: lines in pieces
        h = np.concatenate([_line_hashes(x, np.zeros(0, dtype=np.int64))[0] for x in pieces(data, NEWLINE)])
        doc = np.zeros(len(h), dtype=np.int64)
    else:
        h, s = _line_hashes(data, edges)
        doc = np.searchsorted(edges, s, "right") - 1
    order = np.lexsort((h, doc))
    h, d = h[order], doc[order]
    again = (h[1:] == h[:-1]) & (d[1:] == d[:-1])
    return np.bincount(d[1:][again], minlength=rows)


def _profile(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, dict[str, np.ndarray]]]:
    """Blocks (first, last, word hashes, row of each word, counts per row)."""
    for first, last, data, edges in blocks(column):
        rows = last - first
        h, doc = block_words(data, edges, _CASED)
        lead = (data & 0xC0) != 0x80            # bytes that begin a code point
        yield first, last, h, doc, {
            "n_words": np.bincount(doc, minlength=rows),
            "word_chars": _per_row(lead & ~SPACE[data], edges),
            "n_symbols": _per_row(_SYMBOL[data], edges),
            "n_dup_lines": _duplicate_lines(data, edges),
            "n_repeat_words": _repeated_words(h, doc, rows),
        }


def _count_task(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(1 << bits, dtype=np.int64), np.zeros(1 << bits, dtype=np.int64)
        for batch in batches:
            trusted = np.asarray(batch.column("trusted").to_numpy(zero_copy_only=False), dtype=bool)
            for first, last, data, edges in blocks(batch.column("text")):
                h, doc = block_words(data, edges, _CASED)
                b, d = _bins(h, doc, bits)
                raw += np.bincount(b, minlength=1 << bits)
                target += np.bincount(b[trusted[first:last][d]], minlength=1 << bits)
        at = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(raw[at]), pa.array(target[at])],
                                         names=["bin", "raw", "target"])
    return run


STAT_COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
STAT_SCHEMA = "doc_id long, " + ", ".join(f"{c} long" for c in STAT_COLUMNS) + ", llr double"


def _score_task(ratio, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratios = ratio.value
        for batch in batches:
            for first, last, h, doc, stats in _profile(batch.column("text")):
                b, d = _bins(h, doc, bits)
                n = np.bincount(d, minlength=last - first)
                total = np.bincount(d, weights=ratios[b], minlength=last - first)
                llr = np.where(n > 0, total / np.maximum(n, 1), 0.0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, last - first),
                     *[pa.array(stats[c].astype(np.int64)) for c in STAT_COLUMNS], pa.array(llr)],
                    names=["doc_id", *STAT_COLUMNS, "llr"])
    return run


def trusted_ids(labels: DataFrame) -> DataFrame:
    """``doc_id, good``: one row per labelled document."""
    return (labels.where("doc_id is not null and quality is not null").groupBy("doc_id")
            .agg((F.min("quality") >= 1).alias("good")))


def log_ratios(docs: DataFrame, labels: DataFrame, bits: int = BITS, smooth: float = SMOOTH, trusted: int = TRUSTED) -> np.ndarray:
    """log(target / raw) per bin, counted over all documents."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    t = written(trusted_ids(labels).where("good").select("doc_id"), "trusted")
    n = t.count()
    if n > trusted:
        t = t.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(trusted / n * (1 << 30)))
    t = F.broadcast(t.select("doc_id", F.lit(True).alias("trusted")))
    d = d.join(t, "doc_id", "left").select("text", F.coalesce("trusted", F.lit(False)).alias("trusted"))
    counts = (d.mapInArrow(_count_task(bits), "bin long, raw long, target long")
              .groupBy("bin").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")))
    rows = counts.toPandas()                         # at most 2**bits rows
    raw, target = np.zeros(1 << bits), np.zeros(1 << bits)
    raw[rows["bin"]], target[rows["bin"]] = rows["raw"], rows["target"]
    if raw.sum() == 0 or target.sum() == 0:
        return np.zeros(1 << bits)
    p = (raw + 1e-9) / (raw + 1e-9).sum()
    mass = smooth * (1 << bits)                      # pseudo-counts, dealt like the raw corpus
    q = (target + mass * p) / (target.sum() + mass)
    return np.log(q / p)


def threshold(scored: DataFrame, labels: DataFrame, keep_cost: float = KEEP_COST) -> float | None:
    """The score below which documents are dropped; None if no threshold pays."""
    s = scored.where("n_words > 0").select("doc_id", F.floor(F.col("llr") / STEP).cast("int").alias("step"))
    h = (s.join(trusted_ids(labels), "doc_id").groupBy("step")
         .agg(F.sum(F.when(F.col("good"), 1).otherwise(0)).alias("good"),
              F.sum(F.when(F.col("good"), 0).otherwise(1)).alias("bad")).toPandas())   # a row per step of the score
    if h.empty:
        return None
    h = h.sort_values("step")
    gain = h["bad"].cumsum() - keep_cost * h["good"].cumsum()
    best = int(gain.to_numpy().argmax())
    return float((h["step"].iloc[best] + 1) * STEP) if gain.iloc[best] > 0 else None


def judge(docs: DataFrame, labels: DataFrame, bits: int = BITS, smooth: float = SMOOTH,
          keep_cost: float = KEEP_COST) -> DataFrame:
    """``doc_id, text`` -> statistics, ``llr``, ``base_failed`` and ``kept``, one row per row."""
    spark = docs.sparkSession
    ratio = spark.sparkContext.broadcast(log_ratios(docs, labels, bits, smooth).astype(np.float32))
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = written(d.mapInArrow(_score_task(ratio, bits), STAT_SCHEMA), "quality")
    cut = threshold(scored, labels, keep_cost)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    above = F.lit(True) if cut is None else F.col("llr") >= cut
    return scored.withColumn("base_failed", failed).withColumn("kept", ~failed & above)


def op10_quality_rules(spark, sf_dir: str) -> DataFrame:
    out = judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", "llr")
