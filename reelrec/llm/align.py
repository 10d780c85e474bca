"""Cross-tokenizer alignment by galloping intersection of token ends.

A text is encoded by two tokenizers, and both token lists are laid over the same bytes.  The shorter list of
token ends drives an exponential-plus-binary search into the longer one (``gallop``).  Ends that both have cut
the tokens into groups; where a token's start and end fall among the other list's ends gives, as a difference of
ranks, the range of tokens that it overlaps.  Every pair of ids that overlap in a document is counted once for it,
corpus-wide, and the counts go back to every document's links.

Encoding: texts are cut into units at spaces that follow another character (no white space, no space sign).  No
pre-token of the byte-level tokenizer and no piece of the other one crosses such a place (checked when they are
loaded), so the tokens of a text are those of its units, which the libraries encode in batches and a bounded cache keeps.

Scale: pass one writes a row per document with its links packed (distinct id pairs and how often each occurs, 5 to 6
bytes a pair), so texts are read once and never shuffled.  Pass two adds up counts per pair inside each
task before they are shuffled.  Pass three reads the packed links again: pairs in at least one of ``COMMON`` parts of all
(document, pair) entries are at most ``COMMON`` in number whatever the corpus, and go to every task as sorted arrays;
entries of other pairs, none of which has more than that share of the entries, meet their counts by a shuffle join.

Defined results: a text that is null or empty, or that either tokenizer does not give back byte for byte after a
space, has no tokens, groups or links (zeros, ``groups`` empty).  Special strings are ordinary text.  Each row counts as a
document of its own (ids may repeat or be null); equal texts each count; an empty table stays empty.
"""

from __future__ import annotations

import gc
import re
import struct
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelrec.llm.bpe import Kept, groups, tokenizer_path
from reelrec.llm.common import by_value, per_worker, table, written
from reelrec.llm.gallop import found, ranks
from reelrec.llm.packing import planes, starts, unplanes

by_value(__name__)

MODEL_A, MODEL_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
GROUP_BYTES = 1 << 20        # of texts encoded together
GROUP_UNITS = 1 << 16        # units of a longer text encoded together
CACHED = 1 << 18             # units kept by each of two generations
HELD_PAIRS = 1 << 19         # counts that a task holds before it sends them
COMMON = 1 << 20             # pairs that are sent to every task, at most
SIGN = "▁"

#: A unit: a space and what follows it, up to the next space that follows no white space or space sign.
#: A last space alone stays with the unit before it.
UNITS = re.compile(r"(?: |^)[^ ]*(?:(?<=[\s▁]) [^ ]*)*(?: \Z)?")


def byte_alphabet() -> dict[str, int]:
    """The byte of each character of byte-level vocabularies: printable ones stand for themselves, the others
    for code points from 256 on, in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteLevel:
    """A byte-level tokenizer of the ``tokenizers`` library."""

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        vocabulary, byte = self.tokenizer.get_vocab(with_added_tokens=True), byte_alphabet()
        self.bytes_of = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes_of[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()

    def encode(self, units: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(units, add_special_tokens=False)]


class Pieces:
    """A sentencepiece model that puts a space before each text."""

    def __init__(self, path: str):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.sp.id_to_piece(i) for i in range(self.sp.get_piece_size())]
        if any(SIGN in p.lstrip(SIGN) for p in pieces):
            raise ValueError("a piece holds a space after another character")
        self.bytes_of = [bytes([int(p[3:5], 16)]) if self.sp.is_byte(i) else p.replace(SIGN, " ").encode()
                         for i, p in enumerate(pieces)]

    def encode(self, units: list[str]) -> list[list[int]]:
        return self.sp.encode([u[1:] for u in units], num_threads=1)


class Pair:
    """Both tokenizers, with the units encoded so far."""

    def __init__(self, model_a: str, model_b: str):
        self.both = ByteLevel(tokenizer_path(model_a)), Pieces(tokenizer_path(model_b))
        self.sizes = [np.array([len(b) for b in t.bytes_of], dtype=np.int64) for t in self.both]
        self.units = Kept(CACHED)
        self.second = 3 * len(self.sizes[0])               # where the second tokenizer's begin
        self.digits = [f"{i}{c}".encode() for t in self.both for i in range(len(t.bytes_of)) for c in ",|;"]

    def learn(self, units: set[str]) -> dict[str, tuple[bytes, bytes, bool]]:
        """Packed ids of both tokenizers, and whether both give the unit back."""
        new = self.units.missing(units)
        if new:
            whole, packed, same = [u.encode() for u in new], [], []
            for t in self.both:
                of, rows = t.bytes_of.__getitem__, t.encode(new)
                same.append([b"".join(map(of, ids)) == unit for unit, ids in zip(whole, rows)])
                packed.append([struct.pack(f"<{len(ids)}I", *ids) for ids in rows])
            self.units.young.update(zip(new, zip(*packed, [x and y for x, y in zip(*same)])))
        return self.units.young

    def encode(self, found: list[list[str]]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Ids of both tokenizers for each list of units; None where they don't give the units back."""
        known, out = self.learn({u for units in found for u in units}), []
        for units in found:
            if not units:
                out.append(None)
                continue
            a, b, same = zip(*map(known.__getitem__, units))
            out.append((np.frombuffer(b"".join(a), dtype="<u4"), np.frombuffer(b"".join(b), dtype="<u4")) if all(same) else None)
        return out

    def written_groups(self, a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> list[bytes]:
        """The pieces of ``a1,a2|b1;a3|b2,b3;``, one a token, given the last token of each group in both lists."""
        ca, cb = a.astype(np.int64) * 3, b.astype(np.int64) * 3 + self.second
        ca[cut_a] += 1
        cb[cut_b] += 2
        of_a, of_b = np.diff(cut_a, prepend=-1), np.diff(cut_b, prepend=-1)       # tokens of each group
        order = np.empty(len(a) + len(b), dtype=np.int64)
        order[np.arange(len(a)) + np.repeat(cut_b + 1 - of_b, of_a)] = ca        # after the b of the groups before
        order[np.arange(len(b)) + np.repeat(cut_a + 1, of_b)] = cb               # after the a of its own group
        return list(map(self.digits.__getitem__, order.tolist()))

    def aligned(self, tokens: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[int, int, int, int, bytes, np.ndarray, np.ndarray]]:
        """For each text's ids: tokens of both, groups, links, the written groups, distinct linked pairs and how often each
        is linked.  The texts' ends lie one after the other in two lists, which meet at the end of each text."""
        scale = np.uint64(len(self.sizes[1]))
        a, b = (np.concatenate([t[k] for t in tokens]) for k in (0, 1))
        cut_a, cut_b, ia, ib = meetings(*(np.cumsum(size[x]) for size, x in zip(self.sizes, (a, b))))
        words = self.written_groups(a, b, cut_a, cut_b)
        keys = a[ia].astype(np.uint64) * scale + b[ib]
        to_a, to_b = (np.cumsum([len(t[k]) for t in tokens]) for k in (0, 1))
        to_group, to_link = np.searchsorted(cut_a, to_a), np.searchsorted(ia, to_a)
        ends = zip(*(x.tolist() for x in (to_a, to_b, to_group, to_link)))
        a0 = b0 = g0 = l0 = 0
        for a1, b1, g1, l1 in ends:
            key, times = np.unique(keys[l0:l1], return_counts=True)
            yield a1 - a0, b1 - b0, g1 - g0, l1 - l0, b"".join(words[a0 + b0:a1 + b1])[:-1], key, times
            a0, b0, g0, l0 = a1, b1, g1, l1

    def one_by_one(self, texts: list[str]) -> Iterator:
        """What ``aligned`` gives for each text; None for one without tokens."""
        encoded = self.encode([UNITS.findall(" " + t) if t else [] for t in texts])
        good = [t for t in encoded if t]
        rows = self.aligned(good) if good else iter(())
        for t in encoded:
            yield next(rows) if t else None

    def in_parts(self, text: str) -> tuple | None:
        """The same for a text of any length, ``GROUP_UNITS`` units at a time: both tokenizers end a token with each unit."""
        units, counts, written_parts = (m.group() for m in UNITS.finditer(" " + text)), np.zeros(4, dtype=np.int64), []
        held = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        while part := list(islice(units, GROUP_UNITS)):
            tokens = self.encode([part])
            if tokens[0] is None:
                return None
            *numbers, groups_text, key, times = next(self.aligned(tokens))
            counts += numbers
            written_parts.append(groups_text)
            held = added([held[0], key], [held[1], times])
        return *counts.tolist(), b";".join(written_parts), *held


def added(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and the sums of their counts."""
    key, counted = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key, counted = key[order], counted[order]
    at = starts(key)
    return key[at], np.add.reduceat(counted, at) if len(at) else counted


def meetings(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places in ``a`` and in ``b`` of the ends that both have, and places in ``a`` and in ``b`` of every two tokens
    whose byte ranges overlap.  The shorter list gallops through the longer one: the rank of an end is the token that
    holds the byte before it, so a token overlaps those from the one its start falls into to the one its end falls into."""
    if len(ends_a) > len(ends_b):
        cut_b, cut_a, ib, ia = meetings(ends_b, ends_a)
        return cut_a, cut_b, ia, ib
    last = ranks(ends_a, ends_b)
    same = found(ends_a, ends_b, last)
    first = np.zeros(len(last), dtype=np.int64)
    first[1:] = last[:-1] + same[:-1]                     # where the token before ended, a new one begins
    n = last - first + 1
    own = np.repeat(np.arange(len(ends_a)), n)
    other = np.arange(len(own)) - np.repeat(np.cumsum(n) - n - first, n)
    return np.flatnonzero(same), last[same], own, other


ROW = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups binary, width int, pairs binary, times binary"


def _align_task(model_a: str, model_b: str, finish):
    """Rows ``doc_id, text`` -> ROW; ``finish`` takes the written groups to what is returned of them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()             # no cycles are made; the collector would only walk the caches
        pair = per_worker(("align", model_a, model_b), lambda: Pair(model_a, model_b))
        scale = len(pair.sizes[1])
        width = -(-(len(pair.sizes[0]) * scale).bit_length() // 8)
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            sizes = [n or 0 for n in pc.binary_length(texts).to_pylist()]
            for at, end in groups(sizes, GROUP_BYTES):
                rows = [t or "" for t in texts.slice(at, end - at).to_pylist()]
                out = []
                for found in [pair.in_parts(rows[0])] if sizes[at] > GROUP_BYTES else pair.one_by_one(rows):
                    if found is None:
                        out.append((0, 0, 0, 0, b"", width, b"", b""))
                        continue
                    *counts, groups_text, key, times = found
                    out.append((*counts, finish(groups_text), width,
                                planes(key, width), planes(times.astype(np.uint64), 1 if times.max() < 256 else 4)))
                columns = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(at, end - at), *(pa.array(c, pa.int64()) for c in columns[:4]), pa.array(columns[4], pa.binary()),
                     pa.array(columns[5], pa.int32()), *(pa.array(c, pa.binary()) for c in columns[6:])],
                    names=[f.split()[0] for f in ROW.split(", ")])
        gc.enable()
    return run


def _unpacked(width: int, pairs: bytes, times: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(pairs) // width
    return unplanes(pairs, n, width), unplanes(times, n, len(times) // n).astype(np.int64)


def _count_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``width, pairs`` -> ``pair, docs``: counts added up for as many pairs as are held."""
    def sent(key, counted):
        return pa.RecordBatch.from_arrays([pa.array(key.astype(np.int64)), pa.array(counted)], names=["pair", "docs"])

    none = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    held, keys, size = none, [], 0
    for batch in batches:
        for width, pairs in zip(batch.column("width").to_pylist(), batch.column("pairs")):
            data = pairs.as_py()
            if not data:
                continue
            keys.append(unplanes(data, len(data) // width, width))
            size += len(keys[-1])
            if size >= HELD_PAIRS:
                held = added([held[0], *keys], [held[1], np.ones(size, dtype=np.int64)])
                keys, size = [], 0
                if len(held[0]) >= HELD_PAIRS:
                    yield sent(*held)
                    held = none
    if size or len(held[0]):
        yield sent(*added([held[0], *keys], [held[1], np.ones(size, dtype=np.int64)]))


def pair_counts(aligned: DataFrame, scale: int) -> DataFrame:
    """``pair, docs, best``: in how many documents each id pair is linked, and whether no other pair of its first id
    is in more."""
    counts = (aligned.select("width", "pairs").mapInArrow(_count_task, "pair long, docs long")
              .groupBy("pair").agg(F.sum("docs").alias("docs")))
    counts = written(counts, "pairs")
    a = F.floor(F.col("pair") / scale)
    top = counts.groupBy(a.alias("_a")).agg(F.max("docs").alias("_top"))     # a row per id of the first tokenizer
    out = counts.withColumn("_a", a).join(top, "_a")
    return out.select("pair", "docs", (F.col("docs") == F.col("_top")).alias("best"))


def _sum_task(shared):
    """``row, width, pairs, times`` -> per row the sums over pairs that ``shared`` has, and the other pairs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, docs, best = shared.value
        for batch in batches:
            rows, sums, bests, rest, rest_times = [], [], [], [], []
            for row, width, pairs, times in zip(*(batch.column(c) for c in ("row", "width", "pairs", "times"))):
                data = pairs.as_py()
                if not data:
                    continue
                k, t = _unpacked(width.as_py(), data, times.as_py())
                at = np.minimum(np.searchsorted(key, k), max(len(key) - 1, 0))
                hit = key[at] == k if len(key) else np.zeros(len(k), dtype=bool)
                rows.append(row.as_py())
                sums.append(int((docs[at[hit]] * t[hit]).sum()))
                bests.append(int(t[hit][best[at[hit]]].sum()))
                rest.append(k[~hit].astype(np.int64))
                rest_times.append(t[~hit])
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows, pa.int64()), pa.array(bests, pa.int64()), pa.array(sums, pa.int64()),
                     pa.array(rest, pa.list_(pa.int64())), pa.array(rest_times, pa.list_(pa.int64()))],
                    names=["row", "n_best", "count_sum", "rest", "rest_times"])
    return run


def _link_sums(aligned: DataFrame, counts: DataFrame, most: int) -> DataFrame:
    """``row, n_best, count_sum`` of the rows that have links."""
    spark = aligned.sparkSession
    entries = counts.agg(F.sum("docs")).first()[0] or 0
    held = counts.where(F.col("docs") * most >= entries)                     # at most ``most`` rows: their docs add up to entries
    t = held.select("pair", "docs", "best").toPandas().sort_values("pair")
    shared = spark.sparkContext.broadcast((t["pair"].to_numpy(dtype=np.uint64), t["docs"].to_numpy(dtype=np.int64),
                                           t["best"].to_numpy(dtype=bool)))
    sums = written(aligned.select("row", "width", "pairs", "times").mapInArrow(
        _sum_task(shared), "row long, n_best long, count_sum long, rest array<long>, rest_times array<long>"), "sums")
    other = (sums.select("row", F.explode(F.arrays_zip("rest", "rest_times")).alias("e"))
             .select("row", F.col("e.rest").alias("pair"), F.col("e.rest_times").alias("times")))
    other = (other.join(counts.where(F.col("docs") * most < entries), "pair")
             .select("row", F.when(F.col("best"), F.col("times")).otherwise(0).alias("n_best"),
                     (F.col("docs") * F.col("times")).alias("count_sum")))
    every = sums.select("row", "n_best", "count_sum").unionByName(other)
    return every.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def _digest(groups_text: bytes) -> bytes:
    from hashlib import sha256

    return sha256(groups_text).hexdigest().encode()


def align(docs: DataFrame, model_a: str = MODEL_A, model_b: str = MODEL_B, common_pairs: int = COMMON,
          digest: bool = False) -> DataFrame:
    """``doc_id, text`` -> ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups``, one row per row.
    ``groups`` is the written alignment, or its SHA-256 if ``digest`` (then the texts need not be stored)."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    finish = _digest if digest else bytes
    aligned = written(d.mapInArrow(_align_task(model_a, model_b, finish), ROW)
                      .withColumn("row", F.monotonically_increasing_id()), "aligned")
    scale = len(Pieces(tokenizer_path(model_b)).bytes_of)
    counts = written(pair_counts(aligned, scale), "pair-counts")
    sums = _link_sums(aligned, counts, common_pairs)
    out = aligned.join(sums, "row", "left")
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).cast("long").alias("n_best"),
                      F.coalesce("count_sum", F.lit(0)).cast("long").alias("count_sum"),
                      F.col("groups").cast("string").alias("groups"))


def op11_token_alignment(spark, sf_dir: str) -> DataFrame:
    out = align(table(spark, sf_dir, "documents"), digest=True)
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256"))
