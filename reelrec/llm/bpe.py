"""Byte-level BPE by a hierarchical-bitmap rank queue, and its decoding.

A text is split by the public pattern; each match (pre-token) is encoded alone.  One that is an entry of
the vocabulary is that entry.  Otherwise its bytes form a linked list of parts, and every pair of
neighbours whose joined bytes have a rank waits in the bucket of that rank, by the place of its
first part.  A bitmap of three levels tells which buckets hold something: find-first-set in the top
word, the middle word and the leaf word gives the least rank, without comparing ranks.  The first place of the bucket is
taken; an entry whose pair has changed since is stale and skipped.  A merge renews the pairs on both sides.
So a pre-token of n bytes takes about 3 n entries, however long it is.  Pre-tokens don't touch each other,
so all the new ones of a group of texts lie in one list and go through one queue.

Repeated pre-tokens are encoded once for each Python worker (a bounded cache).  A very long text is cut into groups of units, at
spaces that follow a character that is no white space: no match of the pattern crosses such a place or looks beyond it.  Code points that the installed ``regex`` counts as letters or
numbers but ``tiktoken`` (older Unicode tables) does not are found once on the driver and left out of the classes.

Nothing is shuffled: one ``mapInArrow`` whose state is the ranks and the caches, so copies and hot sources do not matter.  Texts of
over ``LONG`` bytes are encoded ``GROUP`` units at a time.

Defined results: null and empty texts have no tokens and decode to no bytes; special strings inside texts are ordinary
text; each row has its own result (ids may repeat or be null); an empty table stays empty; other columns are ignored.
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

from reelrec.llm.common import by_value, per_worker, table

by_value(__name__)

RANKS = "byte_bpe_multi_50k.tiktoken"
LONG = 1 << 19               # bytes of text encoded together; a longer text is encoded in groups of units
GROUP = 1 << 16              # units
CACHED = 1 << 18             # entries of a cache's younger generation

# Fixed values, for character classes: letters of Latin scripts, and marks that are neither letters, numbers nor white space.
LATIN = "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
MARKS = "\u00a1-\u00a9\u00ab-\u00b1\u00b4\u00b6-\u00b8\u00bb\u00bf\u00d7\u00f7\u2010-\u2027\u2030-\u203a\u20ac"

#: A unit: a space and what follows it, up to the next space that follows no white space.
UNITS = re.compile(r"(?: |^)[^ ]*(?:(?<=\s) [^ ]*)*")


def tokenizer_path(name: str) -> str:
    """A vocabulary file's place: an absolute path as it is, a bare name from the public tokenizers."""
    import os

    if os.path.isabs(name):
        return name
    import public_tokenizers

    return str(public_tokenizers.path(name))


def load_ranks(name: str = RANKS) -> dict[bytes, int]:
    """``token bytes -> rank`` from lines of base64 and number."""
    import base64

    with open(tokenizer_path(name), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    if not all(bytes([b]) in ranks for b in range(256)):
        raise ValueError(f"{name} lacks single bytes")
    return ranks


class RankQueue:
    """Buckets of places by rank; the least rank that has any is found by the bitmaps."""

    def __init__(self, size: int):
        self.bits = max(1, -(-(max(size, 2) - 1).bit_length() // 3))
        self.mask = (1 << self.bits) - 1
        self.leaf = [0] * (1 << 2 * self.bits)
        self.middle = [0] * (1 << self.bits)
        self.top = 0
        self.buckets: list[list[int]] = [[] for _ in range(size)]

    def mark(self, rank: int) -> None:
        """The bucket of ``rank`` has places now."""
        word = rank >> self.bits
        if not self.leaf[word]:
            above = word >> self.bits
            self.middle[above] |= 1 << (word & self.mask)
            self.top |= 1 << above
        self.leaf[word] |= 1 << (rank & self.mask)

    def first(self) -> int:
        """The least rank with a bucket, or -1."""
        if not self.top:
            return -1
        above = (self.top & -self.top).bit_length() - 1
        bits = self.middle[above]
        word = above << self.bits | (bits & -bits).bit_length() - 1
        bits = self.leaf[word]
        return word << self.bits | (bits & -bits).bit_length() - 1

    def clear(self, rank: int) -> None:
        """The bucket of ``rank`` is empty."""
        word = rank >> self.bits
        above = word >> self.bits
        self.leaf[word] ^= 1 << (rank & self.mask)
        if not self.leaf[word]:
            self.middle[above] ^= 1 << (word & self.mask)
            if not self.middle[above]:
                self.top ^= 1 << above


class Merger:
    """Encodes pre-tokens by the ranks, any number of them through one queue."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.queue = RankQueue(max(ranks.values()) + 1)
        self.two = np.full(1 << 16, -1, dtype=np.int64)        # rank of each pair of bytes
        for token, rank in ranks.items():
            if len(token) == 2:
                self.two[token[0] << 8 | token[1]] = rank

    def _fill(self, data: bytes, starts: np.ndarray) -> list[int]:
        """The first pairs of every pre-token, in their buckets; the rank of each."""
        b = np.frombuffer(data, dtype=np.uint8).astype(np.int64)
        pair = np.full(len(b), -1, dtype=np.int64)
        pair[:-1] = self.two[b[:-1] << 8 | b[1:]]
        pair[starts[1:] - 1] = -1                              # nothing crosses a pre-token's end
        at = np.flatnonzero(pair >= 0)
        at = at[np.argsort(pair[at], kind="stable")]
        ranks = pair[at]
        edges = np.flatnonzero(np.concatenate([[True], ranks[1:] != ranks[:-1], [True]])) if len(at) else []
        for lo, hi in zip(edges[:-1], edges[1:]):
            rank = int(ranks[lo])
            self.queue.buckets[rank] = at[lo:hi].tolist()
            self.queue.mark(rank)
        return pair.tolist()

    def _merge(self, data: bytes, starts: np.ndarray) -> list[int]:
        """For each place that still begins a part, the place after that part."""
        n, get, queue = len(data), self.ranks.get, self.queue
        pair = self._fill(data, starts)
        first = bytearray(n + 1)                               # places where a pre-token begins, and the end
        for i in starts.tolist():
            first[i] = 1
        first[n] = 1
        after, before = list(range(1, n + 1)), list(range(-1, n))
        buckets, mark = queue.buckets, queue.mark
        while (rank := queue.first()) >= 0:
            bucket, least = buckets[rank], rank
            bucket.sort(reverse=True)                          # mostly in order already; the first place is at the end
            while bucket:
                i = bucket.pop()
                if pair[i] != rank:                            # stale: one of its parts is no more
                    continue
                j = after[i]
                k = after[i] = after[j]
                pair[j] = pair[i] = -1
                if not first[k]:
                    before[k] = i
                    r = get(data[i:after[k]])
                    if r is not None:
                        pair[i] = r
                        b = buckets[r]
                        if not b:
                            mark(r)
                        b.append(i)
                        if r < least:
                            least = r
                if not first[i]:
                    h = before[i]
                    r = get(data[h:k], -1)
                    pair[h] = r
                    if r >= 0:
                        b = buckets[r]
                        if not b:
                            mark(r)
                        b.append(h)
                        if r < least:
                            least = r
                if least < rank:                               # a lesser rank goes first
                    break
            else:
                queue.clear(rank)
        return after

    def encode(self, pieces: list[bytes]) -> list[bytes]:
        """Packed ids of each pre-token."""
        ranks, out = self.ranks, [b""] * len(pieces)
        rest = []
        for i, piece in enumerate(pieces):
            whole = ranks.get(piece)
            if whole is None:
                rest.append(i)
            else:
                out[i] = whole.to_bytes(4, "little")
        if rest:
            data = b"".join([pieces[i] for i in rest])
            ends = np.cumsum([len(pieces[i]) for i in rest])
            after = self._merge(data, np.concatenate([[0], ends[:-1]]))
            at = 0
            for i, end in zip(rest, ends.tolist()):
                row = []
                while at < end:
                    to = after[at]
                    row.append(ranks[data[at:to]])
                    at = to
                out[i] = struct.pack(f"<{len(row)}I", *row)
        return out


def newer_characters() -> str:
    """Ranges, for a character class, of code points that are letters or numbers to ``regex`` but not to ``tiktoken``."""
    import regex
    import tiktoken

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    mine = "".join(regex.findall(r"[\p{L}\p{N}]+", every))
    single = {bytes([b]): b for b in range(256)}
    theirs = tiktoken.Encoding("classes", pat_str=r"[\p{L}\p{N}]", mergeable_ranks=single, special_tokens={})
    codes = sorted(set(map(ord, mine)) - set(map(ord, bytes(theirs.encode_ordinary(mine)).decode())))
    first = [c for c, b in zip(codes, [None, *codes]) if b is None or c != b + 1]
    last = [c for c, b in zip(codes, [*codes[1:], None]) if b != c + 1]
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(first, last))


class Kept:
    """A bounded cache of two generations: when the younger one is full it becomes the elder."""

    def __init__(self, size: int = CACHED):
        self.size, self.young, self.old = size, {}, {}

    def missing(self, keys: set) -> list:
        """The keys that have no value; those that have one are in the younger generation after this."""
        if len(self.young) + len(keys) > self.size:
            self.old, self.young = self.young, {}
        old, young = self.old, self.young
        rest = keys.difference(young)
        again = {key for key in rest if key in old}
        young.update((key, old[key]) for key in again)
        return list(rest - again)


class Splitter:
    """The matches of the public pattern, with the classes of ``tiktoken``'s Unicode tables."""

    def __init__(self, pattern: str, newer: str):
        import regex

        self.all = regex.compile(pattern).findall
        self.is_latin = re.compile(f"[\\x00-\\x7f{LATIN}{MARKS}]*").fullmatch
        latin = pattern.replace(r"[^\s\p{L}\p{N}]", rf"[^\s{LATIN}0-9]").replace(r"\p{L}", f"[{LATIN}]").replace(r"\p{N}", "[0-9]")
        self.latin = re.compile(latin, re.ASCII).findall          # the same matches in such texts, found faster
        self.newer = re.compile(f"[{newer}]").search if newer else None
        if newer:
            for c in (r"\p{L}", r"\p{N}"):
                pattern = pattern.replace(c, f"[{c}--[{newer}]]")
            self.but_newer = regex.compile("(?V1)" + pattern).findall

    def __call__(self, text: str) -> list[str]:
        if self.is_latin(text):
            return self.latin(text)
        return self.but_newer(text) if self.newer and self.newer(text) else self.all(text)


class Encoder:
    """Texts to packed ids (little-endian, unsigned, 32 bits) and back to bytes."""

    def __init__(self, ranks: dict[bytes, int], newer: str, pattern: str):
        self.merger = Merger(ranks)
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.split = Splitter(pattern, newer)
        self.pieces = Kept()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text; all texts' new pre-tokens go through the queue together."""
        split = list(map(self.split, texts))
        wanted = self.pieces.missing({p for s in split for p in s})
        known = self.pieces.young
        known.update(zip(wanted, self.merger.encode([p.encode() for p in wanted])))
        return [b"".join(map(known.__getitem__, s)) for s in split]

    def encode_long(self, text: str) -> bytes:
        found, out = (m.group() for m in UNITS.finditer(text)), []
        while group := "".join(islice(found, GROUP)):
            out += self.encode([group])
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        step, of = 4 * GROUP, self.bytes_of.__getitem__
        return b"".join(b"".join(map(of, np.frombuffer(ids[at:at + step], dtype="<u4").tolist()))
                        for at in range(0, len(ids), step))


def groups(lengths: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose lengths add up to ``most`` or are one row."""
    at = size = 0
    for i, n in enumerate(lengths):
        if i > at and size + n > most:
            yield at, i
            at, size = i, 0
        size += n
    if at < len(lengths):
        yield at, len(lengths)


def _task(ranks_name: str, newer: str, pattern: str, column: str, steps: tuple[str, ...]):
    """Rows ``(doc_id, column)`` -> ``doc_id`` and the result of each step."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()             # no cycles are made; the collector would only walk the caches
        enc = per_worker(("bpe", ranks_name, newer, pattern), lambda: Encoder(load_ranks(ranks_name), newer, pattern))
        for batch in batches:
            values, ids = batch.column(column), batch.column("doc_id")
            sizes = [0 if x is None else x for x in pc.binary_length(values).to_pylist()]
            for at, end in groups(sizes, LONG):
                rows = [x or b"" for x in values.slice(at, end - at).to_pylist()]
                out = []
                for step in steps:
                    if step == "decoded":
                        rows = list(map(enc.decode, rows))
                    elif len(rows) == 1 and len(rows[0]) > LONG:
                        rows = [enc.encode_long(rows[0])]
                    else:
                        rows = enc.encode([x or "" for x in rows])
                    out.append(pa.array(rows, pa.binary()))
                yield pa.RecordBatch.from_arrays([ids.slice(at, end - at), *out], names=["doc_id", *steps])
        gc.enable()
    return run


def _pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def _mapped(df: DataFrame, column: str, steps: tuple[str, ...], ranks: str) -> DataFrame:
    d = df.select(F.col("doc_id").cast("long").alias("doc_id"), column)
    newer = newer_characters() if "ids" in steps else ""
    return d.mapInArrow(_task(ranks, newer, _pattern(), column, steps),
                        "doc_id long, " + ", ".join(f"{s} binary" for s in steps))


def encode(docs: DataFrame, ranks: str = RANKS) -> DataFrame:
    """``doc_id, text`` -> ``doc_id, ids`` (little-endian unsigned 32-bit integers), one row per row."""
    return _mapped(docs, "text", ("ids",), ranks)


def decode(encoded: DataFrame, ranks: str = RANKS) -> DataFrame:
    """``doc_id, ids`` -> ``doc_id, decoded``: the bytes of the tokens; an id that is no entry raises."""
    return _mapped(encoded, "ids", ("decoded",), ranks)


def round_trip(docs: DataFrame, ranks: str = RANKS) -> DataFrame:
    """``doc_id, text`` -> ``doc_id, ids, decoded``: ``decode`` of ``encode`` in the same tasks."""
    return _mapped(docs, "text", ("ids", "decoded"), ranks)


def op12_byte_bpe(spark, sf_dir: str) -> DataFrame:
    out = round_trip(table(spark, sf_dir, "documents"))
    return out.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                      F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
