"""Token counts by overlap resynchronisation.

Short documents go to the tokenizer whole.  A long one is encoded in chunks that overlap, with
offsets, and the counts are spliced where both chunks have a token start that is proven stable:
a space after a character that isn't a space.  No piece of the vocabulary holds a space after
another character (checked when the model is loaded), so no merge can ever cross such a place, and
the tokens on either side don't depend on the other side.  An overlap without a common stable start
is doubled until it has one or reaches the end of the document, so a text without spaces is encoded
whole, and the next chunk begins behind such a stretch.  The count is exactly the library's count of the whole text.

A task holds one Arrow batch and the pieces of one chunk or of a few hundred short documents.
``piece_bpe_32k.model`` is read on the executor from the path that is a parameter; nothing is
shuffled, so a hot source or copies do not matter.

Defined results: null and empty texts have 0 bytes and 0 tokens; special strings inside a text are
ordinary text; each row has its own result (ids may repeat or be null); an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelrec.llm.common import by_value, table

by_value(__name__)

MODEL = "piece_bpe_32k.model"
CHUNK = 1 << 12              # bytes
OVERLAP = 1 << 8
LIMIT = 4096
GROUP_BYTES = 1 << 20        # of short documents encoded by one call
SPACE_SIGN = "\u2581".encode()


class Encoder:
    """A sentencepiece model with the proof that spaces part its pieces."""

    def __init__(self, model: str = MODEL):
        import os

        import sentencepiece

        if not os.path.isabs(model):
            import public_tokenizers

            model = public_tokenizers.path(model)
        self.sp = sentencepiece.SentencePieceProcessor(model_file=str(model))
        space = "\u2581"
        pieces = (self.sp.id_to_piece(i) for i in range(self.sp.get_piece_size()))
        self.parts = all(space not in p.lstrip(space) for p in pieces)

    def counts(self, texts: list[str]) -> list[int]:
        return [len(x) for x in self.sp.encode(texts, num_threads=1)]

    def starts(self, text: bytes) -> list[int]:
        """Offset of each token, in bytes of UTF-8."""
        return [p.begin for p in self.sp.encode(text.decode(), return_type="proto").pieces]

    def stable(self, text: bytes, at: int) -> bool:
        """Whether a space begins at ``at`` after another character: no merge can cross this place."""
        if not self.parts or not 0 < at < len(text):
            return False
        return ((text[at] == 0x20 or text.startswith(SPACE_SIGN, at))
                and text[at - 1] != 0x20 and not text.endswith(SPACE_SIGN, 0, at))


def _whole(text: bytes, at: int) -> int:
    """The last place up to ``at`` where a character begins."""
    while 0 < at < len(text) and text[at] & 0xC0 == 0x80:
        at -= 1
    return at


def spliced_count(enc, text: bytes, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of the whole UTF-8 text, from overlapping chunks of about ``chunk`` bytes."""
    n, start, entry, total = len(text), 0, 0, 0
    while True:
        ahead, after = overlap, _whole(text, start + max(chunk, 4))
        while True:
            end = _whole(text, min(n, after + max(ahead, 4)))
            left = [start + x for x in enc.starts(text[start:end])]
            if end >= n:
                return total + sum(x >= entry for x in left)
            right = {after + x for x in enc.starts(text[after:end])}
            cut = next((x for x in left if x > after and x in right and enc.stable(text, x)), None)
            if cut is not None:
                break
            ahead *= 2                      # no proven common start: widen the overlap
        total += sum(entry <= x < cut for x in left)
        later = _whole(text, cut - max(overlap, 4))
        if later > after + chunk and cut in {later + x for x in enc.starts(text[later:end])}:
            after = later                   # past a long stretch that has no stable place
        start, entry = after, cut


def _count_batches(model: str, chunk: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = None
        for batch in batches:
            enc = enc or Encoder(model)
            texts = batch.column("text")
            out: list[int] = [0] * len(texts)
            group: list[tuple[int, str]] = []
            size = 0

            def flush():
                for (i, _), c in zip(group, enc.counts([t for _, t in group])):
                    out[i] = c
                group.clear()

            for i, value in enumerate(texts):
                text = value.as_py() or ""
                if len(text) + len(text) // 4 > chunk + overlap:
                    out[i] = spliced_count(enc, text.encode(), chunk, overlap)
                elif text:
                    group.append((i, text))
                    size += len(text)
                    if size > GROUP_BYTES:
                        flush()
                        size = 0
            if group:
                flush()
                size = 0
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(out, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"])
    return run


def count_tokens(docs: DataFrame, model: str = MODEL, limit: int = LIMIT, chunk: int = CHUNK,
                 overlap: int = OVERLAP) -> DataFrame:
    """``doc_id, text`` -> ``doc_id, n_bytes, n_tokens, over_limit``, one row per row."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                    F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "text")
    out = d.mapInArrow(_count_batches(model, chunk, overlap), "doc_id long, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)


def op9_token_counts(spark, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))
