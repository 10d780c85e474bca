"""WARC archives in Zstandard (``.warc.zst``): writer and validating reader.

An archive begins with a skippable frame (magic 0x184D2A5D) that holds the dictionary; after it
each record is one Zstandard frame.  Between the frames stands an empty skippable frame, which
readers skip: its eight bytes are ASCII, so Spark's text sink can write it as the line separator.
Spark's own file commit therefore writes the archives, on any file system that Spark reaches, and a
lost executor leaves no half-written one.  The reader takes archives from the ``binaryFile`` source.

A response record holds an HTTP header and the payload.  Of records with equal payloads of at least
``min_bytes`` bytes the one with the smallest id is the response; the others are revisits that refer
to it and hold the HTTP header alone, whose Content-Length is that of the payload.

The reader loads the dictionary, decodes frame after frame with a window of 64 KB, and checks of each
record the version line, the required headers, Content-Length against the block, the closing blank
lines, and the digest of a response's payload.  What fails is a row with ``error`` set, never a lost one.

Scale: the bodies are shuffled at most once, to meet the list of repeated digests (counted map-side,
one row per repeated payload, so a hot payload is one key that adaptive execution splits).  A file
takes ``per_archive`` records and then a new one begins, with its own copy of the dictionary.  The
dictionary comes from a sample of ``SAMPLE`` records by hash of the id, each cut to 16 KB: it changes
sizes only, never content.

Defined results: null payloads are empty; a null id is written as ``null`` and is never the one others
refer to unless no other id has the payload; rows that repeat the smallest id are all responses; an
empty table gives no archive and reads back as no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrec.llm.common import by_value, shared_path, table

by_value(__name__)

#: Fixed values of the formats.
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
ZSTD_MAGIC = 0xFD2FB528
EMPTY_FRAME = "P*M\x18\x00\x00\x00\x00"       # skippable frame 0x184D2A50 of length 0
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = ("warc-type", "warc-record-id", "warc-date", "content-length")

MIN_BYTES = 100
PER_ARCHIVE = 20_000
SAMPLE = 400
SAMPLE_BYTES = 16 << 10
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
WINDOW = 1 << 16


# --- plan: which record is a response, which a revisit -------------------------------------

def plan_records(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """``id, uri, body`` -> the same with ``digest, record_type, refers_to``."""
    p = pages.select(F.col("id").cast("string").alias("id"), F.col("id").alias("_order"), "uri",
                     F.coalesce(F.col("body").cast("binary"), F.lit(b"")).alias("body"))
    p = p.withColumn("digest", F.sha2("body", 256))
    again = (p.where(F.octet_length("body") >= min_bytes).groupBy("digest")
             .agg(F.min("_order").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1"))
    j = p.join(again, "digest", "left")
    copy = F.col("_first").isNotNull() & ~F.col("_order").eqNullSafe(F.col("_first"))
    return j.select("id", "uri", "body", "digest",
                    F.when(copy, "revisit").otherwise("response").alias("record_type"),
                    F.when(copy, F.col("_first").cast("string")).alias("refers_to"))


# --- writer ------------------------------------------------------------------------------------

def urn(key: str) -> str:
    return f"<urn:record:{key}>"


def record_bytes(key: str | None, uri: str | None, body: bytes, digest: str, kind: str, refers_to: str | None,
                 date: str = "2024-01-01T00:00:00Z") -> bytes:
    """One WARC record; header values get no line breaks."""
    from urllib.parse import quote

    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n").encode()
    block = http + (body if kind == "response" else b"")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {urn(str(key) if key is not None else 'null')}",
            f"WARC-Date: {date}", f"WARC-Payload-Digest: sha256:{digest}",
            "Content-Type: application/http; msgtype=response"]
    if uri is not None:
        head.append("WARC-Target-URI: " + quote(uri, safe="!#$%&'()*+,/:;=?@[]~-._"))
    if kind == "revisit":
        head += [f"WARC-Refers-To: {urn(refers_to)}", f"WARC-Profile: {IDENTICAL}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def train(samples: list[bytes]) -> bytes:
    """A dictionary from the samples; their plain bytes if they are too few to train one."""
    import zstandard

    samples = [s for s in samples if s]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[:DICTIONARY_BYTES]


def dictionary_frame(dictionary: bytes) -> bytes:
    import zstandard

    packed = zstandard.ZstdCompressor(level=19).compress(dictionary)
    return DICTIONARY_MAGIC.to_bytes(4, "little") + len(packed).to_bytes(4, "little") + packed


def _write_task(dictionary: bytes, per_archive: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        d = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=True, write_checksum=True)
        lead, written, size, out = dictionary_frame(dictionary), 0, 0, []
        for batch in batches:
            for r in range(batch.num_rows):
                key, uri, body, digest, kind, refers = (batch.column(c)[r].as_py() for c in
                                                        ("id", "uri", "body", "digest", "record_type", "refers_to"))
                if written % per_archive == 0:
                    out.append(lead)            # first row of each file
                out.append(packer.compress(record_bytes(key, uri, body, digest, kind, refers)))
                written += 1
                size += len(out[-1])
                if size > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["frame"])
                    out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["frame"])
    return run


def write_archives(pages: DataFrame, path: str, min_bytes: int = MIN_BYTES, per_archive: int = PER_ARCHIVE) -> None:
    """``id, uri, body`` -> archives in the new folder ``path``."""
    some = pages.where("body is not null")
    share = min(1.0, 2 * SAMPLE / max(1, some.count()))                     # so each task sends a few rows only
    sample = (some.select(F.substring(F.col("body").cast("binary"), 1, SAMPLE_BYTES).alias("s"),
                          F.xxhash64("id").alias("k"), F.col("id"))
              .where(F.pmod("k", F.lit(1 << 30)) < int(share * (1 << 30)))
              .orderBy("k", "id").limit(SAMPLE).collect())                  # bounded: SAMPLE * SAMPLE_BYTES
    dictionary = train([bytes(r.s) for r in sample])
    frames = plan_records(pages, min_bytes).mapInArrow(_write_task(dictionary, per_archive), "frame binary")
    (frames.select(F.col("frame").cast("string").alias("value"))
     .write.option("lineSep", EMPTY_FRAME).option("maxRecordsPerFile", per_archive + 1).text(path))


# --- reader -----------------------------------------------------------------------------------

def frames(data) -> Iterator[tuple[int, int, bytes | None, str | None]]:
    """``(offset, length, decoded, error)`` of each record frame of an archive."""
    import zstandard

    view, at, dictionary, first = memoryview(data), 0, None, True
    while at < len(view):
        if len(view) - at < 8:
            yield at, len(view) - at, None, "truncated frame"
            return
        magic = int.from_bytes(view[at:at + 4], "little")
        if magic in SKIPPABLE:
            size = int.from_bytes(view[at + 4:at + 8], "little")
            if at + 8 + size > len(view):
                yield at, len(view) - at, None, "truncated skippable frame"
                return
            if first and magic == DICTIONARY_MAGIC and size:
                raw = bytes(view[at + 8:at + 8 + size])
                if int.from_bytes(raw[:4], "little") == ZSTD_MAGIC:
                    try:
                        raw = zstandard.ZstdDecompressor().decompressobj().decompress(raw)
                    except zstandard.ZstdError as e:
                        yield at, size + 8, None, f"dictionary: {e}"
                        return
                dictionary = zstandard.ZstdCompressionDict(raw) if raw else None
            at, first = at + 8 + size, False
            continue
        first = False
        if magic != ZSTD_MAGIC:
            yield at, len(view) - at, None, "no frame magic"
            return
        unpacker = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj()
        begin, parts = at, []
        try:
            while not unpacker.eof and at < len(view):
                piece = view[at:at + WINDOW]
                parts.append(unpacker.decompress(piece))
                at += len(piece) - (len(unpacker.unused_data) if unpacker.eof else 0)
        except zstandard.ZstdError as e:
            yield begin, len(view) - begin, None, f"frame: {e}"
            return
        if not unpacker.eof:
            yield begin, at - begin, None, "truncated frame"
            return
        yield begin, at - begin, b"".join(parts), None


def parse_record(raw: bytes) -> dict:
    """Fields of a record, or ``error``."""
    out = dict.fromkeys(("record_id", "record_type", "refers_to", "uri", "payload", "payload_bytes", "payload_digest", "error"))
    head, gap, rest = raw.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not gap or not lines[0].startswith(b"WARC/1."):
        return out | {"error": "no WARC header"}
    fields: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.decode("utf-8", "replace").partition(":")
        if not colon:
            return out | {"error": "bad header line"}
        fields[name.strip().lower()] = value.strip()
    missing = [n for n in REQUIRED if n not in fields]
    if missing:
        return out | {"error": f"missing {', '.join(missing)}"}
    length = fields["content-length"]
    if not (length.isascii() and length.isdigit()) or len(rest) != int(length) + 4 or rest[-4:] != b"\r\n\r\n":
        return out | {"error": "Content-Length doesn't fit the record"}
    bare = lambda v: v.removeprefix("<urn:record:").removesuffix(">") if v else None
    digest = fields.get("warc-payload-digest", "")
    out |= {"record_id": bare(fields["warc-record-id"]), "record_type": fields["warc-type"],
            "refers_to": bare(fields.get("warc-refers-to")), "uri": fields.get("warc-target-uri"),
            "payload_digest": digest.removeprefix("sha256:") if digest.startswith("sha256:") else None}
    block = rest[:-4]
    http, gap, payload = block.partition(b"\r\n\r\n")
    if out["record_type"] not in ("response", "revisit"):
        return out | {"payload": block, "payload_bytes": len(block)}
    sizes = [x.split(b":", 1)[1].strip() for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
    if not gap or len(sizes) != 1 or not sizes[0].isdigit():
        return out | {"error": "no HTTP header"}
    out["payload_bytes"] = int(sizes[0])
    if out["record_type"] == "revisit":
        if payload or out["refers_to"] is None or out["payload_digest"] is None:
            return out | {"error": "bad revisit"}
        return out
    if len(payload) != out["payload_bytes"]:
        return out | {"error": "HTTP Content-Length doesn't fit the payload"}
    actual = hashlib.sha256(payload).hexdigest()
    if out["payload_digest"] not in (None, actual):
        return out | {"error": "payload digest doesn't fit"}
    return out | {"payload": payload, "payload_digest": actual}


READ_SCHEMA = ("archive string, offset long, length long, record_id string, record_type string, refers_to string, "
               "uri string, payload_bytes long, payload_digest string, payload binary, error string")


def _read_task(with_payload: bool):
    schema = pa.schema([("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64()),
                        ("record_id", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string()),
                        ("uri", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                        ("payload", pa.binary()), ("error", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                name, data = batch.column("path")[r].as_py(), batch.column("content")[r].as_buffer()
                rows, size = [], 0
                for offset, length, raw, error in frames(data):
                    row = parse_record(raw) if error is None else {"error": error}
                    size += (len(row.get("payload") or b"") if with_payload else 0) + 200
                    if not with_payload:
                        row["payload"] = None
                    rows.append({"archive": name, "offset": offset, "length": length, **row})
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
    return run


def read_archives(spark: SparkSession, path: str, with_payload: bool = True, glob: str = "*") -> DataFrame:
    """One row per record of all archives below ``path``; ``error`` tells what is wrong with one.
    A row of the ``binaryFile`` source holds a whole archive, 2 GB at most."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
             .where("length > 0").select("path", "content"))
    return files.mapInArrow(_read_task(with_payload), READ_SCHEMA)


def op8_warc(spark, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), F.col("url").alias("uri"), F.col("html").alias("body"))
    path = shared_path(spark, "warc")
    write_archives(pages, path)
    r = read_archives(spark, path, with_payload=False, glob="part-*")
    sound = F.when(F.col("error").isNotNull(), F.raise_error(F.concat(F.lit("bad record: "), F.col("error")))).otherwise(F.col("record_type"))
    number = lambda c: F.when(F.col(c) != "null", F.col(c).cast("long"))
    return r.select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest",
                    sound.alias("record_type"), number("refers_to").alias("refers_to"))


ORACLE_SQL = """
with p as (select page_id, coalesce(html, '') as body from pages),
d as (select page_id, octet_length(encode(body))::bigint as payload_bytes, sha256(body) as payload_digest from p),
f as (select *, min(page_id) over (partition by payload_digest) as first from d)
select page_id, payload_bytes, payload_digest,
  case when payload_bytes < 100 or page_id = first then 'response' else 'revisit' end as record_type,
  case when payload_bytes < 100 or page_id = first then null else first end as refers_to
from f
"""
