"""Operator 11: WARC archives with segmented records, chunked HTTP framing and revisits.

Writing: every row becomes a ``response`` record whose block is an HTTP response with chunked transfer framing. A block
longer than ``segment_bytes`` is cut into an origin record and ``continuation`` records that name their origin, their
segment number and, in the last one, the total length. Of rows with equal payloads of at least ``revisit_from`` bytes
those with the largest key are responses and the others ``revisit`` records that refer to one of them. Every record is a gzip
member of its own. The files are written by Spark's text sink, so a file counts only when its task committed, on any file
system Spark can reach; members are separated by an empty member, which readers of gzip skip.

Reading: files are parsed record by record (plain, one member per record, or one member per file); continuation records
are grouped by origin, ordered by segment number and joined, the total length is verified, the chunked framing is
decoded and the payload compared with its digest. Segments of one record may lie in any files. Only segmented records are shuffled.
Revisits get size and digest of the record they refer to; a record that a third of all rows refer to is joined by a broadcast of
proven size (``join_groups``).

Bounds: a file holds at most ``file_records`` records of ``segment_bytes`` plus headers; a task holds one file of an
archive written here (foreign archives: of their file size) and one reassembled record.

Defined cases: a null payload is empty; a null url has no target line; blanks and control characters in urls are written as
%XX; a null key is smaller than any other and read back as null; rows with equal payload and equal largest key are all
responses; repeated rows are records of their own; other columns are ignored; an empty table gives an archive without records.
A record that is damaged (cut off, missing or contradictory segments, wrong total length, broken chunk, wrong digest, nothing
to refer to) comes back with its ``error`` and without payload; others are not affected.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import batches_of, discard, join_groups, save, shared_dir

SEGMENT_BYTES = 16 << 10
CHUNK_BYTES = 4 << 10
FILE_RECORDS = 16_384
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"


# --- one record -------------------------------------------------------------------------------------------------

def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """``payload`` in chunked transfer framing."""
    parts = []
    for at in range(0, len(payload), size):
        piece = payload[at:at + size]
        parts += [b"%x\r\n" % len(piece), piece, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def unchunked(body: bytes) -> bytes:
    """The payload of a chunked body; chunk extensions and trailers are skipped. ``ValueError`` if the framing is broken."""
    parts, at = [], 0
    while True:
        line = body.find(b"\r\n", at)
        digits = body[at:line].split(b";")[0].strip() if line >= 0 else b""
        if not digits or digits.strip(b"0123456789abcdefABCDEF"):
            raise ValueError("chunk size")
        size, at = int(digits, 16), line + 2
        if size == 0:
            return b"".join(parts)
        if body[at + size:at + size + 2] != b"\r\n":
            raise ValueError("chunk end")
        parts.append(body[at:at + size])
        at += size + 2


def http_payload(block: bytes) -> bytes:
    """The payload of an HTTP response message."""
    end = block.find(b"\r\n\r\n")
    if end < 0:
        raise ValueError("http header")
    head = block[:end].lower().replace(b" ", b"")
    body = block[end + 4:]
    return unchunked(body) if b"\r\ntransfer-encoding:chunked" in head else body


def urn(*names) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, '/'.join(map(str, names)))}>"


def header(fields: list[tuple[str, object]], size: int) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields if v is not None), f"Content-Length: {size}", "", ""]
    return "\r\n".join(lines).encode()


def quoted(url: str | None) -> str | None:
    return None if url is None else "".join(f"%{ord(c):02X}" if c <= " " or c == "\x7f" else c for c in url)


def digest_label(sha1_hex: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def digest_hex(label: str | None) -> str | None:
    """Lower-case hex of a ``sha1:`` label in base 32 or hex."""
    if not label or not label.lower().startswith("sha1:"):
        return None
    value = label[5:].strip()
    try:
        return (bytes.fromhex(value) if len(value) == 40 else base64.b32decode(value.upper())).hex()
    except ValueError:
        return None


def records_of(rid: str, key, url, payload: bytes, sha1: str, refers: str | None, date: str, segment_bytes: int):
    """The records of one row, as bytes."""
    common = [("WARC-Date", date), ("WARC-Target-URI", quoted(url)), ("Record-Key", key),
              ("WARC-Payload-Digest", digest_label(sha1)), ("Content-Type", "application/http;msgtype=response")]
    if refers is not None:
        block = _HTTP + b"\r\n"
        yield header([("WARC-Type", "revisit"), ("WARC-Record-ID", rid), ("WARC-Refers-To", refers),
                      ("WARC-Profile", _PROFILE), *common], len(block)) + block + b"\r\n\r\n"
        return
    block = _HTTP + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    last = max(-(-len(block) // segment_bytes), 1)
    for k in range(1, last + 1):
        part = block[(k - 1) * segment_bytes:k * segment_bytes]
        number = ("WARC-Segment-Number", k if last > 1 else None)
        if k == 1:
            fields = [("WARC-Type", "response"), ("WARC-Record-ID", rid), number, *common]
        else:
            fields = [("WARC-Type", "continuation"), ("WARC-Record-ID", urn(rid, k)), ("WARC-Date", date),
                      ("WARC-Segment-Origin-ID", rid), number,
                      ("WARC-Segment-Total-Length", len(block) if k == last else None)]
        yield header(fields, len(part)) + part + b"\r\n\r\n"


# --- writing ----------------------------------------------------------------------------------------------------

def response_records(pages: DataFrame, to: str, key: str, url: str, payload: str, date: str, segment_bytes: int, level: int) -> DataFrame:
    """Every row as a response, written once to the folder ``to``: ``(rid, key, url, sha1, size, check, members)``; ``members`` are its compressed records, so that
    no later step moves more than they take. Retried tasks of later steps see the same record ids."""
    import pyarrow as pa

    def run(batches):
        for b in batches:
            made, held, first = [], 0, 0

            def part(first=0, last=0, made=()):
                return pa.RecordBatch.from_arrays([*(b.column(i).slice(first, last - first) for i in range(6)),
                                                   pa.array(made, pa.list_(pa.binary()))],
                                                  names=["rid", "key", "url", "sha1", "size", "check", "members"])

            for i, (rid, k, u, sha1, raw, name) in enumerate(zip(*(b.column(c).to_pylist() for c in ("rid", "key", "url", "sha1", "payload", "name")))):
                made.append([gzip.compress(r, level, mtime=0) for r in records_of(rid, name, u, raw, sha1, None, date, segment_bytes)])
                held += sum(map(len, made[-1]))
                if held > 4 << 20:
                    yield part(first, i + 1, made)
                    made, held, first = [], 0, i + 1
            yield part(first, b.num_rows, made)

    body = F.coalesce(F.col(f"`{payload}`").cast("binary"), F.lit("").cast("binary"))
    kind = pages.select(F.col(f"`{key}`")).dtypes[0][1]
    rows = pages.select(F.format_string("<urn:uuid:%s>", F.uuid()).alias("rid"), F.col(f"`{key}`").alias("key"),
                        F.col(f"`{url}`").cast("string").alias("url"), body.alias("payload")).select(
        "rid", "key", "url", F.sha1("payload").alias("sha1"), F.length("payload").alias("size"), F.xxhash64("payload").alias("check"),
        "payload", F.col("key").cast("string").alias("name"))
    made = rows.mapInArrow(run, f"rid string, key {kind}, url string, sha1 string, size int, check long, members array<binary>")
    made.write.option("compression", "none").parquet(to)
    return pages.sparkSession.read.schema(made.schema).parquet(to)


def with_references(rows: DataFrame, revisit_from: int) -> DataFrame:
    """``rows`` and ``refers``, the record that a revisit stands for (null: a response)."""
    equal = ["sha1", "size", "check"]
    groups = (rows.where(F.col("size") >= revisit_from).groupBy(*equal)
              .agg(F.count(F.lit(1)).alias("group_n"), F.max("key").alias("top"), F.max_by("rid", F.struct("key", "rid")).alias("first"))
              .where("group_n > 1"))
    joined = join_groups(rows, save(groups, "equal-payloads"), equal)
    refers = F.when(F.col("top").isNotNull() & ~F.col("key").eqNullSafe(F.col("top")), F.col("first"))
    return joined.select("rid", F.col("key").cast("string").alias("key"), "url", "sha1", "members", refers.alias("refers"))


def write_warc(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", payload: str = "html",
               revisit_from: int = 1000, segment_bytes: int = SEGMENT_BYTES, file_records: int = FILE_RECORDS,
               date: str = "1970-01-01T00:00:00Z", level: int = 6) -> None:
    """Write a record per row of ``pages`` into gzip files under ``path``. ``key`` may be of any type that orders."""
    import pyarrow as pa

    def revisits(batches):
        for b in batches:
            out = [gzip.compress(r, level, mtime=0) for rid, k, u, sha1, refers in zip(*(b.column(i).to_pylist() for i in range(5)))
                   for r in records_of(rid, k, u, b"", sha1, refers, date, segment_bytes)]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["member"])

    spark = pages.sparkSession
    own = shared_dir(spark, "records")
    rows = with_references(response_records(pages, own, key, url, payload, date, segment_bytes, level), revisit_from)
    members = rows.where("refers IS NULL").select(F.explode("members").alias("member")).unionByName(
        rows.where("refers IS NOT NULL").select("rid", "key", "url", "sha1", "refers").mapInArrow(revisits, "member binary"))
    (members.select(F.col("member").cast("string").alias("value"))
     .write.option("lineSep", gzip.compress(b"", mtime=0).decode("latin-1")).option("encoding", "ISO-8859-1")
     .option("maxRecordsPerFile", file_records).text(path))
    discard(spark, own)  # the archive holds all of it


# --- reading ----------------------------------------------------------------------------------------------------

def inflated(raw, step: int = 1 << 16, most: int = 1 << 20):
    """The bytes of a file, plain or of any number of gzip members, in pieces of at most ``most`` bytes."""
    if bytes(raw[:2]) != b"\x1f\x8b":
        yield from (raw[at:at + most] for at in range(0, len(raw), most))
        return
    at, gz, tail = 0, zlib.decompressobj(31), b""
    while at < len(raw) or tail:
        piece = tail
        if not piece:
            piece = raw[at:at + step]
            at += len(piece)
        out = gz.decompress(piece, most)
        tail = gz.unconsumed_tail
        if gz.eof:
            at -= len(gz.unused_data)
            gz, tail = zlib.decompressobj(31), b""
        if out:
            yield out


def parsed(pieces):
    """``(fields, block, error)`` of every record in a stream of bytes. After damage no later record of the file can be found."""
    pieces, held = iter(pieces), bytearray()

    def fill(n: int) -> bool:
        while len(held) < n:
            more = next(pieces, None)
            if more is None:
                return False
            held.extend(more)
        return True

    try:
        while fill(1):
            at = 0
            while (end := held.find(b"\r\n\r\n", at)) < 0:
                at = max(len(held) - 3, 0)
                if not fill(len(held) + 1):
                    yield {}, None, "record header"
                    return
            lines = bytes(held[:end]).decode("utf-8", "replace").split("\r\n")
            fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
            size = fields.get("content-length", "")
            if not lines[0].startswith("WARC/") or not size.isdigit():
                yield fields, None, "record header"
                return
            size = int(size)
            whole = fill(end + 4 + size + 4)
            if not whole and len(held) < end + 4 + size:
                yield fields, None, "record cut off"
                return
            yield fields, bytes(held[end + 4:end + 4 + size]), None
            del held[:end + 4 + size + 4]
    except zlib.error:
        yield {}, None, "gzip"


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """A row per record of the files under ``path``, as written: ``record_id, type, target_uri, key, refers_to, sha1`` (of the
    header), ``origin`` and ``segment`` (null if not segmented), ``total`` (null if not given), ``block``, ``error``."""
    import pyarrow as pa

    names = ["record_id", "type", "target_uri", "key", "refers_to", "sha1", "origin", "segment", "total", "block", "error"]
    types = [*[pa.string()] * 7, pa.int32(), pa.int64(), pa.binary(), pa.string()]

    def number(text):
        return int(text) if text and text.isdigit() else None

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 11, types)], names=names)

    def run(batches):
        for b in batches:
            for raw in b.column("content"):
                rows, held = [], 0
                for f, block, error in parsed(inflated(raw.as_buffer().to_pybytes())):
                    segment = number(f.get("warc-segment-number"))
                    rows.append((f.get("warc-record-id"), f.get("warc-type"), f.get("warc-target-uri"), f.get("record-key"),
                                 f.get("warc-refers-to"), digest_hex(f.get("warc-payload-digest")),
                                 None if segment is None else f.get("warc-segment-origin-id", f.get("warc-record-id")), segment,
                                 number(f.get("warc-segment-total-length")), block, error))
                    held += len(block or b"")
                    if held > 4 << 20 or len(rows) == 5000:
                        yield batch(rows)
                        rows, held = [], 0
                yield batch(rows)

    files = spark.read.format("binaryFile").load(path).select("content")
    schema = ", ".join(f"{n} {t}" for n, t in zip(names, [*["string"] * 7, "int", "long", "binary", "string"]))
    with batches_of(spark, 1):  # one file at a time is handed to a worker
        return save(files.mapInArrow(run, schema), "warc-records", compression="zstd")


def reassemble(records: DataFrame) -> DataFrame:
    """Join segments: whole records pass, those of one origin become one record, ordered by segment number. The numbers must
    be 1 to n, each with one content, and the last must give the length of the whole."""
    whole = records.where("origin IS NULL").drop("origin", "segment", "total")
    parts = records.where("origin IS NOT NULL")
    head = F.col("segment") == 1
    joined = parts.groupBy("origin").agg(
        *(F.max(F.when(head, F.col(c))).alias(c) for c in ("type", "target_uri", "key", "refers_to", "sha1")),
        F.sort_array(F.collect_set(F.struct("segment", "block"))).alias("parts"),
        F.max("total").alias("total"), F.max("error").alias("error"))
    numbers = F.col("parts")["segment"]
    block = F.aggregate("parts", F.lit("").cast("binary"), lambda acc, p: F.concat(acc, F.coalesce(p["block"], F.lit("").cast("binary"))))
    error = (F.when(F.col("error").isNotNull(), F.col("error"))
             .when(F.size(F.array_distinct(numbers)) < F.size("parts"), F.lit("segments contradict"))
             .when((F.element_at(numbers, 1) != 1) | (F.element_at(numbers, -1) != F.size("parts")) | F.col("total").isNull(),
                   F.lit("segment missing")))
    joined = joined.withColumn("error", error).withColumn("block", block)
    joined = joined.withColumn("error", F.coalesce("error", F.when(F.length("block") != F.col("total"), F.lit("total length"))))
    return whole.unionByName(joined.select(F.col("origin").alias("record_id"), *(c for c in whole.columns if c != "record_id")))


def decode_records(records: DataFrame) -> DataFrame:
    """``block`` of responses becomes ``payload`` (HTTP header removed, chunked framing decoded), compared with the digest.
    Other types keep their block as payload; a revisit has none."""
    import pyarrow as pa

    names = ["record_id", "type", "target_uri", "key", "refers_to", "sha1"]

    def run(batches):
        for b in batches:
            payloads, errors = [], []
            for kind, sha1, block, error in zip(*(b.column(c).to_pylist() for c in ("type", "sha1", "block", "error"))):
                payload = None
                if error is None and kind != "revisit":
                    try:
                        payload = http_payload(block) if kind == "response" else block
                        if kind == "response" and sha1 is not None and hashlib.sha1(payload).hexdigest() != sha1:
                            payload, error = None, "payload digest"
                    except ValueError as e:
                        error = str(e)
                payloads.append(payload)
                errors.append(error)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(payloads, pa.binary()),
                                              pa.array(errors, pa.string())], names=[*names, "payload", "error"])

    return records.select(*names, "block", "error").mapInArrow(
        run, ", ".join(f"{n} string" for n in names) + ", payload binary, error string")


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The archive under ``path``: ``record_id, type, target_uri, key, refers_to, sha1, payload, error``, a row per record
    after reassembly."""
    return decode_records(reassemble(read_records(spark, path)))


def resolve_revisits(records: DataFrame) -> DataFrame:
    """``record_id, type, key, payload_bytes, payload_digest, refers_key, error`` of responses and revisits, with size and digest of
    the record that a revisit refers to. ``records`` as ``read_warc`` gives them; their payloads are read once."""
    known = save(records.where(F.col("type").isin("response", "revisit")).select(
        "record_id", "type", "key", "refers_to", "sha1", F.length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"), "error"), "warc-sizes")
    out = ["record_id", "type", "key", "payload_bytes", "payload_digest", "refers_key", "error"]
    responses = known.where("type = 'response'").withColumn("refers_key", F.lit(None).cast("string"))
    revisits = known.where("type = 'revisit'").drop("payload_bytes", "payload_digest")
    asked = revisits.where("refers_to IS NOT NULL").groupBy("refers_to").agg(F.count(F.lit(1)).alias("group_n"))
    given = known.where("type = 'response' AND error IS NULL").groupBy(F.col("record_id").alias("refers_to")).agg(
        F.max("key").alias("refers_key"), F.max("payload_bytes").alias("payload_bytes"), F.max("payload_digest").alias("payload_digest"))
    back = join_groups(save(revisits, "revisits"), save(asked.join(given, "refers_to"), "referred"), ["refers_to"])
    wrong = (F.when(F.col("payload_digest").isNull(), F.lit("nothing to refer to"))
             .when(F.col("sha1") != F.col("payload_digest"), F.lit("payload digest")))
    back = back.withColumn("error", F.coalesce("error", wrong))
    return responses.select(*out).unionByName(back.select(*out))
