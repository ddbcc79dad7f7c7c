"""WARC archives with an index first.

``write_archives`` deals pages over tasks; each writes one archive file of
gzip members, one per record, and returns an index row per record: file,
offset, length, URL, digest.  Of records with equal payloads the one with
the least id is a response, the others are revisits that refer to it.
``read_records`` serves any selection of index rows: the ranges of a file
are sorted, neighbouring ones are coalesced into one read, and the records
are cut from it and parsed.

Scale: digests are reduced to (digest, least id) with pre-aggregation
before the payloads move, once; a payload that a third of all pages share
is one key of a plain join, which adaptive execution splits.  A file name
belongs to one task attempt, and the index holds only the files of the
attempts that succeeded.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, shuffle_partitions, text_slices

#: Ranges of a file no further apart than this are read at once.
COALESCE_GAP = 64 << 10
#: Bytes of one coalesced read at most (a single record may be longer).
COALESCE_MOST = 8 << 20
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: WARC-Date of every record: the pages carry no time of their own.
DATE = "2024-01-01T00:00:00Z"
INDEX = ("page_id long, file string, offset long, length long, url string, "
         "payload_digest string, record_type string, refers_to long")


def digest_text(sha1: bytes) -> str:
    """Bare upper-case base32, as WARC digests are written."""
    return base64.b32encode(sha1).decode()


def _header_text(value: str) -> str:
    return value.replace("\r", " ").replace("\n", " ")


def record_bytes(page_id, url: str | None, block: bytes, digest: str, *, record_type: str,
                 payload_length: int, refers_to=None) -> bytes:
    """One record as a gzip member.  A revisit has no block: its payload is
    that of the record it refers to, its digest and length are stated."""
    head = ["WARC/1.1", f"WARC-Type: {record_type}", f"WARC-Record-ID: <urn:page:{page_id}>",
            f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest}",
            f"X-Payload-Length: {payload_length}", "Content-Type: text/html; charset=utf-8"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_header_text(url)}")
    if record_type == "revisit":
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head.append(f"Content-Length: {len(block)}")
    return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n",
                         compresslevel=5, mtime=0)


def parse_record(member: bytes) -> dict:
    """Headers and block of one gzip member; ValueError where the record is
    not whole."""
    data = zlib.decompress(member, wbits=31)
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    headers = dict(line.split(": ", 1) for line in lines)
    size = int(headers["Content-Length"])
    if first != "WARC/1.1" or rest[size:] != b"\r\n\r\n":
        raise ValueError("not a whole WARC record")
    return {"headers": headers, "block": rest[:size]}


def _page_of(urn: str | None):
    text = urn.removeprefix("<urn:page:").removesuffix(">") if urn else "None"
    return None if text == "None" else int(text)


def write_archives(pages: DataFrame, folder: str, *, key: str = "page_id", url: str = "url",
                   payload: str = "html", least_bytes: int = 0) -> DataFrame:
    """Write a record per row of ``pages`` into ``folder`` (a URI that all
    executors share); returns the index, a row per record.

    Payloads are texts in UTF-8, a null is the empty one.  Payloads of
    ``least_bytes`` or more are written once; rows that share key and
    payload with the response are responses too.  A null key is never
    referred to unless all of its payload's keys are null: then all are
    responses.  A null URL is left out of the record, a line break in one
    becomes a space.  No rows write
    nothing.
    """
    spark = pages.sparkSession
    # named apart from whatever else the pages hold
    p = pages.select(F.col(f"`{key}`").cast("bigint").alias("page_id"), F.col(f"`{url}`").alias("url"),
                     F.coalesce(F.col(f"`{payload}`"), F.lit("")).alias("payload"))
    p = p.withColumn("sha1", F.unhex(F.sha1(F.encode("payload", "UTF-8"))))
    firsts = (p.where(F.octet_length("payload") >= least_bytes).groupBy("sha1")
              .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
              .where("n > 1").select("sha1", "first"))
    firsts = Scratch(spark, "warc").keep(firsts, "firsts")
    dealt = (p.join(firsts, "sha1", "left")
             .withColumn("refers_to", F.when(~F.col("first").eqNullSafe(F.col("page_id")),
                                             F.col("first")))
             .select("page_id", "url", "refers_to", "sha1",
                     # a revisit's payload stays behind; its length is stated
                     F.octet_length("payload").alias("payload_bytes"),
                     F.when(F.col("refers_to").isNull(), F.col("payload")).alias("payload")))

    def write(batches):
        out, at = None, 0
        for rows in text_slices(batches, "payload", 4 << 20):
            if out is None:
                fs, path = pa.fs.FileSystem.from_uri(folder)
                fs.create_dir(path, recursive=True)
                name = f"pages-{uuid.uuid4().hex}.warc.gz"
                out = fs.open_output_stream(f"{path}/{name}", compression=None)
            index = []
            for r in rows.to_pylist():
                kind = "response" if r["refers_to"] is None else "revisit"
                digest = digest_text(r["sha1"])
                record = record_bytes(r["page_id"], r["url"], (r["payload"] or "").encode(), digest, record_type=kind,
                                      refers_to=r["refers_to"], payload_length=r["payload_bytes"])
                out.write(record)
                index.append({"page_id": r["page_id"], "file": f"{folder}/{name}", "offset": at,
                              "length": len(record), "url": r["url"], "payload_digest": digest,
                              "record_type": kind, "refers_to": r["refers_to"]})
                at += len(record)
            yield pa.RecordBatch.from_pylist(index, schema=_INDEX)
        if out is not None:
            out.close()

    return Scratch(spark, "warc-index").keep(dealt.mapInArrow(write, INDEX), "index")


_INDEX = pa.schema([("page_id", pa.int64()), ("file", pa.string()), ("offset", pa.int64()),
                    ("length", pa.int64()), ("url", pa.string()), ("payload_digest", pa.string()),
                    ("record_type", pa.string()), ("refers_to", pa.int64())])


def coalesced(ranges, gap: int = COALESCE_GAP, most: int = COALESCE_MOST):
    """Groups of (offset, length, ...) ranges sorted by offset that one read
    serves: (start, end, members)."""
    group, start, end = [], 0, 0
    for r in ranges:
        if group and (r[0] - end > gap or max(end, r[0] + r[1]) - start > most):
            yield start, end, group
            group = []
        if not group:
            start = r[0]
            end = r[0]
        group.append(r)
        end = max(end, r[0] + r[1])
    if group:
        yield start, end, group


def read_records(index: DataFrame) -> DataFrame:
    """The records of the index rows given, read back from the archives:
    ``page_id``, ``url``, ``record_type``, ``refers_to``,
    ``payload_bytes``, ``payload_digest`` and ``payload`` (null for a
    revisit).  A response whose block does not have its digest, or a
    record other than the index states, is an error."""
    spark = index.sparkSession
    dealt = (index.select("file", "offset", "length", "payload_digest")
             .repartitionByRange(shuffle_partitions(spark), "file", "offset")
             .sortWithinPartitions("file", "offset"))
    schema = ("page_id long, url string, record_type string, refers_to long, "
              "payload_bytes long, payload_digest string, payload binary")

    def read(batches):
        opened = None
        for batch in batches:
            by_file: dict[str, list] = {}
            for file, *r in zip(*(c.to_pylist() for c in batch.columns)):
                by_file.setdefault(file, []).append(r)
            for file, ranges in by_file.items():
                if opened is None or opened[0] != file:
                    fs, path = pa.fs.FileSystem.from_uri(file)
                    opened = file, fs.open_input_file(path)
                for start, end, members in coalesced(ranges):
                    data = opened[1].read_at(end - start, start)
                    yield pa.RecordBatch.from_pylist(
                        [_read_back(data[o - start:o - start + n], digest)
                         for o, n, digest in members], schema=_RECORD)

    return dealt.mapInArrow(read, schema)


_RECORD = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                     ("refers_to", pa.int64()), ("payload_bytes", pa.int64()),
                     ("payload_digest", pa.string()), ("payload", pa.binary())])


def _read_back(member: bytes, digest: str) -> dict:
    record = parse_record(member)
    h, block = record["headers"], record["block"]
    kind = h["WARC-Type"]
    stated = h["WARC-Payload-Digest"].removeprefix("sha1:")
    if stated != digest or (kind == "response"
                            and digest_text(hashlib.sha1(block).digest()) != digest):
        raise ValueError(f"digest of {h['WARC-Record-ID']} differs from its index")
    return {"page_id": _page_of(h["WARC-Record-ID"]), "url": h.get("WARC-Target-URI"),
            "record_type": kind, "refers_to": _page_of(h.get("WARC-Refers-To")),
            "payload_bytes": int(h["X-Payload-Length"]), "payload_digest": stated,
            "payload": block if kind == "response" else None}
