"""WARC archives compressed record by record with a Zstandard dictionary in a leading skippable frame."""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sinks.storage import scratch_dir
from .common import broadcast_below, store

# Magic of the skippable frame that holds a dictionary, and the smallest payload that is revisited.
DICT_FRAME, LEAST = 0x184D2A5D, 1000
#: Records that the dictionary is built from, and their payload bytes (at most); bytes of the dictionary and of an archive.
SAMPLE, SAMPLE_BYTES, DICT_BYTES, ARCHIVE = 1000, 8 << 20, 64 << 10, 64 << 20
CHUNK = 1 << 20


def train(payloads: list[bytes]) -> bytes:
    """A dictionary of the records; too few or too small ones give their joined text as plain content."""
    try:
        return zstandard.train_dictionary(DICT_BYTES, payloads).as_bytes()
    except zstandard.ZstdError:
        return b"".join(payloads)[-DICT_BYTES:]


def header(fields: list[tuple[str, str]]) -> bytes:
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n").encode()


def record_id(page_id: int | None, digest: str, place: str = "") -> str:
    """The id of a record; ``place`` tells those apart that no other record refers to."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {digest} {place}')}>"


def record(
    page_id: int | None, url: str | None, digest: str, size: int, payload: bytes, response: int | None, place: str = ""
) -> bytes:
    """A response record with its payload, or a revisit (``response`` is the page it refers to) without."""
    revisit = response is not None
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page_id, digest, place)),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Target-URI", "".join((url or "").split())),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("X-Payload-Length", str(size)),
    ]
    fields += [("X-Page-Id", str(page_id))] if page_id is not None else []
    if revisit:
        fields += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", record_id(response, digest)),
            ("X-Refers-To-Page", str(response)),
        ]
    body = b"" if revisit else payload
    return header([*fields, ("Content-Type", "text/html"), ("Content-Length", str(len(body)))]) + body + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1" or not rest.endswith(b"\r\n\r\n"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    body = rest[:-4]
    if len(body) != int(fields["Content-Length"]):
        raise ValueError("length of a WARC record")
    return fields, body


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def _write(batches: Iterator[pa.RecordBatch], folder: str, words: bytes) -> Iterator[pa.RecordBatch]:
    """Archives of bounded size; a repeated task writes files of its own, and only listed files are read."""
    home, base = _open(folder)
    home.create_dir(base, recursive=True)
    dictionary = zstandard.ZstdCompressionDict(words) if words else None
    packer = zstandard.ZstdCompressor(level=6, dict_data=dictionary, write_checksum=True)
    out, name, size, n = None, "", 0, 0

    def listed() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"]), pa.array([n], pa.int64())], ["path", "records"])

    for batch in batches:
        for i in range(batch.num_rows):
            page_id, url, html, digest, length, response, target = (batch.column(c)[i].as_py() for c in range(7))
            if out is None:
                name, size, n = f"{uuid.uuid4().hex}.warc.zst", 0, 0
                out = home.open_output_stream(f"{base}/{name}", compression=None)
                out.write(struct.pack("<II", DICT_FRAME, len(words)) + words)
            # A record that revisits refer to has the id that they can know; any other has one of its own.
            place = "" if target else f"{name} {n}"
            out.write(packer.compress(record(page_id, url, digest, length, (html or "").encode(), response, place)))
            size, n = size + length, n + 1
            if size >= ARCHIVE:
                out.close()
                yield listed()
                out = None
    if out is not None:
        out.close()
        yield listed()


def records(stream) -> Iterator[bytes]:
    """The records of an archive, frame by frame."""
    magic, size = struct.unpack("<II", stream.read(8))
    if magic != DICT_FRAME:
        raise ValueError("no dictionary frame")
    words = stream.read(size)
    unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(words) if words else None)
    data = stream.read(CHUNK)
    while data:
        frame, parts = unpacker.decompressobj(), []
        while True:
            parts.append(frame.decompress(data))
            if frame.eof:
                data = frame.unused_data or stream.read(CHUNK)
                break
            data = stream.read(CHUNK)
            if not data:
                raise ValueError("archive ends inside a record")
        yield b"".join(parts)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    for batch in batches:
        for path in batch.column(0).to_pylist():
            home, place = _open(path)
            rows: list[tuple] = []
            with home.open_input_stream(place, compression=None) as stream:
                for data in records(stream):
                    fields, body = parse(data)
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    kind, size = fields["WARC-Type"], int(fields["X-Payload-Length"])
                    if kind == "response":
                        if hashlib.sha1(body).hexdigest() != digest:
                            raise ValueError("digest of a WARC record")
                        size = len(body)
                    page, refers = fields.get("X-Page-Id"), fields.get("X-Refers-To-Page")
                    rows.append((page and int(page), fields["WARC-Target-URI"], size, digest, kind, refers and int(refers)))
                    if len(rows) == 5000:
                        yield _rows(rows, names, kinds)
                        rows = []
            if rows:
                yield _rows(rows, names, kinds)


def _rows(rows: list[tuple], names: list[str], kinds: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def _sample(hashed: DataFrame) -> list[bytes]:
    """Whole records for the dictionary, in the order of a hash of their content, up to the bounds.

    A bound on the hash, from the number of payloads, lets about twice as many pass as are wanted; their sizes decide
    how many payloads are fetched.
    """
    some = hashed.filter("_bytes > 0").withColumn("_at", F.pmod(F.xxhash64("_digest"), F.lit(1 << 30)))
    n = some.count()
    share = min(1 << 30, (1 << 30) * 2 * SAMPLE // max(1, n) + 1)
    sizes = some.filter(F.col("_at") < share).select("_at", "_digest", "_bytes").distinct().orderBy("_at", "_digest").limit(SAMPLE).collect()
    left, chosen = SAMPLE_BYTES, []
    for row in sizes:
        left -= row["_bytes"]
        if left < 0:
            break
        chosen.append(row["_digest"])
    if not chosen:
        return []
    rows = some.filter(F.col("_digest").isin(chosen)).groupBy("_digest").agg(F.min(F.struct("page_id", "url", "html", "_bytes")).alias("r"))
    return [record(r["page_id"], r["url"], d, r["_bytes"], r["html"].encode(), None) for d, r in sorted(rows.collect())]


def write_warc(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write one record per page into archives under ``folder``; the list of (path, records) comes back.

    Of equal payloads of at least 1000 bytes the one with the largest key is a response and the others
    revisit it; smaller ones are responses. Null payloads are empty, null keys come before all others (a
    group that has only null keys is all responses), rows repeated with the largest key are responses too,
    an empty table writes no archive. Only key, url and html are read. The dictionary is built from whole
    records as they are archived, at most ``SAMPLE`` of them and ``SAMPLE_BYTES``, taken by hash; every record is
    written. Records of repeated rows that others refer to share their id.
    """
    narrow = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    body = F.coalesce(F.col("html"), F.lit(""))
    hashed = narrow.withColumn("_digest", F.sha1(F.encode(body, "UTF-8"))).withColumn(
        "_bytes", F.octet_length(body).cast("long")
    )
    large = hashed.filter(F.col("_bytes") >= LEAST).groupBy("_digest").agg(F.max("page_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    groups = store(large.filter("_n > 1").select(F.col("_digest").alias("_group"), "_first"), "warc-groups")
    joined = hashed.join(broadcast_below(groups), F.col("_digest") == F.col("_group"), "left")
    revisit = (F.col("_first") != F.col("page_id")) | (F.col("page_id").isNull() & F.col("_first").isNotNull())
    target = F.col("_first").isNotNull() & ~revisit
    rows = joined.select("page_id", "url", "html", "_digest", "_bytes", F.when(revisit, F.col("_first")).alias("_response"), target.alias("_target"))
    words = train(_sample(hashed))
    return store(rows.mapInArrow(partial(_write, folder=folder, words=words), "path string, records long"), "warc-list")


def read_warc(listed: DataFrame) -> DataFrame:
    """One row per record of the listed archives; payload digests are checked; archives are read in parallel."""
    paths = listed.select("path").repartition(listed.sparkSession.sparkContext.defaultParallelism)
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return paths.mapInArrow(_read, schema)


def archive_folder(spark) -> str:
    return f"{scratch_dir(spark)}/warc/{uuid.uuid4().hex}"
