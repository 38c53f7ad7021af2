"""WARC archives with an embedded Zstandard dictionary.

Every task groups its records into archives of ``ARCHIVE_BYTES``, trains a
dictionary on an archive's own records, puts it into a leading skippable
frame and compresses each record as a frame of its own, so a record can be
read by seeking.  Archives go to the shared folder; a manifest written by
Spark lists those of the attempts that succeeded, so files of lost or
repeated attempts are never read.

Cases: null html is an empty payload; null urls leave the header out; pages
with a null id are written and never referred to (they revisit the smallest
id of their payload, if there is one); rows repeating the smallest id of a
payload are responses, each of them; payloads under ``MIN_REVISIT`` bytes are
always responses; an empty table gives no archive and an empty result; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import io
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .keys import NULL_ID

MIN_REVISIT = 100
ARCHIVE_BYTES = 16 << 20    # of records, before compression
DICTIONARY_BYTES = 64 << 10
SAMPLE_BYTES = 100 * DICTIONARY_BYTES       # of an archive's records that its dictionary is trained on
LEVEL = 3
#: Fixed values of the formats.
SKIPPABLE = 0x184D2A5D
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"               # pages have no capture time

MANIFEST = "path string, records long, raw_bytes long, stored_bytes long, trained boolean"
RECORDS = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
           "refers_to long, archive string, payload binary")


def decided(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            min_revisit: int = MIN_REVISIT) -> DataFrame:
    """(page_id, url, html, digest, refers_to): which pages revisit which response.

    Only ids and digests are grouped and joined by digest; the html moves
    once, to the key of its page.
    """
    page = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        page.alias("html"), F.sha2(page, 256).alias("digest"))
    narrow = rows.filter(F.octet_length("html") >= min_revisit).select("page_id", "digest")
    first = (narrow.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
             .filter((F.col("n") > 1) & F.col("refers_to").isNotNull()).drop("n"))
    revisits = (narrow.join(first, "digest")
                .filter(F.col("page_id").isNull() | (F.col("page_id") > F.col("refers_to")))
                .select(F.coalesce("page_id", F.lit(NULL_ID)).alias("key"), "digest", "refers_to").distinct())
    return (rows.withColumn("key", F.coalesce("page_id", F.lit(NULL_ID)))
            .join(revisits, ["key", "digest"], "left").drop("key"))


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record: a response with its HTTP block, or a revisit with the block's head only."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="!#$%&'()*+,/:;=?@[]~"))
    head.append(f"WARC-Payload-Digest: sha256:{digest}")
    if refers_to is None:
        block += payload
    else:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def dictionary(records: list[bytes]) -> tuple[bytes, bool]:
    """The dictionary of an archive and whether it was trained: else, of too few or too uniform records, it is a piece of them."""
    sample, size = [], 0
    step = max(1, sum(map(len, records)) // SAMPLE_BYTES)
    for r in records[::step]:
        sample.append(r)
        size += len(r)
    try:
        if size >= 10 * 1024:
            return zstandard.train_dictionary(min(DICTIONARY_BYTES, size // 10), sample, k=1024, d=8).as_bytes(), True
    except zstandard.ZstdError:
        pass
    return b"".join(sample)[:min(DICTIONARY_BYTES, max(1024, size // 10))], False


def pack(records: list[bytes], prepared: bytes | None = None) -> bytes:
    """An archive: its dictionary in a skippable frame, then the frames; nothing for no records."""
    trained = dictionary(records)[0] if prepared is None else prepared
    tool = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True,
                                    dict_data=zstandard.ZstdCompressionDict(trained) if trained else None)
    out = [struct.pack("<II", SKIPPABLE, len(trained)) + trained] if trained else []
    return b"".join([*out, *map(tool.compress, records)])


def unpack(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of an archive."""
    data, trained = archive, None
    if len(archive) >= 8 and struct.unpack("<I", archive[:4])[0] == SKIPPABLE:
        size = struct.unpack("<I", archive[4:8])[0]
        trained, data = zstandard.ZstdCompressionDict(archive[8:8 + size]), memoryview(archive)[8 + size:]
    plain = io.BufferedReader(zstandard.ZstdDecompressor(dict_data=trained).stream_reader(
        io.BytesIO(data), read_across_frames=True), 1 << 16)
    while line := plain.readline():
        if line != b"WARC/1.1\r\n":
            raise ValueError(f"no WARC record here: {line[:40]!r}")
        head = {}
        while (line := plain.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode().partition(":")
            head[name.lower()] = value.strip()
        block = plain.read(int(head["content-length"]))
        if plain.read(4) != b"\r\n\r\n":
            raise ValueError("the record's block doesn't end where it should")
        yield head, block


def _store(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:/") \
        else (fs.LocalFileSystem(), folder)


def write(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES, **columns) -> DataFrame:
    """Write the archives into ``folder`` (shared storage); the manifest, read back from there.

    The manifest is written by Spark's committer: an attempt that fails
    leaves files that no row names.
    """
    spark = pages.sparkSession

    def archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(folder)
        store.create_dir(f"{base}/archives", recursive=True)
        held: list[bytes] = []

        def flush() -> pa.RecordBatch:
            path = f"{base}/archives/{uuid.uuid4().hex}.warc.zst"
            prepared, trained = dictionary(held)
            packed = pack(held, prepared)
            with store.open_output_stream(path) as f:
                f.write(packed)
            row = {"path": [path], "records": [len(held)], "raw_bytes": [sum(map(len, held))],
                   "stored_bytes": [len(packed)], "trained": [trained]}
            held.clear()
            return pa.RecordBatch.from_pydict(row)

        size = 0
        for batch in batches:
            cols = [batch.column(c) for c in ("page_id", "url", "html", "digest", "refers_to")]
            for i in range(batch.num_rows):
                page_id, url, page, digest, refers = (c[i].as_py() for c in cols)
                held.append(record(page_id, url, page.encode(), digest, refers))
                size += len(held[-1])
                if size >= archive_bytes:
                    yield flush()
                    size = 0
        if held:
            yield flush()

    decided(pages, **columns).mapInArrow(archives, MANIFEST).write.parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def read(manifest: DataFrame, folder: str, payloads: bool = False) -> DataFrame:
    """Records of the archives in a manifest; full payloads' digests are computed anew and compared."""
    n = max(1, min(manifest.count(), 1 << 14))

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = _store(folder)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with store.open_input_stream(path) as f:
                    archive = f.read()
                rows = []
                for head, block in unpack(archive):
                    rows.append(_row(head, block, path, payloads))
                    if len(rows) == 256:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows = []
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                        ("archive", pa.string()), ("payload", pa.binary())])
    return manifest.select("path").repartition(n, "path").mapInArrow(records, RECORDS)


def _row(head: dict[str, str], block: bytes, path: str, payloads: bool) -> dict:
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    digest = head["warc-payload-digest"].removeprefix("sha256:")
    response = head["warc-type"] == "response"
    if response and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"{path}: payload of {head['warc-record-id']} is damaged")
    number = lambda x: int(x.removeprefix("<urn:page:").removesuffix(">") or NULL_ID)
    page_id = number(head["warc-record-id"])
    return {"page_id": None if page_id == NULL_ID else page_id, "url": head.get("warc-target-uri"),
            "payload_bytes": size, "payload_digest": digest, "record_type": head["warc-type"],
            "refers_to": None if response else number(head["warc-refers-to"]), "archive": path,
            "payload": payload if payloads and response else None}


def roundtrip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write ``pages`` to new archives in the session's shared folder and read them back."""
    folder = scratch_path(spark, "warc")
    return read(write(pages, folder), folder)
