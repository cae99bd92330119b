"""WARC archives with Zstandard dictionaries, written and read by Spark.

Each archive starts with a skippable frame that holds its dictionary, trained
from records of the same archive; every record is a frame of its own, so one
record can be read without the others. Pages whose payload occurred under a
smaller id become revisit records.

Archives are written by Spark's own file writer, so that they land on whatever
file system the path names and only finished tasks leave files: a row of the text
writer is a frame, and the line separator is an empty skippable frame, which
readers pass over.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from triplake.llm.common import python_ready, stored

#: Records of an archive at most, and bytes of them from which it is closed; a task
#: writes as many archives as it needs and holds one of them.
ARCHIVE_RECORDS = 4000
ARCHIVE_BYTES = 64 * 1024 * 1024
#: Bytes of a dictionary, and of the records it is trained from.
DICTIONARY_BYTES = 32 * 1024
TRAINING_BYTES = 4 * 1024 * 1024
#: Records without which no dictionary is trained.
LEAST_SAMPLES = 8
LEVEL = 3
#: Bytes that go back to Spark in one batch about.
OUT_BYTES = 8 * 1024 * 1024

# Fixed values of the formats.
_DICTIONARY_MAGIC = 0x184D2A5D
_SKIPPABLE = range(0x184D2A50, 0x184D2A60)
_NO_RECORD = struct.pack("<II", 0x184D2A50, 0)
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_WRITTEN = "2024-01-01T00:00:00Z"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page_id: int | None, url: str | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {url}')}>"


def _clean(value: str) -> str:
    """A header value stays on its line."""
    return value.replace("\r", "%0D").replace("\n", "%0A")


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record; a revisit keeps the HTTP header, not the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_record_id(page_id, url)}",
        f"WARC-Date: {_WRITTEN}",
        f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {_clean(url)}")
    if page_id is not None:
        head.append(f"Page-ID: {page_id}")
    if refers_to is not None:
        head += [f"WARC-Profile: {_PROFILE}", f"Refers-To-Page-ID: {refers_to}"]
    return "\r\n".join([*head, "", ""]).encode() + block + b"\r\n\r\n"


def train(records: list[bytes]) -> bytes:
    """A dictionary of these records; too few give their own bytes, or none."""
    samples, size = [], 0
    for r in records:
        # The trainer divides by the number of 8-byte words in part of its samples.
        if len(r) >= 8:
            samples.append(r)
            size += len(r)
        if size >= TRAINING_BYTES:
            break
    if len(samples) >= LEAST_SAMPLES:
        try:
            return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
        except zstandard.ZstdError:
            pass  # nothing in common
    # Bytes that are no trained dictionary serve as plain content.
    return b"".join(samples)[-DICTIONARY_BYTES:] if size >= 64 else b""


def archive_frames(records: list[bytes]) -> Iterator[bytes]:
    """The leading frame with the dictionary, then a frame for each record."""
    dictionary = train(records)
    yield struct.pack("<II", _DICTIONARY_MAGIC, len(dictionary)) + dictionary
    known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    compressor = zstandard.ZstdCompressor(
        level=LEVEL, dict_data=known, write_content_size=True, write_checksum=True
    )
    for r in records:
        yield compressor.compress(r)


def archive_records(data: bytes) -> Iterator[bytes]:
    """The records of an archive, one at a time."""
    at, known = 0, None
    while at < len(data):
        magic, size = struct.unpack_from("<II", data, at) if len(data) - at >= 8 else (0, 0)
        if magic in _SKIPPABLE:
            if magic == _DICTIONARY_MAGIC and at == 0 and size:
                known = zstandard.ZstdCompressionDict(data[8 : 8 + size])
            at += 8 + size
            continue
        frame = zstandard.ZstdDecompressor(dict_data=known).decompressobj()
        out = []
        while not frame.eof:
            piece = data[at : at + 8192]
            if not piece:
                raise ValueError("archive ends within a record")
            out.append(frame.decompress(piece))
            at += len(piece)
        at -= len(frame.unused_data)
        yield b"".join(out)


def parse(data: bytes) -> dict:
    """Header fields by lower-case name, the HTTP header and the payload."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    fields = {k.lower(): v for k, v in fields.items()}
    http, _, payload = rest[: int(fields["content-length"])].partition(b"\r\n\r\n")
    return {**fields, "http": http.decode(), "payload": payload}


def with_first(pages: DataFrame) -> DataFrame:
    """id, url, payload and the page that a revisit refers to.

    Of equal payloads, that with the smallest id is the response. NULL ids are
    the largest; rows alike in id and payload are responses both.
    """
    keyed = pages.withColumn("sha", F.sha1("payload"))
    firsts = stored(
        keyed.groupBy("sha").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("times"))
        .filter("times > 1").select("sha", "first"),
        "first-payloads",
    )
    later = F.col("page_id").isNull() | (F.col("page_id") > F.col("first"))
    return keyed.join(firsts, "sha", "left").select(
        "page_id", "url", "payload", F.when(later, F.col("first")).alias("refers_to")
    )


def write_archives(
    df: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    archive_records_: int = ARCHIVE_RECORDS,
    archive_bytes: int = ARCHIVE_BYTES,
) -> None:
    """Write one record for each page; NULL html is an empty payload.

    An archive has at most so many records, and is closed with the record that
    brings it to so many bytes; a page of any size is one record. Other columns
    are not archived. An empty table leaves no records. A dictionary is trained on
    the first records of its archive (``TRAINING_BYTES``); all are compressed.
    """
    python_ready(df.sparkSession)
    pages = df.select(
        F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").alias("url"),
        F.coalesce(F.col(f"`{html_col}`"), F.lit("")).cast("binary").alias("payload"),
    )

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[bytes] = []
        size = 0

        def archive() -> Iterator[pa.RecordBatch]:
            # The writer starts a file after so many rows, so an archive that was
            # closed by its bytes is filled up with empty ones.
            rows, held = [], 0
            for frame in [*archive_frames(waiting), *[b""] * (archive_records_ - len(waiting))]:
                rows.append(frame)
                held += len(frame)
                if len(rows) == 256 or held > OUT_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["frame"])
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["frame"])
            waiting.clear()

        for batch in batches:
            for i in range(batch.num_rows):
                waiting.append(record(*(c[i].as_py() for c in batch.columns)))
                size += len(waiting[-1])
                if len(waiting) == archive_records_ or size >= archive_bytes:
                    yield from archive()
                    size = 0
        if waiting:
            yield from archive()

    rows = with_first(pages).mapInArrow(frames, "frame binary")
    (
        rows.select(F.col("frame").cast("string").alias("value"))
        .write.option("lineSep", _NO_RECORD.decode("ascii"))
        .option("maxRecordsPerFile", archive_records_ + 1)
        .text(path)
    )


_RECORD = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("refers_to", T.LongType()),
        T.StructField("payload", T.BinaryType()),
    ]
)


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """The records of all archives under a path.

    The digest of a response is taken from its payload and must be the one in its
    header; a revisit has the digest and length of the payload it refers to, and
    no payload of its own.
    """
    python_ready(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows, held = [], 0
                for data in archive_records(batch.column(0)[i].as_py()):
                    rows.append(_row(parse(data), with_payload))
                    held += len(data)
                    if len(rows) == 256 or held > OUT_BYTES:
                        yield _as_batch(rows)
                        rows, held = [], 0
                if rows:
                    yield _as_batch(rows)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, _RECORD)


def _row(found: dict, with_payload: bool) -> tuple:
    kind, named = found["warc-type"], found["warc-payload-digest"].removeprefix("sha1:")
    length = int(found["http"].rpartition("Content-Length: ")[2])
    if kind == "response":
        digest = payload_digest(found["payload"])
        if digest != named or length != len(found["payload"]):
            raise ValueError(f"payload of {found['warc-record-id']} is damaged")
    page, refers = found.get("page-id"), found.get("refers-to-page-id")
    return (
        None if page is None else int(page), found.get("warc-target-uri"), length, named, kind,
        None if refers is None else int(refers),
        found["payload"] if with_payload and kind == "response" else None,
    )


def _as_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], _RECORD.names
    )
