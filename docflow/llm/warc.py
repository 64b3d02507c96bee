"""WARC archives of Zstandard frames: a writer and a reader that Spark deals out by archive.

An archive starts with a skippable frame that holds its dictionary (itself a Zstandard frame, or
bare); each record is one frame with its size in the frame header. The reader finds frames by their
block headers, decodes one at a time, whether or not its header tells its size, and checks the record's
version line, headers, lengths and digests; a record that fails is reported in `error`, never dropped.
Other skippable frames are passed over. After bytes that are no frame, or a frame that is cut short or
damaged, reading goes on at the next frame; a dictionary that cannot be read is an error of its own,
and the records that do not need it are still read.

Written archives are bounded by `archive_bytes` of payload, so that a task holds one at a time. Archives
above `LARGE_BYTES` are read from their file as far as the reader has come, so that a task holds one
frame of theirs, however long they are. Archives are written below the shared folder under their final names only when complete, and a manifest written by
Spark's committed writer says which of them belong to the result: files that a lost executor left are
not read.

Defined cases: a null payload is empty; payloads are equal if their SHA-1 and length are; among equal
ones the least page_id is the response and the others revisit it, also if a page_id repeats (rows
that repeat the least id are responses too); a null page_id is only the response if all are null, and
then each is; an empty table has no archives and no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.llm.common import settle, shared_dir, spread_left_join

# Fixed values of the formats.
DICTIONARY_FRAME = 0x184D2A5D
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
ZSTD_FRAME = 0xFD2FB528

RECORD = "page_id long, url string, record_type string, refers_to long, payload binary, payload_bytes long, payload_digest string, record_id string, archive string, error string"
#: A record's bytes at most: what an Arrow value and a Spark row hold. A larger one is reported.
MOST_BYTES = (1 << 31) - 1
#: Larger archives are read from their file piece by piece.
LARGE_BYTES = 128 << 20


class WarcError(ValueError):
    """An archive or record that breaks the format."""


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def train_dictionary(samples: list[bytes], size: int = 16_384) -> bytes:
    """A dictionary from sample records, or nothing if they are too few or too small to train one."""
    if len(samples) < 8 or sum(map(len, samples)) < 8 * size:
        return b""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def dictionary_frame(dictionary: bytes) -> bytes:
    packed = zstandard.ZstdCompressor().compress(dictionary)
    return DICTIONARY_FRAME.to_bytes(4, "little") + len(packed).to_bytes(4, "little") + packed


def frame_end(data: memoryview, at: int) -> int:
    """Where the Zstandard frame that starts at `at` ends."""
    if int.from_bytes(data[at : at + 4], "little") != ZSTD_FRAME:
        raise WarcError(f"no frame at byte {at}")
    flags = data[at + 4]
    single = flags >> 5 & 1
    at += 5 + (1 - single) + (0, 1, 2, 4)[flags & 3] + ((1 if single else 0), 2, 4, 8)[flags >> 6]
    while True:
        head = int.from_bytes(data[at : at + 3], "little")
        if at + 3 > len(data):
            raise WarcError("a frame is cut short")
        at += 3 + (1 if head >> 1 & 3 == 1 else head >> 3)
        if head & 1:
            break
    at += 4 * (flags >> 2 & 1)
    if at > len(data):
        raise WarcError("a frame is cut short")
    return at


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """One WARC record; a revisit carries the payload's digest and length but not the payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    uri = quote(url or "", safe="!#$%&'()*+,/:;=?@[]~") or "about:blank"
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
        ("WARC-Date", date),
        ("WARC-Target-URI", uri),
        ("WARC-Payload-Digest", f"sha1:{digest32(payload)}"),
        ("WARC-Block-Digest", f"sha1:{digest32(block)}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if revisit:
        fields.insert(4, ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
        fields.insert(5, ("WARC-Refers-To", f"<urn:page:{refers_to}>"))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """The fields of one record; raises WarcError where headers or lengths are wrong."""
    head, sep, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "strict").split("\r\n")
    if not sep or not re.fullmatch(r"WARC/1\.[01]", lines[0]):
        raise WarcError("no WARC version line")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not re.fullmatch(r"[!-9;-~]+", name):
            raise WarcError("a header line without a name")
        fields[name.lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in fields:
            raise WarcError(f"no {name}")
    if not fields["content-length"].isdigit():
        raise WarcError("content-length is no number")
    length = int(fields["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise WarcError("content-length does not fit the record")
    block, kind = rest[:length], fields["warc-type"]
    if not _fits(fields.get("warc-block-digest"), block):
        raise WarcError("the block digest does not fit")
    payload, told = block, None
    if fields.get("content-type", "").replace(" ", "").lower().startswith("application/http"):
        http, sep, payload = block.partition(b"\r\n\r\n")
        if not sep:
            raise WarcError("no HTTP header block")
        # Of a body that is coded for transfer the header tells nothing about what is stored.
        if not re.search(rb"\r\ntransfer-encoding:", http, re.I):
            told = re.search(rb"\r\ncontent-length: *(\d+)", http, re.I)
    n = int(told[1]) if told else len(payload)
    label = fields.get("warc-payload-digest")
    if kind == "revisit":
        if payload:
            raise WarcError("a revisit with a payload")
    elif (len(payload) != n and "warc-truncated" not in fields) or not _fits(label, payload):
        raise WarcError("the payload does not fit its length and digest")
    page = re.fullmatch(r"<urn:page:(-?\d*)>", fields["warc-record-id"])
    origin = re.fullmatch(r"<urn:page:(-?\d+)>", fields.get("warc-refers-to", ""))
    return {
        "page_id": int(page[1]) if page and page[1] else None,
        "url": fields.get("warc-target-uri"),
        "record_type": kind,
        "refers_to": int(origin[1]) if origin else None,
        "payload": None if kind == "revisit" else payload,
        "payload_bytes": n,
        "payload_digest": label.removeprefix("sha1:") if label else digest32(payload),
        "record_id": fields["warc-record-id"],
    }


def _fits(label: str | None, data: bytes) -> bool:
    """Whether a labelled digest is that of the data; other digests than SHA-1 are not checked."""
    return not label or not label.startswith("sha1:") or label == f"sha1:{digest32(data)}"


def _dictionary(raw: bytes) -> zstandard.ZstdCompressionDict:
    if raw[:4] == ZSTD_FRAME.to_bytes(4, "little"):
        raw = zstandard.ZstdDecompressor().decompressobj().decompress(raw)
    return zstandard.ZstdCompressionDict(raw)


def _unpacked(reader: zstandard.ZstdDecompressor, frame: memoryview, most: int) -> bytes:
    """A frame's content, decoded piece by piece so that no more than `most` bytes are ever held."""
    pieces, size = [], 0
    with reader.stream_reader(frame) as out:
        while piece := out.read(1 << 20):
            pieces.append(piece)
            size += len(piece)
            if size > most:
                raise WarcError(f"a record of more than {most} bytes")
    return b"".join(pieces)


class Pieces:
    """The bytes of an open file, read as they are asked for; what was read last is kept."""

    def __init__(self, file: pa.NativeFile, ahead: int = 1 << 20):
        self.file, self.ahead, self.size = file, ahead, file.size()
        self.at, self.data = 0, b""

    def __len__(self) -> int:
        return self.size

    def __getitem__(self, key: int | slice) -> int | memoryview:
        if isinstance(key, int):
            if key >= self.size:
                raise IndexError(key)
            return self[key : key + 1][0]
        lo, hi, _ = key.indices(self.size)
        if lo < self.at or hi > self.at + len(self.data):
            self.file.seek(lo)
            self.at, self.data = lo, self.file.read(max(hi - lo, self.ahead))
        return memoryview(self.data)[lo - self.at : max(lo, hi) - self.at]


def _next_frame(data: memoryview | Pieces, at: int, step: int = 1 << 20) -> int:
    """Where the next bytes stand that may begin a frame."""
    while at < len(data):
        found = bytes(data[at : at + step]).find(ZSTD_FRAME.to_bytes(4, "little"))
        if found >= 0:
            return at + found
        # The next piece begins with the last three bytes of this one.
        at += step - 3
    return len(data)


def read_archive(data: bytes | Pieces, most: int = MOST_BYTES) -> Iterator[dict]:
    """The records of one archive; whatever cannot be read is a row with `error`, and what follows is read."""
    view, at = data if isinstance(data, Pieces) else memoryview(data), 0
    reader = zstandard.ZstdDecompressor()
    while at < len(view):
        magic = int.from_bytes(view[at : at + 4], "little")
        if magic in SKIPPABLE:
            size = int.from_bytes(view[at + 4 : at + 8], "little")
            end = at + 8 + size
            if end > len(view):
                yield {"error": f"the skippable frame at byte {at} is cut short"}
                at = _next_frame(view, at + 4)
                continue
            if magic == DICTIONARY_FRAME and not at:
                try:
                    reader = zstandard.ZstdDecompressor(dict_data=_dictionary(bytes(view[8:end])))
                except zstandard.ZstdError as e:
                    yield {"error": f"the dictionary cannot be read: {e}"}
            at = end
            continue
        try:
            end = frame_end(view, at)
            if end - at > most + most // 128 + 1024:
                raise WarcError(f"a record of more than {most} bytes")
        except (WarcError, IndexError) as e:
            yield {"error": str(e)}
            at = _next_frame(view, at + 1)
            continue
        try:
            yield parse_record(_unpacked(reader, view[at:end], most)) | {"error": None}
        except zstandard.ZstdError as e:
            # The damage may lie in a length, so that other frames follow within this one's bounds.
            yield {"error": str(e)}
            end = _next_frame(view, at + 1)
        except (WarcError, UnicodeDecodeError) as e:
            yield {"error": str(e)}
        at = end


def with_revisits(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, refers_to and revisit: the least page_id of equal payloads responds.

    Groups are counted before they are joined, and only repeated payloads are joined: a payload on very
    many pages meets its response where its pages are, and the rest are shuffled by digest.
    """
    narrow = pages.select("page_id", F.coalesce(F.encode("html", "UTF-8"), F.lit(b"")).alias("p"))
    narrow = narrow.select("page_id", F.sha1("p").alias("digest"), F.length("p").alias("size"))
    groups = narrow.groupBy("digest", "size").agg(F.min("page_id").alias("origin"), F.count("*").alias("n")).where("n > 1")
    rows = pages.select("page_id", "url", F.coalesce(F.encode("html", "UTF-8"), F.lit(b"")).alias("payload"))
    keyed = rows.withColumn("digest", F.sha1("payload")).withColumn("size", F.length("payload"))
    joined = spread_left_join(keyed, settle(groups, "payloads"), ["digest", "size"], pages.count())
    revisit = F.coalesce(F.col("origin").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("origin")), F.lit(False))
    return joined.select("page_id", "url", "payload", F.when(revisit, F.col("origin")).alias("refers_to"), revisit.alias("revisit"))


def write_warc(pages: DataFrame, path: str, archive_bytes: int = 32 << 20, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Writes the archives of pages(page_id, url, html) below path; returns the manifest (archive, records)."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pafs.FileSystem.from_uri(path)
        store.create_dir(root, recursive=True)
        part, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
        held: list[bytes] = []
        size = count = 0

        def flush() -> pa.RecordBatch:
            nonlocal held, size, count
            dictionary = train_dictionary(held[:: max(1, len(held) // 200)][:200])
            packer = zstandard.ZstdCompressor(level=3, write_content_size=True, write_checksum=True, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
            name = f"part-{part:06d}-{attempt}-{count:05d}.warc.zst"
            with store.open_output_stream(f"{root}/{name}.writing") as out:
                if dictionary:
                    out.write(dictionary_frame(dictionary))
                for record in held:
                    out.write(packer.compress(record))
            store.move(f"{root}/{name}.writing", f"{root}/{name}")
            told = pa.RecordBatch.from_pydict({"archive": pa.array([name]), "records": pa.array([len(held)], pa.int64())})
            held, size, count = [], 0, count + 1
            return told

        for batch in batches:
            for row in batch.to_pylist():
                held.append(record_bytes(row["page_id"], row["url"], row["payload"], row["refers_to"], row["revisit"], date))
                size += len(held[-1])
                if size >= archive_bytes:
                    yield flush()
        if held:
            yield flush()

    return settle(with_revisits(pages).mapInArrow(write, "archive string, records long"), "manifest")


def read_warc(spark: SparkSession, path: str, manifest: DataFrame | None = None, large: int = LARGE_BYTES) -> DataFrame:
    """The records of the archives below path, or of those that the manifest names.

    Spark reads archives of up to `large` bytes; tasks open larger ones by Arrow's file systems.
    """
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_id", pa.string()), ("archive", pa.string()), ("error", pa.string())])

    def told(name: str, data: bytes | Pieces) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for row in read_archive(data):
            rows.append(row | {"archive": name})
            size += len(row.get("payload") or b"")
            if size >= 8 << 20 or len(rows) >= 10_000:
                yield pa.RecordBatch.from_pylist(rows, schema)
                rows, size = [], 0
        yield pa.RecordBatch.from_pylist(rows, schema)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("archive"), batch.column("content"), strict=True):
                yield from told(name.as_py(), content.as_py())

    def piecewise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                # Spark names local files with one slash where Arrow wants three.
                store, at = pafs.FileSystem.from_uri(re.sub("^file:/(?!/)", "file:///", row["path"]))
                with store.open_input_file(at) as file:
                    yield from told(row["archive"], Pieces(file))

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(path)
    files = files.withColumn("archive", F.element_at(F.split("path", "/"), -1))
    if manifest is not None:
        files = files.join(manifest.select("archive"), "archive", "left_semi")
    small = files.where(F.col("length") <= large).select("archive", "content").mapInArrow(whole, RECORD)
    # Only names and lengths of these leave the scan; a row each.
    return small.unionByName(files.where(F.col("length") > large).select("archive", "path").mapInArrow(piecewise, RECORD))


def round_trip(pages: DataFrame, archive_bytes: int = 32 << 20) -> DataFrame:
    """Writes pages as archives in the shared folder and returns their records, read back."""
    spark = pages.sparkSession
    path = shared_dir(spark, "warc")
    manifest = write_warc(pages, path, archive_bytes)
    if manifest.isEmpty():
        return spark.createDataFrame([], RECORD)
    return read_warc(spark, path, manifest)
