"""Dictionary-compressed WARC archives: write, deduplicate by payload, read back.

Writing.  Every row becomes one WARC/1.1 record, a ``response`` with an HTTP head and the page as payload.  Of the records
with equal payloads of at least ``min_bytes``, the one with the largest ``page_id`` stays a response and the others become
``revisit`` records of the identical-payload profile: HTTP head only, with a reference to the response.  A task writes its
records, in order of their number, to archives of about ``archive_bytes`` of plain records.  For each archive a Zstandard
dictionary is built from all of its records and written first, compressed, in a skippable frame (magic ``5D 2A 4D 18``);
after it each record is a frame of its own, compressed with that dictionary.  An archive of records too few or too small
for a dictionary has none, and its frames need none.

Archives are files in a folder shared by the executors (a local, HDFS or object-store URI that Arrow's file systems
know).  A file is written under the attempt's own name and then moved, its contents follow from the stored records alone, and
only archives listed in the returned table count: a lost executor or a second attempt changes nothing.

Reading streams a file frame by frame: a task holds one record at a time.  Payload digests are recomputed from what was
read; for revisits they come from the record's fields, as WARC has it.

Defined cases.  Null html is an empty payload; null url gives no target field; null ``page_id`` is less than any other.  Rows
that repeat are records of their own: of rows with one ``page_id`` and payload, one (the last by the order of writing) is
the response.  An empty table gives no archive and no record.  Other columns of the input are not read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ranklight.llm.common import byte_slices, shuffle_partitions, tidied
from ranklight.session import checkpoint_dir
from ranklight.sources.scratch import materialize

MIN_BYTES = 1000
ARCHIVE_BYTES = 16 << 20
DICT_BYTES = 112 << 10
LEVEL = 6
DATE = "2000-01-01T00:00:00Z"  # pages carry no time of capture
# fixed values of the formats
SKIPPABLE, FRAME = b"\x5d\x2a\x4d\x18", b"\x28\xb5\x2f\xfd"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LISTED = "path string, records long, plain_bytes long, stored_bytes long, dictionary_bytes long"
READ = ("page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary")


def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    head = [f"{k}: {v}" for k, v in fields if v is not None] + [f"Content-Length: {len(block)}"]
    return ("WARC/1.1\r\n" + "\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def _record_id(number: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'record {number}')}>"


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def page_record(number: int, page_id: int | None, url: str | None, payload: bytes, first: tuple | None, date: str = DATE) -> bytes:
    """The record of one page; ``first`` is ``(number, page_id)`` of the response it repeats, or None."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head + (payload if first is None else b"")
    target = None if url is None else quote(url, safe="".join(chr(c) for c in range(0x21, 0x7F)))
    fields = [("WARC-Type", "response" if first is None else "revisit"), ("WARC-Record-ID", _record_id(number)), ("WARC-Date", date),
              ("WARC-Target-URI", target), ("WARC-Payload-Digest", _sha1(payload)), ("WARC-Block-Digest", _sha1(block)),
              ("Content-Type", "application/http;msgtype=response"), ("X-Page-ID", page_id)]
    if first is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _record_id(first[0])), ("X-Refers-To-Page-ID", first[1])]
    return _record(fields, block)


def build_dictionary(records: list[bytes], size: int = DICT_BYTES) -> zstandard.ZstdCompressionDict | None:
    """A dictionary from all the records, or None where they are too few or too small for one."""
    if len(records) < 8 or sum(map(len, records)) < 8 * size:
        return None
    try:
        return zstandard.train_dictionary(size, records, k=256, d=8, f=18, accel=5)
    except zstandard.ZstdError:  # e.g. nothing in them repeats
        return None


def archive_bytes_of(records: list[bytes], level: int = LEVEL) -> tuple[bytes, int]:
    """An archive of the records, each a frame, after the frame with their dictionary; and the dictionary's size."""
    known = build_dictionary(records)
    own = zstandard.ZstdCompressor(level=level, dict_data=known, write_checksum=True)
    out = []
    if known is not None:
        packed = zstandard.ZstdCompressor(level=19).compress(known.as_bytes())
        out += [SKIPPABLE, len(packed).to_bytes(4, "little"), packed]
    out += [own.compress(r) for r in records]
    return b"".join(out), 0 if known is None else len(known.as_bytes())


class _Source:
    """Reads exactly as many bytes of a stream as asked for."""

    def __init__(self, stream):
        self.stream = stream

    def take(self, n: int, may_end: bool = False) -> bytes:
        parts, left = [], n
        while left and (got := self.stream.read(left)):
            parts.append(got)
            left -= len(got)
        if left and not (may_end and left == n):
            raise ValueError("archive ends inside a frame")
        return b"".join(parts)


def _frame(source: _Source) -> bytes:
    """The rest of a Zstandard frame whose magic number is read already, block by block."""
    out = [FRAME, flags := source.take(1)]
    f = flags[0]
    single, checksum = f >> 5 & 1, f >> 2 & 1
    out.append(source.take((1 - single) + (0, 1, 2, 4)[f & 3] + ((1 if single else 0), 2, 4, 8)[f >> 6]))
    last = False
    while not last:
        out.append(head := source.take(3))
        n = int.from_bytes(head, "little")
        last = bool(n & 1)
        out.append(source.take(1 if n >> 1 & 3 == 1 else n >> 3))
    out.append(source.take(4 * checksum))
    return b"".join(out)


def records_of(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Fields and block of each record of an archive, one frame at a time."""
    source, known = _Source(stream), None
    while magic := source.take(4, may_end=True):
        if magic == SKIPPABLE:
            packed = source.take(int.from_bytes(source.take(4), "little"))
            plain = zstandard.ZstdDecompressor().decompress(packed) if packed[:4] == FRAME else packed
            known = zstandard.ZstdCompressionDict(plain)
            continue
        if magic != FRAME:
            raise ValueError(f"no Zstandard frame: {magic.hex()}")
        plain = zstandard.ZstdDecompressor(dict_data=known).decompressobj().decompress(_frame(source))
        head, _, rest = plain.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError(f"no WARC record: {lines[0]!r}")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        n = int(fields["Content-Length"])
        if len(rest) != n + 4 or _sha1(rest[:n]) != fields.get("WARC-Block-Digest", _sha1(rest[:n])):
            raise ValueError(f"record {fields.get('WARC-Record-ID')} is damaged")
        yield fields, rest[:n]


def _write(folder: str, size: int, level: int):
    schema = pa.schema([("path", pa.string()), ("records", pa.int64()), ("plain_bytes", pa.int64()), ("stored_bytes", pa.int64()),
                        ("dictionary_bytes", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        task, files = TaskContext.get(), 0
        held: list[bytes] = []
        plain = 0

        def put() -> pa.RecordBatch:
            data, known = archive_bytes_of([info(), *held], level)
            name = f"{root}/pages-{task.partitionId():06d}-{files:05d}.warc.zst"
            own = f"{root}/.attempt-{task.taskAttemptId()}-{files}"
            with store.open_output_stream(own, compression=None) as sink:
                sink.write(data)
            if store.get_file_info(name).type != fs.FileType.NotFound:
                store.delete_file(name)  # of an earlier attempt, with the same contents; not every store replaces on a move
            store.move(own, name)
            return pa.RecordBatch.from_arrays([pa.array([x], t.type) for x, t in zip(
                [f"pages-{task.partitionId():06d}-{files:05d}.warc.zst", len(held), plain, len(data), known], schema)], schema=schema)

        def info() -> bytes:
            block = b"software: ranklight\r\nformat: WARC File Format 1.1\r\n"
            return _record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", _record_id(-1 - files)), ("WARC-Date", DATE),
                            ("Content-Type", "application/warc-fields")], block)

        for b in byte_slices(batches, 2):
            for page, url, html, number, first, first_page in zip(*(c.to_pylist() for c in b.columns)):
                held.append(page_record(number, page, url, html or b"", None if first is None else (first, first_page)))
                plain += len(held[-1])
                if plain >= size:
                    yield put()
                    held, plain, files = [], 0, files + 1
        if held:
            yield put()

    return tidied(run)


def write(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
          min_bytes: int = MIN_BYTES, archive_bytes: int = ARCHIVE_BYTES, level: int = LEVEL) -> DataFrame:
    """Writes the archives into ``folder`` and returns what was written: ``path, records, plain_bytes, stored_bytes,
    dictionary_bytes`` for each archive."""
    own = pages.select(pages[f"`{id_col}`"].cast("long").alias("page_id"), pages[f"`{url_col}`"].cast("string").alias("url"),
                       F.encode(pages[f"`{html_col}`"].cast("string"), "UTF-8").alias("html"))
    own = own.select("*", F.sha1("html").alias("digest"), F.monotonically_increasing_id().alias("number"))
    own = materialize(own, "warc-records")  # from here on a record's number is fixed
    large = own.filter(F.octet_length("html") >= min_bytes)
    firsts = large.groupBy(F.col("digest").alias("d")).agg(
        F.count("*").alias("k"), F.max(F.struct("page_id", "number")).alias("first"))
    firsts = firsts.filter("k > 1").select("d", F.col("first.number").alias("first"), F.col("first.page_id").alias("first_page"))
    firsts = materialize(firsts, "warc-firsts")  # its size is known before the join: pages are shuffled only if it is large
    typed = own.join(firsts, (F.col("digest") == F.col("d")) & (F.octet_length("html") >= min_bytes), "left")
    repeats = F.col("number") != F.col("first")
    typed = typed.select("page_id", "url", "html", "number", F.when(repeats, F.col("first")).alias("first"),
                         F.when(repeats, F.col("first_page")).alias("first_page"))
    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    listed = typed.sortWithinPartitions("number").mapInArrow(_write(folder, archive_bytes, level), LISTED)
    return materialize(listed, "warc-archives")


def _read(folder: str, with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)

        def whole(fields: dict, block: bytes) -> list:
            head, _, payload = block.partition(b"\r\n\r\n")
            known = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
            kind = fields["WARC-Type"]
            if kind == "response":
                if (digest := hashlib.sha1(payload).hexdigest()) != known:
                    raise ValueError(f"payload of {fields['WARC-Record-ID']} is damaged")
                size = len(payload)
            else:
                digest = known
                size = next(int(x[15:]) for x in head.decode().split("\r\n") if x.lower().startswith("content-length:"))
            page, of = fields.get("X-Page-ID"), fields.get("X-Refers-To-Page-ID")
            return [None if page is None else int(page), fields.get("WARC-Target-URI"), kind, size, digest,
                    None if of is None else int(of), payload if with_payload and kind == "response" else None]

        for b in batches:
            for path in b.column(0).to_pylist():
                rows, held = [], 0
                with store.open_input_stream(f"{root}/{path}", compression=None, buffer_size=1 << 20) as stream:
                    for fields, block in records_of(stream):
                        if fields["WARC-Type"] not in ("response", "revisit"):
                            continue
                        rows.append(whole(fields, block))
                        held += len(block) if with_payload else 200
                        if held > 8 << 20:
                            yield _rows(rows)
                            rows, held = [], 0
                if rows:
                    yield _rows(rows)

    return tidied(run)


def _rows(rows: list[list]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], [f.split()[0] for f in READ.split(", ")])


def read(archives: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """The page records of the archives listed in ``archives`` (column ``path``): ``page_id, url, record_type,
    payload_bytes, payload_digest, refers_to, payload``.  Size and digest are those of the full payload; a revisit has no
    payload of its own."""
    spread = archives.select("path").repartition(shuffle_partitions(archives.sparkSession), "path")
    return spread.mapInArrow(_read(folder, with_payload), READ)


def archive_and_read(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Writes archives of ``pages`` into ``folder`` (a new one in the shared checkpoint folder if None) and returns
    what reading them gives, one row for each page."""
    folder = folder or f"{checkpoint_dir(pages.sparkSession).rstrip('/')}/ranklight/warc-{uuid.uuid4().hex}"
    return read(write(pages, folder), folder, with_payload=False).drop("payload")


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha1(html) AS payload_digest FROM p),
m AS (SELECT payload_digest, max(page_id) AS first FROM d GROUP BY payload_digest)
SELECT d.page_id, CAST(d.payload_bytes AS BIGINT) AS payload_bytes, d.payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> first THEN first END AS refers_to
FROM d JOIN m USING (payload_digest)
"""
