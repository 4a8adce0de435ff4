"""WARC archives: written, made random-access by a gzip normaliser, and read back by offset.

`write_archives` writes records as crawlers often deliver them: one gzip stream
over a whole file, in which no record can be found without inflating all before it.
`normalise` inflates such a stream once, in pieces of fixed size, cuts it into records
by their declared lengths and rewrites each as a gzip member of its own, next to an
index of offsets. `read_records` then reads members by offset alone.

Records with equal payloads of at least `least` bytes are stored once: the one with
the largest id as a response, the others as revisits that name it and carry the
digest and length of the full payload.

Files lie in the shared folder (see `files`). A task writes to a name with a random
part and returns it, and only returned names are read on, so a task that is run
again leaves an orphan and no damage. An archive holds one partition of the records, or about `archive_bytes`.

Cases. Null html is an empty payload; a null url is left out. A null id sorts below all
others and is written as an empty id. Rows that share the largest id of a payload are all
responses. An empty table writes no archive. Payloads of any length are streamed to
the member in pieces, but one record fits a worker.
"""

from __future__ import annotations

import base64
import hashlib
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import shared_dir, small_batches, stored
from .files import open_input, write_file

PIECE = 1 << 20
LINE = b"\r\n"
_INDEX = "archive string, offset long, length long"
_RECORD = "page_id long, url string, record_type string, payload_digest string, payload_bytes long, refers_to long, payload binary"


def digest32(payload: bytes) -> str:
    """SHA-1 in upper-case base32, as WARC writes it."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, kind: str, refers_to: int | None) -> bytes:
    """One WARC record. A revisit has no body; either kind names the full payload's digest and length."""
    body = payload if kind == "response" else b""
    name = lambda i: f"<urn:page:{'' if i is None else i}>"
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", name(page_id)),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Payload-Digest", f"sha1:{digest32(payload)}"),
        ("X-Payload-Length", str(len(payload))),
        ("Content-Type", "text/html; charset=utf-8"),
        ("Content-Length", str(len(body))),
    ]
    if url is not None:
        # A header is one line.
        fields.insert(2, ("WARC-Target-URI", url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")))
    if kind == "revisit":
        fields.insert(3, ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
        fields.insert(4, ("WARC-Refers-To", name(refers_to)))
    head = LINE.join(f"{k}: {v}".encode() for k, v in fields)
    return b"WARC/1.1" + LINE + head + LINE + LINE + body + LINE + LINE


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and body of one record."""
    head, _, rest = raw.partition(LINE + LINE)
    fields = dict(line.decode().split(": ", 1) for line in head.split(LINE)[1:])
    return fields, rest[: int(fields["Content-Length"])]


def cut_records(pieces):
    """Records of an inflated stream, whole, whatever the pieces it comes in."""
    held, need = bytearray(), 0
    for piece in pieces:
        held += piece
        while True:
            if not need:
                end = held.find(LINE + LINE)
                if end < 0:
                    break
                length = next(int(x.split(b":", 1)[1]) for x in bytes(held[:end]).split(LINE) if x.lower().startswith(b"content-length:"))
                need = end + 4 + length + 4
            if len(held) < need:
                break
            yield bytes(held[:need])
            del held[:need]
            need = 0
    if held:
        raise ValueError("the archive ends within a record")


def inflated(source):
    """A whole gzip file, one member or many, in pieces of bounded size."""
    stream = zlib.decompressobj(31)
    while raw := source.read(PIECE):
        while raw:
            piece = stream.decompress(raw, PIECE)
            if piece:
                yield piece
            raw = stream.unconsumed_tail
            if stream.eof:
                raw = stream.unused_data
                stream = zlib.decompressobj(31)
    if piece := stream.flush():
        yield piece


def _deflated(records, level: int):
    """One gzip stream over all records."""
    stream = zlib.compressobj(level, zlib.DEFLATED, 31)
    for raw in records:
        if piece := stream.compress(raw):
            yield piece
    yield stream.flush()


def _writer(folder: str, level: int):
    def run(batches):
        def records():
            for batch in batches:
                for row in batch.to_pylist():
                    yield record(row["page_id"], row["url"], row["payload"], row["kind"], row["refers_to"])

        rows = records()
        first = next(rows, None)
        if first is not None:
            from itertools import chain

            name = write_file(f"{folder}/whole", "part.warc.gz", _deflated(chain([first], rows), level))
            yield pa.record_batch([pa.array([name])], names=["archive"])

    return run


def _normaliser(folder: str, level: int):
    def run(batches):
        for batch in batches:
            for name in batch.column("archive"):
                places: list[tuple[int, int]] = []

                def members(source, places=places):
                    at = 0
                    for raw in cut_records(inflated(source)):
                        stream = zlib.compressobj(level, zlib.DEFLATED, 31)
                        member = stream.compress(raw) + stream.flush()
                        places.append((at, len(member)))
                        at += len(member)
                        yield member

                with open_input(name.as_py()) as source:
                    made = write_file(f"{folder}/members", "part.warc.gz", members(source))
                yield pa.record_batch(
                    [pa.array([made] * len(places)), *[pa.array([p[i] for p in places], pa.int64()) for i in (0, 1)]],
                    names=["archive", "offset", "length"],
                )

    return run


def _reader(with_payload: bool):
    number = lambda x: int(v) if (v := x.removeprefix("<urn:page:").removesuffix(">")) else None

    def run(batches):
        opened, name = None, None
        for batch in batches:
            rows = []
            for place in batch.to_pylist():
                if place["archive"] != name:
                    if opened:
                        opened.close()
                    name = place["archive"]
                    opened = open_input(name)
                opened.seek(place["offset"])
                fields, body = parse(zlib.decompress(opened.read(place["length"]), 31))
                kind = fields["WARC-Type"]
                digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                if kind == "response" and digest32(body) != digest:
                    raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
                url = fields.get("WARC-Target-URI")
                rows.append(
                    {
                        "page_id": number(fields["WARC-Record-ID"]),
                        "url": url and url.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%"),
                        "record_type": kind,
                        "payload_digest": digest,
                        "payload_bytes": len(body) if kind == "response" else int(fields["X-Payload-Length"]),
                        "refers_to": number(fields["WARC-Refers-To"]) if kind == "revisit" else None,
                        "payload": body if with_payload and kind == "response" else None,
                    }
                )
            yield pa.RecordBatch.from_pylist(
                rows,
                pa.schema(
                    [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("refers_to", pa.int64()), ("payload", pa.binary())]
                ),
            )

    return run


def as_records(pages: DataFrame, least: int = 0, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Pages with payload, kind and refers_to.

    Only digests and ids are grouped. Payloads move once at most, by digest and id, so a
    payload that many pages share is spread over all partitions.
    """
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"),
        F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(html).cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    # A null id adds nothing to the text, which no other id does.
    rows = rows.withColumn("_place", F.concat_ws(":", "digest", F.col("page_id").cast("string")))
    known = rows.select("_place", "page_id", "digest", F.octet_length("payload").alias("bytes")).distinct()
    newest = known.groupBy("digest").agg(F.max("page_id").alias("newest"))
    revisit = (F.col("bytes") >= least) & ~F.col("page_id").eqNullSafe(F.col("newest"))
    roles = known.join(newest, "digest").select(
        "_place", F.when(revisit, "revisit").otherwise("response").alias("kind"), F.when(revisit, F.col("newest")).alias("refers_to")
    )
    return rows.join(roles, "_place").select("page_id", "url", "payload", "kind", "refers_to")


def write_archives(records: DataFrame, folder: str, archive_bytes: int | None = None, level: int = 6) -> DataFrame:
    """Whole-file gzip archives; returns their names.

    A partition of `records` is an archive; with `archive_bytes`, rows are dealt anew to archives of about that.
    """
    small_batches(records.sparkSession)
    if archive_bytes:
        total = records.agg(F.sum(F.octet_length("payload"))).first()[0] or 0
        records = records.repartition(int(max(1, -(-total // archive_bytes))), F.xxhash64("page_id", "url"))
    return stored(records.mapInArrow(_writer(folder, level), "archive string"), folder, "written")


def normalise(archives: DataFrame, folder: str, level: int = 6) -> DataFrame:
    """Rewrites archives member by member; returns, and keeps as a sidecar table, the index of offsets."""
    spread = archives.repartition(max(1, archives.count()), "archive")
    return stored(spread.mapInArrow(_normaliser(folder, level), _INDEX), folder, "index")


def read_records(index: DataFrame, with_payload: bool = True, records_per_task: int = 5000) -> DataFrame:
    """Records by offset; an archive's members are read in order, a stretch of them by one task."""
    small_batches(index.sparkSession)
    parts = max(1, -(-index.count() // records_per_task), index.sparkSession.sparkContext.defaultParallelism)
    spread = index.repartitionByRange(int(parts), "archive", "offset").sortWithinPartitions("archive", "offset")
    return spread.mapInArrow(_reader(with_payload), _RECORD)


def round_trip(pages: DataFrame, least: int = 0, **columns: str) -> DataFrame:
    """Pages to archives, normalised, and read back."""
    folder = shared_dir(pages.sparkSession)
    archives = write_archives(as_records(pages, least, **columns), folder)
    return read_records(normalise(archives, folder), with_payload=False)
