"""WARC archives: writing, and normalising of whole-file gzip streams.

``write_stream_archives`` writes WARC 1.1 records into archives that are one
gzip stream from end to end (the form that cannot be read at an offset).
``normalise_archives`` inflates each such stream once, passes every record on
in pieces, rewrites it as a gzip member of its own and writes a sidecar index of
member offsets.  ``read_archives`` reads the members at their offsets.
No step holds more than one piece of a record.

Records with equal payloads of at least ``least`` bytes share one response
record, that with the largest id; the others are revisit records without the
payload that refer to it.

Cases: a null payload is empty; rows with a null id are always responses and
come back with a null id; rows that repeat the id of the response are responses
too; a null url has no target header, line breaks in urls are escaped; no rows
give no archives; other columns are ignored.

Index entry, one line of JSON: id, type, offset and length of the member.
"""

from __future__ import annotations

import base64
import hashlib
import json
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import attach, ship_code, utf8, written
from contrail.llm.files import attempt_name, open_in, open_out
from contrail.session import scratch_path

PIECE = 1 << 18
_DATE = "1970-01-01T00:00:00Z"  # the pages carry no fetch time
_SAME = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"


def _urn(page_id) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def _from_urn(urn: str | None):
    text = urn[len("<urn:x-page:"):-1] if urn else ""
    return int(text) if text else None


def record(page_id, url, payload: bytes | None, digest: str, size: int, refers_to) -> bytes:
    """One WARC record; the HTTP header of a revisit keeps the length of the payload it leaves out."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload or b"")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_urn(page_id)}", f"WARC-Date: {_DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    head.append("WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest)).decode())
    if refers_to is not None:
        head += [f"WARC-Refers-To: {_urn(refers_to)}", f"WARC-Profile: {_SAME}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def headers_of(raw: bytes) -> dict[str, str]:
    out = {}
    for line in raw.decode("utf-8", "surrogateescape").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        out[name.strip().lower()] = value.strip()
    return out


def inflated(f):
    """The bytes of a gzip file in bounded pieces; any number of members; a cut file is an error."""
    unzip, fresh = zlib.decompressobj(31), True
    while data := f.read(PIECE):
        while data:
            out = unzip.decompress(data, PIECE)
            fresh = False
            if out:
                yield out
            data = unzip.unconsumed_tail or unzip.unused_data
            if unzip.eof:
                unzip, fresh = zlib.decompressobj(31), True
            elif not out and not unzip.unconsumed_tail:
                break
    while not fresh:
        if out := unzip.decompress(unzip.unconsumed_tail, PIECE):
            yield out
        if unzip.eof:
            return
        if not out:
            raise OSError("gzip stream ends early")


class Stream:
    """Reads header blocks and counted bodies from pieces of bytes."""

    def __init__(self, pieces):
        self.pieces, self.held = iter(pieces), b""

    def _more(self) -> bool:
        piece = next(self.pieces, None)
        self.held += piece or b""
        return piece is not None

    def head(self) -> bytes | None:
        """Through the next blank line; None at the end of the stream."""
        while (at := self.held.find(b"\r\n\r\n")) < 0:
            if not self._more():
                if self.held.strip():
                    raise OSError("record header ends early")
                return None
        out, self.held = self.held[: at + 4], self.held[at + 4 :]
        return out

    def body(self, size: int):
        while size:
            if not self.held and not self._more():
                raise OSError("record body ends early")
            out, self.held = self.held[:size], self.held[size:]
            size -= len(out)
            if out:
                yield out


def _manifest_batch(rows: list[tuple]) -> pa.RecordBatch:
    names = ["pid", "archive", "index", "records"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.string(), pa.string(), pa.int64()))], names=names)


_MANIFEST = "pid int, archive string, index string, records long"


def _stream_writer(folder: str, level: int):
    def write(batches):
        pid, out, n, name = TaskContext.get().partitionId(), None, 0, attempt_name(folder, TaskContext.get().partitionId(), ".warc.gz")
        squeeze = zlib.compressobj(level, zlib.DEFLATED, 31)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                for r in batch.slice(at, 64).to_pylist():
                    out = out or open_out(name)
                    out.write(squeeze.compress(record(r["page_id"], r["url"], r["payload"], r["digest"], r["size"], r["refers_to"])))
                    n += 1
        if out is not None:
            out.write(squeeze.flush())
            out.close()
            yield _manifest_batch([(pid, name, None, n)])
    return write


def normalise_file(source, target, index, level: int) -> int:
    """Rewrite one gzip stream of records as one member per record; returns the number of records."""
    stream, offset, n = Stream(inflated(source)), 0, 0
    while (head := stream.head()) is not None:
        fields = headers_of(head)
        squeeze, size = zlib.compressobj(level, zlib.DEFLATED, 31), 0
        size += target.write(squeeze.compress(head))
        for piece in stream.body(int(fields["content-length"]) + 4):  # with the two line ends behind the block
            size += target.write(squeeze.compress(piece))
        size += target.write(squeeze.flush())
        index.write(json.dumps({"id": fields["warc-record-id"], "type": fields["warc-type"], "offset": offset, "length": size}).encode() + b"\n")
        offset += size
        n += 1
    return n


def _normaliser(folder: str, level: int):
    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                names = [attempt_name(folder, r["pid"], e) for e in (".warc.gz", ".idx")]
                with open_in(r["archive"]) as source, open_out(names[0]) as target, open_out(names[1]) as index:
                    n = normalise_file(source, target, index, level)
                yield _manifest_batch([(r["pid"], *names, n)])
    return run


def _members(archive: str, index: str):
    """(index entry, record headers, HTTP headers, payload pieces) of each record, read at its offset."""
    with open_in(index) as f:
        entries = [json.loads(line) for line in f.read().splitlines()]
    with open_in(archive) as f:
        for e in entries:
            f.seek(e["offset"])

            def member(left=e["length"]):
                unzip = zlib.decompressobj(31)
                while left:
                    data = f.read(min(PIECE, left))
                    left -= len(data)
                    while data:
                        yield unzip.decompress(data, PIECE)
                        data = unzip.unconsumed_tail
                yield unzip.flush()

            stream = Stream(member())
            fields = headers_of(stream.head())
            block = Stream(stream.body(int(fields["content-length"])))
            http = headers_of(block.head())

            def payload(block=block):
                if block.held:
                    yield block.held
                yield from block.pieces

            yield e, fields, http, payload()


def _reader(batches):
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                        ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string())])
    for batch in batches:
        for r in batch.to_pylist():
            rows = []
            for e, fields, http, payload in _members(r["archive"], r["index"]):
                named = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
                sha, size = hashlib.sha1(), 0
                for piece in payload:
                    sha.update(piece)
                    size += len(piece)
                if fields["warc-type"] == "response":
                    if sha.hexdigest() != named:
                        raise OSError(f"payload of {e['id']} does not match its digest")
                else:
                    size = int(http["content-length"])
                rows.append((_from_urn(fields["warc-record-id"]), size, named, fields["warc-type"], _from_urn(fields.get("warc-refers-to")), fields.get("warc-target-uri")))
                if len(rows) == 4096:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def with_revisits(pages: DataFrame, least: int = 1000) -> DataFrame:
    """page_id, url, payload (null for revisits), digest, size, refers_to."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", utf8(F.col("html")).alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload")).withColumn("size", F.octet_length("payload").cast("long"))
    rows = rows.withColumn("same", F.when((F.col("size") >= least) & F.col("page_id").isNotNull(), F.concat("digest", F.hex(F.xxhash64("payload")))))
    shared = rows.filter("same is not null").groupBy("same").agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    facts = written(shared, "payloads")
    total = facts.agg(F.sum("n")).first()[0] or 0
    joined = attach(rows, facts, "same", "n", "page_id", total)
    refers = F.when(F.col("first") != F.col("page_id"), F.col("first"))
    return joined.withColumn("refers_to", refers).select(
        "page_id", "url", F.when(F.col("refers_to").isNull(), F.col("payload")).alias("payload"), "digest", "size", "refers_to")


def write_stream_archives(records: DataFrame, folder: str | None = None, level: int = 6) -> DataFrame:
    """One whole-stream gzip archive per partition; returns the committed manifest."""
    ship_code(records.sparkSession)
    folder = folder or scratch_path(records.sparkSession, "warc-streams")
    return written(records.mapInArrow(_stream_writer(folder, level), _MANIFEST), "manifest")


def _one_each(manifest: DataFrame) -> DataFrame:
    return manifest.repartition(max(1, manifest.count()), "pid")


def normalise_archives(manifest: DataFrame, folder: str | None = None, level: int = 6) -> DataFrame:
    """Archives with one gzip member per record and their sidecar indexes; returns the committed manifest."""
    ship_code(manifest.sparkSession)
    folder = folder or scratch_path(manifest.sparkSession, "warc")
    return written(_one_each(manifest).mapInArrow(_normaliser(folder, level), _MANIFEST), "manifest")


def read_archives(manifest: DataFrame) -> DataFrame:
    """One row per record of normalised archives."""
    ship_code(manifest.sparkSession)
    return _one_each(manifest).mapInArrow(_reader, _READ)


def archive_round_trip(pages: DataFrame, least: int = 1000) -> DataFrame:
    return read_archives(normalise_archives(write_stream_archives(with_revisits(pages, least))))
