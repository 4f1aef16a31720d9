"""WARC archives: a writer and a sequential reader.

Records are one gzip member each. The reader inflates a file in small steps, frames each block by its content length, and checks digests as the block goes by; only the payload of the
record at hand is ever held, and only if it is asked for. The archives are ordinary ``.warc.gz`` files in the shared folder; a manifest row names each one that a finished task wrote, with its
records and bytes, so what a failed or repeated task left behind is never read, and an archive that lost a part is an error. Archives of other tools can be read, too.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnlake.llm.common import shared_dir, stage

#: Payloads below this size are never revisited.
MIN_REVISIT_BYTES = 100
ARCHIVE_BYTES = 16 << 20
#: Compressed bytes read, and inflated bytes held, at once; longest header of a record.
_STEP, _HEAD = 1 << 18, 1 << 20
_DATE = "2000-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "archive string, records long, bytes long"
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary, verified boolean"


class WarcError(ValueError):
    """An archive that breaks the format or a digest."""


def _uri(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page(uri: str | None) -> int | None:
    number = (uri or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number.removeprefix("-").isdigit() and uri.startswith("<urn:page:") else None


def _target(url: str | None) -> str | None:
    """The URL in one header line: controls and blanks are percent-encoded, all else stays, in UTF-8."""
    return None if url is None else "".join(f"%{ord(c):02X}" if c <= " " or c == "\x7f" else c for c in url)


def encode_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record as one gzip member. A revisit has the HTTP header alone; its payload's size and digest stay in the header."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", _uri(page_id)), ("WARC-Date", _DATE)]
    if (target := _target(url)) is not None:
        fields.append(("WARC-Target-URI", target))
    if refers_to is not None:
        fields += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", _uri(refers_to))]
    fields += [
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Block-Digest", f"sha1:{hashlib.sha1(block).hexdigest()}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    packer = zlib.compressobj(3, zlib.DEFLATED, 31)
    return packer.compress(head.encode() + block + b"\r\n\r\n") + packer.flush()


class _Members:
    """The gzip members of a stream, one after another, inflated step by step."""

    def __init__(self, stream):
        self.stream, self.raw = stream, b""
        self.inflater, self.ready = None, b""

    def next(self) -> bool:
        """Go to the next member; False at the end of the file."""
        if not self.raw:
            self._fill()
        if not self.raw:
            return False
        self.inflater, self.ready = zlib.decompressobj(31), b""
        return True

    def _fill(self) -> None:
        self.raw = bytes(self.stream.read(_STEP))

    def _more(self) -> bool:
        """Inflate _STEP bytes more, at most; False at the member's end. A file that ends before its member does is an error."""
        while not self.inflater.eof:
            if not self.raw:
                self._fill()
                if not self.raw:
                    raise WarcError("the archive ends inside a record")
            try:
                found = self.inflater.decompress(self.raw, _STEP)
            except zlib.error as error:
                raise WarcError(f"bad gzip data: {error}") from error
            self.raw = self.inflater.unused_data if self.inflater.eof else self.inflater.unconsumed_tail
            if found:
                self.ready += found
                return True
        return False

    def until(self, mark: bytes, limit: int) -> bytes | None:
        """What stands before ``mark``, which is passed; None if it doesn't come within ``limit`` bytes or the member."""
        while (at := self.ready.find(mark)) < 0:
            if len(self.ready) > limit or not self._more():
                return None
        out, self.ready = self.ready[:at], self.ready[at + len(mark) :]
        return out

    def pieces(self, size: int) -> Iterator[bytes]:
        """The next ``size`` bytes, in pieces."""
        while size:
            if not self.ready and not self._more():
                raise WarcError("the block is shorter than its content length")
            piece, self.ready = self.ready[:size], self.ready[size:]
            size -= len(piece)
            yield piece

    def rest(self) -> bytes:
        """What is left of the member, which must be little."""
        while self._more():
            if len(self.ready) > _STEP:
                break
        return self.ready


class _Digest:
    """A digest as ``algorithm:value`` states it, in hex of either case or in base32. One with an unknown algorithm or none checks nothing."""

    def __init__(self, stated: str | None):
        name, _, self.value = (stated or "").strip().partition(":")
        name = name.lower().replace("-", "")
        self.known = name in ("sha1", "sha256", "sha512", "md5") and bool(self.value)
        self.sum = hashlib.new(name) if self.known else None
        self.sha256 = self.known and name == "sha256"

    def add(self, data: bytes) -> None:
        if self.known:
            self.sum.update(data)

    def matches(self) -> bool:
        if not self.known:
            return True
        digest = self.sum.digest()
        return self.value.lower() == digest.hex() or self.value.upper().rstrip("=") == base64.b32encode(digest).decode().rstrip("=")


def _fields(head: bytes) -> dict[str, str]:
    """Header fields by lower-case name; of repeated ones the first. A line that starts with white space goes on with the one before."""
    out: list[list[str]] = []
    for line in head.decode("utf-8", "replace").split("\r\n"):
        if line[:1] in (" ", "\t") and out:
            out[-1][1] += " " + line.strip()
        elif ":" in line:
            name, value = line.split(":", 1)
            out.append([name.strip().lower(), value.strip()])
    return dict(reversed([tuple(x) for x in out]))


class _Chunks:
    """Undoes HTTP's chunked coding, piece by piece."""

    def __init__(self):
        self.line, self.left, self.over = b"", 0, False

    def add(self, data: bytes) -> bytes:
        out = b""
        while data and not self.over:
            if self.left > 2:
                piece, data = data[: self.left - 2], data[self.left - 2 :]
                out += piece
                self.left -= len(piece)
            elif self.left:  # the line end after a chunk
                used = min(self.left, len(data))
                data, self.left = data[used:], self.left - used
            else:
                line, end, data = (self.line + data).partition(b"\n")
                if not end:
                    if len(line) > _HEAD:
                        raise WarcError("a bad chunk size")
                    self.line, data = line, b""
                    continue
                self.line = b""
                try:
                    self.left = int(line.split(b";")[0].strip(), 16)
                except ValueError as error:
                    raise WarcError("a bad chunk size") from error
                self.over = self.left == 0
                self.left += 2
        return out


def _payload_of(members: _Members, size: int, fields: dict[str, str], block: _Digest) -> tuple[Iterator[bytes], dict[str, str]]:
    """The pieces of a block's payload, and the HTTP header's fields: what follows the HTTP header where there is one, else the whole block."""
    pieces = members.pieces(size)
    if not size or not fields.get("content-type", "").lower().startswith("application/http"):

        def whole():
            for piece in pieces:
                block.add(piece)
                yield piece

        return whole(), {}
    head, at = b"", -1
    for piece in pieces:
        block.add(piece)
        head += piece
        if (at := head.find(b"\r\n\r\n")) >= 0 or len(head) > _HEAD:
            break
    if at < 0 and len(head) > _HEAD:
        raise WarcError("no end of the HTTP header")
    head, first = (head, b"") if at < 0 else (head[:at], head[at + 4 :])

    def body():
        if first:
            yield first
        for piece in pieces:
            block.add(piece)
            yield piece

    return body(), _fields(head)


def read_records(stream, payloads: bool = True) -> Iterator[dict]:
    """Records of one archive, in order. Raises :class:`WarcError` on bad framing, on a digest that differs, and on an archive that ends inside a record.

    A member holds one record. ``payload_bytes`` and ``payload_digest`` (SHA-256) are those of the payload: of an HTTP message what follows its header, with chunked coding undone, else the block; a revisit
    has none of its own, so they are what its headers state. ``page_id`` and ``refers_to`` are null in records that this module didn't write. ``verified``: a block or payload digest was stated and found right;
    a stated payload digest may be that of the chunked body. Other types (warcinfo, request, metadata, ...) come with their own type.
    """
    members = _Members(stream)
    while members.next():
        head = members.until(b"\r\n\r\n", _HEAD)
        if head is None or not head.startswith(b"WARC/"):
            raise WarcError("no record header")
        fields = _fields(head)
        if not fields.get("content-length", "").isdigit() or "warc-type" not in fields:
            raise WarcError("no content length or no type")
        kind, block = fields["warc-type"].lower(), _Digest(fields.get("warc-block-digest"))
        pieces, http = _payload_of(members, int(fields["content-length"]), fields, block)
        chunks = _Chunks() if http.get("transfer-encoding", "").lower() == "chunked" and kind == "response" else None
        stated = fields.get("warc-payload-digest")
        plain, raw, size, kept = _Digest(stated), _Digest(stated), 0, []
        own = plain.sum if plain.sha256 else hashlib.sha256()
        for piece in pieces:
            if chunks:
                raw.add(piece)
                piece = chunks.add(piece)
            plain.add(piece)
            if not plain.sha256:
                own.update(piece)
            size += len(piece)
            if payloads:
                kept.append(piece)
        if members.rest() != b"\r\n\r\n":
            raise WarcError("the block doesn't have its content length")
        if not block.matches():
            raise WarcError("the block digest differs")
        revisit = kind == "revisit"
        if not revisit and not (plain.matches() or chunks and raw.matches()):
            raise WarcError("the payload digest differs")
        length, whole = http.get("content-length", ""), "warc-truncated" not in fields
        if kind == "response" and whole and not plain.known and (not chunks.over if chunks else length.isdigit() and int(length) != size):
            raise WarcError("the payload doesn't have its content length")
        yield {
            "page_id": _page(fields.get("warc-record-id")),
            "url": fields.get("warc-target-uri"),
            "payload_bytes": (int(length) if length.isdigit() else None) if revisit else size,
            "payload_digest": plain.value.lower() if revisit and (stated or "").startswith("sha256:") else None if revisit else own.hexdigest(),
            "record_type": kind,
            "refers_to": _page(fields.get("warc-refers-to")),
            "payload": b"".join(kept) if payloads and not revisit else None,
            "verified": block.known or (plain.known and not revisit),
        }


def _writer(folder: str, limit: int):
    def write(batches):
        import pyarrow as pa
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        out, name, records, size = None, "", 0, 0

        def finished():
            out.close()
            return pa.RecordBatch.from_pydict({"archive": [name], "records": [records], "bytes": [size]}, schema=pa.schema([("archive", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))

        for batch in batches:
            columns = [batch.column(i) for i in range(5)]
            for i in range(batch.num_rows):
                page_id, url, payload, digest, refers_to = (c[i].as_py() for c in columns)
                if out is None:
                    name, records, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(f"{root}/{name}")
                data = encode_record(page_id, url, payload, digest, refers_to)
                out.write(data)
                records, size = records + 1, size + len(data)
                if size >= limit:
                    yield finished()
                    out = None
        if out is not None:
            yield finished()

    return write


class _Counted:
    """A stream that counts the bytes read."""

    def __init__(self, stream):
        self.stream, self.bytes = stream, 0

    def read(self, n: int) -> bytes:
        data = self.stream.read(n)
        self.bytes += len(data)
        return data


def _reader(folder: str, payloads: bool):
    def read(batches):
        import pyarrow as pa
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        kinds = [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()), ("verified", pa.bool_())]
        schema = pa.schema([k for k in kinds if payloads or k[0] != "payload"])
        for batch in batches:
            for archive, records, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows, size, n = [], 0, 0
                with store.open_input_stream(f"{root}/{archive}") as stream:
                    counted = _Counted(stream)
                    for record in read_records(counted, payloads):
                        rows.append(record)
                        n += 1
                        size += len(record["payload"] or b"") + 200
                        if size > 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, size = [], 0
                if records not in (None, n) or length not in (None, counted.bytes):
                    raise WarcError(f"{archive} has {n} records and {counted.bytes} bytes; its manifest says {records} and {length}")
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return read


def write_archives(pages: DataFrame, archive_bytes: int = ARCHIVE_BYTES, min_revisit: int = MIN_REVISIT_BYTES) -> tuple[str, DataFrame]:
    """Write a record per row of ``pages`` (page_id, url, html; more columns are ignored). Returns the folder and its manifest.

    Null html is an empty payload; a null url leaves the target out; a row with a null page_id is a response and never referred to.
    Of equal payloads of ``min_revisit`` bytes or more, rows with the smallest page_id are responses (all of them, where rows repeat)
    and the others revisit it. Whether the copies are few or a third of the table, a digest's smallest page is found by partial
    aggregation and joined back in partitions that Spark may split.
    """
    spark = pages.sparkSession
    base = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    firsts = stage(
        base.where((F.octet_length("payload") >= min_revisit) & F.col("page_id").isNotNull())
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("digest", "first"),
        "warc-firsts",
    )
    tagged = base.join(firsts, "digest", "left").select("page_id", "url", "payload", "digest", F.when(F.col("page_id") != F.col("first"), F.col("first")).alias("refers_to"))
    folder = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex[:12]}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(folder)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(hadoop)
    return folder, stage(tagged.mapInArrow(_writer(folder, archive_bytes), MANIFEST), "warc-manifest")


def read_archives(folder: str, manifest: DataFrame, payloads: bool = True, tasks: int | None = None) -> DataFrame:
    """Rows of :data:`RECORDS` (``payload`` only if asked for) of the archives that ``manifest`` names, one archive at a time in each task.

    Where the manifest has ``records`` and ``bytes``, an archive with others raises :class:`WarcError`. For archives of other tools a manifest of their names (column ``archive``) will do.
    """
    schema = RECORDS if payloads else RECORDS.replace("payload binary, ", "")
    tasks = tasks or manifest.sparkSession.sparkContext.defaultParallelism
    have = [F.col(c).cast("long").alias(c) if c in manifest.columns else F.lit(None).cast("long").alias(c) for c in ("records", "bytes")]
    return manifest.select("archive", *have).repartition(max(1, tasks)).mapInArrow(_reader(folder, payloads), schema)
