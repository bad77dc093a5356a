"""WARC archives: a writer with revisit records, and a reader that salvages damaged files.

Records are gzip members of their own in files of about ``SHARD_BYTES``.  The reader inflates members as streams and
checks each record's length and digests, and the member's checksum where a record has no digest.  After a failed check
it looks for the next version line in the member's content, or, where a member cannot be inflated on, for the next
member that holds a version line; it goes on from there and reports what lies between as a gap.  Headers, records and
members may be of any length.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import filesystem, map_batches, shared_dir

SHARD_BYTES = 64 << 20
REVISIT_FROM = 1000  # payloads of fewer bytes are always stored
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
URN = "urn:tidemark:page:"
CHUNK = 1 << 16
GZIP = b"\x1f\x8b\x08"
VERSION = re.compile(rb"WARC/1\.[01]\r\n")
ROWS = "archive string, offset long, inner long, length long, kind string, record_type string, record_id string, target_uri string, refers_to string, payload_bytes long, payload_digest string, payload binary"


def sha1_label(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(kind: str, record_id: str, uri: str, payload: bytes, refers_to: str | None) -> bytes:
    """The bytes of a response or revisit record; a revisit keeps the payload's length and digest, not the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<{record_id}>"), ("WARC-Date", DATE), ("WARC-Target-URI", re.sub(r"[\r\n]", "", uri))]
    if refers_to:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{refers_to}>")]
    fields += [("WARC-Payload-Digest", sha1_label(payload)), ("WARC-Block-Digest", sha1_label(block)), ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes, level: int = 6) -> bytes:
    c = zlib.compressobj(level, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def with_revisits(df: DataFrame, id_col: str = "page_id", url_col: str = "url", body_col: str = "html") -> DataFrame:
    """``id``, ``url``, ``body`` and ``refers_to``: for each row with the payload of a row with a larger id, that id.

    Only a digest, a length and the largest id of each payload with several rows meet the pages in a join; a
    payload that very many rows share is split by adaptive execution.
    """
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"), F.coalesce(F.col(body_col), F.lit("")).alias("body"))
    size = F.octet_length("body")
    key = F.when(size >= REVISIT_FROM, F.unhex(F.sha2("body", 256)))
    kept = rows.where(size >= REVISIT_FROM).groupBy(key.alias("key"), size.alias("size")).agg(F.max("id").alias("kept"), F.count("*").alias("n")).where("n > 1").drop("n")
    keyed = rows.withColumn("key", key).withColumn("size", size)
    return keyed.join(kept.hint("merge"), ["key", "size"], "left").select("id", "url", "body", F.when(~F.col("id").eqNullSafe(F.col("kept")), F.col("kept")).alias("refers_to"))


def write_archives(df: DataFrame, id_col: str = "page_id", url_col: str = "url", body_col: str = "html") -> DataFrame:
    """Write a record per row; returns the manifest (``archive`` URI, ``records``, ``bytes``).

    Null html is an empty payload, a null url an empty one; urls and payloads of any length are written whole; of equal
    payloads the row of largest id is the response, and rows repeated with that id are responses each; other repeated rows
    are written each; an empty table writes nothing.  Files of failed or repeated task attempts are not in the manifest, hence never read.
    """
    spark = df.sparkSession
    folder = shared_dir(spark, "warc")
    fs, root = filesystem(folder)
    fs.create_dir(root, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(folder)
        rows, out, name, n, size = [], None, "", 0, 0
        for batch in batches:
            for key, url, body, refers_to in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if out and size >= SHARD_BYTES:
                    out.close()
                    rows.append((f"{folder}/{name}", n, size))
                    out = None
                if out is None:
                    name, n, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = fs.open_output_stream(f"{root}/{name}", compression=None)
                kind, target = ("response", None) if refers_to is None else ("revisit", f"{URN}{refers_to}")
                data = gzip_member(record(kind, f"{URN}{'' if key is None else key}", url, body.encode(), target))
                out.write(data)
                n, size = n + 1, size + len(data)
        if out:
            out.close()
            rows.append((f"{folder}/{name}", n, size))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=["archive", "records", "bytes"])

    schema = "archive string, records long, bytes long"
    map_batches(with_revisits(df, id_col, url_col, body_col), write, schema).write.parquet(f"{folder}/manifest")
    return spark.read.schema(schema).parquet(f"{folder}/manifest")


class Damaged(Exception):
    """A record fails a check."""


class Broken(Exception):
    """The bytes cannot be read on: no compressed member here, or it breaks off."""


class Stream:
    """The content of a gzip member, or of a plain file, from an offset on: read once forwards, in bounded memory.

    ``mark`` and ``reset`` go back to a record's beginning without inflating what lies before it again.
    """

    def __init__(self, f, offset: int, packed: bool):
        self.f, self.at, self.pos, self.buf = f, offset, 0, b""
        self.inflater = zlib.decompressobj(31) if packed else None
        self.pending = False

    def fill(self) -> bool:
        """Get more content; False at the end of the member or file."""
        d = self.inflater
        if d is None:
            chunk = self.f.read_at(CHUNK, self.at)
            self.at += len(chunk)
            self.buf += chunk
            return bool(chunk)
        while not d.eof:
            data = d.unconsumed_tail
            if not data and not self.pending:
                data = self.f.read_at(CHUNK, self.at)
                self.at += len(data)
                if not data:
                    raise Broken("the member does not end")
            try:
                out = d.decompress(data, CHUNK)
            except zlib.error as e:
                raise Broken(str(e)) from e
            self.pending = len(out) == CHUNK  # more may come without input
            if out:
                self.buf += out
                return True
        return False

    def unread(self) -> int:
        """The archive's offset behind what has been inflated."""
        d = self.inflater
        return self.at - len(self.buf if d is None else d.unused_data if d.eof else d.unconsumed_tail)

    def more(self) -> bool:
        return bool(self.buf) or self.fill()

    def peek(self, n: int) -> bytes:
        while len(self.buf) < n and self.fill():
            pass
        return self.buf[:n]

    def until(self, mark: bytes) -> bytes:
        """The content up to and with ``mark``."""
        parts, tail = [], b""
        while self.more():
            found = (tail + self.buf).find(mark)
            if found >= 0:
                parts.append(self.skip(found + len(mark) - len(tail)))
                return b"".join(parts)
            tail = (tail + self.buf)[1 - len(mark) :]
            parts.append(self.skip(len(self.buf)))
        raise Damaged("no end of header")

    def skip(self, n: int) -> bytes:
        """What is in hand, at most ``n`` bytes of it."""
        out, self.buf = self.buf[:n], self.buf[n:]
        self.pos += len(out)
        return out

    def take(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.more():
                raise Damaged("wrong length")
            out = self.skip(n)
            n -= len(out)
            yield out

    def mark(self) -> tuple:
        return self.at, self.pos, self.buf, self.pending, self.inflater and self.inflater.copy()

    def reset(self, mark: tuple) -> None:
        self.at, self.pos, self.buf, self.pending, inflater = mark
        self.inflater = inflater and inflater.copy()

    def next_line(self) -> bool:
        """Go to the next version line that a readable header follows; False at the end."""
        self.skip(1)
        last = b""
        while self.more():
            at = self.buf.find(b"WARC/1.")
            if at < 0:
                if len(self.buf) > 8:
                    last = self.skip(len(self.buf) - 8)[-2:]
                elif not self.fill():
                    self.skip(8)
                continue
            last = (last + self.skip(at))[-2:]
            here = self.mark()
            try:
                good = last in (b"", b"\r\n") and header(self) is not None
            except Damaged:
                good = False
            self.reset(here)
            if good:
                return True
            last = self.skip(1)
        return False


def sound(f, offset: int) -> bool:
    """Whether the member at ``offset`` inflates to its end and its checksum holds."""
    stream = Stream(f, offset, True)
    try:
        while stream.fill():
            stream.skip(len(stream.buf))
    except Broken:
        return False
    return True


def begins(f, offset: int) -> bool:
    """Whether a member starts here whose content begins with a version line."""
    try:
        return bool(VERSION.match(zlib.decompressobj(31).decompress(f.read_at(CHUNK, offset), 64)))
    except zlib.error:
        return False


def next_member(f, offset: int, size: int) -> int:
    """The first offset from ``offset`` on where a member begins that holds a version line; ``size`` if there is none."""
    while offset < size:
        window = f.read_at(CHUNK, offset)
        at = window.find(GZIP)
        while at >= 0:
            if begins(f, offset + at):
                return offset + at
            at = window.find(GZIP, at + 1)
        offset += max(1, len(window) - len(GZIP) + 1)
    return size


def header(stream: Stream) -> dict[str, str]:
    """The fields of the header that the stream stands at, however long it is."""
    if not VERSION.match(stream.peek(10)):
        raise Damaged("no version line")
    lines = stream.until(b"\r\n\r\n").decode("utf-8", "replace").split("\r\n")[1:]
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    if not re.fullmatch("[0-9]+", fields.get("content-length", "")):
        raise Damaged("no length")
    return fields


def sha1_of(label: str | None) -> str | None:
    """The hex digest that a ``sha1:`` label in base 32 or hex gives; None for other labels."""
    kind, _, value = (label or "").partition(":")
    if kind.lower() != "sha1":
        return None
    try:
        return value.lower() if len(value) == 40 else base64.b32decode(value.upper()).hex()
    except ValueError:
        return ""


def next_record(stream: Stream, keep: bool, vouched) -> tuple:
    """The record that the stream stands at, as a row's columns from ``kind`` on; raises where a check fails.

    ``vouched``: called where the record has no digest of its own; whether something else vouches for its bytes.
    """
    fields = header(stream)
    block, payload, kept, n, head = hashlib.sha1(), hashlib.sha1(), [], 0, b""
    inside = not fields.get("content-type", "").lower().startswith("application/http")  # the payload begins at once
    for chunk in stream.take(int(fields["content-length"])):
        block.update(chunk)
        if not inside:
            searched = max(0, len(head) - 3)
            head += chunk
            end = head.find(b"\r\n\r\n", searched)
            if end < 0:
                continue
            inside, chunk, head = True, head[end + 4 :], head[: end + 2]
        payload.update(chunk)
        n += len(chunk)
        if keep:
            kept.append(chunk)
    if b"".join(stream.take(4)) != b"\r\n\r\n":
        raise Damaged("wrong length")
    kind, wanted, said = fields.get("warc-type", ""), sha1_of(fields.get("warc-block-digest")), sha1_of(fields.get("warc-payload-digest"))
    if wanted is not None and wanted != block.hexdigest():
        raise Damaged("wrong block digest")
    revisit = kind == "revisit"
    if not revisit and said is not None and said != payload.hexdigest():
        raise Damaged("wrong payload digest")
    if wanted is None and (revisit or said is None) and not vouched():
        raise Damaged("no digest, and a wrong checksum")
    if revisit:
        length = re.search(rb"(?i)\r\ncontent-length: *(\d+)\r\n", head)
        n = int(length[1]) if length else None
    strip = lambda v: v.strip("<>") if v else None
    body = b"".join(kept) if keep and not revisit else None
    return "record", kind, strip(fields.get("warc-record-id")), fields.get("warc-target-uri"), strip(fields.get("warc-refers-to")), n, said or payload.hexdigest(), body


def salvage(f, size: int, packed: bool, keep: bool = True) -> Iterator[tuple]:
    """(offset, inner, length, kind, ...) of every record and every gap of an open archive, each as soon as it is known.

    A record's ``offset`` is its member's and ``inner`` its place in the member's content (null in plain files);
    ``length`` counts its content.  A gap with ``inner`` lies in a member of which other records were saved; one
    without is a stretch of the archive's own bytes.
    """
    at = 0
    while at < size:
        stream, saved, lost, checked = Stream(f, at, packed), False, [], []

        def vouched() -> bool:
            if not checked:
                checked.append(not packed or sound(f, at))  # noqa: B023
            return checked[0]

        place = lambda a: (at, a) if packed else (a, None)  # noqa: B023, E731
        begun = at
        try:
            while stream.more():
                mark, start = stream.mark(), stream.pos
                begun = stream.unread() if saved else at
                try:
                    row = next_record(stream, keep, vouched)
                except Damaged:
                    stream.reset(mark)
                    stream.next_line()
                    lost.append((start, stream.pos - start))
                    continue
                if packed and not saved:
                    yield from ((*place(a), n, "gap", *[None] * 7) for a, n in lost)
                    lost.clear()
                saved = True
                yield from ((*place(a), n, "gap", *[None] * 7) for a, n in lost)
                lost.clear()
                begun = stream.unread()
                yield *place(start), stream.pos - start, *row
            if packed and not saved:
                yield at, None, stream.unread() - at, "gap", *[None] * 7
            else:
                yield from ((*place(a), n, "gap", *[None] * 7) for a, n in lost)
            at = stream.unread() if packed else size
        except Broken:
            after = next_member(f, max(at, begun) + 1, size)
            if after > begun:  # a lost trailer behind a record whose digest holds quarantines nothing
                yield begun, None, after - begun, "gap", *[None] * 7
            at = after


def read_archives(manifest: DataFrame, payloads: bool = False) -> DataFrame:
    """Every record and gap of the archives in column ``archive``, one task per archive, streamed.

    ``kind`` is ``record`` or ``gap``; see ``salvage`` for ``offset``, ``inner`` and ``length``.  Only with ``payloads``
    is a payload held in memory, one at a time.  An archive that is empty has no rows; one that cannot be opened fails the
    job, since its records would be missing.  Other columns are not read.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in ROWS.split(", ")]
        types = [{"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[c.split()[1]] for c in ROWS.split(", ")]
        pack = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)
        for batch in batches:
            for archive in batch.column(0).to_pylist():
                fs, path = filesystem(archive)
                rows, held = [], 0
                with fs.open_input_file(path) as f:
                    for row in salvage(f, f.size(), f.read_at(3, 0) == GZIP or archive.endswith(".gz"), payloads):
                        rows.append((archive, *row))
                        held += len(row[-1] or b"") + 100
                        if held > 1 << 22:
                            yield pack(rows)
                            rows, held = [], 0
                if rows:
                    yield pack(rows)

    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return map_batches(manifest.select("archive").repartition(n), read, ROWS)


def page_records(manifest: DataFrame, id_col: str = "page_id") -> DataFrame:
    """Per page record read back: the id, ``payload_bytes``, ``payload_digest``, ``record_type``, ``refers_to``."""
    page = lambda c: F.nullif(F.substring_index(c, ":", -1), F.lit("")).cast("long")
    rows = read_archives(manifest).where("kind = 'record'")
    return rows.select(page("record_id").alias(id_col), "payload_bytes", "payload_digest", "record_type", page("refers_to").alias("refers_to"))
