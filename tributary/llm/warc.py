"""Web archives: writing WARC records, mending monolithic gzip, and reading by a sidecar index.

Archives are often compressed as one gzip stream, in which no record can be read without inflating
all before it. The normaliser inflates such a file once, writes every record as a gzip member of its
own, and notes each member's offset and length in a sidecar.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.files import make_folder, opened
from tributary.session import fresh_folder, kept_table

GZIP = 16 + zlib.MAX_WBITS
CHUNK = 1 << 18
PAGE_URN, NO_PAGE = "urn:x-page:", "none"
WRITTEN = "path string, n_records long"
NORMALISED = "path string, sidecar string, n_records long"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, path string, offset long, length long"
# Fixed values of the format.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MEMBER_END = b"\r\n\r\n"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _one_line(value: str) -> str:
    """A header value: line ends would begin a new header, so they and the percent sign are escaped."""
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def _whole(value: str) -> str:
    return value.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, digest: str) -> bytes:
    """One WARC/1.1 record. A revisit holds the HTTP header alone, which still tells the payload's length."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    lines = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{PAGE_URN}{NO_PAGE if page_id is None else page_id}>", "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_one_line(url)}")
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <{PAGE_URN}{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + MEMBER_END


def headers(head: bytes) -> dict[str, str]:
    """Header fields of a record or an HTTP message, names in lower case; the first line is left out."""
    fields = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        if name:
            fields[name.strip().lower()] = value.strip()
    return fields


class _Stream:
    """Decompressed bytes of a file of one or more gzip members, or of plain text, chunk by chunk."""

    def __init__(self, source) -> None:
        self._in, self._held, self._inflate, self._ended = source, b"", None, False
        start = source.read(2)
        self._plain = start != b"\x1f\x8b"
        self._rest = start

    def more(self) -> bool:
        """Gets another chunk; false at the end of the file."""
        while not self._ended:
            packed = self._rest or self._in.read(CHUNK)
            self._rest = b""
            if not packed:
                self._ended = True
                if self._inflate is not None:
                    raise EOFError("the gzip stream is cut off")
                return False
            if self._plain:
                self._held += packed
                return True
            if self._inflate is None:
                packed = packed.lstrip(b"\0") if not self._held else packed
                if not packed:
                    continue
                self._inflate = zlib.decompressobj(GZIP)
            content = self._inflate.decompress(packed)
            if self._inflate.eof:
                self._rest, self._inflate = self._inflate.unused_data, None
            if content:
                self._held += content
                return True
        return False

    def until(self, mark: bytes) -> bytes | None:
        """All up to and with ``mark``; None when nothing but line ends is left."""
        while (at := self._held.find(mark)) < 0:
            if not self.more():
                if self._held.strip(b"\r\n"):
                    raise EOFError("the file ends within a record's header")
                return None
        found, self._held = self._held[: at + len(mark)], self._held[at + len(mark) :]
        return found

    def exactly(self, n: int) -> Iterator[bytes]:
        """The next ``n`` bytes, in parts."""
        while n:
            if not self._held and not self.more():
                raise EOFError("the file ends within a record's block")
            part, self._held = self._held[:n], self._held[n:]
            n -= len(part)
            yield part


def normalise(source, target, level: int = 6) -> list[tuple[int, int, dict[str, str]]]:
    """Copies every record of ``source`` into a gzip member of ``target``: offset, length and header of each.

    One pass over the stream. Memory stays at a few chunks however long a record is. Line ends
    between records are ignored, so archives with too few or too many of them are mended.
    """
    stream, offset, found = _Stream(source), 0, []
    while (head := stream.until(b"\r\n\r\n")) is not None:
        head = head.lstrip(b"\r\n")
        if not head:
            continue
        if not head.startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        fields = headers(head)
        member = zlib.compressobj(level, zlib.DEFLATED, GZIP)
        length = 0
        parts = (p for group in ((head,), stream.exactly(int(fields["content-length"])), (MEMBER_END,)) for p in group)
        for part in parts:
            length += target.write(packed) if (packed := member.compress(part)) else 0
        length += target.write(member.flush())
        found.append((offset, length, fields))
        offset += length
    return found


def write_archives(pages: DataFrame, folder: str, level: int = 1, archive_bytes: int = 1 << 28) -> DataFrame:
    """Monolithic ``.warc.gz`` files below ``folder`` of rows (page_id, url, payload, refers_to): rows (path, n_records).

    A task begins a new file after ``archive_bytes`` of records. Names are new in every attempt, and
    the kept table returned lists the files of successful tasks.
    """
    make_folder(folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, out, packer, size, records, path = [], None, None, 0, 0, ""
        for batch in batches:
            for page_id, url, payload, refers_to in zip(*(batch.column(c) for c in ("page_id", "url", "payload", "refers_to"))):
                if out is None:
                    path = f"{folder}/{uuid.uuid4().hex}.warc.gz"
                    system, inner = opened(path)
                    out, packer, size, records = system.open_output_stream(inner, compression=None), zlib.compressobj(level, zlib.DEFLATED, GZIP), 0, 0
                payload = payload.as_py() or b""
                made = record(page_id.as_py(), url.as_py(), payload, refers_to.as_py(), base32_sha1(payload))
                out.write(packer.compress(made))
                size, records = size + len(made), records + 1
                if size >= archive_bytes:
                    out.write(packer.flush())
                    out.close()
                    done.append((path, records))
                    out = None
        if out is not None:
            out.write(packer.flush())
            out.close()
            done.append((path, records))
        yield pa.RecordBatch.from_arrays(
            [pa.array([p for p, _ in done], pa.string()), pa.array([n for _, n in done], pa.int64())], names=["path", "n_records"]
        )

    return kept_table(pages.mapInArrow(write, WRITTEN), "archives")


def normalise_archives(archives: DataFrame, folder: str, level: int = 6) -> DataFrame:
    """Each file of ``archives`` (path) with a member per record, and its sidecar: rows (path, sidecar, n_records).

    One task inflates a file, as a single stream can only be read from its start; files are dealt
    over all tasks. The sidecar has a JSON line per record: id, type, digest, offset and length.
    """
    make_folder(folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                name = f"{folder}/{uuid.uuid4().hex}"
                system, inner = opened(path)
                to, target = opened(f"{name}.warc.gz")
                with system.open_input_stream(inner, compression=None) as source, to.open_output_stream(target, compression=None) as out:
                    found = normalise(source, out, level)
                with to.open_output_stream(opened(f"{name}.cdxj")[1]) as sidecar:
                    for offset, length, fields in found:
                        line = {
                            "id": fields.get("warc-record-id"), "type": fields.get("warc-type"),
                            "digest": fields.get("warc-payload-digest"), "offset": offset, "length": length,
                        }
                        sidecar.write(json.dumps(line).encode() + b"\n")
                row = [(f"{name}.warc.gz",), (f"{name}.cdxj",), (len(found),)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, t) for v, t in zip(row, (pa.string(), pa.string(), pa.int64()))], names=["path", "sidecar", "n_records"]
                )

    width = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return kept_table(archives.select("path").repartition(width).mapInArrow(run, NORMALISED), "normalised")


def _parsed(member: bytes) -> tuple:
    """(page_id, payload_bytes, digest, type, refers_to, url) of one record; a response's digest is verified."""
    content = zlib.decompress(member, GZIP)
    head, _, rest = content.partition(b"\r\n\r\n")
    fields = headers(head)
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    n = int(headers(http)["content-length"])
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    kind = fields["warc-type"]
    if kind == "response" and (len(payload) != n or base32_sha1(payload) != digest):
        raise ValueError(f"{fields['warc-record-id']}: the payload does not match its digest")

    def page(name: str) -> int | None:
        value = fields.get(name, "").strip("<>").removeprefix(PAGE_URN)
        return None if value in ("", NO_PAGE) else int(value)

    url = fields.get("warc-target-uri")
    return page("warc-record-id"), n, digest, kind, page("warc-refers-to"), None if url is None else _whole(url)


def read_archives(normalised: DataFrame) -> DataFrame:
    """Every record of the files, each read alone at the offset its sidecar names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, sidecar in zip(batch.column("path").to_pylist(), batch.column("sidecar").to_pylist()):
                system, inner = opened(path)
                rows = []
                with opened(sidecar)[0].open_input_stream(opened(sidecar)[1]) as lines:
                    places = [json.loads(x) for x in lines.read().splitlines()]
                with system.open_input_file(inner) as source:
                    for p in places:
                        rows.append((*_parsed(source.read_at(p["length"], p["offset"])), path, p["offset"], p["length"]))
                if rows:
                    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64())
                    names = [c.split()[0] for c in RECORDS.split(", ")]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    width = int(normalised.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return normalised.select("path", "sidecar").repartition(width).mapInArrow(run, RECORDS)


def with_revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Rows (page_id, url, payload, refers_to): of pages with equal payloads the smallest id is the response.

    The other pages refer to it. Payloads of fewer than ``least_bytes`` are all responses, and so are rows
    without an id, or with the id of the response itself. Payloads are grouped by SHA-1 and length with
    partial aggregates, and the revisits are found among ids and digests, where a hot payload's rows can be split. The payloads
    themselves are shuffled once, by id and digest, so copies of one payload are spread.
    """
    body = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    hashed = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), body.alias("payload")).withColumn(
        "same", F.struct(F.sha1("payload").alias("d"), F.length("payload").alias("n"))
    )
    narrow = hashed.where((F.length("payload") >= least_bytes) & F.col("page_id").isNotNull()).select("page_id", "same")
    many = narrow.groupBy("same").agg(F.min("page_id").alias("first_page"), F.count(F.lit(1)).alias("n")).where("n > 1")
    many = many.select(F.struct(F.col("same").alias("s")).alias("same_key"), "first_page")
    revisits = (
        narrow.join(many, F.struct(F.col("same").alias("s")) == F.col("same_key")).where("first_page != page_id")
        .groupBy(F.col("page_id").alias("r_page"), F.col("same").alias("r_same")).agg(F.min("first_page").alias("refers_to"))
    )
    width = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = hashed.repartition(width, "page_id", "same")
    joined = dealt.join(revisits, (F.col("page_id") == F.col("r_page")) & (F.col("same") == F.col("r_same")), "left")
    return joined.select("page_id", "url", "payload", "refers_to")


def archive_round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """All pages written as monolithic archives, normalised, and read back: one row per page.

    Null html is an empty payload; a null url has no header; a null id is no revisit and reads back as
    null; rows that repeat an id are records of their own, responses all if they have the smallest id of
    their payload. Other columns are ignored. An empty table gives no rows.
    """
    spark = pages.sparkSession
    ordered = with_revisits(pages, least_bytes).sortWithinPartitions("page_id")
    archives = write_archives(ordered, fresh_folder(spark, "warc"))
    return read_archives(normalise_archives(archives, fresh_folder(spark, "warc-members")))
