"""WARC archives: written by tasks, and read back past damaged stretches.

Archives are files of gzip members, one for each record, written beside each other in a
shared folder through the file system its address names. A task that runs twice leaves files
that no manifest row names; only named ones are read.

The reader checks each record: its member, version line, headers, length and digests. Where a
check fails it searches for the next member (or, in plain archives, version line) that holds
a valid record, goes on there, and logs the bytes between as a quarantined gap.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adstream.llm.common import prepare, saved, scratch

# Bytes of payload after which a task begins another archive.
ARCHIVE_BYTES = 64 << 20
CHUNK = 1 << 16
# Of a head is read so much, and four times as much as long as it does not end.
HEADER_BYTES = 1 << 16
DIGESTS = ("md5", "sha1", "sha256", "sha384", "sha512")
CHUNK_SIZE = re.compile(rb"([0-9A-Fa-f]{1,15})[^\r\n]*\r\n")
MAGIC = b"\x1f\x8b\x08"
VERSION = re.compile(rb"WARC/1\.[01]\r\n")
MANIFEST = "path string, n_records long, n_bytes long"
RECORDS = (
    "path string, start long, end long, gap string, record_type string, record_id string, "
    "refers_to string, target_uri string, payload_digest string, payload_bytes long, payload binary"
)
NAMES = [c.split()[0] for c in RECORDS.split(", ")]


def file_system(address: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder or file address, and the path in it."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", address))


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(headers: list[tuple[str, str | None]], block: bytes) -> bytes:
    """A record: version line, headers without a value left out, block, two line ends."""
    lines = ["WARC/1.1", *(f"{k}: {re.sub('[\r\n]+', ' ', v)}" for k, v in headers if v is not None)]
    head = "\r\n".join([*lines, f"Content-Length: {len(block)}", "", ""])
    return head.encode() + block + b"\r\n\r\n"


def member(record: bytes) -> bytes:
    packed = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packed.compress(record) + packed.flush()


def roles(pages: DataFrame, revisit_from: int = 0) -> DataFrame:
    """``page_id``, ``url``, ``html`` and ``original``: the page a revisit refers to, if any.

    Of records with equal payloads of at least ``revisit_from`` bytes that with the smallest
    ``page_id`` is the response; repeated rows of it are responses too. A NULL id is never
    the smallest: where all are NULL, all are responses. Only digests that repeat are joined.
    """
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"), F.sha1(html).alias("sha1")
    )
    repeated = saved(
        rows.where(F.octet_length("html") >= revisit_from)
        .groupBy("sha1")
        .agg(F.min("page_id").alias("first_page"), F.count("*").alias("n"))
        .where("n > 1")
        .select("sha1", "first_page"),
        scratch(pages.sparkSession, "repeated-payloads"),
    )
    joined = rows.join(repeated, "sha1", "left")
    original = F.when(~F.col("page_id").eqNullSafe(F.col("first_page")), F.col("first_page"))
    return joined.select("page_id", "url", "html", original.alias("original"))


def _page_uri(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_record(page_id: int | None, url: str | None, payload: bytes, original: int | None, date: str) -> bytes:
    """A resource's response, or a revisit that keeps its digest and length but no payload."""
    revisit = original is not None
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _page_uri(page_id)),
        ("WARC-Date", date),
        ("WARC-Target-URI", url),
        ("WARC-Payload-Digest", f"sha1:{base32_sha1(payload)}"),
        ("WARC-Refers-To", _page_uri(original) if revisit else None),
        (
            "WARC-Profile",
            "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if revisit else None,
        ),
        ("X-Payload-Length", str(len(payload)) if revisit else None),
        ("Content-Type", "text/html; charset=utf-8"),
    ]
    return record_bytes(headers, b"" if revisit else payload)


def write_archives(
    pages: DataFrame, folder: str, revisit_from: int = 0, compress: bool = True, archive_bytes: int = ARCHIVE_BYTES
) -> DataFrame:
    """Write a record for each row of ``pages``; returns the stored manifest of the archives."""
    prepare(pages.sparkSession)
    date = datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = file_system(folder)
        system.create_dir(base, recursive=True)
        out, name, done, n_records, n_payload, n_bytes = None, "", [], 0, 0, 0
        for batch in batches:
            for page_id, url, html, original in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc{'.gz' if compress else ''}"
                    # Members are packed here; the stream must not pack the file again.
                    out = system.open_output_stream(f"{base}/{name}", compression=None)
                    n_records = n_payload = n_bytes = 0
                payload = html.encode()
                record = page_record(page_id, url, payload, original, date)
                packed = member(record) if compress else record
                out.write(packed)
                n_records, n_payload, n_bytes = n_records + 1, n_payload + len(payload), n_bytes + len(packed)
                if n_payload >= archive_bytes:
                    out.close()
                    done.append((f"{folder}/{name}", n_records, n_bytes))
                    out = None
        if out is not None:
            out.close()
            done.append((f"{folder}/{name}", n_records, n_bytes))
        yield pa.RecordBatch.from_arrays(
            [pa.array([d[i] for d in done], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64()))],
            ["path", "n_records", "n_bytes"],
        )

    return saved(roles(pages, revisit_from).mapInArrow(write, MANIFEST), f"{folder}-manifest")


class Damaged(ValueError):
    """What check a record failed."""


def _find(file: pa.NativeFile, size: int, start: int, wanted: re.Pattern) -> int:
    """The place of the next match from ``start``, ``size`` if there is none."""
    keep = 16
    while start < size:
        chunk = file.read_at(CHUNK * 16 + keep, start)
        found = wanted.search(chunk)
        if found:
            return start + found.start()
        if len(chunk) <= keep:
            break
        start += len(chunk) - keep
    return size


def _inflate(file: pa.NativeFile, size: int, start: int) -> tuple[bytes, int]:
    inflater, out, at, step = zlib.decompressobj(31), [], start, CHUNK // 4
    while not inflater.eof:
        chunk = file.read_at(min(step, size - at), at)
        if not chunk:
            raise Damaged("member ends early")
        try:
            out.append(inflater.decompress(chunk))
        except zlib.error as e:
            raise Damaged("member is corrupt") from e
        at, step = at + len(chunk), CHUNK * 4
    return b"".join(out), at - len(inflater.unused_data)


def parse_head(head: bytes) -> dict[str, str]:
    """Headers by lower-case name."""
    version, _, rest = head.partition(b"\r\n")
    if not VERSION.fullmatch(version + b"\r\n"):
        raise Damaged("no version line")
    headers: dict[str, str] = {}
    name = None
    for line in rest.split(b"\r\n"):
        if line[:1] in (b" ", b"\t") and name is not None:
            # A folded header goes on.
            headers[name] = f"{headers[name]} {line.decode('utf-8', 'replace').strip()}".strip()
            continue
        label, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("bad header")
        name = label.decode("utf-8", "replace").strip().lower()
        headers[name] = value.decode("utf-8", "replace").strip()
    if not {"warc-type", "warc-record-id", "content-length"} <= headers.keys():
        raise Damaged("header missing")
    if not headers["content-length"].isdecimal():
        raise Damaged("bad length")
    return headers


def _same_digest(said: str, data: bytes) -> bool | None:
    """Whether ``algorithm:value`` (base 32 or 16) is that of the data; None if that cannot be told."""
    algorithm, colon, value = said.partition(":")
    if not colon:
        algorithm, value = "sha1", said
    algorithm = algorithm.strip().lower().replace("-", "")
    if algorithm not in DIGESTS:
        return None
    own, value = hashlib.new(algorithm, data).digest(), value.strip()
    forms = (base64.b32encode(own).decode(), own.hex().upper(), base64.b64encode(own).decode())
    return value.upper().rstrip("=") in {f.rstrip("=") for f in forms[:2]} or value == forms[2]


def _unchunked(body: bytes) -> bytes:
    """The body without the chunk sizes that HTTP put between its parts; as it is where it has none."""
    out, at = [], 0
    while found := CHUNK_SIZE.match(body, at):
        n = int(found[1], 16)
        if not n:
            return b"".join(out)
        out.append(body[found.end() : found.end() + n])
        at = found.end() + n + 2
    return body


def payload_of(headers: dict[str, str], block: bytes) -> bytes:
    """The block, or where it is an HTTP message what follows its head."""
    if headers.get("content-type", "").replace(" ", "").lower().startswith("application/http"):
        return block.partition(b"\r\n\r\n")[2]
    return block


def _checked(headers: dict[str, str], block: bytes) -> dict:
    kind = headers["warc-type"]
    said = headers.get("warc-payload-digest") or None
    full = headers.get("x-payload-length", "")
    if _same_digest(headers.get("warc-block-digest", ""), block) is False and headers.get("warc-block-digest"):
        raise Damaged("block digest differs")
    payload = payload_of(headers, block)
    if kind != "revisit" and said and _same_digest(said, payload) is False:
        # Writers differ in what they digest of an HTTP message.
        if payload is block or not any(_same_digest(said, x) for x in (block, _unchunked(payload))):
            raise Damaged("payload digest differs")
    return {
        "record_type": kind,
        "record_id": headers["warc-record-id"],
        "refers_to": headers.get("warc-refers-to"),
        "target_uri": headers.get("warc-target-uri"),
        "payload_digest": said.removeprefix("sha1:") if said else None,
        "payload_bytes": int(full) if kind == "revisit" and full.isdecimal() else len(payload),
        "payload": payload,
    }


def _gz_record(file: pa.NativeFile, size: int, start: int) -> tuple[dict, int]:
    record, end = _inflate(file, size, start)
    head, blank, rest = record.partition(b"\r\n\r\n")
    if not blank:
        raise Damaged("headers do not end")
    headers = parse_head(head)
    length = int(headers["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise Damaged("length differs")
    return _checked(headers, rest[:length]), end


def _plain_record(file: pa.NativeFile, size: int, start: int) -> tuple[dict, int]:
    step = HEADER_BYTES
    while True:
        head, blank, _ = file.read_at(min(step, size - start), start).partition(b"\r\n\r\n")
        if blank:
            break
        if not VERSION.match(head) or start + step >= size:
            raise Damaged("headers do not end")
        step *= 4
    headers = parse_head(head)
    length = int(headers["content-length"])
    body = start + len(head) + 4
    end = body + length + 4
    if end > size or file.read_at(4, body + length) != b"\r\n\r\n":
        raise Damaged("length differs")
    return _checked(headers, file.read_at(length, body) if length else b""), end


def salvage(file: pa.NativeFile) -> Iterator[dict]:
    """Records and gaps of one archive, in order; together they cover all its bytes.

    A gap names the first check that failed in it.
    """
    size = file.size()
    packed = file.read_at(3, 0) == MAGIC if size else False
    if size and not packed:
        # Damage may have hit the first member: take the kind of record that comes first.
        packed = _find(file, size, 0, re.compile(re.escape(MAGIC))) < _find(file, size, 0, VERSION)
    read, mark = (_gz_record, re.compile(re.escape(MAGIC))) if packed else (_plain_record, VERSION)
    at, gap, why = 0, None, ""
    while at < size:
        try:
            record, end = read(file, size, at)
        except Damaged as e:
            if gap is None:
                gap, why = at, str(e)
            at = _find(file, size, at + 1, mark)
            continue
        if gap is not None:
            yield {"start": gap, "end": at, "gap": why}
            gap = None
        yield {"start": at, "end": end, **record}
        at = end
    if gap is not None:
        yield {"start": gap, "end": size, "gap": why}


def read_archives(paths: DataFrame, payloads: bool = True, whole: bool = False) -> DataFrame:
    """Records of the archives in column ``path``, and gaps (``gap`` is not NULL).

    An archive is read in one task, a record at a time. ``payloads`` False leaves the
    payloads out of the result; they are checked all the same. With ``whole`` an archive
    that does not hold the ``n_records`` of its manifest, or has a gap, is an error.
    """
    prepare(paths.sparkSession)
    schema = pa.schema(
        [(n, pa.int64() if n in ("start", "end", "payload_bytes") else pa.binary() if n == "payload" else pa.string()) for n in NAMES]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            expected = batch["n_records"].to_pylist() if whole else [None] * batch.num_rows
            for path, n in zip(batch["path"].to_pylist(), expected, strict=True):
                system, name = file_system(path)
                rows, held, seen = [], 0, 0
                with system.open_input_file(name) as file:
                    for row in salvage(file):
                        seen += 1
                        if whole and row.get("gap"):
                            raise Damaged(f"{path}: {row['gap']} at {row['start']}")
                        if not payloads:
                            row.pop("payload", None)
                        rows.append({"path": path, **row})
                        held += len(row.get("payload") or b"")
                        if len(rows) == 512 or held > CHUNK * 64:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                if whole and seen != n:
                    raise Damaged(f"{path}: {seen} records instead of {n}")
                yield pa.RecordBatch.from_pylist(rows, schema)

    # An archive is a row here and megabytes of work: a task for each, up to the cores.
    listed = paths.select("path", *(["n_records"] if whole else [])).repartition(max(1, paths.sparkSession.sparkContext.defaultParallelism * 4))
    return listed.mapInArrow(read, RECORDS)


def page_id_of(column: str) -> F.Column:
    """The page number in a record id, NULL if it holds none."""
    return F.regexp_extract(column, r"^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")


def round_trip(spark: SparkSession, pages: DataFrame, revisit_from: int = 0) -> DataFrame:
    """Write ``pages`` to archives in the shared folder and read them back; all records have to be there."""
    manifest = write_archives(pages, scratch(spark, "warc"), revisit_from)
    return read_archives(manifest, payloads=False, whole=True)
