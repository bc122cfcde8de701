"""WARC archives: gzip member per record, sequential streaming reader.

Writer: each task streams its rows into ``.warc.gz`` files of bounded size
under a shared folder, one gzip member per record, under names that no other
attempt uses, and returns a manifest row per file. The manifest is the commit:
files of failed or duplicate attempts are in no manifest and are never read.

Reader: any archive of one gzip member per record, of this writer or another one, is
read front to back with incremental
zlib decompression in small chunks; a record's block is framed by its
Content-Length, and its digests are computed as the bytes arrive. A member counts as read
only behind its own checksum and length. Records of every type are returned; those with an HTTP
header have it cut off, of others the block is the payload. Digests may be in hex or
base32, of any algorithm that hashlib has, or missing. Memory
holds one chunk and one batch of rows, whatever the archive's size. Archives
are the unit of parallel work.

Files are opened through ``pyarrow.fs`` by the folder's own URI, so any shared
store that it knows works; nothing is written to a machine-local folder.

Defined cases: null payload is empty. Of equal payloads (SHA-1 and length) of
at least ``min_revisit_bytes`` the largest key is the response, others are
revisits that carry the response's HTTP header and refer to it. A row repeated
with that key is a response too. A null key is smaller than all others; if all
are null, all are responses. ``digest_ok`` is false where a digest or length that a header states is
not met, true where none is stated. An id that is not of this writer has no record_key. Broken framing raises. Header values can't hold line breaks: CR and LF
in a URL are percent-encoded.
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import re
import uuid
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from stratum.session import scratch_dir

MANIFEST = "path string, records long, bytes long"
RECORD = ("record_key long, record_id string, record_type string, target_uri string, refers_to long, payload_bytes long, "
          "payload_digest string, digest_ok boolean, payload binary")
CHUNK = 1 << 16
HTTP_BYTES = 1 << 20  # a longer HTTP header is taken for payload
BATCH_ROWS, BATCH_BYTES = 2000, 16 << 20


def _store(folder: str) -> tuple[fs.FileSystem, str]:
    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(path, recursive=True)
    return store, path


def _urn(key) -> str:
    return "<urn:record:none>" if key is None else f"<urn:record:{int(key)}>"


def _key(urn: str | None):
    """The key in an id that ``_urn`` gave; other ids have none."""
    known = re.fullmatch(r"<urn:record:(-?\d+)>", urn or "")
    return int(known[1]) if known else None


def record_bytes(key, uri, payload: bytes, refers_to, is_revisit: bool, digest: str) -> bytes:
    """One record, not yet compressed."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if is_revisit else http + payload
    uri = (uri or "").replace("\r", "%0D").replace("\n", "%0A")
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if is_revisit else 'response'}", f"WARC-Record-ID: {_urn(key)}",
        f"WARC-Target-URI: {uri}", "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{hashlib.sha1(block).hexdigest()}",
        "Content-Type: application/http;msgtype=response",
    ]
    if is_revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {_urn(refers_to)}"]
    return "\r\n".join([*head, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"


def _writer(folder: str, max_bytes: int, level: int) -> Callable:
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = _store(folder)
        out, path, records, size, done = None, "", 0, 0, []
        for pdf in batches:
            for key, uri, html, refers, revisit, digest in pdf.itertuples(index=False, name=None):
                if out is None:
                    path, records, size = posixpath.join(base, f"{uuid.uuid4().hex}.warc.gz"), 0, 0
                    out = store.open_output_stream(path, compression=None)
                key, refers = (None if pd.isna(x) else x for x in (key, refers))
                member = zlib.compressobj(level, zlib.DEFLATED, 31)
                data = member.compress(record_bytes(key, uri, (html or "").encode(), refers, bool(revisit), digest))
                data += member.flush()
                out.write(data)
                records, size = records + 1, size + len(data)
                if size >= max_bytes:
                    out.close()
                    done.append((path, records, size))
                    out = None
        if out is not None:
            out.close()
            done.append((path, records, size))
        yield pd.DataFrame(done, columns=["path", "records", "bytes"])
    return write


def with_roles(pages: DataFrame, key_col: str = "page_id", payload_col: str = "html",
               min_revisit_bytes: int = 1000) -> DataFrame:
    """``pages`` plus ``_digest``, ``_revisit`` and ``_refers_to``. Only (key, digest)
    rows are grouped and joined by digest; payloads are joined by key."""
    body = F.encode(F.coalesce(F.col(payload_col), F.lit("")), "UTF-8")
    rows = pages.withColumn("_digest", F.sha1(body)).withColumn("_bytes", F.octet_length(body))
    narrow = rows.where(F.col("_bytes") >= min_revisit_bytes).select(
        F.col(key_col).alias("_k"), F.struct("_digest", "_bytes").alias("_same"))
    keeper = (narrow.groupBy("_same").agg(F.max("_k").alias("_keeper"), F.count(F.lit(1)).alias("_n"))
                    .where("_n > 1").select(F.xxhash64("_same").alias("_j"), F.col("_same").alias("_s"), "_keeper"))
    again = (narrow.withColumn("_j", F.xxhash64("_same")).join(keeper, "_j")
                   .where((F.col("_same") == F.col("_s")) & ~F.col("_k").eqNullSafe(F.col("_keeper")))
                   .select("_k", F.col("_same._digest").alias("_d"), F.col("_keeper").alias("_refers_to")).distinct())
    out = rows.join(again, F.col(key_col).eqNullSafe(F.col("_k")) & (F.col("_digest") == F.col("_d")), "left")
    return out.withColumn("_revisit", F.col("_d").isNotNull()).drop("_k", "_d", "_bytes")


def write_archives(pages: DataFrame, folder: str, key_col: str = "page_id", uri_col: str = "url",
                   payload_col: str = "html", min_revisit_bytes: int = 1000, max_bytes: int = 128 << 20,
                   level: int = 6) -> DataFrame:
    """Writes ``pages`` as ``.warc.gz`` files under ``folder``; returns the manifest."""
    rows = with_roles(pages, key_col, payload_col, min_revisit_bytes).select(
        F.col(key_col).cast("long"), uri_col, payload_col, F.col("_refers_to").cast("long"), "_revisit", "_digest")
    manifest = f"{folder}/manifest"
    rows.mapInPandas(_writer(folder, max_bytes, level), MANIFEST).write.parquet(manifest)
    return pages.sparkSession.read.parquet(manifest)


class _Members:
    """The gzip members of a stream, one after the other, decompressed piece by piece into ``buf``."""

    def __init__(self, stream):
        self.stream, self.raw, self.buf = stream, b"", bytearray()

    def open(self) -> bool:
        """Goes to the next member; False at the end of the archive."""
        self.raw = self.raw or self.stream.read(CHUNK)
        self.z = zlib.decompressobj(31)
        return bool(self.raw)

    def more(self) -> bool:
        """Appends the member's next bytes; False at its end, which is behind its checksum and length."""
        while not self.z.eof:
            self.raw = self.raw or self.stream.read(CHUNK)
            last = not self.raw
            try:
                got = self.z.decompress(self.raw, CHUNK)
            except zlib.error as exc:
                raise ValueError(f"damaged gzip member: {exc}") from exc
            self.raw = self.z.unused_data if self.z.eof else self.z.unconsumed_tail
            if got:
                self.buf.extend(got)
                return True
            if last and not self.z.eof:
                raise ValueError("archive ends inside a gzip member")
        return False

    def until(self, mark: bytes, limit: int | None = None) -> int:
        """Where ``mark`` ends in the buffer, or -1 if it isn't within the member (or the next ``limit`` bytes)."""
        at = 0
        while (end := self.buf.find(mark, max(0, at - len(mark)), limit)) < 0:
            at = len(self.buf)
            if limit is not None and at >= limit or not self.more():
                return -1
        return end + len(mark)

    def take(self, n: int) -> bytes:
        part = bytes(self.buf[:n])
        del self.buf[:len(part)]
        return part


def _fields(rows: list[str]) -> dict[str, str]:
    return {k.lower(): v.strip() for k, _, v in (r.partition(":") for r in rows)}


class _Digest:
    """A running digest beside what a header says of it: ``algorithm:value``, the value in hex or base32."""

    def __init__(self, stated: str | None):
        algorithm, _, self.value = (stated or "").rpartition(":")
        self.known = algorithm.lower() in hashlib.algorithms_guaranteed and "shake" not in algorithm.lower()
        self.run = hashlib.new(algorithm.lower()) if self.known else None

    def update(self, part: bytes) -> None:
        if self.known:
            self.run.update(part)

    def stated(self) -> bytes | None:
        try:
            return bytes.fromhex(self.value) if len(self.value) == 2 * self.run.digest_size else base64.b32decode(self.value.upper())
        except (ValueError, AttributeError):
            return None

    def ok(self) -> bool:
        return not self.known or self.run.digest() == self.stated()


def read_stream(stream, with_payload: bool) -> Iterator[tuple]:
    """Records of one archive, in order. Raises ValueError on broken framing: a member that is cut or damaged, or holds
    no record or more than one, or a block that isn't as long as its Content-Length says."""
    members = _Members(stream)
    while members.open():
        yield _record(members, with_payload)
        members.more()
        if members.buf or members.more():
            raise ValueError("a gzip member holds more than one record")


def _record(members: _Members, with_payload: bool) -> tuple:
    end = members.until(b"\r\n\r\n")
    if end < 0:
        raise ValueError("a member ends inside a record's header")
    head = members.take(end)[:-4].decode("utf-8", "replace").split("\r\n")
    f = _fields(head[1:])
    if not head[0].startswith("WARC/") or "content-length" not in f:
        raise ValueError(f"no record at {head[0][:40]!r}")
    kind, left = f.get("warc-type", ""), int(f["content-length"])
    block, payload, sha1 = _Digest(f.get("warc-block-digest")), _Digest(f.get("warc-payload-digest")), hashlib.sha1()
    http: dict[str, str] = {}
    if f.get("content-type", "").startswith("application/http"):
        end = members.until(b"\r\n\r\n", min(left, HTTP_BYTES))
        if 0 <= end <= left:
            part = members.take(end)
            block.update(part)
            left -= end
            http = _fields(part[:-4].decode("utf-8", "replace").split("\r\n")[1:])
    size, kept = 0, bytearray()
    while left:
        if not members.buf and not members.more():
            raise ValueError("a member ends inside a block")
        part = members.take(left)
        left, size = left - len(part), size + len(part)
        for digest in (block, payload, sha1):
            digest.update(part)
        if with_payload:
            kept += part
    while len(members.buf) < 4 and members.more():
        pass
    if members.take(4) != b"\r\n\r\n":
        raise ValueError("a record doesn't end where its Content-Length says")
    revisit, coded = kind == "revisit", "transfer-encoding" in http  # a chunked body is not the payload its digest is of
    stated = http.get("content-length", "")
    ok = block.ok() and (revisit or coded or payload.ok()) and (revisit or coded or not stated.isdigit() or int(stated) == size)
    digest = payload.stated().hex() if revisit and payload.known and payload.stated() else None if revisit else sha1.hexdigest()
    return (_key(f.get("warc-record-id")), f.get("warc-record-id"), kind, f.get("warc-target-uri"), _key(f.get("warc-refers-to")),
            (int(stated) if stated.isdigit() else None) if revisit else size, digest, ok,
            bytes(kept) if with_payload and not revisit else None)


def _reader(with_payload: bool) -> Callable:
    names = [x.split(" ")[0] for x in RECORD.split(", ")]

    def frame(rows: list) -> pd.DataFrame:
        pdf = pd.DataFrame(rows, columns=names)
        return pdf.astype({"record_key": "Int64", "refers_to": "Int64", "payload_bytes": "Int64"})

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path in pdf["path"]:
                store, where = fs.FileSystem.from_uri(path)
                rows, size = [], 0
                with store.open_input_stream(where, compression=None, buffer_size=CHUNK) as stream:
                    for r in read_stream(stream, with_payload):
                        rows.append(r)
                        size += len(r[-1] or b"")
                        if len(rows) >= BATCH_ROWS or size >= BATCH_BYTES:
                            yield frame(rows)
                            rows, size = [], 0
                if rows:
                    yield frame(rows)
    return read


def read_archives(manifest: DataFrame, with_payload: bool = True, files_per_task: int = 1) -> DataFrame:
    """Rows of RECORD, one per record of the archives in ``manifest``. ``digest_ok``
    tells whether block and payload match their digests; a revisit's payload is
    null (its response holds it)."""
    files = manifest.select("path")
    tasks = max(1, -(-files.count() // files_per_task))
    return files.repartition(tasks).mapInPandas(_reader(with_payload), RECORD)


def archive_folder(spark: SparkSession) -> str:
    return scratch_dir(spark, "warc")
