"""WARC archives: a writer of one gzip member per record, and a splittable reader.

Archives are written by Spark's own text writer, so any store and its commit protocol will do: a member's last byte is zero
whenever the record is below 16 MiB (else an empty member follows), and that byte is the writer's line separator.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, tasks

_MAGIC = b"\x1f\x8b\x08"
_EMPTY = zlib.compress(b"", 9, 31)
_DATE = "2024-01-01T00:00:00Z"
SCHEMA = "path string, record_offset long, page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary, error string"
_FOUND = SCHEMA + ", __split long, __end long"


def _member(data: bytes, level: int) -> bytes:
    out = zlib.compress(data, level, 31)
    return out if out[-1] == 0 else out + _EMPTY


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def build_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, level: int = 3) -> bytes:
    """One gzip member: a response with the payload behind HTTP headers, or a revisit that refers to another record."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    body = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_urn(page_id)}", f"WARC-Date: {_DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f%]", lambda m: f"%{ord(m[0]):02X}", url))
    head.append("WARC-Payload-Digest: sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode())
    if refers_to is not None:
        head += [f"WARC-Refers-To: {_urn(refers_to)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return _member("\r\n".join(head).encode("utf-8", "replace") + b"\r\n\r\n" + body + b"\r\n\r\n", level)


def write_warc(pages: DataFrame, path: str, *, least_bytes: int = 1000, level: int = 3) -> None:
    """Writes pages (page_id, url, html) as archives below path.

    Null html is an empty payload. Of equal payloads of least_bytes and more, that with the largest page_id is the response
    and the others revisit it; rows that tie on that id are all responses. Null ids are responses. Extra columns are left out.
    """
    body = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), body.alias("html"))
    keyed = rows.withColumn("digest", F.sha1("html"))
    large = keyed.where(F.octet_length("html") >= least_bytes).select("page_id", "digest")
    heads = large.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1").drop("n")
    revisits = large.join(heads, "digest").where("page_id < refers_to").distinct()
    planned = keyed.join(revisits, ["page_id", "digest"], "left").select("page_id", "url", "html", "refers_to")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, 500):
                x = whole.slice(i, 500)
                made = [build_record(p, u, h.encode("utf-8", "replace"), r, level)[:-1] for p, u, h, r in zip(*(x.column(c).to_pylist() for c in ("page_id", "url", "html", "refers_to")), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], names=["value"])

    planned.coalesce(tasks(pages.sparkSession)).mapInArrow(run, "value binary").select(F.col("value").cast("string")).write.option("lineSep", "\0").text(path)


def _open(path: str):
    from pyarrow import fs

    uri = re.sub(r"^file:/+", "file:///", path)
    if "://" not in uri:
        return fs.LocalFileSystem().open_input_file(uri)
    system, inner = fs.FileSystem.from_uri(uri)
    return system.open_input_file(inner)


class _Window:
    """Bytes of a file from a position on, read ahead in steps; what lies before the position in use is let go."""

    def __init__(self, file, size: int, at: int, step: int = 4 << 20):
        self.file, self.size, self.base, self.step, self.data = file, size, at, step, b""

    def more(self) -> bool:
        got = self.file.read_at(min(self.step, self.size - self.base - len(self.data)), self.base + len(self.data)) if self.base + len(self.data) < self.size else b""
        self.data += got
        return bool(got)

    def forget(self, at: int) -> None:
        if at - self.base > self.step:
            self.data, self.base = self.data[at - self.base :], at


def members(file, size: int, start: int, end: int) -> Iterator[tuple[int, int, bytes | None, str | None]]:
    """Offset, end, content and error of every gzip member that begins in [start, end) and holds a WARC record, wherever it ends.

    A member that begins as a record and does not inflate to its end comes without content and with the error; so do bytes between two members that are none.
    What is found before the first record that really begins in the range may lie inside a record from before it; read_warc leaves that out.
    """
    w = _Window(file, size, start)
    at, after = start, None  # after: where the last member ended, if it did
    while at < end:
        w.forget(at)
        k = w.data.find(_MAGIC, at - w.base)
        if k < 0:
            at = max(at, w.base + len(w.data) - 2)
            if not w.more():
                if after is not None and after < size:
                    yield after, size, None, "no member begins here"
                return
            continue
        at = w.base + k
        if at >= end:
            return
        inflate, out, head, pos, error = zlib.decompressobj(31), [], b"", at, None
        try:
            while not inflate.eof:
                if pos - w.base >= len(w.data) and not w.more():
                    raise zlib.error("ends early")
                part = w.data[pos - w.base : pos - w.base + (1 << 16 if len(head) >= 5 else 64)]  # an error takes away what its own part gave
                piece = inflate.decompress(part)
                out.append(piece)
                pos += len(part) - len(inflate.unused_data)
                if len(head) < 5:
                    head += piece[:5]
                    if len(head) >= 5 and not head.startswith(b"WARC/"):
                        raise zlib.error("no record")
        except zlib.error as e:
            error = str(e)
        if error is not None and not head.startswith(b"WARC/"):
            at += 1
            continue
        if after is not None and at > after:
            yield after, at, None, "no member begins here"
        if error is not None:
            yield at, at + len(_MAGIC), None, error  # what follows is searched from its first bytes on
            at, after = at + len(_MAGIC), None
            continue
        content = b"".join(out)
        if content.startswith(b"WARC/"):
            yield at, pos, content, None
        at = after = pos


def parse_record(content: bytes) -> dict:
    head, _, rest = content.partition(b"\r\n\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode("utf-8", "replace").split("\r\n")[1:])}
    body = rest[: int(fields.get("content-length", len(rest)))]
    http, _, payload = body.partition(b"\r\n\r\n")
    urn = lambda k: int(m[1]) if (m := re.fullmatch(r"<urn:page:(-?\d+)>", fields.get(k, ""))) else None
    digest = fields.get("warc-payload-digest", "")
    stated = base64.b32decode(digest[5:]).hex() if digest.startswith("sha1:") else None
    kind, mismatch = fields.get("warc-type"), None
    if kind == "revisit":
        length = re.search(rb"(?i)^content-length:\s*(\d+)", http, re.M)
        size, found, payload = int(length[1]) if length else None, stated, None
    else:
        size, found = len(payload), hashlib.sha1(payload).hexdigest()
        mismatch = None if stated in (None, found) else f"payload does not match its digest {stated}"
    url = re.sub(r"%(0[0-9A-F]|1[0-9A-F]|20|25|7F)", lambda m: chr(int(m[1], 16)), fields["warc-target-uri"]) if "warc-target-uri" in fields else None
    return {"page_id": urn("warc-record-id"), "url": url, "record_type": kind, "refers_to": urn("warc-refers-to"), "payload_bytes": size, "payload_digest": found, "payload": payload, "mismatch": mismatch}


def read_warc(spark: SparkSession, path: str, *, split_bytes: int = 16 << 20, with_payload: bool = True) -> DataFrame:
    """Records of the archives below path. A split scans its byte range for gzip magic, decodes candidates to see whether they are records, and
    owns those that begin in it. No archives give no rows.

    A candidate inside another record's stored bytes is no record: what begins before the end of a record of an earlier split is left out. Such ends are one number
    a split. A damaged record, bytes that are no member, and a response whose payload does not match its stated digest come as rows with error.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", F.col("length").alias("size")).where("size > 0")
    splits = files.select("path", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(split_bytes).cast("long"))).alias("start"))
    dealt = splits.repartition(tasks(spark))
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    kinds = pa.schema([pa.field(n, {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[k]) for n, k in (x.split() for x in _FOUND.split(", "))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path_, size, start in zip(*(batch.column(c).to_pylist() for c in ("path", "size", "start")), strict=True):
                rows, held = [], 0
                with _open(path_) as file:
                    for at, end, content, error in members(file, size, start, min(size, start + split_bytes)):
                        row = {"path": path_, "record_offset": at, "error": error, "__split": start, "__end": end}
                        if content is not None:
                            row = parse_record(content) | row
                            row["error"] = row.pop("mismatch")
                        rows.append(row if with_payload else row | {"payload": None})
                        held += len(row.get("payload") or b"") if with_payload else 0
                        if len(rows) == 500 or held > 32 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema=kinds)
                            rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema=kinds)

    found = materialize(dealt.mapInArrow(run, _FOUND), "records", scan=True)
    ends = found.groupBy("path", "__split").agg(F.max("__end").alias("e"))
    before = Window.partitionBy("path").orderBy("__split").rowsBetween(Window.unboundedPreceding, -1)
    reach = ends.select("path", "__split", F.max("e").over(before).alias("__reach")).where("__reach > __split")  # only where a record runs into a split
    return found.join(reach, ["path", "__split"], "left").where("__reach IS NULL OR record_offset >= __reach").select(*names)
