"""WARC archives: records in segments, written and put together again.

Writing. Each page is an HTTP response in chunked transfer framing. Pages with equal payloads share one response, that of the largest page id, and the
others are revisits, which have no payload but its digest. A response longer than `segment` bytes is cut into a first record and continuations, numbered, with the first one's identifier, and the
total length in the last. A record is a gzip member. Tasks write files of bounded size under names of their own; what a task wrote counts only when the job is committed, by a list of files that the driver
writes, so what lost or repeated tasks leave is never read.

Reading. Files are partitions, and are read member by member. Continuations are grouped by the identifier of their origin, ordered by number and checked against the
total length; then the transfer framing is decoded, and the digest of the payload compared with that in the header. Records without continuations aren't shuffled. What fails is told in `problem`, not dropped.
Revisits find their response by digest.

Defined cases: a null payload is an empty one; a null id has no header and is smaller than all ids; rows of one id and one payload are all responses, as are all rows of a payload that has only null ids; texts of any length;
a missing segment, a wrong length, broken framing or another digest give a null digest and length and a problem; a revisit without its response has a null length; an empty table gives an empty table; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from quillon.llm.common import cut, name, scratch_path, split_join

#: Bytes of a segment's block, of a chunk of the transfer framing, and of a file from which on the next one begins.
SEGMENT, CHUNK, FILE = 8192, 4096, 64 << 20
DATE = "2020-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_LINE = b"\r\n"
_MANIFEST = "_files-"
RECORD = "kind string, id string, headers map<string,string>, content binary"


def digest(payload: bytes) -> str:
    """SHA-1 in base32."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def store(path: str) -> tuple[arrow_fs.FileSystem, str]:
    """File system and path in it."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return arrow_fs.FileSystem.from_uri(path) if "://" in path else (arrow_fs.LocalFileSystem(), path)


# records


def member(kind: str, headers: dict[str, str | None], block: bytes) -> bytes:
    """A record as a gzip member."""
    head = [f"WARC-Type: {kind}", *[f"{k}: {v}" for k, v in headers.items() if v is not None], f"Content-Length: {len(block)}"]
    pack = zlib.compressobj(3, zlib.DEFLATED, 31)
    return pack.compress(b"WARC/1.1\r\n" + _LINE.join(h.encode() for h in head) + 2 * _LINE + block + 2 * _LINE) + pack.flush()


def framed(payload: bytes, chunk: int) -> bytes:
    """Chunked transfer framing."""
    return b"".join(b"%x\r\n%b\r\n" % (len(x), x) for x in (payload[i : i + chunk] for i in range(0, len(payload), chunk))) + b"0\r\n\r\n"


def unframed(body: bytes) -> bytes | None:
    """What framed() took; extensions of chunks and trailers are left out. None: broken."""
    out, at = [], 0
    while True:
        end = body.find(_LINE, at)
        size = re.fullmatch(rb"[ \t]*([0-9A-Fa-f]{1,15})[ \t]*(;.*)?", body[at:end], re.DOTALL) if end >= 0 else None
        if not size:
            return None
        n, at = int(size[1], 16), end + 2
        if not n:
            break
        if body[at + n : at + n + 2] != _LINE:
            return None
        out.append(body[at : at + n])
        at += n + 2
    while (end := body.find(_LINE, at)) != at:  # trailers
        if end < 0:
            return None
        at = end + 2
    return b"".join(out)


def uri(url: str | None, page: int | None) -> str:
    return "".join(c if "!" <= c <= "~" and c not in "<>" else "".join(f"%{b:02X}" for b in c.encode()) for c in url) if url else f"urn:page:{page}"


def page_members(page: int | None, url: str | None, html: str | None, revisit_of: int | None, target: str | None, segment: int, chunk: int) -> Iterator[bytes]:
    """The records of a page; revisit_of: the page whose response has the payload."""
    payload = (html or "").encode()
    own = {"WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>", "WARC-Date": DATE, "WARC-Target-URI": uri(url, page), "WARC-Payload-Digest": f"sha1:{digest(payload)}", "X-Page-Id": None if page is None else str(page)}
    http = {"Content-Type": "application/http; msgtype=response"}
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    if revisit_of is not None:
        yield member("revisit", own | http | {"WARC-Profile": PROFILE, "WARC-Refers-To-Target-URI": uri(target, revisit_of), "WARC-Refers-To-Date": DATE, "X-Refers-To-Page-Id": str(revisit_of)}, head)
        return
    block = head + framed(payload, chunk)
    parts = [block[i : i + segment] for i in range(0, len(block), segment)]
    yield member("response", own | http | {"WARC-Segment-Number": "1" if len(parts) > 1 else None}, parts[0])
    for k, part in enumerate(parts[1:], 2):
        more = {"WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>", "WARC-Date": DATE, "WARC-Target-URI": own["WARC-Target-URI"], "WARC-Segment-Number": str(k), "WARC-Segment-Origin-ID": own["WARC-Record-ID"]}
        yield member("continuation", more | {"WARC-Segment-Total-Length": str(len(block)) if k == len(parts) else None}, part)


def records(stream: io.BufferedIOBase) -> Iterator[tuple[str, str | None, dict[str, str], bytes]]:
    """(kind, id, headers by names in small letters, block) of each record of an unpacked archive."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        headers, last = {}, None
        while (line := stream.readline()).strip():
            text = line.decode("utf-8", "replace").rstrip("\r\n")
            if text[0] in " \t" and last:  # goes on from the line before
                headers[last] += " " + text.strip()
                continue
            k, _, v = text.partition(":")
            last = k.strip().lower()
            headers[last] = v.strip()
        n = int(headers["content-length"])
        block = stream.read(n)
        if len(block) < n:
            raise ValueError(f"the archive ends within a record: {headers}")
        yield headers.get("warc-type", ""), headers.get("warc-record-id"), headers, block


# source and sink


@dataclass
class Written(WriterCommitMessage):
    files: list[str] = field(default_factory=list)


@dataclass
class Archive(InputPartition):
    path: str


class Writer(DataSourceArrowWriter):
    """Rows (page_id, url, html, revisit_of, target) to archives."""

    def __init__(self, options: dict) -> None:
        self.path, self.segment, self.chunk, self.file = options["path"], int(options.get("segment", SEGMENT)), int(options.get("chunk", CHUNK)), int(options.get("file", FILE))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        where, root = store(self.path)
        where.create_dir(root, recursive=True)
        out, sink, size = Written(), None, 0
        for b in iterator:
            for row in zip(*(b.column(c) for c in ("page_id", "url", "html", "revisit_of", "target")), strict=True):
                if sink is None or size >= self.file:
                    if sink:
                        sink.close()
                    file = f"pages-{uuid.uuid4().hex}.warc.gz"
                    sink, size = where.open_output_stream(f"{root}/{file}", compression=None), 0
                    out.files.append(file)
                    sink.write(member("warcinfo", {"WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>", "WARC-Date": DATE, "WARC-Filename": file, "Content-Type": "application/warc-fields"}, b"software: quillon\r\nformat: WARC File Format 1.1\r\n"))
                for x in page_members(*(v.as_py() for v in row), self.segment, self.chunk):
                    sink.write(x)
                    size += len(x)
        if sink:
            sink.close()
        return out

    def commit(self, messages: list[Written | None]) -> None:
        where, root = store(self.path)
        where.create_dir(root, recursive=True)
        with where.open_output_stream(f"{root}/{_MANIFEST}{uuid.uuid4().hex}.json", compression=None) as f:
            f.write(json.dumps([x for m in messages if m for x in m.files]).encode())

    def abort(self, messages: list[Written | None]) -> None:
        where, root = store(self.path)
        for x in (x for m in messages if m for x in m.files):
            where.delete_file(f"{root}/{x}")


class Reader(DataSourceReader):
    """Records of the archives that lists of files name, or of all archives of a folder without a list, or of one file."""

    def __init__(self, path: str) -> None:
        self.path = path

    def partitions(self) -> list[Archive]:
        where, root = store(self.path)
        if where.get_file_info(root).is_file:
            return [Archive(self.path)]
        found = [i.base_name for i in where.get_file_info(arrow_fs.FileSelector(root)) if i.is_file]
        lists = [f for f in found if f.startswith(_MANIFEST)]
        names = [f for f in found if re.search(r"\.warc(\.gz)?$", f)]
        if lists:
            names = []
            for f in lists:
                with where.open_input_stream(f"{root}/{f}", compression=None) as x:
                    names += json.loads(x.read())
        return [Archive(f"{self.path.rstrip('/')}/{f}") for f in sorted(names)] or [Archive("")]

    def read(self, part: Archive) -> Iterator[pa.RecordBatch]:
        if not part.path:
            return
        where, own = store(part.path)
        rows, size = [], 0
        with where.open_input_stream(own, compression=None) as raw:
            plain = io.BufferedReader(raw, 1 << 20)
            for r in records(io.BufferedReader(gzip.GzipFile(fileobj=plain), 1 << 16) if plain.peek(2)[:2] == b"\x1f\x8b" else plain):
                rows.append(r)
                size += len(r[3]) + 500
                if size > 4_000_000:
                    yield _batch(rows)
                    rows, size = [], 0
        if rows:
            yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kind, ids, headers, content = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(kind, pa.string()), pa.array(ids, pa.string()), pa.array([list(h.items()) for h in headers], pa.map_(pa.string(), pa.string())), pa.array(content, pa.binary())], ["kind", "id", "headers", "content"])


class Source(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return RECORD

    def reader(self, schema) -> DataSourceReader:
        return Reader(self.options["path"])

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return Writer(dict(self.options))


def write(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html", least: int = 0, **options: int) -> None:
    """Archives of the pages in the folder path. least: bytes of a payload from which on equal ones are revisits; options: segment, chunk, file."""
    pages.sparkSession.dataSource.register(Source)
    rows = pages.select(F.col(name(page_id)).cast("long").alias("page_id"), F.col(name(url)).cast("string").alias("url"), F.coalesce(F.col(name(html)).cast("string"), F.lit("")).alias("html"))
    key = F.concat(F.sha1("html"), F.lit(" "), F.octet_length("html"))
    # a row for each payload that several pages have; a payload with a third of all pages is a row of each task before
    same = rows.select(key.alias("key"), "page_id", "url", F.octet_length("html").alias("n")).where(F.col("n") >= least)
    same = cut(same.groupBy("key").agg(F.max("page_id").alias("top"), F.max_by("url", "page_id").alias("target"), F.count("*").alias("k")).where("k > 1 AND top IS NOT NULL").drop("k"), "payloads")
    # the table's size is known, so Spark broadcasts it if it is small; if not, it splits partitions of frequent payloads, as nothing after the join needs them whole
    placed = rows.withColumn("key", key).join(same, "key", "left")
    revisit = F.col("top").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("top"))
    out = placed.select("page_id", "url", "html", F.when(revisit, F.col("top")).alias("revisit_of"), F.when(revisit, F.col("target")).alias("target"))
    out.write.format("warc").mode("append").options(path=path, **options).save()


# putting together


def _payloads(with_payload: bool):
    """Rows (page_id, kind, payload_bytes, payload_digest, refers_to, problem[, payload]) of first records with their segments."""

    def checked(kind: str, headers: dict[str, str], segments: list[dict]) -> tuple[bytes | None, str | None]:
        segments = sorted(segments, key=lambda s: s["number"])
        if [s["number"] for s in segments] != list(range(1, len(segments) + 1)):
            return None, "segments are missing or repeated"
        block = b"".join(s["content"] for s in segments)
        total = segments[-1]["total"]
        if (total is None) != (headers.get("warc-segment-number") is None) or total is not None and total != len(block):
            return None, "another total length"
        head, gap, body = block.partition(2 * _LINE)
        if not gap:
            return None, "no HTTP response"
        if re.search(rb"(?i)^transfer-encoding:[^\r\n]*\bchunked[ \t]*\r?$", head, re.MULTILINE) and kind != "revisit":
            body = unframed(body)
            if body is None:
                return None, "broken transfer framing"
        stated = headers.get("warc-payload-digest")
        if kind != "revisit" and stated and stated.removeprefix("sha1:") != digest(body):
            return None, "another digest"
        return body, None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for kind, headers, segments in zip(*(b.column(i) for i in range(3)), strict=True):
                kind, headers = kind.as_py(), dict(headers.as_py() or ())
                payload, problem = checked(kind, headers, segments.as_py())
                page, to = headers.get("x-page-id"), headers.get("x-refers-to-page-id")
                revisit = kind == "revisit"
                stated = headers.get("warc-payload-digest", "").removeprefix("sha1:") or None
                good = problem is None
                rows.append((int(page) if page else None, kind, len(payload) if good and not revisit else None, (stated if revisit else digest(payload)) if good else None, int(to) if to else None, problem) + ((None if revisit else payload),) * with_payload)
            types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), *[pa.binary()] * with_payload]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], ["page_id", "kind", "payload_bytes", "payload_digest", "refers_to", "problem", *["payload"] * with_payload])

    return run


def assemble(found: DataFrame, with_payload: bool = False) -> DataFrame:
    """(page_id, kind, payload_bytes, payload_digest, refers_to, problem[, payload]) of each response and revisit of the records; those in segments are put together."""
    held = found.where(F.col("kind").isin("response", "revisit", "continuation"))
    h = lambda k: F.element_at("headers", F.lit(k))
    number = F.coalesce(h("warc-segment-number").cast("int"), F.lit(1))
    segment = F.struct(number.alias("number"), h("warc-segment-total-length").cast("long").alias("total"), "content")
    alone = h("warc-segment-number").isNull()
    whole = held.where(alone).select("kind", "headers", F.array(segment).alias("segments"))
    first = F.col("kind") != "continuation"
    origin = F.when(first, F.col("id")).otherwise(h("warc-segment-origin-id"))
    parts = held.where(~alone).select(origin.alias("origin"), F.when(first, F.col("kind")).alias("kind"), F.when(first, F.map_entries("headers")).alias("headers"), segment.alias("segment"))
    parts = parts.groupBy("origin").agg(F.max("kind").alias("kind"), F.map_from_entries(F.coalesce(F.max("headers"), F.array().cast("array<struct<key:string,value:string>>"))).alias("headers"), F.collect_list("segment").alias("segments"))
    parts = parts.select(F.coalesce("kind", F.lit("continuation")).alias("kind"), "headers", "segments")
    schema = "page_id long, kind string, payload_bytes long, payload_digest string, refers_to long, problem string" + ", payload binary" * with_payload
    return whole.union(parts).mapInArrow(_payloads(with_payload), schema)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The archives' records."""
    spark.dataSource.register(Source)
    return spark.read.format("warc").load(path)


def resolved(pages: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, problem): assemble()'s rows, revisits with the length of their response's payload."""
    by_digest = ["payload_digest", "refers_to"]
    again = pages.where("kind = 'revisit'")
    asked = again.groupBy(*by_digest).agg(F.count("*").alias("k"))
    known = pages.where("kind <> 'revisit' AND problem IS NULL").select("payload_digest", F.col("page_id").alias("refers_to"), F.col("payload_bytes").alias("n")).distinct()
    known = cut(asked.join(known, by_digest, "left"), "responses")
    done = split_join(again.drop("payload_bytes"), known, by_digest, "k", again.count())
    done = done.select("page_id", F.col("n").alias("payload_bytes"), "payload_digest", "kind", "refers_to", F.when(F.col("n").isNull(), "no response").otherwise(F.col("problem")).alias("problem"))
    rest = pages.where("kind <> 'revisit'").select("page_id", "payload_bytes", "payload_digest", "kind", "refers_to", "problem")
    return done.union(rest).withColumnRenamed("kind", "record_type")


def round_trip(df: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", least: int = 0, **options: int) -> DataFrame:
    """df's pages through archives in the shared folder and back."""
    where = scratch_path(df.sparkSession, "archives")
    write(df, where, page_id, url, html, least, **options)
    return resolved(cut(assemble(read(df.sparkSession, where)), "pages"))
