"""WARC archives: records written per capture, read back and assembled into one row per capture."""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import re
import uuid
import zlib
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillage.llm.common import hold, tasks
from tillage.session import fresh_path, materialize

FILE_BYTES = 256 << 20  # a task starts another file beyond this
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value of the format
_RECORDS = ("path string, kind string, record_id string, concurrent_to array<string>, refers_to string, url string, date string, content_type string, "
            "payload_bytes long, payload_digest string, intact boolean, http string, fields map<string,string>, payload binary")
_KINDS = {"string": pa.string(), "array<string>": pa.list_(pa.string()), "long": pa.int64(), "boolean": pa.bool_(), "map<string,string>": pa.map_(pa.string(), pa.string()), "binary": pa.binary()}
_FIELDS = re.findall(r"(\w+) ([\w<>]+(?:,string>)?)", _RECORDS)


def record(kind: str, record_id: str, headers: list[tuple[str, str | None]], block: bytes) -> bytes:
    """One record as a gzip member of its own."""
    head = [f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{record_id}>", *(f"{k}: {v}" for k, v in headers if v is not None), f"Content-Length: {len(block)}"]
    plain = "\r\n".join(["WARC/1.1", *head, "", ""]).encode() + block + b"\r\n\r\n"
    packer = zlib.compressobj(4, zlib.DEFLATED, 31)
    return packer.compress(plain) + packer.flush()


def _named(capture: str, kind: str) -> str:
    return str(uuid.UUID(hashlib.md5(f"{capture} {kind}".encode()).hexdigest()))


def _capture_records(row: dict, date: str) -> bytes:
    """Request, response or revisit, and metadata of one capture."""
    url = row["url"]
    safe = None if url is None else quote(url, safe="".join(map(chr, range(0x21, 0x7F))))
    capture, body = row["capture"], row["payload"]
    own, request, extra = (_named(capture, k) for k in ("response", "request", "metadata"))
    to = ("WARC-Concurrent-To", f"<urn:uuid:{own}>")
    base = [("WARC-Date", date), ("WARC-Target-URI", safe)]
    rest = re.sub(r"^[^:/?#]*://", "", safe or "")
    host = re.match(r"[^/?#]*", rest)[0]
    asked = f"GET {rest[len(host):].split('#')[0] or '/'} HTTP/1.1\r\nHost: {host}\r\n\r\n".encode()
    answer = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n".encode()
    http = ("Content-Type", "application/http; msgtype=response")
    digest = ("WARC-Payload-Digest", f"sha256:{row['digest']}")
    if row["original"] is None:
        main = record("response", own, [*base, digest, http], answer + body)
    else:
        main = record("revisit", own, [*base, digest, http, ("WARC-Profile", IDENTICAL), ("WARC-Refers-To", f"<urn:uuid:{_named(row['original'], 'response')}>")], answer)
    fields = {"pageId": row["page_id"], "copies": str(row["copies"]), "sourceUrl": json.dumps(url) if url != safe else None}
    notes = "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None).encode()
    return record("request", request, [*base, to, ("Content-Type", "application/http; msgtype=request")], asked) + main + record(
        "metadata", extra, [*base, to, ("Content-Type", "application/warc-fields")], notes)


def write_warc(pages: DataFrame, folder: str, id_col: str = "page_id", url: str = "url", payload: str = "html", least: int = 100, date: str = "1970-01-01T00:00:00Z", file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes a request, a response or revisit, and a metadata record per row of ``pages`` as
    ``.warc.gz`` files under ``folder`` (a URI or path that all executors reach) and returns the
    written index: path, records.

    Of rows with equal payloads of at least ``least`` bytes those with the smallest id hold the
    payload, the others are revisits that refer to one of them. A row without id counts as
    larger than all others. A null payload is empty. Rows equal in id, url and payload are one
    capture that notes its number of copies. Record ids follow from id, url and payload, and a
    file's name has the attempt in it, so repeated tasks leave no mixed data: the index
    names the files that count. Other columns are ignored; an empty table writes no file.
    """
    spark = pages.sparkSession
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b"").cast("binary"))
    base = pages.select(F.col(id_col).cast("string").alias("page_id"), F.col(id_col).alias("rank"), F.col(url).alias("url"), body.alias("payload")).withColumn(
        "digest", F.sha2("payload", 256)).withColumn("capture", F.md5(F.to_json(F.struct("page_id", "url", "digest"))))
    held = base.groupBy("capture").agg(F.first(F.struct("page_id", "url", "digest", "payload")).alias("row"), F.count("*").alias("copies"))

    # a payload that many rows share is counted in parts, and joined in parts
    light = base.where(F.length("payload") >= least).select(
        "capture", "digest", F.struct(F.col("rank").isNull().alias("none"), "rank", "url", "capture").alias("who"), F.pmod(F.xxhash64("capture"), F.lit(tasks(spark))).alias("part"))
    parts = light.groupBy("digest", "part").agg(F.min("who").alias("who"), F.count("*").alias("n"))
    shared = parts.groupBy("digest").agg(F.min("who").alias("first"), F.sum("n").alias("n")).where("n > 1").drop("n")
    originals = materialize(parts.select("digest", "part").join(shared, "digest"), "warc-originals")
    again = light.join(originals, ["digest", "part"]).where("NOT (who.rank <=> first.rank)").select("capture", F.col("first.capture").alias("original")).distinct()
    rows = held.join(materialize(again, "warc-revisits"), "capture", "left").select("capture", "row.*", F.col("copies"), "original")

    def write(batches):
        hold("warc")
        context = TaskContext.get()
        sink, path, count, held, made, done = None, None, 0, 0, 0, []
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                for row in batch.slice(at, 64).to_pylist():
                    if sink is None:
                        fs, root = pafs.FileSystem.from_uri(folder)
                        fs.create_dir(root, recursive=True)
                        name = f"part-{context.partitionId():06d}-{context.taskAttemptId()}-{made:04d}.warc.gz"
                        path, sink, count, held = f"{folder}/{name}", fs.open_output_stream(f"{root}/{name}", compression=None), 0, 0
                        made += 1
                        sink.write(record("warcinfo", _named(name, "info"), [("WARC-Date", date), ("WARC-Filename", name), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
                    data = _capture_records(row, date)
                    sink.write(data)
                    held += len(data)
                    count += 3
                    if held >= file_bytes:
                        sink.close()
                        done.append((path, count))
                        sink = None
        if sink is not None:
            sink.close()
            done.append((path, count))
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in done], pa.string()), pa.array([n for _, n in done], pa.int64())], names=["path", "records"])

    return materialize(rows.mapInArrow(write, "path string, records long"), "warc-index")


def list_warc(spark, folder: str) -> DataFrame:
    """The archives of a folder, to be read: path. Spark lists them, their contents are not loaded."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.warc*").option("recursiveFileLookup", "true").load(folder).select("path")


def parse_records(stream):
    """(headers, block) of each record of a stream; header names in lower case, repeated ones in lists."""
    while True:
        line = stream.readline()
        while line in (b"\r\n", b"\n"):
            line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        headers: dict[str, list[str]] = {}
        last = None
        while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
            text = line.decode("utf-8", "replace").rstrip("\r\n")
            if text[:1] in " \t" and last:  # a folded line
                headers[last][-1] += " " + text.strip()
                continue
            last, _, value = text.partition(":")
            last = last.strip().lower()
            headers.setdefault(last, []).append(value.strip())
        if "content-length" not in headers:
            raise ValueError("a record has no Content-Length")
        size = int(headers["content-length"][0])
        block = stream.read(size)
        if len(block) < size:
            raise ValueError("a record ends before its Content-Length")
        yield headers, block


def _bare(value: str | None) -> str | None:
    return value.strip("<>") if value else None


def _parsed(path: str, headers: dict, block: bytes, bodies: bool) -> tuple:
    one = lambda k: headers.get(k, [None])[0]
    kind, content = one("warc-type"), one("content-type")
    http, payload = None, block
    if content and content.startswith("application/http"):
        cut = block.find(b"\r\n\r\n")
        http, payload = block[: cut if cut >= 0 else len(block)].decode("latin-1"), block[cut + 4 :] if cut >= 0 else b""
    fields = None
    if content and content.startswith("application/warc-fields"):
        fields = [(k.strip(), v.strip()) for k, s, v in (x.partition(":") for x in block.decode("utf-8", "replace").split("\r\n")) if s]
        fields = list(dict(fields).items())
    declared = one("warc-payload-digest")
    declared = declared.partition(":")[2] if declared and declared.startswith("sha256:") else declared
    size, digest, intact = len(payload), None, None
    if kind == "revisit":
        size, digest, payload = None, declared, None
    elif kind in ("response", "resource"):
        digest = hashlib.sha256(payload).hexdigest()
        intact = declared is None or declared == digest
    return (path, kind, _bare(one("warc-record-id")), [_bare(x) for x in headers.get("warc-concurrent-to", [])], _bare(one("warc-refers-to")), _bare(one("warc-target-uri")),
            one("warc-date"), content, size, digest, intact, http, fields, payload if bodies else None)


def read_warc(files: DataFrame, bodies: bool = True) -> DataFrame:
    """One row per record of the archives that ``files`` (path) names: kind, record_id,
    concurrent_to, refers_to, url, date, content_type, payload_bytes, payload_digest (SHA-256 of
    the payload; of a revisit, as declared), intact (the digest is the declared one), http (head
    of the message), fields (of ``application/warc-fields``) and payload (null without ``bodies``).

    Files are read as streams, gzipped or plain, so one record is in memory at a time. A broken
    record ends the job with the reason.
    """

    def read(batches):
        hold("warc")

        def table(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, _KINDS[k]) for c, (_, k) in zip(zip(*rows), _FIELDS)], names=[n for n, _ in _FIELDS])

        for batch in batches:
            for path in batch.column("path").to_pylist():
                fs, name = pafs.FileSystem.from_uri(re.sub("^file:/+", "/", path))
                with fs.open_input_stream(name, compression=None, buffer_size=1 << 20) as raw:
                    stream = io.BufferedReader(gzip.GzipFile(fileobj=raw) if name.endswith(".gz") else raw, 1 << 20)
                    rows, held = [], 0
                    for headers, block in parse_records(stream):
                        rows.append(_parsed(path, headers, block, bodies))
                        held += 500 + (len(block) if bodies else 0)
                        if held > 4 << 20:
                            yield table(rows)
                            rows, held = [], 0
                    if rows:
                        yield table(rows)

    return files.select("path").repartition(tasks(files.sparkSession)).mapInArrow(read, _RECORDS)


def assemble_captures(records: DataFrame) -> DataFrame:
    """One nested row per capture: the columns of its response, revisit or resource record, with
    requests (record_id, http) and metadata (maps of fields).

    A request or metadata record belongs to a capture if either names the other in its
    WARC-Concurrent-To, or if it does so with the capture's request. Records that belong to none are
    left out; a capture without them has empty lists.
    """
    main = records.where("kind IN ('response', 'revisit', 'resource')")
    links = records.select(F.col("record_id").alias("a"), F.explode("concurrent_to").alias("b"))
    edges = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    near = edges.join(main.select(F.col("record_id").alias("a")), "a").select(F.col("b").alias("side"), F.col("a").alias("capture"), F.lit(0).alias("far"))
    over = edges.join(near.select(F.col("side").alias("a"), "capture"), "a").where("b <> capture").select(F.col("b").alias("side"), "capture", F.lit(1).alias("far"))
    owner = near.unionAll(over).groupBy("side").agg(F.min(F.struct("far", "capture")).alias("o")).select(F.col("side").alias("record_id"), F.col("o.capture").alias("capture"))
    sides = records.where("kind IN ('request', 'metadata')").join(owner, "record_id")
    packed = sides.groupBy("capture").agg(
        F.sort_array(F.collect_list(F.when(F.col("kind") == "request", F.struct("record_id", "http")))).alias("requests"),
        F.collect_list(F.when(F.col("kind") == "metadata", F.col("fields"))).alias("metadata"))
    joined = main.join(packed.withColumnRenamed("capture", "record_id"), "record_id", "left")
    return joined.select(
        "record_id", "kind", "url", "date", "refers_to", "payload_bytes", "payload_digest", "intact", "http", "payload",
        F.coalesce("requests", F.array().cast("array<struct<record_id:string,http:string>>")).alias("requests"),
        F.coalesce("metadata", F.array().cast("array<map<string,string>>")).alias("metadata"))


def warc_captures(pages: DataFrame, folder: str | None = None, bodies: bool = False, **options) -> DataFrame:
    """Writes the archives, reads them back and returns one row per row of ``pages``: page_id,
    payload_bytes, payload_digest, record_type, refers_to (the page_id of the response that a
    revisit refers to) and capture (the nested row)."""
    files = write_warc(pages, folder or fresh_path(pages.sparkSession, "warc"), **options)
    records = materialize(read_warc(files, bodies), "warc-records")
    captures = materialize(assemble_captures(records), "warc-captures")
    note = lambda k: F.get(F.col("metadata"), F.lit(0))[k]
    told = captures.select(
        "record_id", "refers_to", note("pageId").cast("long").alias("page_id"), note("copies").cast("long").alias("copies"), "kind", "payload_bytes", "payload_digest",
        F.struct(*captures.columns).alias("capture"))
    response = told.where("kind = 'response'").select(F.col("record_id").alias("refers_to"), F.col("page_id").alias("original"), F.col("payload_bytes").alias("bytes"))
    # a response that a third of all pages refer to is one row; the other side is split where it is large
    found = told.join(response, "refers_to", "left").select(
        "page_id", F.coalesce("payload_bytes", "bytes").alias("payload_bytes"), "payload_digest", F.col("kind").alias("record_type"), F.col("original").alias("refers_to"), "copies", "capture")
    runs = F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / 4096))
    spread = found.withColumn("run", F.explode(runs)).withColumn("one", F.explode(F.array_repeat(F.lit(1), F.least(F.lit(4096), F.col("copies") - F.col("run") * 4096).cast("int"))))
    return spread.drop("run", "one", "copies")
