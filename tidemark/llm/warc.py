"""WARC archives: written with revisit records for equal payloads, read back by splits.

Archives are plain (uncompressed) WARC/1.1, so any byte range can be searched for records. The
text WARC/1.1 inside a payload looks like the start of a record to a task that sees only part of
a file; which candidates are records is settled by following the chain from the file's start.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import new_path, written

MAGIC = b"WARC/1.1\r\n"
#: Bytes read past a range for the headers that begin in it; more are read where one is longer.
LOOK = 65536
#: Where parse_header says that the block starts if the bytes at hand don't end a header.
MORE = -1
MOST_TASKS = 20_000
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"


def record(page_id: int | None, url: str | None, payload: bytes, size: int, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One record. A revisit has the HTTP header only; its length and digest are the payload's."""
    block = _HTTP % size + (b"" if revisit else payload)
    head = [b"WARC/1.1", b"WARC-Type: " + (b"revisit" if revisit else b"response"), b"WARC-Record-ID: <urn:page:%s>" % str(page_id).encode(), b"WARC-Date: 1970-01-01T00:00:00Z"]
    if url is not None:
        head.append(b"WARC-Target-URI: " + re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", url).encode())
    head.append(b"WARC-Payload-Digest: sha256:" + digest.encode())
    if revisit:
        head += [b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", b"WARC-Refers-To: <urn:page:%d>" % refers_to]
    head += [b"Content-Type: application/http; msgtype=response", b"Content-Length: %d" % len(block)]
    return b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_header(data: bytes, at: int, whole: bool = True) -> tuple[dict[str, str], int] | None:
    """The fields of the header at `at`, and where its block starts; None if it isn't a header.
    the block starts at MORE if it may be one but ends after the data, unless that is whole."""
    if not data.startswith(MAGIC, at):
        return None
    fields, at = {}, at + len(MAGIC)
    while not data.startswith(b"\r\n", at):
        end = data.find(b"\r\n", at)
        if end < 0:
            return None if whole else (fields, MORE)
        name, colon, value = data[at:end].partition(b":")
        if not colon:
            return None
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
        at = end + 2
    return (fields, at + 2) if fields.get("content-length", "").isdecimal() else None


def candidates(data: bytes, base: int, start: int, end: int, size: int) -> dict[int, int] | None:
    """Offset of each possible record that begins in [start, end), with that of its successor;
    None if a header may go on after the data."""
    found, at, whole = {}, data.find(MAGIC), base + len(data) >= size
    while 0 <= at and base + at < end:
        head = parse_header(data, at, whole) if base + at >= start else None
        if head and head[1] == MORE:
            return None
        if head:
            follow = base + head[1] + int(head[0]["content-length"]) + 4
            if follow <= size:
                found[base + at] = follow
        at = data.find(MAGIC, at + 1)
    return found


def leaving(found: dict[int, int], end: int) -> dict[int, int]:
    """For each candidate, where its chain leaves the range that ends at `end`; chains that
    lead to no candidate are left out."""
    out: dict[int, int] = {}
    for at in sorted(found, reverse=True):
        follow = found[at]
        if follow >= end:
            out[at] = follow
        elif follow in out:
            out[at] = out[follow]
    return out


#: Hadoop's names of file systems that are called otherwise here.
_SCHEMES = {"s3a": "s3", "s3n": "s3"}


def uri(path: str) -> str:
    """A path as Hadoop writes it, as pyarrow reads it."""
    scheme, colon, rest = path.partition(":")
    if colon and scheme in _SCHEMES:
        return f"{_SCHEMES[scheme]}://{rest.lstrip('/')}"
    return f"file:///{rest.lstrip('/')}" if colon and scheme == "file" else path


def _open(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri(path))


def _writer(folder: str, file_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        system, inner = _open(folder)
        system.create_dir(inner, recursive=True)
        out, path, at, n, made = None, "", 0, 0, []

        def close():
            if out is not None:
                out.close()
                made.append((path, at, n))

        for batch in batches:
            cols = [batch.column(i) for i in range(batch.num_columns)]
            for i in range(batch.num_rows):
                page_id, url, html, size, digest, refers_to = (c[i].as_py() for c in cols)
                if out is None or at >= file_bytes:
                    close()
                    name = f"{uuid.uuid4().hex}.warc"
                    path, at, n, out = f"{folder}/{name}", 0, 0, system.open_output_stream(f"{inner}/{name}")
                data = record(page_id, url, html or b"", size, digest, refers_to, refers_to is not None)
                out.write(data)
                at, n = at + len(data), n + 1
        close()
        yield pa.RecordBatch.from_pydict({"path": [x[0] for x in made], "size": [x[1] for x in made], "records": [x[2] for x in made]}, schema=pa.schema([("path", pa.string()), ("size", pa.int64()), ("records", pa.int64())]))

    return write


def write_warc(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = 100, file_bytes: int = 1 << 30) -> DataFrame:
    """Writes a record for every row and returns the manifest (path, size, records).

    Of the rows with equal payloads of at least min_bytes bytes, those with the smallest id are
    response records; the others are revisits that refer to it. Smaller payloads are all
    responses. A null payload counts as empty; a null url leaves its field out, and control
    characters in urls are written as %XX; a null id is
    never the smallest, and rows of a group whose ids are all null are responses. Urls and
    payloads may be of any length.

    Each attempt of a task writes files of its own; the manifest, which is written as a table,
    names only those of attempts that succeeded. Payloads that repeat are found by digest, with
    counts combined before the shuffle; the decisions join the pages by digest, and by broadcast
    only if their written size is below Spark's threshold.
    """
    payload = F.coalesce(F.col(f"`{payload_col}`"), F.lit("")).cast("binary")
    rows = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"size": F.octet_length("payload").cast("long"), "digest": F.sha2("payload", 256)})
    large = rows.where(F.col("size") >= min_bytes)
    repeated = large.groupBy(F.unhex("digest").alias("key")).agg(F.count("*").alias("n"), F.min("page_id").alias("least")).where("n > 1 and least is not null").select("key", "least")
    repeated = written(repeated, "repeated")
    key = F.when(F.col("size") >= min_bytes, F.unhex("digest"))
    first = F.col("page_id").eqNullSafe(F.col("least"))
    told = rows.join(repeated, key == F.col("key"), "left").withColumn("refers_to", F.when(~first, F.col("least")))
    told = told.select("page_id", "url", F.when(F.col("refers_to").isNull(), F.col("payload")).alias("payload"), "size", "digest", "refers_to")
    return written(told.mapInArrow(_writer(folder, file_bytes), "path string, size long, records long"), "manifest")


def _scanner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, size, start, end in zip(*(batch.column(n).to_pylist() for n in ("path", "size", "start", "end"))):
            system, inner = _open(path)
            with system.open_input_file(inner) as f:
                if f.size() < size:
                    raise ValueError(f"{path} is shorter than its manifest says")
                look, found = LOOK, None
                while found is None:
                    f.seek(start)
                    found = candidates(f.read(min(size, end + look + len(MAGIC)) - start), start, start, end, size)
                    look *= 4
            out = leaving(found, end)
            yield pa.RecordBatch.from_pydict({"path": [path] * len(out), "at": list(out), "leaves": list(out.values()), "size": [size] * len(out)}, schema=pa.schema([("path", pa.string()), ("at", pa.int64()), ("leaves", pa.int64()), ("size", pa.int64())]))


_FIELDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def _reader(with_payload: bool, batch_bytes: int = 32 << 20):
    def page(name: str | None) -> int | None:
        inner = (name or "")[len("<urn:page:") : -1]
        return int(inner) if inner.lstrip("-").isdecimal() else None

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])
        rows, held = [], 0
        for batch in batches:
            for path, at, end in zip(*(batch.column(n).to_pylist() for n in ("path", "at", "end"))):
                system, inner = _open(path)
                with system.open_input_file(inner) as f:
                    base, data, size = at, b"", f.size()
                    while at < end:
                        look, whole = batch_bytes // 4, base + len(data) >= size
                        head = parse_header(data, at - base, whole) if whole or at + len(MAGIC) <= base + len(data) else ({}, MORE)
                        while head and head[1] == MORE:
                            f.seek(at)
                            base, data = at, f.read(look)
                            head, look = parse_header(data, 0, base + len(data) >= size), 4 * look
                        fields, block = head
                        length = int(fields["content-length"])
                        if block + length + 4 > len(data):
                            f.seek(at)
                            data, block, base = f.read(block - (at - base) + length + 4), block - (at - base), at
                        body = data[block : block + length]
                        if data[block + length : block + length + 4] != b"\r\n\r\n":
                            raise ValueError(f"{path}: the record at {at} isn't ended")
                        http, _, payload = body.partition(b"\r\n\r\n")
                        digest = fields["warc-payload-digest"].removeprefix("sha256:")
                        revisit = fields["warc-type"] == "revisit"
                        if not revisit and hashlib.sha256(payload).hexdigest() != digest:
                            raise ValueError(f"{path}: the payload at {at} doesn't have its digest")
                        n_bytes = int(http.rpartition(b"Content-Length: ")[2])
                        rows.append((page(fields["warc-record-id"]), fields.get("warc-target-uri"), n_bytes, digest, fields["warc-type"], page(fields.get("warc-refers-to")), payload if with_payload and not revisit else None))
                        held += len(rows[-1][6] or b"") + 200
                        at = base + block + length + 4
                        if held > batch_bytes:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)
                            rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)

    return read


def read_warc(manifest: DataFrame, split_bytes: int = 64 << 20, with_payload: bool = True) -> DataFrame:
    """The records of the archives of a manifest (path, size): page_id, url, payload_bytes,
    payload_digest, record_type, refers_to, payload (null for revisits, which have none).

    Files are searched by ranges of split_bytes. Each task links every candidate in its range to
    where its chain leaves the range; pointer jumping over the ranges' entries, from offset 0,
    keeps those that are reachable, in rounds that grow with the logarithm of a file's ranges.
    Each range is then read from its one reachable entry. Candidates inside payloads are on no
    chain from the start. A file whose chain doesn't end at its end raises an error, as does a
    payload without its digest. An empty manifest gives no rows.
    """
    splits = manifest.where("size > 0").select("path", "size", F.explode(F.sequence(F.lit(0), F.col("size") - 1, F.lit(split_bytes))).alias("start"))
    splits = splits.withColumn("end", F.least(F.col("start") + split_bytes, "size"))
    n = min(max(1, splits.count()), MOST_TASKS)
    tasks = splits.repartition(n, "path", "start")
    found = written(tasks.mapInArrow(_scanner, "path string, at long, leaves long, size long"), "candidates")
    entries = found.select("path", F.col("leaves").alias("at")).union(manifest.select("path", F.lit(0))).distinct()
    nodes = written(found.join(entries, ["path", "at"], "left_semi"), "entries")
    reached, jump = manifest.where("size > 0").select("path", F.lit(0).cast("long").alias("at")), nodes.select("path", "at", "leaves")
    while True:
        further = reached.join(jump, ["path", "at"]).select("path", F.col("leaves").alias("at"))
        reached = written(reached.union(further).distinct(), "reached")
        jump = written(jump.alias("x").join(jump.alias("y"), F.expr("x.path = y.path and x.leaves = y.at")).select("x.path", "x.at", "y.leaves"), "jump")
        if jump.isEmpty():
            break
    whole = reached.join(manifest, (reached.at == manifest.size) & (reached.path == manifest.path)).count()
    if whole != manifest.where("size > 0").count():
        raise ValueError("an archive's chain of records doesn't lead to its end")
    todo = reached.join(manifest.select("path", "size"), "path").where("at < size")
    todo = todo.select("path", "at", F.least((F.floor(F.col("at") / split_bytes) + 1) * split_bytes, F.col("size")).alias("end"))
    return todo.repartition(n, "path", "at").mapInArrow(_reader(with_payload), _FIELDS)


def archive_and_read(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", **options) -> DataFrame:
    """write_warc into a new folder of the shared one, then read_warc."""
    manifest = write_warc(pages, new_path(pages.sparkSession, "warc"), id_col, url_col, payload_col)
    return read_warc(manifest, **options)
