"""WARC archives with revisit resolution.

Record headers (id, digest, size) are shuffled by payload digest; of equal
payloads of at least ``min_bytes`` the record with the largest id is the
original response, the others become revisit records that name it.  Decisions
are joined back to the pages by id, so a payload that a third of all pages
share is never gathered anywhere.  Every task writes its archives with fresh
headers, one gzip member per record, and renames them when whole.
"""

from __future__ import annotations

import base64
import hashlib
import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourglass.llm.common import LONG_MAX, partitions, prepare, shared_dir, store

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def resolve_revisits(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                     min_bytes: int = 1000) -> DataFrame:
    """Per distinct (id, payload): ``_id, _sha, _bytes, _orig, _orig_url``;
    ``_orig`` is null for responses.  Null payloads are empty; rows without id
    revisit the largest id of their group, or stay responses if it has none."""
    body = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    heads = pages.select(
        F.col(id_col).cast("long").alias("_id"), F.col(url_col).alias("_url"),
        F.sha1(body).alias("_sha"), F.octet_length(body).cast("long").alias("_bytes"),
    )
    groups = (
        heads.filter(F.col("_bytes") >= min_bytes)
        .groupBy("_sha", "_bytes")  # partial aggregation folds copies before the exchange
        .agg(F.max("_id").alias("_orig"), F.max_by("_url", F.coalesce("_id", F.lit(-LONG_MAX))).alias("_orig_url"),
             F.count(F.lit(1)).alias("_n"))
        .filter("_n > 1").drop("_n")
    )
    same = F.col("_id").eqNullSafe(F.col("_orig"))
    return (
        heads.drop("_url").distinct().join(groups, ["_sha", "_bytes"], "left")
        .select("_id", "_sha", "_bytes",
                F.when(~same, F.col("_orig")).alias("_orig"), F.when(~same, F.col("_orig_url")).alias("_orig_url"))
    )


def _record(kind: str, uri: str, url: str, date: str, sha: str, block: bytes, extra: list[tuple[str, str]]) -> bytes:
    clean = " ".join((url or "").split())
    digest = base64.b32encode(bytes.fromhex(sha)).decode()
    head = [
        ("WARC-Type", kind), ("WARC-Record-ID", f"<{uri}>"), ("WARC-Date", date), ("WARC-Target-URI", clean),
        ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha1:{digest}"),
        *extra, ("Content-Length", str(len(block))),
    ]
    raw = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n"
    gz = zlib.compressobj(6, zlib.DEFLATED, 31)
    return gz.compress(raw.encode("utf-8") + block + b"\r\n\r\n") + gz.flush()


def record_uri(page_id, sha: str) -> str:
    return f"urn:x-page:{'' if page_id is None else page_id}:{sha}"


def write_warc(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
               min_bytes: int = 1000, date: str = "2024-01-01T00:00:00Z", file_bytes: int = 16_000_000,
               path: str | None = None) -> DataFrame:
    """Write the archives; returns the stored manifest ``path, n_records``.

    Null payload: empty; null url: empty target.  Of rows repeating id and
    payload (adjacent in a task) the first is the response.  Digests are taken
    from the payloads as written.
    """
    spark = prepare(pages)
    base = path or shared_dir(spark, "warc")

    def write(batches):
        import pyarrow as pa
        from pyarrow import fs as pafs
        from pyspark import TaskContext

        ctx = TaskContext.get()
        fs, root = pafs.FileSystem.from_uri(base)
        fs.create_dir(root, recursive=True)
        serial, out, n, last = 0, None, 0, None

        def close():
            nonlocal serial, out, n
            out.close()
            file = f"{root}/part-{ctx.partitionId():06d}-{serial:06d}.warc.gz"
            fs.move(f"{file}.{ctx.taskAttemptId()}.part", file)
            row = pa.RecordBatch.from_arrays(
                [pa.array([f"{base}/{file.rsplit('/', 1)[1]}"]), pa.array([n], "int64")], ["path", "n_records"])
            serial, out, n = serial + 1, None, 0
            return row

        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("_id", "_url", "_body", "_sha", "_orig", "_orig_url")]
            for page, url, body, sha, orig, orig_url in zip(*cols):
                if out is None:
                    out = fs.open_output_stream(f"{root}/part-{ctx.partitionId():06d}-{serial:06d}.warc.gz.{ctx.taskAttemptId()}.part", compression=None)
                body = body.encode("utf-8")
                http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n"
                again = len(body) >= min_bytes and last == (page, sha)
                if orig is None and not again:
                    rec = _record("response", record_uri(page, sha), url, date, sha, http.encode() + body, [])
                else:
                    target = (page, url) if orig is None else (orig, orig_url)
                    rec = _record("revisit", record_uri(page, sha) + ":revisit", url, date, sha, http.encode(), [
                        ("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{record_uri(target[0], sha)}>"),
                        ("WARC-Refers-To-Target-URI", " ".join((target[1] or "").split()))])
                out.write(rec)
                n, last = n + 1, (page, sha)
                if out.tell() >= file_bytes:
                    yield close()
        if out is not None:
            yield close()

    # payloads are exchanged once: dealt by (id, digest), joined and sorted where they are
    # a missing id is a key of its own, apart from every real one
    key, none = F.coalesce("_id", F.lit(0).cast("long")), F.col("_id").isNull()
    decided = resolve_revisits(pages, id_col, url_col, payload_col, min_bytes).select(
        key.alias("_key"), none.alias("_none"), "_sha", "_orig", "_orig_url")
    text = F.coalesce(F.col(payload_col), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("_id"), F.col(url_col).alias("_url"), text.alias("_body"),
                        F.sha1(text.cast("binary")).alias("_sha")).withColumns({"_key": key, "_none": none})
    dealt = (
        rows.repartition(partitions(spark), "_key", "_none", "_sha").join(decided, ["_key", "_none", "_sha"])
        .sortWithinPartitions("_key", "_none", "_sha").select("_id", "_url", "_body", "_sha", "_orig", "_orig_url")
    )
    return store(dealt.mapInArrow(write, "path string, n_records long"), "warc-manifest")


SLICE = 1 << 16  # bytes given to a decompressor at a time


def parse_records(stream):
    """Records ``(headers, block)`` of a gzip-member WARC stream (bytes chunks).
    A member is inflated once, wherever chunks end."""
    z, parts, begun = zlib.decompressobj(31), [], False
    for chunk in stream:
        at = 0
        while at < len(chunk):
            piece = chunk[at : at + SLICE]
            parts.append(z.decompress(piece))
            at += len(piece) - len(z.unused_data)
            begun = True
            if z.eof:
                yield _parsed(b"".join(parts))
                z, parts, begun = zlib.decompressobj(31), [], False
    if begun:
        raise ValueError("archive ends inside a record")


def _parsed(raw: bytes):
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    size = int(fields["Content-Length"])
    if len(rest) != size + 4:
        raise ValueError("record length does not match Content-Length")
    return fields, rest[:size]


def read_warc(manifest: DataFrame, with_payload: bool = False) -> DataFrame:
    """Records of the archives: ``page_id, url, payload_bytes, payload_digest,
    record_type, refers_to`` and, if asked, ``payload`` (null for revisits).
    A response whose payload does not have its digest raises."""
    prepare(manifest)
    schema = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
              + (", payload binary" if with_payload else ""))

    def read(batches):
        import pyarrow as pa
        from pyarrow import fs as pafs

        def page(uri):
            part = uri.strip("<>").split(":")[2]
            return int(part) if part else None

        for batch in batches:
            for path in batch.column("path").to_pylist():
                fs, file = pafs.FileSystem.from_uri(path)
                rows = []
                with fs.open_input_stream(file, compression=None) as f:
                    for h, block in parse_records(iter(lambda: f.read(1 << 22), b"")):
                        sha = base64.b32decode(h["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                        http, _, payload = block.partition(b"\r\n\r\n")
                        size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.startswith(b"Content-Length:"))
                        kind = h["WARC-Type"]
                        if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != sha):
                            raise ValueError(f"payload of {h['WARC-Record-ID']} does not match its digest")
                        row = (page(h["WARC-Record-ID"]), h["WARC-Target-URI"], size, sha, kind,
                               page(h["WARC-Refers-To"]) if kind == "revisit" else None)
                        rows.append(row + (payload if kind == "response" else None,) if with_payload else row)
                types = ["int64", "string", "int64", "string", "string", "int64", "binary"]
                names = [x.split()[0] for x in schema.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), types)], names)

    n = partitions(manifest.sparkSession)
    return manifest.select("path").repartition(n, "path").mapInArrow(read, schema)
