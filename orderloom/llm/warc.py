"""WARC archives: a deterministic sharded writer and its reader.

Rows are sorted by range of their key, so a shard holds a run of keys and the shards together are in order. Within a shard a task streams
its records, one gzip member each, and starts a new file when the compressed size reaches ``roll_bytes``. Ids, headers and digests
are made anew from the payload, never from the clock or chance: the same rows give the same bytes, whatever was lost and run again.
A file is written under a temporary name and renamed; the manifest, which Spark commits last, lists the files that count.
Equal payloads are stored once: the record with the smallest key is a response, the others revisit it. Which key is first for a payload
comes from an aggregate over digests; it meets the payloads by sorting both together, so payloads are shuffled once.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm.bpe import SLICE
from orderloom.llm.common import cut_lineage, partitions, shared_folder
from orderloom.llm.files import Committed, filesystem

#: Fixed values of the format.
VERSION = b"WARC/1.1\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
MANIFEST = "file string, first_key long, records long, payload_bytes long, file_bytes long, file_sha256 string"
RECORD = "key long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary, file string"


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(key, digest: str, copy: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE, f'{key}/{digest}/{copy}')}>"


def _gzip(data: bytes) -> bytes:
    """One member without name or time."""
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeeze.compress(data) + squeeze.flush()


def _record(kind: str, key, url: str | None, payload: bytes, digest: str, date: str, copy: int, first) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + payload if kind == "response" else http
    headers = [("WARC-Type", kind), ("WARC-Record-ID", _record_id(key, digest, copy)), ("WARC-Date", date)]
    if url is not None:
        # White space and controls would break the header line; such a url is escaped, percent signs too, and marked.
        plain = all(c > " " and c.isprintable() for c in url)
        headers.append(("WARC-Target-URI", url if plain else quote(url, safe=":/?#[]@!$&'()*+,;=")))
        headers += [] if plain else [("X-Escaped-URI", "1")]
    headers += [
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{_digest(block)}"),
        ("X-Payload-Length", str(len(payload))),
    ]
    if key is not None:
        headers.append(("X-Key", str(key)))
    if kind == "revisit":
        headers.append(("WARC-Profile", PROFILE))
        if first is not None:
            headers += [("WARC-Refers-To", _record_id(first, digest, 0)), ("X-Refers-To-Key", str(first))]
    headers.append(("Content-Length", str(len(block))))
    return VERSION + "".join(f"{name}: {value}\r\n" for name, value in headers).encode() + b"\r\n" + block + b"\r\n\r\n"


def write(
    pages: DataFrame,
    folder: str,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    least_bytes: int = 0,
    roll_bytes: int = 256 << 20,
    date: str = "2026-01-01T00:00:00Z",
    tasks: int | None = None,
) -> DataFrame:
    """Write one record per row below ``folder`` and return the manifest.

    Null payloads count as empty. Payloads below ``least_bytes`` are always responses. Repeated keys: rows are ordered by key, digest and url, and of rows with
    the first key of a payload only the first is a response. Null keys come first in the files but are never the first key of a payload that
    also has one; payloads that only have null keys are a response once and revisits without target after. An empty table gives an empty manifest.
    Other columns are not stored.
    """
    spark = pages.sparkSession
    body = F.coalesce(F.col(payload).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(key).cast("long").alias("key"), F.col(url).cast("string").alias("url"), body.alias("payload"))
    seen = cut_lineage(rows.select("key", F.sha1("payload").alias("digest"), F.length("payload").alias("size")).where(F.col("size") >= least_bytes), "digests")
    first = seen.groupBy("digest").agg(F.min("key").alias("first"), F.count("*").alias("copies")).where("copies > 1")
    decisions = cut_lineage(seen.join(first, "digest").select("key", "digest", "first").distinct(), "revisits")
    both = rows.select("key", "url", "payload", F.sha1("payload").alias("digest"), F.lit(None).cast("long").alias("first"), F.lit(1).alias("kind")).unionByName(
        decisions.select("key", F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"), "digest", "first", F.lit(0).alias("kind"))
    )
    dealt = both.repartitionByRange(tasks or partitions(spark), "key").sortWithinPartitions("key", "digest", "kind", "url")

    # Over Arrow, not pandas: there a whole number beside nulls becomes a double, exact to 2**53 only.
    def run(parts: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        shard, number = TaskContext.get().partitionId(), 0
        out = facts = None
        entry = last = None
        copy = 0

        def closed():
            out.commit()
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
            values = [pa.array([x], kind) for x, kind in zip([*facts[:4], out.size, facts[4].hexdigest()], kinds, strict=True)]
            return pa.RecordBatch.from_arrays(values, names=[c.split()[0] for c in MANIFEST.split(", ")])

        slices = (whole.slice(at, SLICE) for whole in parts for at in range(0, whole.num_rows, SLICE))
        for part in slices:
            for k, u, data, digest, leader, kind in zip(*(part.column(c).to_pylist() for c in ("key", "url", "payload", "digest", "first", "kind")), strict=True):
                if kind == 0:
                    entry = (k, digest, leader)
                    continue
                shared = entry is not None and entry[:2] == (k, digest)
                copy = copy + 1 if last == (k, digest) else 0
                last = (k, digest)
                revisit = shared and (entry[2] != k or copy > 0)
                b32 = base64.b32encode(bytes.fromhex(digest)).decode()
                record = _gzip(_record("revisit" if revisit else "response", k, u, data, b32, date, copy, entry[2] if revisit else None))
                if out is not None and out.size + len(record) > roll_bytes:
                    yield closed()
                    out, number = None, number + 1
                if out is None:
                    name = f"shard-{shard:05d}-{number:05d}.warc.gz"
                    out, facts = Committed(f"{folder}/{name}"), [name, k, 0, 0, hashlib.sha256()]
                out.write(record)
                facts[2] += 1
                facts[3] += len(data)
                facts[4].update(record)
        if out is not None:
            yield closed()

    manifest = dealt.mapInArrow(run, MANIFEST)
    manifest.write.mode("overwrite").parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def _members(stream) -> Iterator[bytes]:
    """The members of a gzip file, one by one."""
    unzip, pieces, rest = zlib.decompressobj(31), [], b""
    while chunk := rest or stream.read(1 << 20):
        pieces.append(unzip.decompress(chunk))
        rest = b""
        if unzip.eof:
            yield b"".join(pieces)
            unzip, pieces, rest = zlib.decompressobj(31), [], unzip.unused_data
    if any(pieces):
        raise ValueError("the archive ends within a record")


def read(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """The records of the archives that the manifest lists, their digests checked; a damaged record is an error.

    ``payload`` is null for revisits and, with ``with_payload=False``, for all.
    """
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [c.split()[0] for c in RECORD.split(", ")]
        for part in parts:
            for name in part["file"]:
                system, path = filesystem(f"{folder}/{name}")
                rows, size = [], 0
                with system.open_input_stream(path, compression=None) as stream:
                    for member in _members(stream):
                        head, _, block = member.partition(b"\r\n\r\n")
                        lines = head.decode().split("\r\n")
                        field = dict(line.split(": ", 1) for line in lines[1:])
                        block = block[: int(field["Content-Length"])]
                        digest = field["WARC-Payload-Digest"].removeprefix("sha1:")
                        data = block.partition(b"\r\n\r\n")[2] if field["WARC-Type"] == "response" else None
                        if f"sha1:{_digest(block)}" != field["WARC-Block-Digest"] or (data is not None and _digest(data) != digest):
                            raise ValueError(f"damaged record {field['WARC-Record-ID']} in {name}")
                        url = field.get("WARC-Target-URI")
                        url = unquote(url) if "X-Escaped-URI" in field else url
                        whole, of = field.get("X-Key"), field.get("X-Refers-To-Key")
                        rows.append(
                            (whole and int(whole), url, field["WARC-Type"], int(field["X-Payload-Length"]), digest, of and int(of), data if with_payload else None, name)
                        )
                        size += len(block)
                        if size > 16 << 20:
                            yield pd.DataFrame(rows, columns=columns, dtype=object)
                            rows, size = [], 0
                if rows:
                    yield pd.DataFrame(rows, columns=columns, dtype=object)

    files = manifest.select("file").repartition(partitions(spark))
    return files.mapInPandas(run, RECORD)


def archive(pages: DataFrame, **options) -> str:
    """Write to a new folder of the cluster's shared one; returns it."""
    folder = shared_folder(pages.sparkSession, "warc")
    write(pages, folder, **options)
    return folder
