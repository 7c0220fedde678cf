"""WARC archives: written with an index first, read back by sorted byte ranges.

A task writes one archive into the shared folder, each record a gzip member,
and hands out where each record lies. Spark commits these index rows, so an
archive left by a lost task is never named. Readers take the index rows of the
records wanted, sort them by place, and join near ones to one read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagedframes.llm.common import cut
from pagedframes.storage import new_folder

#: payloads under this many bytes are always written
REVISIT_BYTES = 1000
#: bytes between two records that are rather read than skipped, and the most of one read unless a record is larger
GAP, RANGE = 1 << 16, 1 << 23
#: bytes of an archive that a task reads, about
PIECE = 1 << 24
DATE = "2000-01-01T00:00:00Z"

_INDEX = "file string, offset bigint, length bigint, page_id bigint, url string, digest string, record_type string"
_RECORDS = "page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string, payload binary"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_URI = re.compile(r"<urn:page:(-?\d+|none)>")


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with the scheme of its file system, which tasks need."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    uri = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return re.sub("^file:/+", "file:///", uri)


def classify(pages: DataFrame) -> DataFrame:
    """``pages`` with ``payload`` (UTF-8 html, null: empty), ``sha1``, ``refers_to`` and ``record_type``.

    Only payloads that occur more than once make up the joined side, which is
    small unless much of the corpus repeats; sorting and splitting is Spark's.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("bigint"), "url", payload.alias("payload"))
    rows = rows.withColumns({"sha1": F.sha1("payload"), "sha2": F.sha2("payload", 256), "size": F.octet_length("payload")})
    large = rows.filter(F.col("size") >= REVISIT_BYTES).groupBy("sha2")
    repeated = large.agg(F.max("page_id").alias("last"), F.count("*").alias("n")).filter("n > 1").drop("n")
    found = rows.join(repeated, "sha2", "left")
    again = F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last"))
    return found.select(
        "page_id",
        "url",
        "payload",
        "sha1",
        F.when(again, F.col("last")).alias("refers_to"),
        F.when(again, "revisit").otherwise("response").alias("record_type"),
    )


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _record(page_id, url, payload: bytes, sha1: str, refers_to, kind: str) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + (payload if kind == "response" else b"")
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_name(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        # a line end in a url would end its line
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20%]", lambda m: f"%{ord(m[0]):02X}", url))
    lines.append("WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(sha1)).decode())
    if kind == "revisit":
        lines += [f"WARC-Refers-To: {_name(refers_to)}", f"WARC-Profile: {_PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def _write(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    name = f"{folder}/part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
    store, path = fs.FileSystem.from_uri(name)
    with store.open_output_stream(path, compression=None) as out:
        offset = 0
        for batch in batches:
            places = []
            for row in batch.to_pylist():
                member = gzip.compress(
                    _record(row["page_id"], row["url"], row["payload"], row["sha1"], row["refers_to"], row["record_type"]),
                    mtime=0,
                )
                out.write(member)
                places.append((offset, len(member)))
                offset += len(member)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([name] * len(places), pa.string()),
                    *(pa.array([p[k] for p in places], pa.int64()) for k in (0, 1)),
                    *(batch[c] for c in ("page_id", "url", "sha1", "record_type")),
                ],
                names=["file", "offset", "length", "page_id", "url", "digest", "record_type"],
            )


def write_archives(pages: DataFrame) -> DataFrame:
    """Write a WARC record for each row of ``pages`` (``page_id, url, html``) and return the index, itself a table.

    Of equal payloads of at least ``REVISIT_BYTES``, that with the largest
    ``page_id`` is a response and the others revisit it; rows that share that
    id are all responses. A null ``page_id`` is smaller than any and written as
    ``none``, a null url is left out, null html is an empty payload. No rows
    give an empty index. Other columns are not read.
    """
    spark = pages.sparkSession
    folder = qualified(spark, new_folder(spark, "warc"))
    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(path)
    return cut(classify(pages).mapInArrow(partial(_write, folder=folder), _INDEX), "warc-index")


def _ranges(places: list[tuple[int, int]]) -> Iterator[list[tuple[int, int]]]:
    """Sorted places in runs that are read at once."""
    run: list[tuple[int, int]] = []
    for offset, length in places:
        if run and (offset - sum(run[-1]) > GAP or offset + length - run[0][0] > RANGE):
            yield run
            run = []
        run.append((offset, length))
    if run:
        yield run


def parse(member: bytes) -> tuple:
    """``page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload``; raises if damaged."""
    head, _, block = gzip.decompress(member).partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    http, _, rest = block[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    size = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    kind = fields["WARC-Type"]
    if kind == "response" and (len(rest) != size or hashlib.sha1(rest).hexdigest() != digest):
        raise ValueError(f"record {fields['WARC-Record-ID']} is damaged")
    one, other = (_URI.fullmatch(fields.get(k, "<urn:page:none>"))[1] for k in ("WARC-Record-ID", "WARC-Refers-To"))
    url = fields.get("WARC-Target-URI")
    url = url and re.sub("%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)) if int(m[1], 16) <= 32 or m[1] == "25" else m[0], url)
    number = lambda x: None if x == "none" else int(x)
    return number(one), url, kind, number(other), size, digest, rest if kind == "response" else None


def _read(batches: Iterator[pa.RecordBatch], payload: bool) -> Iterator[pa.RecordBatch]:
    schema = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    for batch in batches:
        by_file: dict[str, list[tuple[int, int]]] = {}
        for file, offset, length in zip(*(batch[c].to_pylist() for c in ("file", "offset", "length")), strict=True):
            by_file.setdefault(file, []).append((offset, length))
        for file, places in by_file.items():
            store, path = fs.FileSystem.from_uri(file)
            with store.open_input_file(path) as held:
                for run in _ranges(places):
                    first = run[0][0]
                    data = held.read_at(sum(run[-1]) - first, first)
                    rows = [parse(data[o - first : o - first + n]) for o, n in run]
                    columns = [[r[k] if k < 6 or payload else None for r in rows] for k in range(7)]
                    arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays(arrays, names=schema)


def read_records(index: DataFrame, payload: bool = True) -> DataFrame:
    """The records that the rows of ``index`` name, parsed and checked; a revisit has no payload of its own.

    Tasks are cut by the bytes of the archives, ``PIECE`` or so each, not by
    the rows of the index, which are far smaller than what they stand for.
    """
    total = index.agg(F.sum("length")).first()[0] or 0
    piece = F.floor(F.col("offset") / PIECE)
    places = index.select("file", "offset", "length").repartition(max(1, -(-total // PIECE)), "file", piece)
    return places.sortWithinPartitions("file", "offset").mapInArrow(partial(_read, payload=payload), _RECORDS)
