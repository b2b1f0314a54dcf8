"""Web archives: written with an index, read back by coalesced byte ranges.

Every task writes its records as gzip members into files of its own in a
shared folder and returns one index row per record: file, offset, length, URL
and digest. Names are new for each attempt, so a task that runs again never
touches what another wrote, and only files named in the index count. Reading
starts from index rows: sorted by file and offset, near ranges are merged into
single reads of bounded size.

Payloads with the same digest and at least `least` bytes are stored once, for
the smallest page id; the others become revisit records. Defined results: a
null payload is empty; a null page id comes after all others; repeated rows of
the smallest id are all responses; a null URL is an empty one; no pages give
an empty index.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusgraph.functions.scale import checkpoint_root, cut_light as cut
from corpusgraph.llm.common import BINARY, LONG, STRING, bounded_batches, record

INDEX = record(page_id=LONG, url=STRING, record_type=STRING, digest=STRING, file=STRING, offset=LONG, length=LONG)
RECORD = record(page_id=LONG, url=STRING, record_type=STRING, digest=STRING, refers_to=LONG, payload=BINARY)

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FILE_BYTES = 256 << 20
READ_BYTES = 8 << 20
#: Bytes of archives that one task reads, about.
TASK_BYTES = 64 << 20
GAP_BYTES = 64 << 10
_END = b"\r\n\r\n"


def _open(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder) if "://" in folder else (pafs.LocalFileSystem(), folder)


def mark_revisits(pages: DataFrame, page_id: str, url: str, payload: str, least: int) -> DataFrame:
    """page_id, url, body, digest, refers_to (null for responses).

    Digests are counted on narrow rows; only digests that occur twice are joined back.
    """
    body = F.coalesce(F.col(f"`{payload}`").cast("string"), F.lit(""))
    rows = pages.select(F.col(f"`{page_id}`").cast("long").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"), body.alias("body"))
    rows = rows.withColumn("digest", F.sha2("body", 256))
    large = rows.filter(F.octet_length("body") >= least)
    shared = large.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    out = rows.join(cut(shared), "digest", "left")
    again = F.col("first").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") > F.col("first")))
    return out.select("page_id", "url", "body", "digest", F.when(again, F.col("first")).alias("refers_to"))


def _member(page_id: int | None, url: str | None, body: str, digest: str, refers_to: int | None, date: str) -> bytes:
    payload = body.encode()
    kind = "response" if refers_to is None else "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    fields = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}:{digest}')}>",
        f"WARC-Date: {date}",
        "WARC-Target-URI: " + re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", url or ""),
        f"WARC-Payload-Digest: sha256:{digest}",
    ]
    if page_id is not None:
        fields.append(f"X-Page-ID: {page_id}")
    if refers_to is not None:
        fields += [f"WARC-Profile: {PROFILE}", f"X-Refers-To-Page-ID: {refers_to}"]
    fields += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    packer = zlib.compressobj(3, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(fields).encode() + _END + block + _END) + packer.flush()


def parse(member: bytes) -> tuple[int | None, str, str, str, int | None, bytes | None]:
    """page_id, url, record_type, digest, refers_to, payload (null for revisits) of one gzip member."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(_END)
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    kind = fields["WARC-Type"]
    page, refers = fields.get("X-Page-ID"), fields.get("X-Refers-To-Page-ID")
    return (
        int(page) if page else None, fields["WARC-Target-URI"], kind, fields["WARC-Payload-Digest"].removeprefix("sha256:"),
        int(refers) if refers else None, block.partition(_END)[2] if kind == "response" else None,
    )


def write_archives(
    pages: DataFrame, *, page_id: str = "page_id", url: str = "url", payload: str = "html", least: int = 100,
    folder: str | None = None, date: str = "2024-01-01T00:00:00Z",
) -> DataFrame:
    """Write every page as a record below a shared `folder`; return the index, itself a written table."""
    spark = pages.sparkSession
    bounded_batches(spark)
    folder = folder or f"{checkpoint_root(spark)}/warc-{uuid.uuid4().hex}"
    rows = mark_revisits(pages, page_id, url, payload, least)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _open(folder)
        store.create_dir(base, recursive=True)
        out, name, at = None, "", 0
        try:
            for batch in batches:
                index = []
                for row in batch.to_pylist():
                    if out is None or at >= FILE_BYTES:
                        if out is not None:
                            out.close()
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = store.open_output_stream(f"{base}/{name}", compression=None)
                    data = _member(row["page_id"], row["url"], row["body"], row["digest"], row["refers_to"], date)
                    out.write(data)
                    kind = "response" if row["refers_to"] is None else "revisit"
                    index.append({**{k: row[k] for k in ("page_id", "url", "digest")}, "record_type": kind, "file": name, "offset": at, "length": len(data)})
                    at += len(data)
                yield pa.RecordBatch.from_pylist(index, schema=_arrow(INDEX))
        finally:
            if out is not None:
                out.close()

    index = cut(rows.mapInArrow(write, INDEX))
    return index.withColumn("folder", F.lit(folder))


def _arrow(kind) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(kind)


def read_records(selected: DataFrame) -> DataFrame:
    """Records of the selected index rows: page_id, url, record_type, digest, refers_to, payload."""
    bounded_batches(selected.sparkSession)
    rows = selected.select("folder", "file", "offset", "length")
    # Index rows are narrow: what they stand for says how many tasks read, and a task takes a run of places.
    size = rows.agg(F.count("*").alias("n"), F.sum("length").alias("bytes")).first()
    tasks = max(-(-(size["bytes"] or 0) // TASK_BYTES), rows.sparkSession.sparkContext.defaultParallelism)
    order = ["folder", "file", "offset"]
    rows = rows.repartitionByRange(max(1, min(tasks, size["n"])), *order).sortWithinPartitions(*order)
    schema = _arrow(RECORD)

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
        """Index rows whose bytes are read at once."""
        group: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if group:
                    end = max(r["offset"] + r["length"] for r in group[-1:])
                    same = (row["folder"], row["file"]) == (group[0]["folder"], group[0]["file"])
                    if not same or row["offset"] - end > GAP_BYTES or row["offset"] + row["length"] - group[0]["offset"] > READ_BYTES:
                        yield group
                        group = []
                group.append(row)
        if group:
            yield group

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, source = None, None
        for group in ranges(batches):
            here = (group[0]["folder"], group[0]["file"])
            if here != name:
                store, base = _open(here[0])
                if source is not None:
                    source.close()
                name, source = here, store.open_input_file(f"{base}/{here[1]}")
            first = group[0]["offset"]
            data = source.read_at(group[-1]["offset"] + group[-1]["length"] - first, first)
            found, held = [], 0
            for row in group:
                found.append(parse(data[row["offset"] - first : row["offset"] - first + row["length"]]))
                held += len(found[-1][5] or b"")
                if held > READ_BYTES:
                    yield _batch(found, schema)
                    found, held = [], 0
            yield _batch(found, schema)
        if source is not None:
            source.close()

    return rows.mapInArrow(read, RECORD)


def _batch(found: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*found, strict=True)) or [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
