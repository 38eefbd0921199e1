"""WARC archives: write pages as records, index them first, read selected records by coalesced ranges.

Archives are gzip files with one member per record, so that any record can be read by itself. The
index (Parquet) has a row per record: file, offset, length, URL, page_id, digest. It lists only files
of task attempts that Spark committed. Reading starts from index rows, never from the archives: the
rows are dealt by file and stretch of offsets, sorted, and neighbouring records are fetched in one read.

Of pages with equal payloads the one with the smallest page_id is the ``response``, the others are
``revisit`` records that name it; pages whose payload is smaller than ``min_revisit`` bytes are all
responses.

Cases: a null html is an empty payload, a null URL an empty one. A null page_id never counts as the
smallest unless all are null; rows that share the smallest page_id are all responses. An empty table
gives no archive and an empty index. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm import common

# Salts that spread the rows of one payload over tasks.
_SALTS = 16
# Records closer than this are fetched in one read, up to so many bytes a read.
_GAP_BYTES, _READ_BYTES = 64 << 10, 4 << 20
# Stretch of a file that one group of index rows covers.
_STRETCH_BYTES = 32 << 20
_DATE = "1970-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_INDEX = "file string, offset long, length long, url string, page_id long, payload_digest string"
_RECORD = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, "
    "payload binary"
)


def with_record_types(pages: DataFrame, min_revisit: int = 0) -> DataFrame:
    """Add payload, its SHA-1 in hex, record_type and refers_to to (page_id, url, html).

    Only payloads that occur more than once are joined back, salted, so that a payload that a third of
    all pages share meets in no single task.
    """
    payload = pages.select(
        "page_id", F.coalesce("url", F.lit("")).alias("url"), F.encode(common.text_or_empty("html"), "UTF-8").alias("payload")
    ).withColumn("sha1", F.sha1("payload"))
    firsts = (
        payload.filter(F.octet_length("payload") >= min_revisit)
        .groupBy("sha1")
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("copies"))
        .filter("copies > 1")
        .select("sha1", "first_id", common.salts(_SALTS).alias("salt"))
    )
    salted = payload.withColumn("salt", common.salt_of("page_id", "url", salts=_SALTS))
    repeats = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return salted.join(firsts, ["sha1", "salt"], "left").select(
        "page_id",
        "url",
        "payload",
        "sha1",
        F.when(repeats, "revisit").otherwise("response").alias("record_type"),
        F.when(repeats, F.col("first_id")).alias("refers_to"),
    )


def write_archives(pages: DataFrame, folder: str, min_revisit: int = 0) -> DataFrame:
    """Write a record per page into archives under ``folder`` and return the index."""

    def write(batches: Iterator) -> Iterator:
        import uuid

        import pandas as pd
        from pyspark import TaskContext

        name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
        stream, offset = None, 0
        for batch in batches:
            if stream is None and len(batch):
                system, path = common.file_system(folder)
                system.create_dir(path, recursive=True)
                stream = system.open_output_stream(f"{path}/{name}", compression=None)
                offset = stream.write(_member(_warcinfo()))
            rows = []
            for page_id, url, payload, sha1, kind, refers in zip(
                batch["page_id"], batch["url"], batch["payload"], batch["sha1"], batch["record_type"], batch["refers_to"]
            ):
                page_id, refers = (None if pd.isna(x) else int(x) for x in (page_id, refers))
                digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                length = stream.write(_member(record(page_id, url, payload, digest, kind, refers)))
                rows.append((name, offset, length, url, page_id, digest))
                offset += length
            out = pd.DataFrame(rows, columns=["file", "offset", "length", "url", "page_id", "payload_digest"])
            yield out.astype({"page_id": "Int64"})
        if stream:
            stream.close()

    typed = with_record_types(pages, min_revisit)
    typed.mapInPandas(write, _INDEX).write.mode("overwrite").parquet(f"{folder}/index")
    return read_index(pages.sparkSession, folder)


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(_INDEX).parquet(f"{folder}/index")


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """The records that the rows of ``index`` select, with the payload of responses.

    The digest of a response is computed from the payload as read; a revisit has none to read and gives
    the one in its header.
    """

    def read(batches: Iterator) -> Iterator:
        for batch in batches:
            spans = list(zip(batch["offset"].tolist(), batch["length"].tolist()))
            yield from frames(folder, batch["file"].tolist(), spans)

    stretch = F.floor(F.col("offset") / _STRETCH_BYTES)
    dealt = index.repartition("file", stretch).sortWithinPartitions("file", "offset")
    return dealt.select("file", "offset", "length").mapInPandas(read, _RECORD)


def frames(folder: str, names: list[str], spans: list[tuple[int, int]]) -> Iterator:
    """Records at (offset, length) in the named files, which are sorted, as frames of ``_RECORD``.

    Index rows are small, records are not: a frame is handed on as soon as it fills a read.
    """
    import pandas as pd

    def frame(rows: list) -> pd.DataFrame:
        found = pd.DataFrame(rows, columns=[x.split()[0] for x in _RECORD.split(", ")])
        return found.astype({"page_id": "Int64", "refers_to": "Int64"})

    system, path = common.file_system(folder)
    rows, held = [], 0
    for a, b in coalesced(names, spans):
        with system.open_input_file(f"{path}/{names[a]}") as stream:
            begin = spans[a][0]
            block = stream.read_at(spans[b - 1][0] + spans[b - 1][1] - begin, begin)
        for offset, length in spans[a:b]:
            plain = zlib.decompress(block[offset - begin : offset - begin + length], 31)
            rows.append(parse(plain))
            held += len(plain)
            if held >= _READ_BYTES:
                yield frame(rows)
                rows, held = [], 0
    yield frame(rows)


def coalesced(names: list[str], spans: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Runs of sorted records, as index ranges, that are close enough to be fetched in one read."""
    at = 0
    for k in range(1, len(spans) + 1):
        if k < len(spans) and names[k] == names[at]:
            before, (offset, length) = sum(spans[k - 1]), spans[k]
            if offset - before <= _GAP_BYTES and offset + length - spans[at][0] <= _READ_BYTES:
                continue
        yield at, k
        at = k


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(3, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _head(fields: list[tuple[str, object]]) -> bytes:
    return "".join(["WARC/1.1\r\n", *(f"{k}: {v}\r\n" for k, v in fields), "\r\n"]).encode()


def _warcinfo() -> bytes:
    body = b"format: WARC File Format 1.1\r\n"
    fields = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", "<urn:page:archive>"), ("WARC-Date", _DATE)]
    return _head([*fields, ("Content-Type", "application/warc-fields"), ("Content-Length", len(body))]) + body + b"\r\n\r\n"


def _uri(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def _page(uri: str) -> int | None:
    number = uri[len("<urn:page:") : -1]
    return None if number == "null" else int(number)


def record(page_id: int | None, url: str, payload: bytes, digest: str, kind: str, refers_to: int | None) -> bytes:
    """One record; a revisit keeps the HTTP head, which states the payload's length, and drops the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if kind == "revisit" else http + payload
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", _uri(page_id)),
        ("WARC-Date", _DATE),
        ("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
    ]
    if kind == "revisit":
        fields += [("WARC-Refers-To", _uri(refers_to)), ("WARC-Profile", _PROFILE)]
    fields += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", len(block))]
    return _head(fields) + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple:
    """A row of ``_RECORD`` from a record's bytes."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    kind, digest, refers = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:"), None
    size = int(http.rpartition(b"Content-Length: ")[2])
    if kind == "revisit":
        payload, refers = None, _page(fields["WARC-Refers-To"])
    else:
        digest, size = base64.b32encode(hashlib.sha1(payload).digest()).decode(), len(payload)
    return _page(fields["WARC-Record-ID"]), fields["WARC-Target-URI"], size, digest, kind, refers, payload
