"""Web archives: writing them as one gzip stream each, and making such archives seekable.

Many tools compress an archive as a single gzip stream, from which no record can be read alone. `normalise` inflates
each stream once, piece by piece, writes every record as a gzip member of its own, and leaves a sidecar with the offset
and length of each member. `read_records` then reads members by the sidecars, in any order and split among all tasks.

Archives live in the shared folder that the caller names and are reached by pyarrow's file systems. A file is written
under the name of its attempt and renamed when complete, so a lost executor leaves no half archive.
"""

from __future__ import annotations

import hashlib
import json
import os
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laborlake.llm.common import tasks

#: Payloads of at least so many bytes are stored once.
REVISIT_BYTES = 1000
LEVEL = 3
PIECE = 1 << 20
RECORD_SCHEMA = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
GZIP = 31  # zlib's window bits for a gzip header


def plan_records(pages: DataFrame) -> DataFrame:
    """page_id, url, html, payload_bytes, payload_digest, refers_to (null for a response)."""
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        html.alias("html"),
        F.octet_length(html).cast("long").alias("payload_bytes"),
        F.sha1(html.cast("binary")).alias("payload_digest"),
    )
    large = rows.filter(F.col("payload_bytes") >= REVISIT_BYTES)
    repeated = (
        large.groupBy(F.col("payload_digest").alias("_digest"))
        .agg(F.max("page_id").alias("_response"), F.count(F.lit(1)).alias("_n"))
        .filter("_n > 1")
    )
    same = (F.col("payload_digest") == F.col("_digest")) & (F.col("payload_bytes") >= REVISIT_BYTES)
    other = ~F.col("page_id").eqNullSafe(F.col("_response"))
    return rows.join(repeated, same, "left").select(*rows.columns, F.when(other, F.col("_response")).alias("refers_to"))


def _uri(page_id) -> str:
    return f"<urn:x-page:{'none' if page_id is None else page_id}>"


def _page_of(uri: str | None) -> int | None:
    name = uri.rpartition(":")[2].rstrip(">") if uri else "none"
    return None if name == "none" else int(name)


def encode_record(page_id, url, html: str, digest: str, refers_to) -> bytes:
    """A response with its payload, or a revisit with the payload's length and digest alone."""
    payload = html.encode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_uri(page_id)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe='%/:=&?~#+!$,;@()*[]' + chr(39))}")
    if refers_to is not None:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: {_uri(refers_to)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(lines: bytes) -> dict[str, str]:
    fields = (x.partition(":") for x in lines.decode("utf-8", "replace").split("\r\n")[1:] if x)
    return {name.strip().lower(): value.strip() for name, _, value in fields}


def decode_record(data: bytes) -> tuple:
    """The row of RECORD_SCHEMA that a whole record holds; a digest that does not fit is an error."""
    head, _, rest = data.partition(b"\r\n\r\n")
    warc = _headers(head)
    http, _, payload = rest[: int(warc["content-length"])].partition(b"\r\n\r\n")
    digest, revisit = warc["warc-payload-digest"].removeprefix("sha1:"), warc["warc-type"] == "revisit"
    if revisit:
        length, payload = int(_headers(http)["content-length"]), None
    else:
        length = len(payload)
        if hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError(f"payload of {warc['warc-record-id']} does not fit its digest")
    page_id, refers_to = _page_of(warc["warc-record-id"]), _page_of(warc.get("warc-refers-to"))
    return page_id, warc.get("warc-target-uri"), length, digest, warc["warc-type"], refers_to, payload


def split_records(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """Whole records out of an archive's inflated bytes, holding one record and one piece at a time."""
    held = bytearray()
    for piece in pieces:
        held += piece
        while True:
            end = held.find(b"\r\n\r\n")
            if end < 0:
                break
            size = end + 4 + int(_headers(bytes(held[:end]))["content-length"]) + 4
            if len(held) < size:
                break
            yield bytes(held[:size])
            del held[:size]
    if held:
        raise ValueError("the archive ends inside a record")


def inflate(source) -> Iterator[bytes]:
    """The bytes of a gzip file of one or more members."""
    unzip = zlib.decompressobj(GZIP)
    while piece := source.read(PIECE):
        while piece:
            if unzip.eof:
                unzip = zlib.decompressobj(GZIP)
            yield unzip.decompress(piece)
            piece = unzip.unused_data
    if not unzip.eof:
        yield unzip.flush()
        if not unzip.eof:
            raise ValueError("the gzip stream is cut off")


def _member(data: bytes) -> bytes:
    zipper = zlib.compressobj(LEVEL, zlib.DEFLATED, GZIP)
    return zipper.compress(data) + zipper.flush()


def _complete(files: fs.FileSystem, made: str, name: str) -> None:
    files.move(made, name)


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """One monolithic archive per task below `folder`/raw; a row per archive: path, n_records."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, root = fs.FileSystem.from_uri(folder)
        files.create_dir(f"{root}/raw", recursive=True)
        task = TaskContext.get()
        name = f"{root}/raw/part-{task.partitionId():06d}.warc.gz"
        made, n = f"{name}.{task.taskAttemptId()}", 0
        with files.open_output_stream(made, compression=None) as out:
            zipper = zlib.compressobj(LEVEL, zlib.DEFLATED, GZIP)
            for batch in batches:
                for page_id, url, html, digest, refers_to in zip(
                    batch["page_id"], batch["url"], batch["html"], batch["payload_digest"], batch["refers_to"], strict=True
                ):
                    page_id, refers_to = (None if pd.isna(x) else int(x) for x in (page_id, refers_to))
                    out.write(zipper.compress(encode_record(page_id, url, html, digest, refers_to)))
                    n += 1
            out.write(zipper.flush())
        _complete(files, made, name)
        yield pd.DataFrame({"path": [os.path.basename(name)], "n_records": [n]})

    rows = plan_records(pages).select(
        F.coalesce(F.col("page_id").cast("string"), F.lit(None)).alias("page_id"),
        "url",
        "html",
        "payload_digest",
        F.col("refers_to").cast("string").alias("refers_to"),
    )
    return rows.mapInPandas(write, "path string, n_records long")


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """Every archive of `archives` (path below `folder`/raw) again, each record a member, with its sidecar.

    A sidecar is a file of JSON lines beside the archive: path, offset, length. A row per archive: path, n_records.
    """

    def rewrite(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, root = fs.FileSystem.from_uri(folder)
        for part in ("members", "index"):
            files.create_dir(f"{root}/{part}", recursive=True)
        attempt = TaskContext.get().taskAttemptId()
        for batch in batches:
            for path in batch["path"]:
                name, index = f"{root}/members/{path}", f"{root}/index/{path}.jsonl"
                made, n, offset = f"{name}.{attempt}", 0, 0
                made_index = f"{root}/index/.{path}.{attempt}"
                with (
                    files.open_input_stream(f"{root}/raw/{path}", compression=None) as source,
                    files.open_output_stream(made, compression=None) as out,
                    files.open_output_stream(made_index, compression=None) as places,
                ):
                    for record in split_records(inflate(source)):
                        member = _member(record)
                        out.write(member)
                        places.write(json.dumps({"path": path, "offset": offset, "length": len(member)}).encode() + b"\n")
                        offset, n = offset + len(member), n + 1
                _complete(files, made, name)
                _complete(files, made_index, index)
                yield pd.DataFrame({"path": [path], "n_records": [n]})

    spread = archives.select("path").repartition(tasks(archives.sparkSession))
    return spread.mapInPandas(rewrite, "path string, n_records long")


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """RECORD_SCHEMA for every record below `folder`, read member by member at the offsets of the sidecars."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, root = fs.FileSystem.from_uri(folder)
        columns = [x.split()[0] for x in RECORD_SCHEMA.split(", ")]
        for batch in batches:
            rows, held = [], 0
            for path, part in batch.groupby("path", sort=False):
                with files.open_input_file(f"{root}/members/{path}") as source:
                    for offset, length in zip(part["offset"], part["length"], strict=True):
                        source.seek(int(offset))
                        rows.append(decode_record(zlib.decompress(source.read(int(length)), GZIP)))
                        held += rows[-1][2] if rows[-1][-1] else 0
                        if held > 16 * PIECE:
                            yield _frame(rows, columns)
                            rows, held = [], 0
            if rows:
                yield _frame(rows, columns)

    places = spark.read.schema("path string, offset long, length long").json(f"{folder}/index")
    return places.mapInPandas(read, RECORD_SCHEMA)


def _frame(rows: list[tuple], columns: list[str]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=columns)
    return frame.astype({"page_id": "Int64", "refers_to": "Int64"})


def archive_pages(pages: DataFrame, folder: str) -> DataFrame:
    """Writes, normalises and reads back `pages`; the records as read from the members.

    Html that is null is an empty payload. Of records with equal payloads of REVISIT_BYTES or more, those with the largest
    page_id are responses and the others revisit it; a row without page_id counts as smallest, and where no row of a
    group has one, all are responses. Rows repeated with the same page_id stay as many records. Other columns are ignored. No pages, no records.
    """
    spark = pages.sparkSession
    raw = write_archives(pages, folder)
    raw.write.parquet(f"{folder}/written")
    done = normalise(spark.read.schema(raw.schema).parquet(f"{folder}/written"), folder)
    done.write.parquet(f"{folder}/normalised")
    files, root = fs.FileSystem.from_uri(folder)
    files.create_dir(f"{root}/index", recursive=True)
    return read_records(spark, folder)
