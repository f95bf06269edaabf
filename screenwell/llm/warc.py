"""WARC archives: written by tasks into the shared folder, read back one record at a time."""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenwell.llm.store import Scratch

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = ("archive string, record_id string, page_id long, url string, record_type string, "
          "payload_digest string, payload_bytes long, refers_to_record string, payload binary")
BLOCK = 1 << 16


class BadArchive(ValueError):
    """An archive that breaks the framing or fails a digest."""


def digests(pages: DataFrame) -> DataFrame:
    """page_id, digest and length of each payload, made of the html in UTF-8 (null: empty)."""
    html = F.coalesce("html", F.lit(""))
    return pages.select("page_id", F.sha2(html.cast("binary"), 256).alias("digest"),
                        F.octet_length(html).cast("long").alias("bytes"))


def revisits(pages: DataFrame, least: int = 100) -> DataFrame:
    """(page_id, first): pages whose payload of at least ``least`` bytes a page of smaller id has."""
    known = digests(pages).where(F.col("bytes") >= least)
    first = (known.groupBy("digest").agg(F.min("page_id").alias("first"), F.max("page_id").alias("last"))
             .where("first < last"))
    return known.join(first, "digest").where("page_id > first").select("page_id", "first").distinct()


def record_name(page_id, position: str) -> str:
    name = f"page:{int(page_id)}" if page_id is not None else f"row:{position}"
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"


def record(page_id, url, html, first, position: str, date: str) -> bytes:
    """One record as a gzip member of its own."""
    payload = (html or "").encode()
    head = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
            + str(len(payload)).encode() + b"\r\n\r\n")
    block = head if first is not None else head + payload
    fields = {
        "WARC-Type": "response" if first is None else "revisit",
        "WARC-Record-ID": record_name(page_id, position),
        "WARC-Date": date,
        "WARC-Target-URI": None if url is None else quote(url, safe="".join(map(chr, range(33, 127)))),
        "WARC-Payload-Digest": "sha256:" + hashlib.sha256(payload).hexdigest(),
        "WARC-Block-Digest": "sha256:" + hashlib.sha256(block).hexdigest(),
        "WARC-Refers-To": None if first is None else record_name(first, ""),
        "WARC-Profile": None if first is None else PROFILE,
        "X-Page-ID": None if page_id is None else str(int(page_id)),
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    text = "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None)
    deflate = zlib.compressobj(4, zlib.DEFLATED, 31)
    return (deflate.compress(b"WARC/1.1\r\n" + text.encode() + b"\r\n" + block + b"\r\n\r\n")
            + deflate.flush())


def members(file) -> Iterator[bytes]:
    """Contents of the gzip members of ``file``, decompressed block by block, one at a time."""
    held = file.read(BLOCK)
    while held:
        inflate, parts = zlib.decompressobj(31), []
        while not inflate.eof:
            if not held:
                raise BadArchive("the last member is not complete")
            parts.append(inflate.decompress(held))
            held = inflate.unused_data if inflate.eof else b""
            held = held or file.read(BLOCK)
        yield b"".join(parts)


def parse(member: bytes) -> dict:
    """Fields and payload of one record; raises when the framing or a digest is wrong."""
    head, mark, rest = member.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not mark or lines[0] != "WARC/1.1":
        raise BadArchive("no record header")
    fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    length = int(fields["content-length"])
    block = rest[:length]
    if len(block) != length or rest[length:] != b"\r\n\r\n":
        raise BadArchive("the record is not as long as it says")
    if fields["warc-block-digest"] != "sha256:" + hashlib.sha256(block).hexdigest():
        raise BadArchive("wrong block digest")
    payload = block.partition(b"\r\n\r\n")[2]
    if (fields["warc-type"] == "response"
            and fields["warc-payload-digest"] != "sha256:" + hashlib.sha256(payload).hexdigest()):
        raise BadArchive("wrong payload digest")
    return {"fields": fields, "payload": payload}


def write_archives(pages: DataFrame, scratch: Scratch, folder: str,
                   date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write one archive per task below ``folder``; a table of (archive, records).

    A task writes to a name of its own attempt, so a repeated task leaves no half archive in the
    table: only names that a finished task reports are read. Folders are reached through their URI
    (``file:``, ``hdfs:``, ...), not as local paths.
    """
    earlier = scratch.cut(revisits(pages))
    rows = pages.select("page_id", "url", "html").join(earlier, "page_id", "left")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        name, out, count = uuid.uuid4().hex, None, 0
        for batch in batches:
            if out is None and len(batch):
                store, path = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
                store.create_dir(path, recursive=True)
                out = store.open_output_stream(f"{path}/{name}.warc.gz")
            none = batch.astype(object).where(batch.notna(), None)
            for row in none.itertuples(index=False):
                out.write(record(row.page_id, row.url, row.html, row.first, f"{name}:{count}", date))
                count += 1
        if out is not None:
            out.close()
            yield pd.DataFrame({"archive": [f"{folder}/{name}.warc.gz"], "records": [count]})

    return scratch.cut(rows.mapInPandas(write, "archive string, records long"))


def read_archives(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """Records of the archives named in column ``archive``, each read front to back by one task."""
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        for batch in batches:
            for name in batch["archive"]:
                store, path = fs.FileSystem.from_uri(name if "://" in name else f"file://{name}")
                rows, size = [], 0
                with store.open_input_stream(path) as file:
                    for member in members(file):
                        found = parse(member)
                        f, own = found["fields"], found["payload"]
                        again = f["warc-type"] == "revisit"
                        rows.append((name, f["warc-record-id"], int(f["x-page-id"]) if "x-page-id" in f else None,
                                     f.get("warc-target-uri"), f["warc-type"],
                                     f["warc-payload-digest"].partition(":")[2], None if again else len(own),
                                     f.get("warc-refers-to"), own if payloads and not again else None))
                        size += len(own) if payloads else 200
                        if size > 1 << 22:
                            yield frame(rows)
                            rows, size = [], 0
                yield frame(rows)

    def frame(rows: list) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=[x.split(" ")[0] for x in RECORD.split(", ")])
        for name in ("page_id", "payload_bytes"):
            out[name] = out[name].astype("Int64")
        return out

    # a number of its own: by size alone, all names would meet in one task
    return archives.select("archive").repartition(max(1, archives.count()), "archive").mapInPandas(read, RECORD)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write a record per page, read all archives back and resolve the revisits.

    Per page: page_id, payload_bytes, payload_digest, record_type, refers_to. Of equal payloads of
    at least 100 bytes the smallest page_id is the response. Null html is an empty payload, a null
    page_id is always a response, rows that repeat the smallest page_id are responses too, an empty
    table gives an empty one, other columns are ignored.
    """
    scratch = Scratch(pages.sparkSession)
    archives = write_archives(pages, scratch, f"{scratch.folder}/warc")
    found = scratch.cut(read_archives(archives, payloads=False).drop("payload"))
    target = (found.where("record_type = 'response' and page_id is not null")
              .join(found.where("refers_to_record is not null")
                    .select(F.col("refers_to_record").alias("record_id")).distinct(), "record_id")
              .groupBy(F.col("record_id").alias("refers_to_record"))
              .agg(F.min("page_id").alias("refers_to"), F.min("payload_bytes").alias("full")))
    return scratch.finish(found.join(target, "refers_to_record", "left").select(
        "page_id", F.coalesce("payload_bytes", "full").alias("payload_bytes"), "payload_digest",
        "record_type", "refers_to"))
