"""Deterministic WARC archives: a sharded writer, and a reader of what it wrote.

Records are dealt to shards by ranges of their key, sorted, and written as gzip members to files
that roll over at a compressed size.  Equal rows give equal files, byte for byte.  A file is
written under a temporary name and renamed when complete; the manifest, written last,
names what belongs to the archive, so what a lost task left behind is never read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardloom.llm.shared import key_cells, same_text, small_table, staged

LEAST_REVISIT = 1000
FILE_BYTES = 32 << 20
SHARD_BYTES = 48 << 20
#: Fixed values of the format.
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "file string, shard int, part int, records long, bytes long, sha256 string"


def file_system(folder: str):
    """File system and path of a shared folder, by URI, for tasks that write or read archives."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", folder))


def payload(html: str | Column) -> Column:
    return F.encode(same_text(html), "UTF-8")


def assign_roles(pages: DataFrame, key: str = "page_id", html: str = "html", least: int = LEAST_REVISIT) -> DataFrame:
    """(page_id, digest, size, refers_to) for each distinct key and payload; refers_to is NULL for responses.

    Of equal payloads of at least ``least`` bytes that with the largest key is the response.  Payloads
    are equal when SHA-1, SHA-256 and size are.  NULL keys are never referred to: if no other key has
    the payload, all are responses.  Aggregated before the shuffle, so copies do
    not meet in one task.
    """
    data = payload(html)
    rows = pages.select(
        F.col(key).alias("page_id"),
        F.sha1(data).alias("digest"),
        F.sha2(data, 256).alias("_exact"),
        F.octet_length(data).cast("long").alias("size"),
    )
    rows = staged(rows.distinct(), "warc-rows")
    same = ["digest", "_exact", "size"]
    last = rows.where(F.col("size") >= least).groupBy(*same).agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n"))
    last = staged(last.where("n > 1").select(*same, "last"), "warc-copies")
    joined = rows.join(last, same, "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("last")), F.col("last"))
    return joined.select("page_id", "digest", "size", refers.alias("refers_to"))


def record_id(page: int | None, digest: str, copy: int = 0) -> str:
    """A page's records are told apart by their payload, and those of equal payload by number."""
    return f"<urn:x-page:{'none' if page is None else page}:{digest}:{copy}>"


def base32(hexed: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(hexed)).decode()


def record(kind: str, headers: list[tuple[str, str]], block: bytes, date: str) -> bytes:
    """One record as a gzip member without a time stamp."""
    lines = [("WARC-Type", kind), *headers, ("WARC-Date", date), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines) + "\r\n"
    packer = zlib.compressobj(5, zlib.DEFLATED, 31)
    return packer.compress(head.encode() + block + b"\r\n\r\n") + packer.flush()


def page_record(page: int | None, copy: int, url: str | None, body: bytes, digest: str, size: int, refers_to: int | None, date: str) -> bytes:
    """A response, or a revisit that keeps the HTTP headers with the full length and no payload."""
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else record_id(page, digest, copy)[1:-1]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (body if refers_to is None else b"")
    headers = [
        ("WARC-Record-ID", record_id(page, digest, copy)),
        ("WARC-Target-URI", target),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Block-Digest", base32(hashlib.sha1(block).hexdigest())),
        ("WARC-Payload-Digest", base32(digest)),
    ]
    if refers_to is None:
        return record("response", headers, block, date)
    headers += [("WARC-Profile", IDENTICAL), ("WARC-Refers-To", record_id(refers_to, digest))]
    return record("revisit", headers, block, date)


class Rolling:
    """Writes the records of one shard to files of about ``most`` compressed bytes."""

    def __init__(self, folder: str, shard: int, most: int, date: str):
        self.fs, self.folder = file_system(folder)
        self.shard, self.most, self.date = shard, most, date
        self.part, self.out, self.done = 0, None, []

    def add(self, data: bytes) -> None:
        if self.out is not None and self.size + len(data) > self.most:
            self.close()
        if self.out is None:
            self.name = f"shard-{self.shard:06d}-{self.part:05d}.warc.gz"
            self.temporary = f"{self.folder}/.{self.name}.{uuid.uuid4().hex}"
            self.out = self.fs.open_output_stream(self.temporary)
            self.size, self.records, self.digest = 0, 0, hashlib.sha256()
            info = f"software: cardloom\r\nformat: WARC File Format 1.1\r\nfilename: {self.name}\r\n".encode()
            headers = [("WARC-Record-ID", f"<urn:x-file:{self.name}>"), ("WARC-Filename", self.name), ("Content-Type", "application/warc-fields")]
            self.write(record("warcinfo", headers, info, self.date))
        self.write(data)
        self.records += 1

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.digest.update(data)
        self.size += len(data)

    def close(self) -> None:
        if self.out is None:
            return
        self.out.close()
        self.fs.move(self.temporary, f"{self.folder}/{self.name}")
        self.done.append((self.name, self.shard, self.part, self.records, self.size, self.digest.hexdigest()))
        self.out, self.part = None, self.part + 1


def write_archive(
    pages: DataFrame,
    folder: str,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
    date: str = "2024-01-01T00:00:00Z",
    file_bytes: int = FILE_BYTES,
    shard_bytes: int = SHARD_BYTES,
    least: int = LEAST_REVISIT,
) -> DataFrame:
    """Write every page as a record and return the manifest, which is stored in ``folder``/manifest.

    Shards are ranges of the key of about ``shard_bytes`` payload; NULL keys come first, repeated keys are told apart
    by a number.  Roles travel beside the payloads as rows of their own, sorted in front of
    them, so payloads are shuffled once.  NULL html is an empty payload, a NULL url becomes an identifier.
    An empty table gives an empty manifest.
    """
    spark = pages.sparkSession
    where, path = file_system(folder)
    where.create_dir(path, recursive=True)
    data = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).alias("url"), payload(html).alias("body"))
    roles = assign_roles(pages, key, html, least)
    cells = key_cells(data.select("page_id", F.octet_length("body").alias("size")), "page_id", F.col("size"), shard_bytes)
    shards = small_table(spark, [(c.cell, c.bucket) for c in cells.rows] or [(0, 0)], "_cell long, shard int")
    heavy = data.select("page_id", F.sha1("body").alias("digest"), F.lit(1).alias("_kind"), "url", "body", F.lit(None).cast("long").alias("size"), F.lit(None).cast("long").alias("refers_to"))
    light = roles.select("page_id", "digest", F.lit(0).alias("_kind"), F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("body"), "size", "refers_to")
    rows = heavy.union(light).withColumn("_cell", cells.column(F.col("page_id")))
    rows = rows.join(F.broadcast(shards), "_cell").drop("_cell")
    count = max((c.bucket for c in cells.rows), default=0) + 1
    rows = rows.repartitionById(count, F.col("shard")).sortWithinPartitions("shard", "page_id", "digest", "_kind", "url")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: Rolling | None = None
        done: list[tuple] = []
        page, copy, size, refers = (), 0, 0, None
        for batch in batches:
            numbers = [None if pd.isna(x) else int(x) for x in batch["page_id"].astype("Int64")]
            targets = [None if pd.isna(x) else int(x) for x in batch["refers_to"].astype("Int64")]
            for i, (shard, kind, digest, link, body) in enumerate(zip(batch["shard"], batch["_kind"], batch["digest"], batch["url"], batch["body"])):
                if out is None or out.shard != shard:
                    if out is not None:
                        out.close()
                        done += out.done
                    out = Rolling(folder, int(shard), file_bytes, date)
                if kind == 0:
                    size, refers = int(batch["size"].iat[i]), targets[i]
                    continue
                copy = copy + 1 if page == (numbers[i], digest) else 0
                page = (numbers[i], digest)
                out.add(page_record(numbers[i], copy, link, bytes(body), digest, size, refers, date))
        if out is not None:
            out.close()
            done += out.done
        yield pd.DataFrame(done, columns=[c.split()[0] for c in MANIFEST.split(", ")])

    manifest = f"{folder}/manifest"
    rows.mapInPandas(write, MANIFEST).write.mode("overwrite").parquet(manifest)
    return spark.read.schema(MANIFEST).parquet(manifest)


def records_of(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of an open, compressed archive file."""
    with gzip.GzipFile(fileobj=stream) as data, io.BufferedReader(data, 1 << 20) as f:
        while line := f.readline():
            if line in (b"\r\n", b"\n"):
                continue
            if not line.startswith(b"WARC/"):
                raise ValueError("not a WARC record")
            headers = {}
            while (line := f.readline()) not in (b"\r\n", b"\n", b""):
                name, _, value = line.decode().partition(":")
                headers[name.strip().lower()] = value.strip()
            length = int(headers["content-length"])
            block = f.read(length)
            if len(block) != length:
                raise ValueError("record cut short")
            yield headers, block


def page_of(identifier: str) -> int | None:
    name = identifier.strip("<>").split(":")[2]
    return None if name == "none" else int(name)


def digest_of(identifier: str) -> str:
    return identifier.strip("<>").split(":")[3]


def read_archive(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """The records of the files that the manifest names, a row per page record.

    Columns: page_id, url, record_type, payload_bytes and payload_digest (of the full payload, for
    revisits from their headers), refers_to, html (NULL for revisits or without ``with_payload``).
    Block and payload digests are checked, and that a revisit refers to a record of its own payload; what is wrong raises.
    """
    schema = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, html string"
    names = schema.replace(" long", "").replace(" string", "").split(", ")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        where, path = file_system(folder)
        for batch in batches:
            for name in batch["file"]:
                rows, held = [], 0
                with where.open_input_stream(f"{path}/{name}", compression=None) as stream:
                    for h, block in records_of(stream):
                        if h["warc-type"] == "warcinfo":
                            continue
                        head, _, body = block.partition(b"\r\n\r\n")
                        said = base64.b32decode(h["warc-payload-digest"].removeprefix("sha1:")).hex()
                        if base32(hashlib.sha1(block).hexdigest()) != h["warc-block-digest"]:
                            raise ValueError(f"wrong block digest in {name}")
                        size = int(re.search(rb"(?i)content-length: *(\d+)", head)[1])
                        refers = h.get("warc-refers-to")
                        if refers is None and (hashlib.sha1(body).hexdigest() != said or len(body) != size):
                            raise ValueError(f"wrong payload digest in {name}")
                        if refers is not None and digest_of(refers) != said:
                            raise ValueError(f"a revisit of another payload in {name}")
                        target = h["warc-target-uri"]
                        html = body.decode() if with_payload and refers is None else None
                        rows.append((page_of(h["warc-record-id"]), None if target.startswith("urn:x-page:") else target, h["warc-type"], size, said, page_of(refers) if refers else None, html))
                        held += len(block)
                        if held > 4 << 20:
                            yield pd.DataFrame(rows, columns=names).astype({"page_id": "Int64", "refers_to": "Int64"})
                            rows, held = [], 0
                yield pd.DataFrame(rows, columns=names).astype({"page_id": "Int64", "refers_to": "Int64"})

    files = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest").select("file")
    count = max(1, files.count())
    return files.repartition(count, "file").mapInPandas(read, schema)
