"""Web archives in ZIP packages: written per task, read through the ZIP directories and an index by range."""

from __future__ import annotations

import base64
import hashlib
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenmart.llm.common import map_arrow, shared_path, stored

ARCHIVE = "archive/data.warc.gz"
INDEX = "indexes/index.cdxj"
PACKAGE_BYTES = 16 << 20
SLICE_BYTES = 4 << 20
BIG32, BIG16 = 0xFFFFFFFF, 0xFFFF
MANIFEST = "path string, size long, records long"


def open_store(path: str) -> tuple[arrow_fs.FileSystem, str]:
    """The file system and the path in it, for any address that all executors reach."""
    return arrow_fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", path))


# --- records


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One compressed WARC record; a revisit holds the response's headers and no payload."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:x-page:{'' if page_id is None else page_id}>"),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe="".join(map(chr, range(33, 127))))))
    if refers_to is not None:
        fields.append(("WARC-Refers-To", f"<urn:x-page:{refers_to}>"))
        fields.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    packer = zlib.compressobj(1, wbits=31)
    return packer.compress(head.encode() + block + b"\r\n\r\n") + packer.flush()


def _headers(text: bytes) -> dict[str, str]:
    lines = text.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines) if k}


def _page(urn: str | None) -> int | None:
    found = re.fullmatch(r"<urn:x-page:(-?\d+)>", urn or "")
    return int(found[1]) if found else None


def parse(packed: bytes) -> tuple[int | None, str, int | None, str, int, bytes | None]:
    """(page_id, type, refers_to, digest, payload length, payload) of one record as stored.

    Length and digest of a response are measured on its payload; a revisit has none and
    repeats them in its headers. A digest that does not fit its payload is an error.
    """
    text = zlib.decompress(packed, wbits=31)
    head, _, rest = text.partition(b"\r\n\r\n")
    warc = _headers(head)
    block = rest[: int(warc["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    stated = warc["warc-payload-digest"].removeprefix("sha1:")
    page_id, kind = _page(warc["warc-record-id"]), warc["warc-type"]
    if kind == "revisit":
        return page_id, kind, _page(warc.get("warc-refers-to")), stated, int(_headers(http)["content-length"]), None
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    if digest != stated:
        raise ValueError(f"record of page {page_id}: digest {digest} where {stated} is stated")
    return page_id, kind, None, digest, len(payload), payload


# --- packages


def package(members: list[tuple[str, bytes]]) -> bytes:
    """A ZIP file of stored members with ZIP64 sizes and directories throughout."""
    out, directory = bytearray(), bytearray()
    for name, data in members:
        raw, crc, at = name.encode(), zlib.crc32(data), len(out)
        sizes = struct.pack("<HHQQ", 1, 16, len(data), len(data))
        out += struct.pack("<IHHHHHIIIHH", 0x04034B50, 45, 0, 0, 0, 0x21, crc, BIG32, BIG32, len(raw), len(sizes))
        out += raw + sizes + data
        extra = struct.pack("<HHQQQ", 1, 24, len(data), len(data), at)
        directory += struct.pack(
            "<IHHHHHHIIIHHHHHII", 0x02014B50, 45, 45, 0, 0, 0, 0x21, crc, BIG32, BIG32, len(raw), len(extra), 0, 0, 0, 0, BIG32
        )
        directory += raw + extra
    start, n = len(out), len(members)
    end64 = struct.pack("<IQHHIIQQQQ", 0x06064B50, 44, 45, 45, 0, 0, n, n, len(directory), start)
    locator = struct.pack("<IIQI", 0x07064B50, 0, start + len(directory), 1)
    end = struct.pack("<IHHHHIIH", 0x06054B50, 0, 0, BIG16, BIG16, BIG32, BIG32, 0)
    return bytes(out) + bytes(directory) + end64 + locator + end


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    header: int  # offset of the local header
    stored_size: int
    size: int


def directory(read, size: int) -> list[Member]:
    """The members of a ZIP file of ``size`` bytes; ``read(offset, length)`` gets a range of it.

    Finds the end record behind any comment, follows the ZIP64 locator where there is one,
    and takes 64-bit sizes and offsets from the extra fields.
    """
    tail_at = max(0, size - 22 - BIG16)
    tail = read(tail_at, size - tail_at)
    at = tail.rfind(b"PK\x05\x06")
    while at >= 0 and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail):
        at = tail.rfind(b"PK\x05\x06", 0, at)
    if at < 0:
        raise ValueError("no end record: not a ZIP file")
    n, length, start = struct.unpack_from("<HII", tail, at + 10)
    locator_at = tail_at + at - 20
    if locator_at >= 0:
        locator = read(locator_at, 20)
        if locator[:4] == b"PK\x06\x07":
            end64 = read(struct.unpack_from("<Q", locator, 8)[0], 56)
            if end64[:4] != b"PK\x06\x06":
                raise ValueError("the ZIP64 locator leads to no end record")
            n, length, start = struct.unpack_from("<QQQ", end64, 32)
    data, members, at = read(start, length), [], 0
    for _ in range(n):
        if data[at : at + 4] != b"PK\x01\x02":
            raise ValueError("broken central directory")
        method = struct.unpack_from("<H", data, at + 10)[0]
        stored_size, full, n_name, n_extra, n_comment = struct.unpack_from("<IIHHH", data, at + 20)
        header = struct.unpack_from("<I", data, at + 42)[0]
        name = data[at + 46 : at + 46 + n_name].decode("utf-8", "replace")
        extra = data[at + 46 + n_name : at + 46 + n_name + n_extra]
        while len(extra) >= 4:
            tag, width = struct.unpack_from("<HH", extra)
            if tag == 1:  # holds, in this order, those of the three that did not fit
                wide = iter(struct.unpack_from(f"<{width // 8}Q", extra, 4))
                full = next(wide) if full == BIG32 else full
                stored_size = next(wide) if stored_size == BIG32 else stored_size
                header = next(wide) if header == BIG32 else header
            extra = extra[4 + width :]
        members.append(Member(name, method, header, stored_size, full))
        at += 46 + n_name + n_extra + n_comment
    return members


def data_offset(read, member: Member) -> int:
    """Where a stored member's bytes begin."""
    if member.method != 0:
        raise ValueError(f"{member.name} is compressed; only stored members are read by range")
    header = read(member.header, 30)
    n_name, n_extra = struct.unpack_from("<HH", header, 26)
    return member.header + 30 + n_name + n_extra


# --- Spark


def with_revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(page_id, url, html, refers_to): html in full, refers_to the response that a revisit names.

    Of pages whose payloads are equal and have at least ``least_bytes`` bytes, that with the largest
    page_id is the response; rows that repeat that id are responses too. Pages without an id
    never are a response to others, and among themselves are all responses. Payloads compare by SHA-1
    and length; groups are reduced to one row before they meet the pages again.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    keyed = pages.select("page_id", "url", html.alias("html"), F.sha1(html.cast("binary")).alias("_sha"), F.octet_length(html).alias("_n"))
    groups = (
        keyed.where(F.col("_n") >= least_bytes).groupBy("_sha", "_n")
        .agg(F.max("page_id").alias("_first"), F.count(F.lit(1)).alias("_rows")).where("_rows > 1").drop("_rows")
    )
    other = ~F.col("page_id").eqNullSafe(F.col("_first"))
    return keyed.join(groups, ["_sha", "_n"], "left").select("page_id", "url", "html", F.when(other, F.col("_first")).alias("refers_to"))


def write_packages(pages: DataFrame, folder: str) -> DataFrame:
    """Write a WARC record per row of ``with_revisits`` and return the packages' (path, size, records).

    A null html is an empty payload, a null page_id or url is written as none; no rows give no packages. Rows that
    repeat a page get a record each.

    Each task writes packages of about PACKAGE_BYTES in ``folder``. Only packages that the stored manifest
    names count, so a task that is lost and run again leaves at worst files that nobody reads.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_store(folder)
        store.create_dir(base, recursive=True)
        records, index, size = [], [], 0

        def flush() -> pa.RecordBatch:
            name = f"{uuid.uuid4().hex}.wacz"
            data = package([(ARCHIVE, b"".join(records)), (INDEX, "".join(index).encode())])
            with store.open_output_stream(f"{base}/{name}") as out:
                out.write(data)
            return pa.RecordBatch.from_arrays(
                [pa.array([f"{folder}/{name}"]), pa.array([len(data)]), pa.array([len(records)])], ["path", "size", "records"]
            )

        for batch in batches:
            for row in zip(*(batch.column(i) for i in range(4)), strict=True):
                page_id, url, html, refers_to = (x.as_py() for x in row)
                packed = record(page_id, url, html.encode("utf-8", "surrogatepass"), refers_to)
                entry = {"offset": size, "length": len(packed), "page": page_id}
                index.append(f"{'' if page_id is None else page_id} 19700101000000 {json.dumps(entry)}\n")
                records.append(packed)
                size += len(packed)
                if size >= PACKAGE_BYTES:
                    yield flush()
                    records, index, size = [], [], 0
        if records:
            yield flush()

    return stored(map_arrow(pages.select("page_id", "url", "html", "refers_to"), run, MANIFEST), "packages")


def located(read, size: int) -> list[tuple[int, int]]:
    """(offset in the package, length) of each record that the package's indexes list, in their order.

    Archives are the stored members called *.warc.gz, indexes those called *.cdxj or, compressed, *.cdxj.gz, in whatever
    folder. An entry names its archive; one that names none means the only archive.
    """
    members = directory(read, size)
    archives = {m.name.rsplit("/", 1)[-1]: m for m in members if m.name.endswith(".warc.gz")}
    indexes = [m for m in members if m.name.endswith((".cdxj", ".cdxj.gz"))]
    if not archives or not indexes:
        raise ValueError("a package needs an archive (*.warc.gz) and an index (*.cdxj or *.cdxj.gz)")
    bases = {name: data_offset(read, m) for name, m in archives.items()}
    out = []
    for index in indexes:
        data = read(data_offset(read, index), index.size)
        text = zlib.decompress(data, wbits=31) if index.name.endswith(".gz") else data
        for line in text.decode().splitlines():
            if not line or line[0] in "!{":  # a header
                continue
            entry = json.loads(line.split(" ", 2)[2])
            name = entry.get("filename")
            if name is None and len(bases) > 1:
                raise ValueError("an index entry names none of several archives")
            base = next(iter(bases.values())) if name is None else bases[name.rsplit("/", 1)[-1]]
            out.append((base + int(entry["offset"]), int(entry["length"])))
    return out


def locate(packages: DataFrame) -> DataFrame:
    """(path, lengths, offset): runs of records in each package, found through directories and index alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, name = open_store(path)
                with store.open_input_file(name) as file:
                    read = lambda offset, length: file.read_at(length, offset)  # noqa: E731, B023
                    entries = located(read, file.size())
                runs: list[tuple[int, list[int]]] = []
                for offset, length in entries:
                    if not runs or sum(runs[-1][1]) >= SLICE_BYTES or offset != runs[-1][0] + sum(runs[-1][1]):
                        runs.append((offset, []))
                    runs[-1][1].append(length)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path] * len(runs)), pa.array([a for a, _ in runs], pa.int64()), pa.array([x for _, x in runs], pa.list_(pa.int64()))],
                    ["path", "offset", "lengths"],
                )

    return map_arrow(packages.select("path"), run, "path string, offset long, lengths array<long>")


def read_records(packages: DataFrame, payload: bool = True) -> DataFrame:
    """One row per record of the packages named in column ``path``; nothing is unpacked to disk.

    Columns: page_id, record_type, refers_to, payload_digest, payload_bytes and, if asked for, payload
    (null for a revisit). Each run of records is one range read of at most about SLICE_BYTES. No packages give no rows.
    """
    spark = packages.sparkSession
    width = max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    names = ["page_id", "record_type", "refers_to", "payload_digest", "payload_bytes"] + ["payload"] * payload
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, offset, lengths in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                store, name = open_store(path)
                with store.open_input_file(name) as file:
                    data = file.read_at(sum(lengths), offset)
                rows, at = [], 0
                for length in lengths:
                    rows.append(parse(data[at : at + length])[: len(names)])
                    at += length
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=False)], names)

    schema = "page_id long, record_type string, refers_to long, payload_digest string, payload_bytes long"
    runs = locate(packages.repartition(width)).repartition(width)
    return map_arrow(runs, run, schema + ", payload binary" * payload)


def op2_warc_zip(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    packages = write_packages(with_revisits(pages, least_bytes=0), shared_path(spark, "warc"))
    return read_records(packages, payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP2_SQL = """
with p as (select page_id, coalesce(html, '') as h from pages),
d as (select page_id, strlen(h)::bigint as payload_bytes, h,
  list_aggregate(list_transform(string_split(sha1(h), ''), lambda c:
    substr('0000000100100011010001010110011110001001101010111100110111101111', strpos('0123456789abcdef', c)::int * 4 - 3, 4)),
    'string_agg', '') as bits from p),
e as (select page_id, payload_bytes, h, list_aggregate(list_transform(range(0, 160, 5), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + 16 * substr(bits, i::int + 1, 1)::int + 8 * substr(bits, i::int + 2, 1)::int
      + 4 * substr(bits, i::int + 3, 1)::int + 2 * substr(bits, i::int + 4, 1)::int + substr(bits, i::int + 5, 1)::int, 1)),
    'string_agg', '') as payload_digest, max(page_id) over (partition by h) as top from d)
select page_id, payload_bytes, payload_digest,
  case when page_id = top then 'response' else 'revisit' end as record_type,
  case when page_id <> top then top end as refers_to
from e
"""
