"""WARC records in ZIP packages: write, list, and range-read without extraction.

A package is a ZIP file with stored (uncompressed) members: ``archive/data.warc.gz``, one gzip
member per record, and ``indexes/index.cdx``, one line "offset length" per record. Members are
written in ZIP64 form whatever their size, so one layout serves all sizes.

Reading never unpacks a package. The end record and the central directory (or their ZIP64 forms)
say where the members lie; the index says where the records lie; tasks then read byte ranges.
Records next to each other are read as one range of about ``span_bytes``, so a large package is
read by many tasks, as many as its bytes make ranges.

A package may hold any number of WARC members. ``indexes/NAME.cdx`` is the index of ``archive/NAME.warc.gz`` (or
``NAME.warc``); a line of ``indexes/index.cdx`` may name its member in a third field, and if it does not, it is
that of the package's only member. A member without an index is read as one range, record by
record. Members ending in ``.warc`` are not packed: their records are told apart by their lengths.

Files are reached through ``pyarrow.fs``, so a package may lie on a shared disk or in a store.
Every attempt at writing a package uses a file name of its own, and only the names that successful
tasks return are read: a lost or repeated task leaves at most a file nobody reads.

Defined cases: a null payload is the empty payload; a null url leaves the target header out; an
empty table gives no packages and no records. A WARC member that is compressed raises an error.
"""

from __future__ import annotations

import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import text as X
from strata.session import scratch_path

WARC_MEMBER, INDEX_MEMBER = "archive/data.warc.gz", "indexes/index.cdx"
PACKAGES = "path string, records bigint, bytes bigint"
SPANS = "path string, start bigint, size bigint, packed boolean"
RECORDS = """path string, record_type string, record_id string, target_uri string,
  payload_digest string, refers_to string, payload binary"""
MOST_TASKS = 10_000
_END, _END64, _LOCATOR64 = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"


def _file_system(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


# --- Records ------------------------------------------------------------------------------------


def _record(kind: str, number: str, url: str | None, digest: str, refers_to: str | None, payload: bytes):
    """A WARC/1.1 record as one gzip member."""
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{number}>",
        "WARC-Date: 2024-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: text/html; charset=utf-8",
        f"Content-Length: {len(payload)}",
    ]
    if url is not None:
        # A header is one line; the escape keeps a url with a line break whole.
        clean = url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")
        head.insert(3, f"WARC-Target-URI: {clean}")
    if refers_to is not None:
        head.insert(3, f"WARC-Refers-To: <urn:page:{refers_to}>")
        head.insert(3, "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    raw = "\r\n".join(head).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n"
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeeze.compress(raw) + squeeze.flush()


def _inner(value: str | None) -> str | None:
    return None if value is None else value.removeprefix("<urn:page:").removesuffix(">")


def _parse(path: str, raw: bytes) -> tuple:
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    url = fields.get("WARC-Target-URI")
    if url is not None:
        url = url.replace("%0D", "\r").replace("%0A", "\n").replace("%25", "%")
    return (
        path,
        fields["WARC-Type"],
        _inner(fields["WARC-Record-ID"]),
        url,
        fields.get("WARC-Payload-Digest", "").removeprefix("sha256:"),
        _inner(fields.get("WARC-Refers-To")),
        rest[: int(fields["Content-Length"])],
    )


def _gzip_members(file, start: int, size: int, block: int = 1 << 20) -> Iterator[bytes]:
    """The gzip members of a byte range, each unpacked, reading a block at a time."""
    file.seek(start)
    left, data = size, b""
    while left or data:
        unpack, out = zlib.decompressobj(31), []
        while not unpack.eof:
            if not data:
                if not left:
                    raise ValueError("the range ends inside a record")
                data = file.read(min(block, left))
                left -= len(data)
            out.append(unpack.decompress(data))
            data = unpack.unused_data
        yield b"".join(out)


# --- Writing ------------------------------------------------------------------------------------


class _Package:
    """One ZIP package being written; records go out as they come."""

    def __init__(self, folder: str):
        system, base = _file_system(folder)
        system.create_dir(base, recursive=True)
        name = f"package-{uuid.uuid4().hex}.zip"
        self.path, self.records, self.index = f"{folder}/{name}", 0, []
        self.out = system.open_output_stream(f"{base}/{name}")
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member = self.zip.open(WARC_MEMBER, "w", force_zip64=True)
        self.size = 0

    def add(self, data: bytes) -> None:
        self.member.write(data)
        self.index.append(f"{self.size} {len(data)}\n")
        self.size, self.records = self.size + len(data), self.records + 1

    def close(self) -> tuple[str, int, int]:
        self.member.close()
        with self.zip.open(INDEX_MEMBER, "w", force_zip64=True) as member:
            member.write("".join(self.index).encode())
        self.zip.close()
        self.out.close()
        return self.path, self.records, self.size


def write_packages(
    rows: DataFrame, folder: str, max_records: int = 100_000, max_bytes: int = 1 << 30
) -> DataFrame:
    """Write rows (record_id, url, digest, refers_to, payload) as packages below ``folder``.

    ``refers_to`` is null for a response. A task goes on to a new package at either limit, so what
    it holds is bounded. Returns the packages; they exist once the returned frame is computed.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        package, done = None, []
        for batch in batches:
            for row in batch.to_pylist():
                package = package or _Package(folder)
                kind = "response" if row["refers_to"] is None else "revisit"
                payload = row["payload"] or b""
                names = (row["record_id"], row["url"], row["digest"], row["refers_to"])
                package.add(_record(kind, *names, payload))
                if package.records >= max_records or package.size >= max_bytes:
                    done.append(package.close())
                    package = None
        if package is not None:
            done.append(package.close())
        columns = list(zip(*done)) if done else [[], [], []]
        types = (pa.string(), pa.int64(), pa.int64())
        arrays = [pa.array(c, t) for c, t in zip(columns, types)]
        yield pa.RecordBatch.from_arrays(arrays, ["path", "records", "bytes"])

    return rows.select("record_id", "url", "digest", "refers_to", "payload").mapInArrow(write, PACKAGES)


# --- Reading ------------------------------------------------------------------------------------


def _directory(file, length: int) -> tuple[int, int]:
    """Offset and size of the central directory, from the end record or its ZIP64 form."""
    tail_size = min(length, 22 + 0xFFFF + 20)
    file.seek(length - tail_size)
    tail = file.read(tail_size)
    at = tail.rfind(_END)
    if at < 0:
        raise ValueError("not a ZIP package: no end record")
    size, offset = struct.unpack("<II", tail[at + 12 : at + 20])
    locator = tail[at - 20 : at] if at >= 20 else b""
    if locator[:4] == _LOCATOR64:
        file.seek(struct.unpack("<Q", locator[8:16])[0])
        end64 = file.read(56)
        if end64[:4] != _END64:
            raise ValueError("the ZIP64 locator points to something else")
        size, offset = struct.unpack("<QQ", end64[40:56])
    return offset, size


def _sizes64(extra: bytes, fields: list[int]) -> list[int]:
    """Fields that are all ones are found, in order, in the ZIP64 extra field (id 1)."""
    at = 0
    while at + 4 <= len(extra):
        kind, size = struct.unpack("<HH", extra[at : at + 4])
        if kind == 1:
            values = iter(struct.unpack(f"<{size // 8}Q", extra[at + 4 : at + 4 + size // 8 * 8]))
            return [next(values) if x == 0xFFFFFFFF else x for x in fields]
        at += 4 + size
    return fields


def members(file, length: int) -> Iterator[tuple[str, int, int, int]]:
    """(name, method, start of the data, size) of each member of a package."""
    offset, size = _directory(file, length)
    file.seek(offset)
    raw, at = file.read(size), 0
    while at + 46 <= len(raw) and raw[at : at + 4] == b"PK\x01\x02":
        method = struct.unpack("<H", raw[at + 10 : at + 12])[0]
        packed, full, n, m, k = struct.unpack("<IIHHH", raw[at + 20 : at + 34])
        name = raw[at + 46 : at + 46 + n].decode()
        extra = raw[at + 46 + n : at + 46 + n + m]
        header = struct.unpack("<I", raw[at + 42 : at + 46])[0]
        _, packed, header = _sizes64(extra, [full, packed, header])
        # The local header has lengths of its own for name and extra field.
        file.seek(header)
        local = file.read(30)
        n2, m2 = struct.unpack("<HH", local[26:30])
        yield name, method, header + 30 + n2 + m2, packed
        at += 46 + n + m + k


def _spans(file, length: int, span_bytes: int) -> Iterator[tuple[int, int, bool]]:
    """(start, size, packed) of byte ranges of whole records, in the order they lie in."""
    known = {name: rest for name, *rest in members(file, length)}
    archives = [name for name in known if name.endswith((".warc", ".warc.gz"))]
    for name in archives:
        method, start, size = known[name]
        if method != zipfile.ZIP_STORED:
            raise ValueError(f"member {name} is compressed and cannot be read by range")
        packed = name.endswith(".gz")
        first = last = 0
        for offset, record in _records_of(file, known, name, len(archives) == 1):
            if last - first >= span_bytes:
                yield start + first, last - first, packed
                first = offset
            last = offset + record
        if last > first:
            yield start + first, last - first, packed
        elif size and not last:
            yield start, size, packed


def _records_of(file, known: dict, name: str, only: bool) -> Iterator[tuple[int, int]]:
    """(offset, length) of the records of a WARC member by its index; nothing if it has none."""
    base = name.rpartition("/")[2]
    own = f"indexes/{base.removesuffix('.gz').removesuffix('.warc')}.cdx"
    index = own if own in known and own != INDEX_MEMBER else INDEX_MEMBER
    if index in known:
        for offset, length, *named in _index(file, *known[index][1:]):
            if index == own or (named[0] in (name, base) if named else only):
                yield int(offset), int(length)


def _index(file, start: int, size: int, block: int = 1 << 20) -> Iterator[list[str]]:
    """The fields of each line of an index, read a block at a time."""
    rest, end = b"", start + size
    while start < end:
        file.seek(start)
        data = file.read(min(block, end - start))
        start += len(data)
        *lines, rest = (rest + data).split(b"\n")
        for line in lines:
            yield line.decode().split()
    if rest.strip():
        yield rest.decode().split()


def _plain_records(file, start: int, size: int, block: int = 1 << 20) -> Iterator[bytes]:
    """The records of a byte range that is not packed; each ends where its header says."""
    file.seek(start)
    left, data = size, b""

    def more() -> bytes:
        nonlocal left
        if not left:
            raise ValueError("the range ends inside a record")
        got = file.read(min(block, left))
        left -= len(got)
        return got

    while left or data:
        while (at := data.find(b"\r\n\r\n")) < 0:
            data += more()
        fields = dict(line.split(b": ", 1) for line in data[:at].split(b"\r\n")[1:])
        whole = at + 4 + int(fields[b"Content-Length"]) + 4
        parts, got = [data], len(data)
        while got < whole:
            parts.append(more())
            got += len(parts[-1])
        data = b"".join(parts)
        yield data[:whole]
        data = data[whole:]


def read_records(packages: DataFrame, span_bytes: int = 4 << 20) -> DataFrame:
    """The records of the packages named by ``path``, by range reads, in a task a range.

    ``bytes``, if the table of packages has it, tells how many ranges to expect.
    """

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                system, inner = _file_system(path)
                with system.open_input_file(inner) as file:
                    found = list(_spans(file, file.size(), span_bytes))
                columns = list(zip(*found)) if found else [[], [], []]
                types = (pa.int64(), pa.int64(), pa.bool_())
                names = pa.array([path] * len(found), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [names, *map(pa.array, columns, types)], ["path", "start", "size", "packed"]
                )

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(n, pa.string()) for n in names[:-1]] + [("payload", pa.binary())])
        for batch in batches:
            for span in batch.to_pylist():
                system, inner = _file_system(span["path"])
                with system.open_input_file(inner) as file:
                    rows = []
                    each = _gzip_members if span["packed"] else _plain_records
                    for raw in each(file, span["start"], span["size"]):
                        rows.append(_parse(span["path"], raw))
                        if len(rows) == 256:
                            yield _batch(rows, schema)
                            rows = []
                    if rows:
                        yield _batch(rows, schema)

    names = [part.split()[0] for part in RECORDS.split(",")]
    spans = packages.select("path").mapInArrow(locate, SPANS)
    # Without this the task that read a package's directory would read all its records; without
    # a number the few small rows of ``spans`` would be merged into one partition.
    tasks = int(packages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if "bytes" in packages.columns:
        total = packages.agg(F.sum("bytes")).first()[0] or 0
        tasks = min(MOST_TASKS, 1 + total // span_bytes)
    return spans.repartition(tasks, "path", "start").mapInArrow(fetch, RECORDS)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


# --- Pages --------------------------------------------------------------------------------------


def page_records(pages: DataFrame, min_bytes: int = 100) -> DataFrame:
    """One record per page; later copies of a payload refer to its first page.

    Of pages with equal payloads of at least ``min_bytes`` bytes the one with the smallest id is
    the response. Only (digest, id) is grouped; a payload that a third of all pages share is one
    row per map task there. Rows that tie on the smallest id are all responses; so are rows with a
    null id if no page with an id holds their payload.
    """
    rows = pages.select(
        F.col("page_id"),
        F.col("url"),
        X.filled(F.col("html")).cast("binary").alias("payload"),
        F.sha2(X.filled(F.col("html")), 256).alias("digest"),
    )
    large = rows.where(F.octet_length("payload") >= min_bytes)
    shared = (
        large.groupBy("digest")
        .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        # Under another name and type of key, so that Spark deals both sides anew for the join and
        # may split the pages of a hot payload over tasks.
        .select(F.concat(F.lit("="), "digest").alias("same"), "first_id")
    )
    both = rows.withColumn("same_as", F.concat(F.lit("="), "digest")).join(
        shared, F.col("same_as") == F.col("same"), "left"
    )
    first = F.col("first_id").isNull() | F.col("page_id").eqNullSafe(F.col("first_id"))
    small = F.octet_length("payload") < min_bytes
    refers = F.when(first | small, None).otherwise(F.col("first_id")).cast("string")
    return both.select(
        F.coalesce(F.col("page_id").cast("string"), F.lit("")).alias("record_id"),
        "url",
        "digest",
        refers.alias("refers_to"),
        # A revisit carries no payload of its own.
        F.when(refers.isNull(), F.col("payload")).alias("payload"),
    )


def archive_pages(spark: SparkSession, pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write the pages as packages and return the table of packages, itself written.

    The table is what makes a package count: it lists what successful tasks wrote.
    """
    folder = folder or scratch_path(spark, "warc")
    write_packages(page_records(pages), f"{folder}/packages").write.parquet(f"{folder}/table")
    return spark.read.schema(PACKAGES).parquet(f"{folder}/table")


def resolve(records: DataFrame) -> DataFrame:
    """Records with the size and digest of their full payload; a revisit has its response's.

    The digest of a response is computed from the bytes read, not taken from its header. The records
    are read once: what is used of them, without their payloads, is staged.
    """
    seen = records.select(
        "record_id",
        "record_type",
        "refers_to",
        F.col("payload_digest").alias("said"),
        F.octet_length("payload").cast("bigint").alias("bytes"),
        F.sha2("payload", 256).alias("digest"),
    )
    staged = scratch_path(records.sparkSession, "warc-records")
    seen.write.parquet(staged)
    seen = records.sparkSession.read.schema(seen.schema).parquet(staged)
    responses = (
        seen.where("record_type = 'response'")
        .select(
            F.col("record_id").alias("of"),
            F.col("digest").alias("full_digest"),
            F.col("bytes").alias("full_bytes"),
        )
    )
    targets = seen.where("record_type = 'revisit'").select(
        F.col("refers_to").alias("wanted"), F.col("said").alias("wanted_digest")
    ).distinct()
    # Only responses that a revisit names, once each, by id and digest.
    named = responses.join(
        targets, (F.col("of") == F.col("wanted")) & (F.col("full_digest") == F.col("wanted_digest"))
    ).groupBy("of", "full_digest").agg(F.max("full_bytes").alias("full_bytes"))
    same = (F.col("refers_to") == F.col("of")) & (F.col("said") == F.col("full_digest"))
    revisit = F.col("record_type") == "revisit"
    return seen.join(named, same, "left").select(
        "record_id",
        F.when(revisit, F.col("full_bytes")).otherwise(F.col("bytes")).alias("payload_bytes"),
        F.when(revisit, F.col("full_digest")).otherwise(F.col("digest")).alias("payload_digest"),
        "record_type",
        "refers_to",
    )

