"""WARC archives in shards, the same bytes for the same pages.

Every page becomes a record of its own, compressed on its own. Of the pages with equal payloads (of
least_bytes or more) the one with the smallest page_id is a response, and the others are revisits that
refer to it. Headers, digests and record ids are made anew from the page.

Records are in order of page_id, payload and url. Their sizes, summed in that order, cut it into shards at places that
depend on the pages alone, not on the cluster. Each shard is sorted and written by one task, which begins
a new file when the compressed size reaches roll_bytes. A task writes below a temporary name of its own attempt and
reports finished files; when all tasks are done, the reported files are renamed, each by a task, and
last the manifest is written. Archives are read by their manifest, so files of lost or repeated attempts,
and of a run that broke off, are never seen.

Which pages are revisits is found from digests alone. The payloads move once: a revisit's record comes
without one, and a page whose payload the same task has seen under a smaller id isn't sent. Equal rows are counted before
they are shuffled, and their copies are dealt out in chunks.

The folder has to be one that pyarrow reaches from every task (file, hdfs, s3, gs).

Cases: a null html is empty, as is an empty one, and both are equal payloads; a null page_id comes last, so it refers to
others first; a page without url has the target `urn:page:` and its id; blanks and control characters of a url are percent-encoded;
equal rows are a record each, all but one of them revisits; an empty table gives a manifest without files, and no
rows when read; a record whose digest doesn't agree is an error; other columns are not looked at.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook.llm.ranks import running
from rollbook.llm.scratch import keep

#: Payload and header bytes of a shard, unless there would be more than MOST_SHARDS.
SHARD_BYTES = 1 << 23
MOST_SHARDS = 20_000
#: Compressed bytes from which the next record begins a new file.
ROLL_BYTES = 1 << 28
#: About as many bytes as a record's headers have.
HEADERS = 600
#: Copies of one row that stay together.
CHUNK = 5_000
#: Payloads that a task remembers, to send copies once.
SEEN = 100_000
DATE = "2000-01-01T00:00:00Z"
LEVEL = 6
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_PLACE = ("late", "page_id", "digest", "site", "chunk")
_ROW = "late boolean, page_id bigint, digest string, site string, chunk bigint, turn int, copy bigint, size bigint, sha1 string, of_page bigint, of_site string, payload binary"
_FILE = "name string, temporary string, records bigint, bytes bigint, sha256 string"
_BATCH_BYTES = 1 << 22


def file_system(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder and the folder's path in it."""
    if folder.startswith("/"):
        return fs.LocalFileSystem(), folder
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", folder.replace("s3a://", "s3://", 1)))


def _base32(hexed: str) -> str:
    return base64.b32encode(bytes.fromhex(hexed)).decode()


def _record_id(page_id: int | None, digest: str, site: str, copy: int) -> str:
    name = f"{page_id}\n{digest}\n{copy}\n{site}".encode()
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(name).digest()[:16], version=5)}>"


def _target(site: str, page_id: int | None) -> str:
    if not site:
        return f"urn:page:{'' if page_id is None else page_id}"
    return re.sub(r"[\x00-\x20\x7F]", lambda m: f"%{ord(m[0]):02X}", site[1:])


def _headed(fields: list[tuple[str, Any]], block: bytes) -> bytes:
    head = "".join(f"{name}: {value}\r\n" for name, value in fields if value is not None)
    return f"WARC/1.1\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def record(row: dict[str, Any], date: str = DATE) -> bytes:
    """The record of one row: a response if it has a payload, else a revisit."""
    payload = row["payload"]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['size']}\r\n\r\n".encode()
    block = http + (payload or b"")
    fields = [
        ("WARC-Type", "revisit" if payload is None else "response"),
        ("WARC-Record-ID", _record_id(row["page_id"], row["digest"], row["site"], row["copy"])),
        ("WARC-Date", date),
        ("WARC-Target-URI", _target(row["site"], row["page_id"])),
        ("WARC-Payload-Digest", f"sha1:{_base32(row['sha1'])}"),
        ("WARC-Block-Digest", f"sha1:{base64.b32encode(hashlib.sha1(block).digest()).decode()}"),
        ("X-Page-ID", row["page_id"]),
    ]
    if payload is None:
        fields += [
            ("WARC-Profile", _PROFILE),
            ("WARC-Refers-To", _record_id(row["of_page"], row["digest"], row["of_site"], 0)),
            ("WARC-Refers-To-Target-URI", _target(row["of_site"], row["of_page"])),
            ("WARC-Refers-To-Date", date),
            ("X-Refers-To-Page-ID", row["of_page"]),
        ]
    return _headed([*fields, ("Content-Type", "application/http; msgtype=response")], block)


def _opening(name: str, date: str) -> bytes:
    block = b"software: rollbook\r\nformat: WARC File Format 1.1\r\n"
    number = uuid.UUID(bytes=hashlib.sha256(name.encode()).digest()[:16], version=5)
    return _headed([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{number}>"), ("WARC-Date", date), ("WARC-Filename", name), ("Content-Type", "application/warc-fields")], block)


def _press(data: bytes) -> bytes:
    press = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return press.compress(data) + press.flush()


def _dealt(cuts: list[tuple], least: int):
    """Adds each row's shard; of payloads that are seen again, only those under a smaller place go on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, tuple] = {}
        for batch in batches:
            places = list(zip(*(batch.column(k).to_pylist() for k in range(len(_PLACE))), strict=True))
            turns, sizes = batch.column(5).to_pylist(), batch.column(7).to_pylist()
            stay = []
            for k, (place, turn, size) in enumerate(zip(places, turns, sizes, strict=True)):
                if turn == 2 and size >= least:
                    before = seen.get(place[2])
                    if before is not None and before <= place:
                        continue
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen[place[2]] = place
                stay.append(k)
            shards = pa.array([bisect_right(cuts, places[k]) for k in stay], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.take(pa.array(stay, pa.int64())).columns, shards], [*batch.schema.names, "shard"])

    return run


class _File:
    """One archive file below a temporary name."""

    def __init__(self, files: fs.FileSystem, folder: str, name: str, date: str):
        self.name, self.path = name, f"{folder}/{name}"
        self._out = files.open_output_stream(self.path, compression=None)
        self._sum, self.records, self.bytes = hashlib.sha256(), 0, 0
        self.add(_opening(name, date))
        self.records = 0

    def add(self, data: bytes) -> None:
        pressed = _press(data)
        self._out.write(pressed)
        self._sum.update(pressed)
        self.records += 1
        self.bytes += len(pressed)

    def close(self) -> tuple[str, str, int, int, str]:
        self._out.close()
        return self.name, self.path, self.records, self.bytes, self._sum.hexdigest()


def _write(folder: str, least: int, roll: int, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = file_system(folder)
        own = f"{path}/_temporary/{uuid.uuid4().hex}"
        shard, number, file, written, dropped = None, 0, None, None, None
        done: list[tuple] = []

        def close() -> None:
            if file is not None:
                done.append(file.close())

        for batch in batches:
            for k in range(len(batch)):
                row = {name: column[k].as_py() for name, column in zip(batch.schema.names, batch.columns, strict=True)}
                place = tuple(row[c] for c in _PLACE)
                if row["turn"] == 1:
                    dropped = place
                elif row["turn"] == 2:
                    # a copy's payload, or one that was sent more than once
                    if place == dropped or (place == written and row["size"] >= least):
                        continue
                    row["copy"] = number_of + 1 if place == written else 0
                    written, number_of = place, row["copy"]
                if row["shard"] != shard or file.bytes >= roll:
                    close()
                    if file is None:
                        files.create_dir(own, recursive=True)
                    shard, number = row["shard"], number + 1 if row["shard"] == shard else 0
                    file = _File(files, own, f"shard-{shard:06d}-{number:05d}.warc.gz", date)
                file.add(record(row, date))
        close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], ["name", "temporary", "records", "bytes", "sha256"])

    return run


def _publish(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = file_system(folder)
        for batch in batches:
            for name, temporary, size in zip(*(batch.column(k).to_pylist() for k in (0, 1, 3)), strict=True):
                end = f"{path}/{name}"
                if files.get_file_info(temporary).type == fs.FileType.File:
                    files.move(temporary, end)
                elif files.get_file_info(end).size != size:  # moved by an earlier attempt, unless it's lost
                    raise FileNotFoundError(f"{temporary}, to become {end}")
            yield batch

    return run


def _records(pages: DataFrame, least: int) -> DataFrame:
    """A row for each chunk of equal rows: place, copies, size, sha1, whether it's the response of its payload, and the page that it refers to."""
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.coalesce(F.concat(F.lit("="), "url"), F.lit("")).alias("site"), payload.alias("payload"))
    rows = rows.select(F.col("page_id").isNull().alias("late"), "page_id", "site", F.sha2("payload", 256).alias("digest"), F.sha1("payload").alias("sha1"), F.octet_length("payload").cast("bigint").alias("size"))
    same = rows.groupBy("late", "page_id", "site", "digest", "sha1", "size").agg(F.count(F.lit(1)).alias("copies"))
    same = keep(same, "pages")
    shared = same.filter(F.col("size") >= least).groupBy("digest").agg(F.min(F.struct("late", "page_id", "site")).alias("first"), F.sum("copies").alias("n")).filter("n > 1").drop("n")
    marked = same.join(shared, "digest", "left").withColumn("is_first", F.expr("first IS NULL OR first = named_struct('late', late, 'page_id', page_id, 'site', site)"))
    marked = marked.select("*", F.explode(F.expr(f"sequence(0L, (copies - 1) div {CHUNK})")).alias("chunk"))
    return marked.select("late", "page_id", "digest", "site", "chunk", F.expr(f"least({CHUNK}L, copies - chunk * {CHUNK})").alias("copies"), "size", "sha1", "is_first", F.col("first").isNotNull().alias("shared"), F.col("first.page_id").alias("of_page"), F.col("first.site").alias("of_site"))


def write_warc(pages: DataFrame, folder: str, least_bytes: int = 0, shard_bytes: int = SHARD_BYTES, roll_bytes: int = ROLL_BYTES, date: str = DATE) -> None:
    """Write the pages (page_id, url, html) as archives into a new folder."""
    system, path = file_system(folder)
    if system.get_file_info(f"{path}/manifest").type != fs.FileType.NotFound:
        raise FileExistsError(f"{folder} already exists")
    weighed = _records(pages, least_bytes).withColumn("weight", F.expr(f"copies * {HEADERS} + if(NOT shared, copies * size, if(is_first AND chunk = 0, size, 0))"))
    placed = running(weighed, [F.col(c) for c in _PLACE], "weight", "places")
    total = placed.agg(F.sum("weight")).first()[0] or 0
    size = max(shard_bytes, -(-total // MOST_SHARDS))
    # at most MOST_SHARDS places
    cuts = sorted(tuple(r[0]) for r in placed.filter("before > 0").groupBy(F.expr(f"before div {size}").alias("k")).agg(F.min(F.struct(*_PLACE)).alias("place")).filter("k > 0").select("place").collect())
    cuts = [(late, -1 if page is None else page, *rest) for late, page, *rest in cuts]
    copies = placed.filter("shared").select("*", F.explode(F.expr("sequence(0L, copies - 1)")).alias("k")).filter("NOT is_first OR chunk > 0 OR k > 0")
    revisits = copies.select(*_PLACE, F.expr("if(chunk = 0 AND k = 0, 1, 3)").alias("turn"), F.expr(f"chunk * {CHUNK} + k").alias("copy"), "size", "sha1", "of_page", "of_site", F.lit(None).cast("binary").alias("payload"))
    payload = F.coalesce("html", F.lit("")).cast("binary")
    sent = pages.select(F.col("page_id").isNull().alias("late"), F.col("page_id").cast("bigint").alias("page_id"), F.sha2(payload, 256).alias("digest"), F.coalesce(F.concat(F.lit("="), "url"), F.lit("")).alias("site"), F.lit(0).cast("bigint").alias("chunk"), F.lit(2).alias("turn"), F.lit(0).cast("bigint").alias("copy"), F.octet_length(payload).cast("bigint").alias("size"), F.sha1(payload).alias("sha1"), F.lit(None).cast("bigint").alias("of_page"), F.lit(None).cast("string").alias("of_site"), payload.alias("payload"))
    dealt = revisits.unionByName(sent).withColumn("page_id", F.coalesce("page_id", F.lit(-1))).mapInArrow(_dealt(cuts, least_bytes), f"{_ROW}, shard bigint")
    dealt = dealt.withColumn("page_id", F.expr("if(late, null, page_id)"))
    ordered = dealt.repartition(2 * len(cuts) + 1, "shard").sortWithinPartitions("shard", *_PLACE, "turn", "copy")
    files = keep(ordered.mapInArrow(_write(folder, least_bytes, roll_bytes, date), _FILE), "warc-files")
    moved = files.repartition(max(1, min(256, files.count())), "name").mapInArrow(_publish(folder), _FILE)
    moved.drop("temporary").write.parquet(f"{folder}/manifest")
    if total:
        system.delete_dir(f"{path}/_temporary")


def parse(stream: Any, where: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """Fields and block of each record of an archive. A digest that doesn't agree is an error."""
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            raise ValueError(f"{where}: not a record: {line[:40]!r}")
        fields = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode().partition(":")
            fields[name.strip().lower()] = value.strip()
        block = stream.read(int(fields["content-length"]))
        if stream.read(4) != b"\r\n\r\n" or len(block) != int(fields["content-length"]):
            raise ValueError(f"{where}: cut off at {fields.get('warc-record-id')}")
        _agree(fields, "warc-block-digest", block, where)
        yield fields, block


def _agree(fields: dict[str, str], name: str, data: bytes, where: str) -> None:
    given = fields.get(name)
    if given and given != f"sha1:{base64.b32encode(hashlib.sha1(data).digest()).decode()}":
        raise ValueError(f"{where}: {name} of {fields.get('warc-record-id')} doesn't agree")


def _read(folder: str, payloads: bool):
    def row(fields: dict[str, str], block: bytes, where: str) -> tuple:
        head, _, payload = block.partition(b"\r\n\r\n")
        kind = fields["warc-type"]
        if kind == "response":
            _agree(fields, "warc-payload-digest", payload, where)
            size = len(payload)
        else:
            size = int(re.search(rb"(?i)\r\ncontent-length: *(\d+)", head)[1])
        number = lambda name: int(fields[name]) if name in fields else None
        given = payload if payloads and kind == "response" else None
        return number("x-page-id"), size, fields["warc-payload-digest"].removeprefix("sha1:"), kind, number("x-refers-to-page-id"), fields["warc-target-uri"], fields["warc-record-id"], fields.get("warc-refers-to"), given

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = file_system(folder)
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary()]
        names = [c.split()[0] for c in _READ.split(", ")]
        batch_of = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, held = [], 0
                with files.open_input_stream(f"{path}/{name}", compression=None, buffer_size=1 << 20) as raw, gzip.GzipFile(fileobj=raw) as stream:
                    for fields, block in parse(stream, name):
                        if fields["warc-type"] != "warcinfo":
                            rows.append(row(fields, block, name))
                            held += len(rows[-1][-1] or b"") + HEADERS
                            if held >= _BATCH_BYTES:
                                yield batch_of(rows)
                                rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    return run


_READ = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, target_uri string, record_id string, refers_to_record string, payload binary"


def read_warc(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """One row per record of the files in the manifest; a revisit has no payload. Digests are checked in any case."""
    manifest = spark.read.parquet(f"{folder}/manifest")
    return manifest.select("name").repartition(max(1, manifest.count()), "name").mapInArrow(_read(folder, payloads), _READ)
