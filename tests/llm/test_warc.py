"""Archives against plain rules, and what failed or repeated attempts leave."""

from __future__ import annotations

import base64
import glob
import gzip
import hashlib
import os

import pytest

from rollbook.llm import warc
from rollbook.llm.warc import parse, read_warc, write_warc

PAGES = "page_id bigint, url string, html string, digest string, chunk int, payload string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "d", 1, "p") for r in rows], PAGES)


def expected(rows, least=0):
    """page_id, payload_bytes, payload_digest, record_type, refers_to of each page."""
    out, groups = [], {}
    for page, url, html in rows:
        body = (html or "").encode()
        groups.setdefault(body, []).append((page is None, page or 0, url or "", page))
    for body, some in groups.items():
        some.sort(key=lambda r: r[:3])
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        for k, row in enumerate(some):
            again = k > 0 and len(body) >= least
            out.append((row[3], len(body), digest, "revisit" if again else "response", some[0][3] if again else None))
    return sorted(out, key=repr)


def results(df):
    return sorted((tuple(r) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=repr)


ROWS = [
    (5, "http://a/5", "same"), (3, "http://a/3", "same"), (9, None, "same"), (None, "http://a/none", "same"), (4, "http://a/4 b\r\nX: y", "other \r\n\r\n WARC/1.1\r\n"), (6, "http://é/ü", None), (7, "u", ""), (None, None, None),
    (8, "http://a/8", "twice"), (8, "http://a/8", "twice"), (8, "http://a/8b", "twice"), (10, "http://a/10", "<p>é 🙂</p>" * 40_000), (2, "http://a/2", "no id before"), (None, None, "no id"), (None, None, "no id"), (0, "http://a/0", "first"), (-4, "x", "below zero"),
]


@pytest.mark.usefixtures("few_rows")
@pytest.mark.parametrize("least", [0, 5, 100])
def test_records_of_odd_pages(spark, tmp_path, least):
    folder = f"file://{tmp_path}/w"
    write_warc(pages(spark, ROWS), folder, least_bytes=least, shard_bytes=2000)
    assert results(read_warc(spark, folder)) == expected(ROWS, least)
    got = read_warc(spark, folder).collect()
    bodies = {base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode(): (h or "").encode() for _, _, h in ROWS}
    assert all(bytes(r["payload"]) == bodies[r["payload_digest"]] for r in got if r["record_type"] == "response")
    assert all(r["payload"] is None for r in got if r["record_type"] == "revisit")
    ids = {r["record_id"]: r for r in got}
    assert len(ids) == len(ROWS)
    assert all(ids[r["refers_to_record"]]["payload_digest"] == r["payload_digest"] and ids[r["refers_to_record"]]["record_type"] == "response" for r in got if r["record_type"] == "revisit")
    assert {r["target_uri"] for r in got} >= {"http://a/4%20b%0D%0AX:%20y", "http://é/ü", "urn:page:9", "urn:page:"}


@pytest.mark.usefixtures("few_rows")
def test_empty_table(spark, tmp_path):
    write_warc(pages(spark, []), f"file://{tmp_path}/w")
    assert read_warc(spark, f"file://{tmp_path}/w").count() == 0


def files(folder):
    return {os.path.basename(f): open(f, "rb").read() for f in glob.glob(f"{folder}/*.warc.gz")}


def test_same_bytes_for_the_same_pages(spark, tmp_path):
    """Shards and files don't depend on partitions or the order of the rows; small files roll, members stand alone, copies split."""
    rows = [(k, f"http://h/{k}", f"body {k % 700} " * (k % 40)) for k in range(2000)] + [(50, "same", "row")] * 1500
    before, chunk = spark.conf.get("spark.sql.shuffle.partitions"), warc.CHUNK
    warc.CHUNK = 100
    try:
        for n, some in ((2, rows), (7, rows[::-1])):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            write_warc(pages(spark, some).repartition(n), f"file://{tmp_path}/{n}", shard_bytes=200_000, roll_bytes=10_000)
    finally:
        warc.CHUNK = chunk
        spark.conf.set("spark.sql.shuffle.partitions", before)
    one, two = files(f"{tmp_path}/2"), files(f"{tmp_path}/7")
    assert one == two and len({name[:12] for name in one}) > 5 and any(name.endswith("-00001.warc.gz") for name in one)
    assert results(read_warc(spark, f"file://{tmp_path}/2", payloads=False)) == expected(rows)
    last = []
    for name in sorted(one):
        with gzip.open(f"{tmp_path}/2/{name}") as stream:
            records = list(parse(stream, name))
        assert records[0][0]["warc-type"] == "warcinfo" and len(one[name]) < 20_000
        last += [int(f["x-page-id"]) for f, _ in records[1:]]
    assert last == sorted(last) and len(last) == len(rows)
    copies = {r["name"]: r["records"] for r in spark.read.parquet(f"{tmp_path}/2/manifest").collect()}
    assert sum(copies.values()) == len(rows) and copies.keys() == one.keys()
    assert {r["name"]: r["sha256"] for r in spark.read.parquet(f"{tmp_path}/2/manifest").collect()} == {n: hashlib.sha256(b).hexdigest() for n, b in one.items()}
    assert not os.path.exists(f"{tmp_path}/2/_temporary")


def test_only_committed_files_are_read(spark, tmp_path):
    folder = f"file://{tmp_path}/w"
    write_warc(pages(spark, ROWS), folder)
    (tmp_path / "w" / "shard-999999-00000.warc.gz").write_bytes(b"of a lost attempt")
    assert results(read_warc(spark, folder)) == expected(ROWS)
    with pytest.raises(FileExistsError, match="already exists"):
        write_warc(pages(spark, ROWS), folder)


def test_a_file_is_moved_once(tmp_path):
    """A task that is repeated finds its file moved; one whose file is gone fails."""
    import pyarrow as pa

    (tmp_path / "t.gz").write_bytes(b"abc")
    batch = lambda size: pa.RecordBatch.from_pydict({"name": ["f.gz"], "temporary": [f"{tmp_path}/t.gz"], "records": [1], "bytes": [size], "sha256": [""]})
    run = warc._publish(f"file://{tmp_path}")
    for _ in range(2):
        assert len(list(run(iter([batch(3)])))) == 1 and (tmp_path / "f.gz").read_bytes() == b"abc"
    with pytest.raises(FileNotFoundError):
        list(run(iter([batch(4)])))


def test_changed_bytes_are_an_error(spark, tmp_path):
    folder = f"file://{tmp_path}/w"
    write_warc(pages(spark, [(1, "u", "some text")]), folder)
    (path,) = glob.glob(f"{tmp_path}/w/*.warc.gz")
    with gzip.open(path) as stream:
        data = stream.read()
    with gzip.open(path, "wb") as out:
        out.write(data.replace(b"some text", b"same text"))
    with pytest.raises(Exception, match="doesn't agree"):
        read_warc(spark, folder).collect()
