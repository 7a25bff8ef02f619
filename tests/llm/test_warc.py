import base64
import gzip
import hashlib
import os

import pytest

from colloquy.llm import warc


@pytest.fixture
def pages(spark):
    def made(rows, parts=3):
        df = spark.createDataFrame([(k, u, h, "z", "z", "z") for k, u, h in rows], "page_id long, url string, html string, shard string, turn string, sha1 string")
        return df.repartition(parts) if rows else df

    return made


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def brute(rows, least=0):
    out = []
    for key, _, html in rows:
        data = (html or "").encode()
        same = [k for k, _, h in rows if (h or "") == (html or "") and k is not None]
        first = max(same, default=None)
        revisit = len(data) >= least and first is not None and (key is None or key < first)
        out.append((key, len(data), digest(html), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=repr)


def got(spark, folder):
    rows = warc.read(spark, folder).collect()
    for r in rows:
        if r.record_type == "response":
            assert digest(bytes(r.payload).decode()) == r.payload_digest
        else:
            assert r.payload is None
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows), key=repr)


ROWS = [
    (1, "http://a.example/1", "<p>same</p>"),
    (9, "http://a.example/9", "<p>same</p>"),
    (5, "http://b.example/ with space\r\nInjected: yes", "<p>same</p>"),
    (2, None, None),
    (3, "", ""),
    (4, "http://c.example/é", "é" * 3000),
    (9, "http://a.example/9", "<p>same</p>"),
    (9, "http://a.example/9b", "<p>other of one key</p>"),
    (None, "http://n.example", "<p>same</p>"),
    (None, "http://n.example", "<p>no key</p>"),
]


def test_odd_rows_round_trip(spark, pages, tmp_path):
    for least in (0, 20):
        folder = f"{tmp_path}/{least}"
        manifest = warc.write(spark, pages(ROWS), folder, least=least)
        assert got(spark, folder) == brute(ROWS, least)
        assert sum(r.records for r in manifest.collect()) == len(ROWS)


def test_empty_table(spark, pages, tmp_path):
    assert warc.write(spark, pages([]), f"{tmp_path}/none").count() == 0
    assert got(spark, f"{tmp_path}/none") == []


def many():
    return [(i * 3, f"http://h{i % 7}.example/{i}", f"<p>page {i % 90}</p>" * (i % 11 + 1)) for i in range(400)]


def test_same_rows_give_the_same_bytes(spark, pages, tmp_path):
    for name, rows, parts in (("a", many(), 2), ("b", many()[::-1], 7)):
        warc.write(spark, pages(rows, parts), f"{tmp_path}/{name}", shards=4, roll_bytes=3000)
    read = lambda name: {f: (tmp_path / name / f).read_bytes() for f in os.listdir(tmp_path / name) if f.endswith(".warc.gz")}
    files = read("a")
    assert files == read("b") and len(files) > 8
    assert got(spark, f"{tmp_path}/a") == brute(many())


def test_files_roll_in_key_order_and_fit_the_manifest(spark, pages, tmp_path):
    manifest = warc.write(spark, pages(many()), f"{tmp_path}/x", shards=3, roll_bytes=2000).orderBy("name").collect()
    keys = []
    for r in manifest:
        data = (tmp_path / "x" / r.name).read_bytes()
        assert (len(data), hashlib.sha256(data).hexdigest()) == (r.bytes, r.sha256) and len(data) <= 2600
        text = gzip.decompress(data).decode()
        assert text.startswith("WARC/1.1\r\nWARC-Type: warcinfo")
        keys += [int(line[9:]) for line in text.split("\r\n") if line.startswith("Row-Key: ")]
    assert keys == sorted(keys) and len(keys) == 400
    assert not (tmp_path / "x" / "_tmp").exists()


def test_nothing_is_seen_before_the_commit_and_broken_records_are_told(spark, pages, tmp_path):
    folder = f"{tmp_path}/y"
    warc.write(spark, pages(many()), folder, shards=1)
    (name,) = [r.name for r in warc.manifest_of(spark, folder).collect()]
    (tmp_path / "y" / "shard-000009-000000.warc.gz").write_bytes(b"of an attempt that failed")
    assert len(got(spark, folder)) == 400
    path = tmp_path / "y" / name
    parts = list(warc.members(open(path, "rb")))
    fields = parts[1].replace(b"page 0", b"page X", 1)
    path.write_bytes(gzip.compress(parts[0]) + gzip.compress(fields))
    with pytest.raises(Exception, match="block digest"):
        warc.read(spark, folder).collect()


def test_a_rename_that_fails_is_told(spark, tmp_path):
    staged = spark.createDataFrame([], warc.ENTRY)
    fields = {f.name: None for f in staged.schema} | {"temporary": "_tmp/not there", "name": "shard-0.warc.gz"}
    staged = spark.createDataFrame([tuple(fields.values())], staged.schema)
    with pytest.raises(Exception, match="could not rename|not there"):
        warc.commit(spark, staged, str(tmp_path / "archive"))
    assert not os.path.exists(tmp_path / "archive" / "_manifest")
