"""Objects of JSON files, however the files are cut into blocks."""

import json
import random

import pytest
from pyspark.sql import types as T

from colloquy.plans.shared import scratch_path
from colloquy.sources import json_records
from colloquy.sources.datasets import read_json_dataset

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("more", T.StringType())])


@pytest.fixture(params=[150, 1 << 27])
def block(request, spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(request.param))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield request.param
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def records(count, seed):
    chance = random.Random(seed)
    parts = ["}", "{", '"', "\\", "\\\\", '\\"', "],[", ", ", "{}", "}{", "é", "你好", "𝒳", "\n", "\t", "word ", "'"]
    return [
        {"id": n, "text": "".join(chance.choice(parts) for _ in range(chance.randrange(40))), "more": {"deep": [{"x": "}"}, {}, [n]], "{": "{"}}
        for n in range(count)
    ]


def written(tmp_path, *texts):
    for n, text in enumerate(texts):
        (tmp_path / f"part{n}.json").write_bytes(text if isinstance(text, bytes) else text.encode())
    return str(tmp_path)


def texts(spark, path):
    return sorted(r.value for r in json_records.json_objects(spark, path).collect())


def test_every_layout_gives_the_same_objects(spark, tmp_path, block):
    rows = records(12, 1)
    layouts = [
        json.dumps(rows),
        json.dumps(rows, ensure_ascii=False, indent=3) + "\n",
        "\n".join(json.dumps(r, separators=(",", ":")) for r in rows),
        b"\xef\xbb\xbf" + json.dumps(rows[:5], ensure_ascii=False).encode(),
        "[]",
        "",
        " \n ",
    ]
    got = [json.loads(t) for t in texts(spark, written(tmp_path, *layouts))]
    want = rows * 3 + rows[:5]
    key = lambda r: json.dumps(r, sort_keys=True)
    assert sorted(map(key, got)) == sorted(map(key, want))


def test_bad_elements_are_kept_aside(spark, tmp_path, block):
    text = '[{"id": 1, "text": "a"}, 5, "x{y}", null, {"id": "no", "text": "b"}, [{"id": 2}], {"id": 3, "text": }, {"id": 4, "text": "c"}]'
    got = read_json_dataset(spark, written(tmp_path, text), SCHEMA, multi_line=True).collect()
    assert sorted(r.id for r in got if r["_corrupt"] is None) == [1, 2, 4]
    bad = sorted(r["_corrupt"] for r in got if r["_corrupt"] is not None)
    assert bad == ['5, "x{y}", null', '{"id": "no", "text": "b"}', '{"id": 3, "text": }']


def test_broken_ends(spark, tmp_path, block):
    whole = [json.dumps(r) for r in records(6, 2)]
    cut = "[" + ", ".join(whole) + ', {"id": 99, "text": "ends {here} and'
    extra = "[" + whole[0] + "}, " + whole[1] + "]"
    no_bracket = "[" + ",".join(whole[:3])
    got = texts(spark, written(tmp_path, cut, extra, no_bracket))
    good = [t for t in got if t in whole]
    assert sorted(good) == sorted(whole + whole[:3] + whole[:2])
    rest = [t for t in got if t not in whole]
    assert "".join(sorted(rest)).count("99") == 1 and "}" in rest
    assert all("here" in t or "99" in t or "and" in t or t == "}" for t in rest)


def test_objects_that_cover_many_blocks(spark, tmp_path, block):
    rows = [{"id": 1, "text": "}" * 90}, {"id": 2, "text": "{" * 90 + "x" * 900}, {"id": 3, "text": "", "more": [{}] * 60}]
    got = read_json_dataset(spark, written(tmp_path, json.dumps(rows)), SCHEMA, multi_line=True).collect()
    assert sorted((r.id, r.text) for r in got) == [(r["id"], r["text"]) for r in rows]
    assert {r["_corrupt"] for r in got} == {None}


def test_one_file_is_read_by_many_tasks(spark, tmp_path):
    path = written(tmp_path, json.dumps(records(400, 3)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        read = spark.read.option("lineSep", "}").text(path)
        assert read.rdd.getNumPartitions() > 20
        assert json_records.json_objects(spark, path).count() == 400
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_many_blocks_are_joined_by_a_sort(spark, tmp_path, monkeypatch, block):
    rows = records(12, 4)
    monkeypatch.setattr(json_records, "FEW_BLOCKS", 0)
    got = [json.loads(t)["id"] for t in texts(spark, written(tmp_path, json.dumps(rows)))]
    assert sorted(got) == list(range(12))


def test_compressed_file(spark):
    rows = records(30, 5)
    path = scratch_path(spark, "compressed")
    spark.createDataFrame([(json.dumps(rows),)], "value string").coalesce(1).write.option("compression", "gzip").text(path)
    assert sorted(json.loads(t)["id"] for t in texts(spark, path)) == list(range(30))
