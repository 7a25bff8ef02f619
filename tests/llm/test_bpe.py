import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from colloquy.llm import bpe

RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
PLAIN = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def coded(docs):
    return [(r.doc_id, r.ids, bytes(r.decoded)) for r in bpe.encode(docs, RANKS, public_tokenizers.PATTERN).collect()]


def expected(pairs):
    return [(k, PLAIN.encode_ordinary(t or ""), (t or "").encode()) for k, t in pairs]


def test_odd_rows_as_the_library(spark, table, odd_rows):
    assert sorted(coded(table(odd_rows)), key=repr) == sorted(expected(odd_rows), key=repr)
    assert coded(table([])) == []


def test_random_characters_as_the_library(spark, table):
    chance = random.Random(3)
    ranges = [(32, 127), (9, 14), (28, 32), (0x80, 0x250), (0x400, 0x500), (0x2000, 0x2070), (0x4E00, 0x4F00), (0x1F600, 0x1F650), (0x10D40, 0x10D4A), (0x1C89, 0x1C8B)]
    texts = ["".join(chr(chance.randrange(*chance.choice(ranges))) for _ in range(chance.randrange(1, 120))) for _ in range(150)]
    texts += ["it's we'll I'd 'tis", "  two  spaces \n\n  and lines\t\ttabs ", "<|endoftext|> is text", "a" * 900, "ab" * 700, "0123456789" * 30]
    pairs = list(enumerate(texts))
    assert sorted(coded(table(pairs))) == sorted(expected(pairs))


def test_long_words_by_the_heap(spark, table, monkeypatch):
    chance = random.Random(4)
    words = ["".join(chance.choice("etaoinshr") for _ in range(n)) for n in (1, 2, 30, 1100, 3000)] + ["z" * 2500]
    for word in words:
        assert bpe.merged_long(word.encode(), RANKS) == PLAIN.encode_ordinary(word)
    monkeypatch.setattr(bpe, "LONG_WORD", 3)
    monkeypatch.setattr(bpe, "LONG_TEXT", 100)
    pairs = list(enumerate([" ".join(words), "thnt ereres", "été " * 60]))
    assert sorted(coded(table(pairs))) == sorted(expected(pairs))


def test_many_texts_in_portions(spark, table, monkeypatch):
    pairs = [(i, f"document {i} about " + "words " * (i % 9)) for i in range(300)]
    monkeypatch.setattr(bpe, "WORDS_AT_ONCE", 40)
    monkeypatch.setattr(bpe, "BLOCK_WORDS", 50)
    monkeypatch.setattr(bpe, "KNOWN_WORDS", 120)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        assert sorted(coded(table(pairs))) == sorted(expected(pairs))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_frequent_words_are_folded_once_for_all_tasks(spark, table, monkeypatch):
    pairs = [(i, f"about zyzzyvas and quixotry {i % 40} wordsmithery " + "syzygies " * (i % 9)) for i in range(300)]
    monkeypatch.setattr(bpe, "SAMPLE_BYTES", 1 << 12)
    monkeypatch.setattr(bpe, "FREQUENT_WORDS", 12)
    monkeypatch.setattr(bpe, "KNOWN_WORDS", 10)
    monkeypatch.setattr(bpe, "BLOCK_WORDS", 50)
    ranks = bpe.RankMap(RANKS)
    known = bpe.frequent(table(pairs), ranks, public_tokenizers.PATTERN, RANKS, "doc_id", "text").value
    assert len(known[0]) == 12 and " syzygies" in known[0].to_pylist()
    for word, ids, decoded in zip(*(c.to_pylist() for c in known)):
        assert ids == PLAIN.encode_ordinary(word) and decoded == word.encode()
    assert sorted(coded(table(pairs))) == sorted(expected(pairs))


@pytest.mark.parametrize("name", ["byte_bpe_50k.tiktoken"])
def test_other_vocabulary(spark, table, name):
    ranks = bpe.read_ranks(public_tokenizers.path(name))
    plain = tiktoken.Encoding("p", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    text = "Any vocabulary will do, naïvely: 你好."
    rows = bpe.encode(table([(1, text)]), ranks, public_tokenizers.PATTERN).collect()
    assert rows[0].ids == plain.encode_ordinary(text) and bytes(rows[0].decoded).decode() == text


def test_query_as_the_library(spark):
    from colloquy.llm.queries import queries

    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for r in queries()["op10_bpe"](spark, folder).collect():
        ids = PLAIN.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_tables_do_not_stand_in_the_plan(spark, table):
    plan = bpe.encode(table([(1, "some words")]), RANKS, public_tokenizers.PATTERN)._jdf.queryExecution().toString()
    assert len(plan) < 50_000  # the driver keeps several descriptions of every query


def test_a_stage_has_one_python_worker_per_task(spark, table):
    plan = bpe.encode(table([(1, "some words")]), RANKS, public_tokenizers.PATTERN)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 2 and "Exchange hashpartitioning" in plan.split("MapInArrow")[1]
