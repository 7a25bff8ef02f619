import random

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from colloquy.llm import token_counts
from colloquy.llm.queries import queries

FILES = ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"]


def plain(name):
    path = public_tokenizers.path(name)
    if name.endswith("json"):
        library = Tokenizer.from_file(path)
        return lambda text: len(library.encode(text or "", add_special_tokens=False).ids)
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    return lambda text: len(library.encode(text or ""))


def read(name):
    with open(public_tokenizers.path(name), "rb") as file:
        return file.read()


@pytest.mark.parametrize("name", FILES)
def test_odd_rows_as_the_library(spark, table, odd_rows, name):
    count, tokens = plain(name), token_counts.counter(public_tokenizers.path(name))
    rows = odd_rows + [(20, "before <|endoftext|>after <|endoftext|> end"), (21, "<s> x </s>"), (22, " lead　and \x1c trail \x85 ")]
    got = table(rows).select("doc_id", tokens("text").alias("n")).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(((k, count(t)) for k, t in rows), key=repr)
    assert table([]).select(tokens("text")).collect() == []


@pytest.mark.parametrize("name", FILES)
def test_cut_texts_as_whole_ones(name):
    count, chance = plain(name), random.Random(5)
    counter = token_counts.Counter(read(name), name.rsplit(".", 1)[-1])
    parts = ["word", "Ünï", " ", "  ", "\n", "\n\n", "\t", "12", "3a", "'s", "n't", "...", "你好", "，", "<|endoftext|>", "<|end", "of", "text|>", "é", "_", "\x1c", " ", "𝒳"]
    for _ in range(300):
        text = "".join(chance.choice(parts) for _ in range(chance.randrange(1, 80)))
        for least in (1, 3, 17):
            pieces = counter.cut(text, least)
            assert sum(counter.lengths(pieces)) == count(text), (text, pieces)
        if counter.by_words:
            assert list(token_counts.by_words(counter, ["", text, text + " x"])) == [0, count(text), count(text + " x")]


def test_long_texts_are_cut_and_calls_are_even():
    counter = token_counts.Counter(read("byte_bpe_50k.json"), "json")
    long = ["word and word, " * 60_000, "7" * 90_000, "a1" * 50_000]
    pieces = [p for t in long for p in counter.cut(t, token_counts.LONG_BYTES)]
    assert max(len(p) for p in pieces if p[0] != "7") < 2 * token_counts.LONG_BYTES
    made = list(token_counts.calls(pieces + ["some words " * 50] * 900))
    assert max(sum(map(len, c)) for c in made) <= token_counts.CALL_BYTES and len(made) < 14
    texts = ["", *long, "x", "", *["some words " * 50] * 90, ""]
    count = plain("byte_bpe_50k.json")
    want = [count(t) for t in texts]
    assert list(token_counts.in_order(counter, texts)) == want and list(token_counts.by_words(counter, texts)) == want


def test_known_pieces_are_bounded(monkeypatch):
    monkeypatch.setattr(token_counts, "KNOWN_PIECES", 40)
    monkeypatch.setattr(token_counts, "TEXT_AT_ONCE", 60)
    counter = token_counts.Counter(read("byte_bpe_50k.json"), "json")
    texts = [f"number {n} and {n * 7919 % 1000} of many words and wordswordswordswordswordswordswordswordswordswordswords{n}" for n in range(60)]
    count = plain("byte_bpe_50k.json")
    assert list(token_counts.by_words(counter, texts)) == [count(t) for t in texts]
    assert len(counter.known) <= 60 and len(counter.before) <= 60


def test_unknown_file(tmp_path):
    with pytest.raises(ValueError, match="no library"):
        token_counts.Counter(b"", "txt")


def test_query_as_the_library(spark):
    folder = "/root/testdata/sf0.001"
    count = plain("byte_bpe_50k.json")
    rows = spark.read.parquet(f"{folder}/documents.parquet").collect()
    want = {r.doc_id: (len((r.text or "").encode()), count(r.text), count(r.text) > 512) for r in rows}
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in queries()["op12_token_counts"](spark, folder).collect()}
    assert got == want
