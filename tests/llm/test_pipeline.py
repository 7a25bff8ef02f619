import hashlib
import re
import zlib

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from colloquy.llm import bpe, quality, tiling
from test_secrets import brute as base_secrets

GOOD = "The {0} stood by the water, and {1} people walked past it on the {2} morning of that year; none of them looked up."


def prose(n):
    words = [hashlib.md5(f"{n} {i}".encode()).hexdigest().translate(str.maketrans("0123456789", "ghijklmnop"))[:7] for i in range(30)]
    return GOOD.format(*words[:3]) + " " + " ".join(words) + "."


def shingles(text):
    """Runs of five words of a text with A-Z in lower case; the whole of a shorter one."""
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def alike_components(sets):
    """By number, the first of those that chains of pairs of a similarity of 0.8 or more connect."""
    head = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if (not a and not b) or (a and b and len(a & b) >= 0.8 * len(a | b)):
                x, y = sorted((head[i], head[j]))
                head = [x if h == y else h for h in head]
    return head


@pytest.fixture(scope="module")
def folder(spark, table, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("tables"))
    item = "seven wise owls watch from the old oak tree at night while a quick fox jumps over the lazy dog"
    halves = item.split()
    rows = [(i, prose(i)) for i in range(60)]
    rows += [(100 + i, ("SALE!! BUY!! NOW!! %%% $$$ ### " + str(i) + " !! ") * 8) for i in range(30)]
    rows += [(200 + i, prose(5)) for i in range(4)] + [(210, prose(6).replace("morning", "evening"))]
    rows += [(220, prose(70) + " " + " ".join(halves[9:] + ["then"] + halves[:9]))]
    rows += [(230, prose(71) + ' password = "hunter2hunter2"'), (231, prose(72) + " key 0123456789abcdef0123 end")]
    rows += [(240, None), (241, ""), (None, prose(73)), (242, prose(74)), (242, prose(74))]
    table(rows).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(1, item), (2, "x")], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    labels = [(i, 1, 0) for i in range(60)] + [(100 + i, 0, 0) for i in range(30)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return at, rows, item


def test_result_as_brute_force(spark, folder):
    at, rows, item = folder
    docs = spark.read.parquet(f"{at}/documents.parquet")
    labels = spark.read.parquet(f"{at}/labels.parquet").collect()
    learnt = {r.doc_id for r in labels if zlib.crc32(str(r.doc_id).encode()) % 4 != 2}
    model = quality.fit(docs, spark.createDataFrame([r for r in labels if r.doc_id in learnt]))
    good = [r for r in rows if model.scores(quality.features(r[1])[None, :])[0] >= quality.KEEP]
    assert {k for k, _ in good if k is not None and 100 <= k < 130} == set() and {k for k, _ in good} >= set(range(60))
    component = alike_components([shingles(t) for _, t in good])
    groups = {}
    for row, c in zip(good, component):
        groups.setdefault(c, []).append(row)
    single = [min(g, key=lambda r: (r[0] is None, r[0] or 0)) for g in groups.values()]
    items = tiling.Items([(1, item)], tiling.SHORTEST)
    clean = [r for r in single if all(c < tiling.COVERED for _, c, _ in tiling.covered(r[1], items))]
    safe = [r for r in clean if not base_secrets(r[1])]
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    plain = tiktoken.Encoding("p", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for key, text in safe:
        ids = plain.encode_ordinary(text or "")
        want.append((key, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    got = [tuple(r) for r in corpus_pipeline.run(spark, at).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    kept = {k for k, *_ in got}
    assert kept >= set(range(60)) | {None, 242} and not kept & {200, 201, 220, 230, 231}


def test_stages_keep_the_columns_and_take_empty_tables(spark, folder):
    at = folder[0]
    docs = spark.read.parquet(f"{at}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "decontamination", "secrets", "tokens"]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs.limit(0), at)
        assert out.count() == 0
        if name != "tokens":
            assert out.columns == docs.columns
