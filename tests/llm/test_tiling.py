import random

import pytest

from colloquy.llm import tiling

ITEM = "the quick brown fox jumps over a lazy dog while seven wise owls watch from the old oak tree at night"


def plain_tiles(a, b, shortest):
    """Greedy string tiling by comparing all places, from the definition."""
    in_a, in_b, out = [False] * len(a), [False] * len(b), []
    while True:
        best = None
        for q in range(len(a)):
            for p in range(len(b)):
                n = 0
                while q + n < len(a) and p + n < len(b) and a[q + n] == b[p + n] and not in_a[q + n] and not in_b[p + n]:
                    n += 1
                if n >= shortest and (best is None or n > best[2]):
                    best = (q, p, n)
        if best is None:
            return out
        q, p, n = best
        out.append(best)
        in_a[q : q + n] = [True] * n
        in_b[p : p + n] = [True] * n


def test_tiles_as_brute_force():
    chance = random.Random(7)
    for _ in range(150):
        item = [chance.choice("abc") for _ in range(chance.randrange(3, 14))]
        text = [chance.choice("abcx") for _ in range(chance.randrange(0, 40))]
        items = tiling.Items([(1, " ".join(item))], 3)
        found = tiling.covered(" ".join(text), items)
        want = plain_tiles(item, text, 3)
        assert (found[0][2] if found else []) == want
        if want:
            assert found[0][1] == pytest.approx(sum(t[2] for t in want) / len(item))


def matched(spark, docs, items, **more):
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = tiling.matcher(bench, **more)
    rows = docs.select("doc_id", found(docs["text"]).alias("m")).collect()
    return [(r.doc_id, [(m["item"], round(m["coverage"], 3)) for m in r.m]) for r in rows]


def test_reordered_and_changed_passages(spark, table):
    words = ITEM.split()
    moved = " ".join(words[10:] + ["besides"] + words[:10])
    docs = [
        (1, "before " + ITEM.upper() + ", after"),
        (2, moved),
        (3, " ".join(words[:9])),
        (4, "nothing in common with it whatever is said"),
        (5, " ".join(words[:4]) + " gap " + " ".join(words[6:10]) + " gap " + " ".join(words[14:18])),
    ]
    got = dict(matched(spark, table(docs), [(7, ITEM)]))
    assert got[1] == [(7, 1.0)] and got[2] == [(7, 1.0)] and got[3] == [(7, round(9 / 21, 3))]
    assert got[4] == [] and got[5] == []
    assert dict(matched(spark, table(docs), [(7, ITEM)], least=tiling.COVERED))[3] == []


def test_blocks_of_items_and_portions_of_text(spark, table, monkeypatch):
    items = [(i, " ".join(f"w{(i * 13 + j) % 40}" for j in range(12))) for i in range(30)] + [(50, ITEM), (51, ITEM)]
    docs = [(i, "x " * i + items[i][1] + " y") for i in range(30)] + [(90, f"{ITEM} {ITEM}")]
    whole = matched(spark, table(docs), items)
    assert dict(whole)[90] == [(50, 1.0), (51, 1.0)]
    monkeypatch.setattr(tiling, "BLOCK_CHARS", 200)
    monkeypatch.setattr(tiling, "TEXT_AT_ONCE", 17)
    assert sorted(matched(spark, table(docs), items)) == sorted(whole)


def test_odd_rows_and_items(spark, table, odd_rows):
    items = [(1, None), (2, ""), (3, "too short"), (None, ITEM), (4, odd_rows[0][1])]
    got = matched(spark, table(odd_rows), items)
    assert len(got) == len(odd_rows)
    assert sorted(k for k, m in got if m) == [1, 7, 7] and all(m == [(4, 1.0)] for _, m in got if m)
    assert matched(spark, table([]), items) == []
    assert all(not m for _, m in matched(spark, table(odd_rows), []))


def test_query_flags_documents_with_whole_items(spark):
    from colloquy.llm.queries import queries

    folder = "/root/testdata/sf0.001"
    items = [(r.item_id, tiling.words(r.text)) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    docs = {r.doc_id: " ".join(tiling.words(r.text)) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for r in queries()["op9_tiling"](spark, folder).collect():
        inside = [k for k, w in items if f" {' '.join(w)} " in f" {docs[r.doc_id]} "]
        assert set(inside) <= set(r["items"]) and r.contaminated == bool(r["items"])
        assert bool(inside) == r.contaminated
