import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from colloquy.llm import simhash
from colloquy.llm.common import Stored
from colloquy.llm.components import connected


def plain_print(text, width=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    runs = [words[i : i + width] for i in range(len(words) - width + 1)] or [words]
    hashes = [xxhash.xxh64_intdigest(b" ".join(r), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, radius):
    """The smallest position that each can reach, by comparing all."""
    label = list(range(len(prints)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if (a ^ b).bit_count() <= radius and label[j] < label[i]:
                    label[i], changed = label[j], True
    return label


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abAB é\t\n\x0b\x1c ", max_size=60))
def test_fingerprint_of_a_text(text):
    assert simhash.simhash(text) % (1 << 64) == plain_print(text)


def test_long_text_in_pieces(monkeypatch):
    text = " ".join(str(i * i % 1009) for i in range(5000))
    whole = simhash.simhash(text)
    monkeypatch.setattr(simhash, "HASHES_AT_ONCE", 37)
    assert simhash.simhash(text) == whole and whole % (1 << 64) == plain_print(text)


def chains(seed, count=160):
    """Fingerprints in chains and clusters, a few bits apart, besides far ones."""
    chance = np.random.default_rng(seed)
    prints = [int(x) for x in chance.integers(0, 1 << 63, 12, dtype=np.int64)] + [0, (1 << 64) - 1]
    while len(prints) < count:
        flips = chance.choice(64, int(chance.integers(1, 7)), replace=False)
        prints.append(prints[int(chance.integers(len(prints)))] ^ sum(1 << int(b) for b in flips))
    return prints


def met_components(spark, prints, radius):
    signed = [p - (1 << 64) if p >= 1 << 63 else p for p in sorted(set(prints))]
    fps = spark.createDataFrame([(s,) for s in signed], "fp long").repartition(3)
    store = Stored(spark, "test")
    heads = {r.node: r["head"] for r in connected(spark, simhash.near_links(spark, fps, radius, store), store).collect()}
    return signed, [heads.get(s, s) for s in signed]


def same_partition(a, b):
    return len(set(zip(a, b))) == len(set(a)) == len(set(b))


def test_links_connect_what_brute_force_connects(spark):
    for radius in (0, 1, 3, 4):
        signed, heads = met_components(spark, chains(radius), radius)
        assert same_partition(heads, plain_components([s % (1 << 64) for s in signed], radius)), radius


def test_crowded_prefixes_are_cut(spark, monkeypatch):
    base = 0x0123456789ABCDEF
    cluster = {base ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(0, 64, 7)} | {base ^ (0xFF << 20)}
    want_signed, want = met_components(spark, cluster, 4)
    monkeypatch.setattr(simhash, "MOST_MEMBERS", 100)
    monkeypatch.setattr(simhash, "VARIANTS_AT_ONCE", 500)
    signed, heads = met_components(spark, cluster, 4)
    assert signed == want_signed and same_partition(heads, want)
    assert same_partition(want, plain_components([s % (1 << 64) for s in signed], 4))


def test_components_of_paths_and_stars(spark):
    store = Stored(spark, "test")
    path = [(i, i + 1) for i in range(300)]
    star = [(1000, 1001 + i) for i in range(200)]
    links = spark.createDataFrame(path + star + [(7, 7), (1, 0)], "a long, b long")
    heads = {r.node: r["head"] for r in connected(spark, links, store).collect()}
    assert len({heads[i] for i in range(301)}) == 1 and len({heads[i] for i in range(1000, 1201)}) == 1
    assert heads[0] != heads[1000] and len(heads) == 502
    assert connected(spark, links.limit(0), store).count() == 0


def test_odd_rows(spark, table, odd_rows):
    rows = simhash.near_copies(spark, table(odd_rows)).collect()
    assert len(rows) == len(odd_rows)
    prints = {r.doc_id: r.fp for r in rows if r.doc_id in (2, 3, 4)}
    assert set(prints.values()) == {0}
    assert {r.doc_id: r.component for r in rows if r.doc_id in (1, 2, 3, 4)} == {1: 1, 2: 2, 3: 2, 4: 2}
    assert {r.component for r in rows if r.doc_id == 7} == {1, 7}
    assert [r.component for r in rows if r.doc_id is None] == [None, 2] or sorted(
        (r.component is None, r.component or 0) for r in rows if r.doc_id is None
    ) == [(False, 2), (True, 0)]
    assert simhash.near_copies(spark, table([])).count() == 0


def test_one_of_each_keeps_columns_and_one_row(spark, table, odd_rows):
    docs = table(odd_rows)
    kept = simhash.one_of_each(spark, docs)
    assert kept.columns == docs.columns and kept.schema == docs.schema
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    want = {(1, odd_rows[0][1]), (2, None), (5, odd_rows[4][1]), (6, odd_rows[5][1]), (7, odd_rows[8][1]), (None, odd_rows[9][1])}
    assert got == sorted(want, key=repr)
    twice = table([(3, "same words here again"), (3, "same words here again")])
    assert simhash.one_of_each(spark, twice).count() == 1
    assert simhash.one_of_each(spark, table([])).count() == 0
