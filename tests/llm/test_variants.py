import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from colloquy.llm import variants
from colloquy.llm.queries import queries


def plain_counts(rows, least, dropping):
    out = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % dropping == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= least:
                out[run] += 1
    return out


def plain_near(words):
    """By forms with a letter blanked out or taken out."""
    near = defaultdict(set)
    blanked, cut = defaultdict(list), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            blanked[w[:i] + "*" + w[i + 1 :]].append(w)
            cut[w[:i] + w[i + 1 :]].add(w)
    for group in blanked.values():
        for a in group:
            near[a].update(b for b in group if b != a)
    for w in words:
        for b in cut.get(w, ()):
            near[w].add(b)
            near[b].add(w)
    return near


def plain_variants(counts, ratio=5):
    near = plain_near(counts)
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * n else None
    rows = []
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        rows.append((w, form[w], root, n, len(near[w]), None if form[w] is None else counts[form[w]]))
    return sorted(rows)


def got(spark, counts):
    words = spark.createDataFrame(list(counts.items()) or [], "word string, n long").repartition(5)
    return sorted(tuple(r) for r in variants.grouped(spark, words).select("word", "form", "root", "n", "n_near", "form_n").collect())


def made_words(count, seed, letters="abcdeé", sizes=(6, 9)):
    chance = random.Random(seed)
    return {"".join(chance.choice(letters) for _ in range(chance.randint(*sizes))): chance.choice([5, 6, 30, 200, 1500]) for _ in range(count)}


@pytest.mark.parametrize("seed", [1, 2])
def test_as_brute_force(spark, seed):
    counts = made_words(700, seed)
    assert got(spark, counts) == plain_variants(counts)


def test_many_cells_and_halves(spark, monkeypatch):
    counts = made_words(900, 3) | {w: 7 for w in made_words(300, 4, "ab", (7, 8))}
    want = plain_variants(counts)
    monkeypatch.setattr(variants, "CELL", 40)
    monkeypatch.setattr(variants, "LEAF", 4)
    monkeypatch.setattr(variants, "WORDS_AT_ONCE", 17)
    monkeypatch.setattr(variants, "PAIRS_AT_ONCE", 50)
    for crowded in (10**6, 1, 0):
        monkeypatch.setattr(variants, "CROWDED", crowded)
        assert got(spark, counts) == want
    monkeypatch.setattr(variants, "SAMPLE", 60)
    assert got(spark, counts) == want


def test_anagrams_long_words_and_chains(spark):
    chance = random.Random(5)
    letters = list("aabbcdeffg")
    counts = {}
    for _ in range(400):
        chance.shuffle(letters)
        counts["".join(letters)] = 5
        counts["".join(letters[:-1])] = 5
    counts |= {"letter": 5, "lettera": 30, "letterab": 400, "letterabc": 2500, "a" * 3000: 5, "a" * 2999 + "b": 26, "a" * 3001: 25, "×÷ßàáâ": 25, "×÷ßàáã": 5, "×÷ßàáä": 25}
    assert got(spark, counts) == plain_variants(counts)
    assert {r[0]: r[2] for r in got(spark, counts)}["letter"] == "letterabc"


def test_no_words_and_one_word(spark):
    assert got(spark, {}) == []
    assert got(spark, {"single": 9}) == [("single", None, "single", 9, 0, None)]


def test_counts_as_brute_force(spark, table, odd_rows, monkeypatch):
    rows = odd_rows + [(30, "Ünïcode×Wörter İstanbul K ſ " + "Repeated repeated REPEATED " * 40), (31, "x" * 500), (2**40, "word " * 300)]
    rows += [(i, "several different longish words appear herein again") for i in range(40, 90)]
    for size in (1 << 20, 64):
        monkeypatch.setattr(variants, "AT_ONCE", size)
        monkeypatch.setattr(variants, "HELD_WORDS", 50 if size == 64 else 10**6)
        for dropping in (3, 199):
            found = variants.word_counts(table(rows), 6, dropping).collect()
            assert {r.word: r.n for r in found} == dict(plain_counts(rows, 6, dropping))
    assert variants.word_counts(table([]), 6, 199).collect() == []
    plain = Counter(w for _, t in rows for w in re.findall("[A-Za-zÀ-ÿ]+", (t or "").encode().lower().decode()) if len(w) > 5)
    assert {r.word: r.n for r in variants.word_counts(table(rows), 6).collect()} == dict(plain)


def test_tree_search_reaches_all_near_vectors():
    words = list(made_words(400, 6))
    points = variants.vectors(words)
    tree = variants.Tree(points, 5)
    reached = np.zeros((len(words), len(words)), bool)
    for node, ids in tree.search(points, 1, 1):
        reached[np.ix_(ids, tree.members[node])] = True
    up = (points[None] - points[:, None]).clip(0).sum(2)
    down = (points[:, None] - points[None]).clip(0).sum(2)
    assert reached[(up <= 1) & (down <= 1)].all() and reached.mean() < 0.5
    homes = np.zeros(len(words), int)
    for node, ids in tree.search(points, 0, 0):
        homes[ids] += 1
        assert set(ids) <= set(tree.members[node])
    assert (homes == 1).all()


def test_query_as_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    counts = {w: n for w, n in plain_counts(rows, 6, 199).items() if n >= 5}
    found = queries()["op13_variants"](spark, folder).select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert sorted(map(tuple, found)) == plain_variants(counts) and len(found) > 100
