import hashlib
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from colloquy.llm import multiset
from colloquy.llm.multiset import Sum

LINES = st.lists(st.text(alphabet="ab é 1", max_size=12), max_size=8)


@settings(max_examples=50, deadline=None)
@given(LINES, st.randoms())
def test_order_of_paragraphs_does_not_matter(lines, chance):
    other = lines[:]
    chance.shuffle(other)
    a, b = Sum.of("\n".join(lines)), Sum.of("\n".join(other))
    assert a == b and a.hex() == b.hex() and a.likeness(b) == 1.0
    assert Sum.from_hex(a.hex()) == a


@settings(max_examples=50, deadline=None)
@given(LINES, LINES)
def test_insertion_and_deletion(kept, more):
    both = Sum.of("\n".join(kept + more))
    assert both == Sum.of("\n".join(kept)) + Sum.of("\n".join(more))
    assert both - Sum.of("\n".join(more)) == Sum.of("\n".join(kept))
    differ = Counter(multiset.paragraphs("\n".join(kept))) != Counter(multiset.paragraphs("\n".join(kept + more)))
    assert (both != Sum.of("\n".join(kept))) == differ


def test_repeats_count_and_likeness_follows_the_common_part():
    assert Sum.of("a\na") != Sum.of("a")
    lines = [f"paragraph {i} with the words {i * 7} and {i * 11} in it" for i in range(400)]
    whole = Sum.of("\n".join(lines))
    near = [whole.likeness(Sum.of("\n".join(lines[:n] + [x + " else" * 9 for x in lines[n:]]))) for n in (0, 100, 200, 300, 390)]
    assert near == sorted(near) and near[4] > 0.9 and near[3] > near[1]
    assert whole.likeness(Sum.of("nothing\nin\ncommon")) < 0.3
    assert Sum.of(None) == Sum.of("") == Sum.of(" \n\t") == Sum()


def brute(pairs):
    rows = sorted(pairs, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    out = []
    for n, (key, text) in enumerate(rows):
        text, after = text or "", rows[(n + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        a, b = Sum.of(text), Sum.of(edited)
        out.append((key, len(text), edited, a.hex(), b.hex(), a.likeness(b), a.likeness(Sum.of(after))))
    return sorted(out, key=repr)


def got(spark, docs):
    return sorted((tuple(r) for r in multiset.compared(spark, docs).collect()), key=repr)


def test_odd_rows_meet_their_next(spark, table, odd_rows):
    assert got(spark, table(odd_rows)) == brute(odd_rows)
    assert got(spark, table([])) == []
    assert got(spark, table([(4, "alone here")])) == brute([(4, "alone here")])


def test_many_ranges(spark, table, monkeypatch):
    monkeypatch.setattr(multiset, "RANGE_BYTES", 300)
    rows = [(i * i - 50, f"text {i}\nline {'x' * (i % 40)}") for i in range(120)] + [(None, "n"), (14, "again"), (14, "twice")]
    assert got(spark, table(rows)) == brute(rows)


def test_fingerprint_column_and_query(spark, table, odd_rows):
    docs = table(odd_rows)
    rows = docs.select("text", multiset.fingerprint(docs["text"]).alias("f")).collect()
    assert all(r.f == Sum.of(r.text).hex() for r in rows)
    from colloquy.llm.queries import queries

    folder = "/root/testdata/sf0.001"
    pairs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    want = {r[0]: r for r in brute(pairs)}
    for r in queries()["op4_multiset"](spark, folder).collect():
        key, n, edited, a, b, near, following = want[r.doc_id]
        assert (r.n_chars, r.edited_sha256, r.fingerprint) == (n, hashlib.sha256(edited.encode()).hexdigest(), a)
        assert (r.edited_fingerprint, r.near_edited, r.near_next) == (b, near, following)
