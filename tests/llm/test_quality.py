import zlib

import numpy as np
import pytest

from colloquy.llm import quality

GOOD = "The river ran past {} houses, and number {} of them stood empty; nobody knew why."
BAD = "BUY!! NOW!! {}%% {}%% $$$ !!!"


def made(table, spark, count=120):
    rows = [(i, (GOOD if i % 3 else BAD).format(i, i * 7) * (1 + i % 4)) for i in range(count)]
    labels = spark.createDataFrame([(i, int(bool(i % 3)), 0, "z") for i in range(count)], "doc_id long, quality int, toxic int, text string")
    return table(rows), labels


def test_learns_the_order_and_the_threshold(spark, table):
    docs, labels = made(table, spark)
    model = quality.fit(docs, labels.where("doc_id % 5 <> 0"))
    scores = {r.doc_id: r.s for r in docs.select("doc_id", quality.score(docs["text"], model).alias("s")).collect()}
    assert all((scores[i] >= quality.KEEP) == bool(i % 3) for i in scores) and all(0 <= s <= 1 for s in scores.values())
    stricter = quality.fit(docs, labels, reject=0.6)
    kept = sum(r.s >= quality.KEEP for r in docs.select(quality.score(docs["text"], stricter).alias("s")).collect())
    assert 0.35 < kept / 120 < 0.45


def test_sample_is_bounded_and_repeatable(spark, table):
    docs, labels = made(table, spark)
    assert quality.fit(docs, labels, most=10) == quality.fit(docs.repartition(7), labels.repartition(2), most=10)
    held = quality.labelled(docs, labels, "doc_id", "text", "quality", 10)
    assert held.groupby("label").size().to_dict() == {0: 10, 1: 10}


def test_threshold_is_over_all_labelled_documents(spark, table):
    docs, labels = made(table, spark)
    for reject in (None, 0.0, 0.2, 0.5, 1.0):
        model = quality.fit(docs, labels, most=10, reject=reject)
        weights = np.array(model.weights)
        strengths = quality.strengths(np.array([quality.features(r.text) for r in docs.collect()]), weights)
        want = quality.quantile(strengths, np.ones(120), 1 / 3 if reject is None else reject)
        assert abs(model.threshold - want) < 1e-9


def test_ranks_as_sorted(spark):
    chance = np.random.default_rng(3)
    values = sorted([*chance.normal(size=300).tolist(), *[0.25] * 50, 1e300, -1e-300, 5e-324, 1e-9, 1e-9 + 1e-24])
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [quality.ranked(df, n) for n in (0, 1, 150, 170, 200, len(values) - 1)] == [values[n] for n in (0, 1, 150, 170, 200, len(values) - 1)]


def test_odd_rows_and_labels(spark, table, odd_rows):
    docs = table(odd_rows)
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (5, 1), (None, 1), (6, None), (6, 7), (99, 0)], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    rows = docs.select("text", quality.score(docs["text"], model).alias("s")).collect()
    assert len(rows) == len(odd_rows) and all(0 <= r.s <= 1 for r in rows)
    assert len({r.s for r in rows if not (r.text or "").strip()}) == 1
    none = table([])
    assert none.select(quality.score(none["text"], model)).collect() == []


def test_without_both_labels_all_stay(spark, table):
    docs, labels = made(table, spark, 12)
    for some in (labels.where("quality = 1"), labels.limit(0)):
        model = quality.fit(docs, some)
        assert {round(r[0], 12) for r in docs.select(quality.score(docs["text"], model)).collect()} == {quality.KEEP}


def test_quantile_is_between_its_neighbours():
    values, weight = np.array([3.0, 1.0, 2.0, 4.0]), np.ones(4)
    assert quality.quantile(values, weight, 0.5) == 2.5
    assert quality.quantile(values, weight, 0.0) < 1 and quality.quantile(values, weight, 1.0) > 4


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01"])
def test_query_on_documents_never_learnt_from(spark, folder):
    from colloquy.llm.queries import queries

    rows = queries()["op6_quality"](spark, folder).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95
    assert all(r.predicted == (r.score >= 0.7) for r in rows)
