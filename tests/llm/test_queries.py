"""The registered queries against SQL, or against brute force on the smallest tables."""

import pytest

from check import difference, duck_table, spark_table
from colloquy.llm.oracle import oracle_sql
from colloquy.llm.queries import queries
from test_simhash import plain_components, plain_print

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_as_sql(spark, duckdb_small, name):
    assert difference(spark_table(queries()[name](spark, FOLDER)), duck_table(duckdb_small, oracle_sql()[name])) is None


def test_near_copies(spark):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect())
    prints = [plain_print(t) for _, t in docs]
    want = {k: (f"{p:016x}", docs[c][0]) for (k, _), p, c in zip(docs, prints, plain_components(prints, 4))}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries()["op3_simhash"](spark, FOLDER).collect()}
    assert got == want


def test_packing(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = queries()["op1_packing"](spark, FOLDER).collect()
    assert {r.doc_id: r["size"] for r in rows} == {k: len(t.encode()) + 1 for k, t in docs.items()}
    assert {r.law for r in rows} == {"bytes"} and {r.grown_shard for r in rows} == {None}
    sums, slots = {}, {}
    for r in rows:
        sums[r.shard] = sums.get(r.shard, 0) + r["size"]
        slots.setdefault(r.shard, []).append(r.slot)
    assert set(sums) == set(range(16)) and max(sums.values()) - min(sums.values()) < 0.1 * max(sums.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
