"""Generation that is broken off and taken up again."""

import pytest
from pyspark.sql import functions as F

from colloquy.operators import answers, ledger
from colloquy.plans.shared import scratch_path

C = F.col


def generator(name, fails=""):
    """A stand-in for a model that says who answered; nested so that workers get it by value."""

    def make():
        def generate(prompts, settings):
            if fails and any(fails in p for p in prompts):
                raise ValueError(f"{fails} fails")
            return [f"{name}: {p} at {s.get('temperature')}" for p, s in zip(prompts, settings)]

        return generate

    return make


@pytest.fixture
def prompts(spark):
    rows = [(n, f"prompt {n % 60} " + "word " * (n % 7), 0.1 * (n % 2), "s", "d") for n in range(150)]
    return spark.createDataFrame(rows, "n long, prompt string, temperature double, slice string, digest string")


def test_a_run_killed_halfway_answers_only_the_rest(spark, prompts):
    folder, done = scratch_path(spark, "ledger"), []

    def kill(number):
        done.append(number)
        if len(done) == 3:
            raise KeyboardInterrupt

    plain = prompts.drop("slice", "digest")
    with pytest.raises(KeyboardInterrupt):
        ledger.answer_missing(plain, generator("first"), folder, slices=8, on_commit=kill)
    kept = {r.n for r in ledger.with_answers(plain, folder).where("output IS NOT NULL").collect()}
    assert 0 < len(kept) < 150
    assert ledger.answer_missing(plain, generator("second"), folder, slices=8) == 5
    rows = ledger.with_answers(plain, folder).collect()
    assert {r.n for r in rows} == set(range(150)) and len(rows) == 150
    for r in rows:
        assert r.output == f"{'first' if r.n in kept else 'second'}: {r.prompt} at {r.temperature}" and r.error is None
    assert ledger.answer_missing(plain, generator("third"), folder, slices=8) == 0
    more = plain.unionByName(plain.where("n < 2").withColumn("prompt", F.lit("a new one")))
    assert ledger.answer_missing(more, generator("third"), folder, slices=8) in (1, 2)


def test_a_job_that_fails_leaves_no_slice(spark, prompts):
    folder = scratch_path(spark, "ledger")

    def dying():
        def generate(prompts, settings):
            import os

            os._exit(1)

        return generate

    with pytest.raises(Exception, match="worker|exit|crash"):
        ledger.answer_missing(prompts.drop("slice", "digest"), dying, folder, slices=4)
    assert ledger.read_ledger(spark, folder).count() == 0
    assert ledger.answer_missing(prompts.drop("slice", "digest"), generator("then"), folder, slices=4) == 4


def test_errors_are_kept_and_may_be_tried_again(spark, prompts):
    folder, plain = scratch_path(spark, "ledger"), prompts.drop("slice", "digest")
    ledger.answer_missing(plain, generator("a", "prompt 7 "), folder, slices=4)
    failed = ledger.with_answers(plain, folder).where("error IS NOT NULL").collect()
    assert failed and all("prompt 7 " in r.prompt for r in failed)
    assert ledger.answer_missing(plain, generator("b"), folder, slices=4) == 0
    assert ledger.answer_missing(plain, generator("b"), folder, slices=4, retry_errors=True) > 0
    rows = ledger.with_answers(plain, folder).collect()
    assert all(r.output.startswith("b" if "prompt 7 " in r.prompt else "a") and r.error is None for r in rows)


def test_odd_prompts(spark):
    rows = [(1, None), (2, ""), (3, None), (4, "x" * 100_000), (5, "same"), (6, "same")]
    prompts = spark.createDataFrame(rows, "n long, prompt string")
    folder = scratch_path(spark, "ledger")
    calls = generator("g")
    ledger.answer_missing(prompts, calls, folder, slices=2)
    assert ledger.read_ledger(spark, folder).count() == 4
    got = {r.n: (r.output, r.error) for r in ledger.with_answers(prompts, folder).collect()}
    assert got[2] == ("g:  at None", None) and got[5] == got[6] and set(got) == set(range(1, 7))
    assert ledger.answer_missing(prompts.where("false"), calls, folder) == 0
    assert answers.batch_generate is ledger.batch_generate
