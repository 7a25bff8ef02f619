"""What the plans of the large jobs look like."""

import pytest
from check import SMALL

from colloquy.operators import candidates, corpus, render, turns
from colloquy.sources.tables import read_table, read_turns
from workload import inputs
from workload.queries import queries


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return plan(df).count("Exchange hashpartitioning")


@pytest.mark.parametrize(
    "job",
    [
        render.render_conversation,
        render.sft_examples,
        render.history_examples,
        turns.number_turns,
        turns.take_until_exit,
        turns.qa_pairs,
        turns.thinking_mode,
        turns.loss_bearing_totals,
        turns.last_query_index,
    ],
)
def test_conversation_jobs_shuffle_once(spark, job):
    assert shuffles(job(read_turns(spark, SMALL))) == 1


def test_rendering_sorts_once_and_needs_no_python(spark):
    text = plan(render.render_conversation(read_turns(spark, SMALL)))
    assert text.count("Sort [") == 1
    assert "Python" not in text and "Pandas" not in text


def test_texts_are_split_after_the_shuffle(spark):
    text = plan(render.render_conversation(read_turns(spark, SMALL)))
    before_shuffle = text[text.index("Exchange") :]
    assert "substring_index" not in before_shuffle


def test_packing_shuffles_once(spark):
    documents = read_table(spark, SMALL, "documents").select("doc_id", "text")
    assert shuffles(corpus.pack_corpus(documents, 4096, 8)) == 1


def test_selection_limits_rows_before_its_only_shuffle(spark):
    chosen = candidates.select_candidates(inputs.candidates(spark, SMALL), 0.6, 20, 0.95, 0.02)
    text = plan(chosen)
    assert text.count("Exchange") == 1
    assert "WindowGroupLimit" in text[text.index("Exchange") :]
    assert text.count("Sort [") == 3  # before and after the shuffle by score, then by item


def test_scans_read_the_columns_they_need(spark):
    text = plan(queries()["loss_bearing_totals"](spark, SMALL))
    assert "ReadSchema: struct<conv_id:bigint,role:string,text:string>" in text
    text = plan(queries()["number_turns"](spark, SMALL))
    assert "ReadSchema: struct<conv_id:bigint,turn:bigint>" in text


def test_filters_reach_the_scan(spark):
    assert "EqualTo(role,user)" in plan(queries()["two_turn_prompt"](spark, SMALL))


@pytest.mark.parametrize("name", sorted(set(queries()) - {"run_report"}))
def test_no_cross_joins(spark, name):
    if name.startswith("stream_") or name == "json_dataset_scan":
        pytest.skip("returns what it wrote")
    text = plan(queries()[name](spark, SMALL))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text
