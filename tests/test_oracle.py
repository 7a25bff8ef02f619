"""Every registered query against its SQL on the small tables."""

import pytest
from check import SMALL, difference, duck_table, spark_table

from workload.oracle import oracle_sql
from workload.queries import queries

SQL = oracle_sql()


def test_every_query_has_sql():
    assert set(queries()) == set(SQL)


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, duckdb_small, name):
    got = spark_table(queries()[name](spark, SMALL))
    assert difference(got, duck_table(duckdb_small, SQL[name])) is None


@pytest.mark.parametrize(
    "name",
    [
        "take_until_exit",
        "last_query_index",
        "render_conversation",
        "render_in_cells",
        "number_turns",
        "thinking_mode",
        "history_examples",
        "qa_pairs",
        "sft_examples",
        "preference_pairs",
        "pack_corpus",
        "reward_pair_accuracy",
        "group_advantage",
        "top_k",
        "top_p",
        "select_candidates",
        "temperature_softmax",
        "top_k_with_gaps",
        "top_p_off",
        "min_p",
        "sample_candidates",
        "thinking_mode_flagged",
        "preset_lookup",
        "history_spans",
        "latency_summary",
        "dpo_summary",
        "prune_history_reasoning",
        "render_generation_prompt",
    ],
)
def test_query_with_cut_groups(spark, duckdb_small, cutting, name):
    got = spark_table(queries()[name](spark, SMALL))
    assert difference(got, duck_table(duckdb_small, SQL[name])) is None
