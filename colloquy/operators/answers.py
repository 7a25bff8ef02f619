"""Running a generator over a table of prompts, and judging what comes back."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colloquy.functions import text
from colloquy.functions.fixed import (
    CONTEXT_LENGTH,
    DEFAULT_DO_SAMPLE,
    DEFAULT_MAX_LENGTH,
    DEFAULT_SYSTEM_PROMPT,
    DEFAULT_TEMPERATURE,
    DEFAULT_TOP_P,
    SWEEP,
)
from colloquy.plans.ordered_groups import OrderedGroups, running_sum, total

ANSWER = T.StructType(
    [
        T.StructField("output", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("elapsed_s", T.DoubleType()),
    ]
)


def resolve_params(cases: DataFrame) -> DataFrame:
    """Generation settings as columns: those given in ``params``, else the defaults."""

    def given(name: str, default) -> Column:
        return F.coalesce(F.try_element_at("params", F.lit(name)), F.lit(float(default)))

    return cases.withColumns(
        {
            "max_length": given("max_length", DEFAULT_MAX_LENGTH).cast("int"),
            "temperature": given("temperature", DEFAULT_TEMPERATURE),
            "top_p": given("top_p", DEFAULT_TOP_P),
            "do_sample": given("do_sample", DEFAULT_DO_SAMPLE) != 0,
        }
    ).drop("params")


def dispatch_prompts(cases: DataFrame, system: str = DEFAULT_SYSTEM_PROMPT) -> DataFrame:
    """Add ``prompt``: the chat format for cases of type 'chat', else the input itself."""
    return cases.withColumn("prompt", text.dispatch_prompt(F.col("type"), F.col("input"), system))


def config_sweep(
    prompts: DataFrame, configs: Sequence[tuple[str, float]] = tuple(SWEEP)
) -> DataFrame:
    """Every prompt under every setting: adds ``config`` and ``temperature``."""
    settings = F.array(
        *[F.struct(F.lit(n).alias("config"), F.lit(float(t)).alias("temperature")) for n, t in configs]
    )
    return prompts.select("*", F.inline(settings))


def batch_generate(
    prompts: DataFrame,
    make_generator: Callable[[], Callable[[list[str], list[dict]], list[str]]],
    batch_rows: int = 64,
) -> DataFrame:
    """Answer every prompt with the caller's generator; adds ``output, error, elapsed_s``.

    ``make_generator`` runs once per Python worker; what it returns takes a list
    of prompts and a list of settings and returns the outputs. If a batch fails,
    its prompts are tried one by one, and those that fail get an ``error`` and a
    null output. Settings are the columns of ``resolve_params`` that are there.
    """
    names = [n for n in ("max_length", "temperature", "top_p", "do_sample") if n in prompts.columns]

    def make_predict():
        import json
        import time

        import numpy as np

        generate = make_generator()

        def attempt(prompt, setting):
            try:
                return generate([prompt], [setting])[0], None
            except Exception as problem:
                return None, f"{type(problem).__name__}: {problem}"

        def predict(prompts, settings):
            asked, given = list(prompts), [json.loads(s) for s in settings]
            began = time.perf_counter()
            try:
                results = [(output, None) for output in generate(asked, given)]
            except Exception:
                results = [attempt(p, s) for p, s in zip(asked, given)]
            each = (time.perf_counter() - began) / max(len(asked), 1)
            return {
                "output": np.array([output for output, _ in results], dtype=object),
                "error": np.array([error for _, error in results], dtype=object),
                "elapsed_s": np.full(len(asked), each),
            }

        return predict

    answer = predict_batch_udf(make_predict, return_type=ANSWER, batch_size=batch_rows)
    settings = F.to_json(F.struct(*names)) if names else F.lit("{}")
    return (
        prompts.withColumn("_answer", answer(F.col("prompt"), settings))
        .select("*", "_answer.*")
        .drop("_answer")
    )


def clean_output(answered: DataFrame) -> DataFrame:
    """Add ``answer``: output without special tokens and without the repeated prompt.

    The prompt loses its special tokens as well, or it could never be found in
    the output.
    """
    return answered.withColumn(
        "answer",
        text.strip_echo(
            text.strip_special_tokens(F.col("output")), text.strip_special_tokens(F.col("prompt"))
        ),
    )


def length_budget(
    prompts: DataFrame,
    prompt_length: Column,
    max_length: int | None = None,
    max_new: int | None = None,
    limit: int = CONTEXT_LENGTH,
) -> DataFrame:
    """Add ``fits`` (the prompt leaves room) and ``room`` for the output.

    ``max_length`` counts prompt and output, ``max_new`` the output alone,
    ``limit`` is the context length. All lengths are in the caller's unit.
    """
    bounds = [F.lit(limit) - prompt_length]
    if max_length is not None:
        bounds.append(F.lit(max_length) - prompt_length)
    if max_new is not None:
        bounds.append(F.lit(max_new))
    tightest = F.least(*bounds) if len(bounds) > 1 else bounds[0]
    return prompts.withColumn("room", F.greatest(tightest, F.lit(0)).cast("int")).withColumn(
        "fits", F.col("room") > 0
    )


def cut_output(output: Column, room: Column) -> Column:
    """The part of an output array that fits."""
    return F.slice(output, F.lit(1), room)


def answer_accuracy(answers: DataFrame, equivalent: bool = False) -> DataFrame:
    """Share of right answers per task: boxed results for maths, letters for choices.

    With ``equivalent``, equal numbers in different spellings are the same result.
    """
    predicted = F.when(F.col("task") == "math", text.boxed_answer(F.col("output"))).when(
        F.col("task") == "choice", text.choice_answer(F.col("output"))
    )
    same = text.strip(F.col("_predicted")) == F.col("gold")
    if equivalent:
        same |= text.canonical_answer(F.col("_predicted")) == text.canonical_answer(F.col("gold"))
    right = F.coalesce(same, F.lit(False))
    return answers.withColumn("_predicted", predicted).groupBy("task").agg(
        F.count(F.lit(1)).alias("answers"),
        F.count("_predicted").alias("parsed"),
        F.avg(right.cast("double")).alias("accuracy"),
    )


def latency_summary(runs: DataFrame) -> DataFrame:
    """Count, mean, maximum and exact percentiles of ``elapsed_s`` per ``config``.

    Equal times are counted first; all else comes from these counts. A percentile
    is the lowest time up to which that share of the runs lies, by a running sum
    over the distinct times, which are cut into blocks where a configuration has
    very many. A run without a time is a run, and in no other figure.
    """
    times = runs.groupBy("config", "elapsed_s").agg(F.count(F.lit(1)).alias("_n"))
    timed = F.when(F.col("elapsed_s").isNotNull(), F.col("_n")).otherwise(0)
    placed = OrderedGroups.of(times, ["config"], "elapsed_s").with_columns(
        _upto=running_sum(timed, inclusive=True), _all=total(F.sum, timed)
    )

    def percentile(share: float) -> Column:
        return F.min(F.when(F.col("_upto") >= F.col("_all") * share, F.col("elapsed_s")))

    return placed.df.groupBy("config").agg(
        F.sum("_n").alias("runs"),
        (F.sum(F.col("elapsed_s") * F.col("_n")) / F.max("_all")).alias("mean_s"),
        F.max("elapsed_s").alias("max_s"),
        percentile(0.5).alias("p50_s"),
        percentile(0.95).alias("p95_s"),
    )
