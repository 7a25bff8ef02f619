"""Chat turns to prompts.

Input: ``(conv_id, turn, role, content)`` and, if present, ``reasoning_content``
(string), ``tool_calls`` (array of ``(name, arguments)`` with arguments as JSON
text), ``tools`` (array of JSON texts, read at a conversation's first turn) and
``enable_thinking`` (boolean, read at its last turn; else an argument).

Everything a turn needs to know about its neighbours (the role before and
after, the place of the last query) comes from windows over one partitioning by
``conv_id``; texts cross the network once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colloquy.functions import template, text
from colloquy.operators.turns import conversations
from colloquy.plans.ordered_groups import (
    OrderedGroups,
    Step,
    following,
    previous,
    running_max,
    running_sum,
    total,
)

_OPTIONAL = ("reasoning_content", "tool_calls", "tools", "enable_thinking")


def _complete(turns: DataFrame) -> tuple[DataFrame, set[str]]:
    """The columns used here, and which of the optional ones are given."""
    given = {c for c in _OPTIONAL if c in turns.columns}
    messages = turns.select("conv_id", "turn", "role", "content", *sorted(given))
    if "reasoning_content" not in given:
        messages = messages.withColumn("reasoning_content", F.lit(None).cast("string"))
    return messages, given


def _placed(turns: DataFrame, **more: Step) -> OrderedGroups:
    """Messages with their neighbours, and the row-wise parts of each.

    The parts are taken after the shuffle, which so carries each text once.
    """
    messages, given = _complete(turns)
    neighbour = F.struct("turn", "role")
    content = F.coalesce("content", F.lit(""))
    separate = F.col("reasoning_content").isNotNull()
    calls = (
        template.tool_call_text(F.col("tool_calls"), F.col("_answer"))
        if "tool_calls" in given
        else F.lit("")
    )

    def parts(df: DataFrame) -> DataFrame:
        return (
            df.withColumns(
                {
                    "_reasoning": F.when(separate, F.col("reasoning_content")).otherwise(
                        text.reasoning_of(content)
                    ),
                    "_answer": F.when(separate, content).otherwise(text.answer_of(content)),
                    "_content": content,
                    "_query": template.is_query(F.col("role"), F.col("content")),
                }
            )
            .withColumn("_calls", calls)
            .drop("content", "reasoning_content", "tool_calls")
        )

    return (
        conversations(messages)
        .with_columns(_prev=previous(neighbour), _next=following(neighbour), **more)
        .replace(parts)
    )


def _query_turn() -> Column:
    return F.when(template.is_query(F.col("role"), F.col("content")), F.col("turn"))


def _with_head(body: Column, columns: list[str]) -> Column:
    """The tools block goes before whatever the first message renders."""
    if "tools" not in columns:
        return body
    system = F.when(F.col("role") == "system", F.col("_content"))
    head = template.tools_head(system, F.col("tools"))
    opens = F.col("_prev").isNull() & template.has_tools(F.col("tools"))
    return F.concat(F.when(opens, head).otherwise(F.lit("")), body)


def _body(assistant: Column, columns: list[str]) -> Column:
    """What a message renders; ``assistant`` is its form if it is an assistant turn."""
    role = F.col("role")
    in_head = (
        F.col("_prev").isNull() & template.has_tools(F.col("tools"))
        if "tools" in columns
        else F.lit(False)
    )
    opens = ~F.coalesce(F.col("_prev.role") == "tool", F.lit(False))
    closes = ~F.coalesce(F.col("_next.role") == "tool", F.lit(False))
    return (
        F.when(
            (role == "user") | ((role == "system") & ~in_head),
            template.block(role, F.col("_content")),
        )
        .when(role == "assistant", assistant)
        .when(role == "tool", template.tool_result(F.col("_content"), opens, closes))
        .otherwise(F.lit(""))
    )


def _plain() -> Column:
    return template.assistant_plain(F.col("_answer"), F.col("_calls"))


def _reasoned() -> Column:
    return template.assistant_with_reasoning(
        F.col("_reasoning"), F.col("_answer"), F.col("_calls")
    )


def _ending(columns: list[str], enable_thinking: bool) -> Column:
    given = "enable_thinking" in columns
    return template.generation_prompt(F.col("enable_thinking") if given else enable_thinking)


def _segments(turns: DataFrame, add_generation_prompt: bool, enable_thinking: bool) -> OrderedGroups:
    groups = _placed(turns, _asked=total(F.max, _query_turn()))
    keeps = (F.col("turn") > F.col("_asked")) & (
        F.col("_next").isNull() | (F.col("_reasoning") != "")
    )

    def finish(df: DataFrame) -> DataFrame:
        assistant = F.when(keeps, _reasoned()).otherwise(_plain())
        segment = _with_head(_body(assistant, df.columns), df.columns)
        if add_generation_prompt:
            ending = F.when(F.col("_next").isNull(), _ending(df.columns, enable_thinking))
            segment = F.concat(segment, F.coalesce(ending, F.lit("")))
        return df.select(
            "conv_id", "turn", "role", segment.alias("segment"), *OrderedGroups.helpers(df)
        )

    return groups.replace(finish)


def render_segments(
    turns: DataFrame, add_generation_prompt: bool = False, enable_thinking: bool = True
) -> DataFrame:
    """What each turn adds to the prompt of its conversation: ``(conv_id, turn, role, segment)``."""
    return _segments(turns, add_generation_prompt, enable_thinking).df


def _joined(rows: DataFrame, *keys) -> DataFrame:
    """Segments end to end; turns that render nothing are not gathered."""
    said = "listagg(nullif(segment, ''), '') WITHIN GROUP (ORDER BY turn)"
    return rows.groupBy(*keys).agg(
        F.min("_start").cast("bigint").alias("prompt_start"), F.coalesce(F.expr(said), F.lit("")).alias("prompt")
    )


def render_conversation(
    turns: DataFrame, add_generation_prompt: bool = False, enable_thinking: bool = True
) -> DataFrame:
    """The prompt of each conversation, one row: ``(conv_id, prompt_start, prompt)`` with start 0."""
    rows = _segments(turns, add_generation_prompt, enable_thinking).rows
    return _joined(rows.withColumn("_start", F.lit(0)), "conv_id").select("conv_id", "prompt_start", "prompt")


def render_in_cells(
    turns: DataFrame, cell_chars: int, add_generation_prompt: bool = False, enable_thinking: bool = True
) -> DataFrame:
    """The prompt of each conversation in rows of about ``cell_chars`` characters.

    ``(conv_id, prompt_start, prompt)``: each row has the character it starts at,
    and takes segments up to the one that passes ``cell_chars``. For prompts that
    no single cell can hold.
    """
    groups = _segments(turns, add_generation_prompt, enable_thinking).with_columns(
        _start=running_sum(F.length("segment"))
    )
    cell = F.floor(F.col("_start") / cell_chars)
    return _joined(groups.rows.withColumn("_cell", cell), "conv_id", "_cell").select("conv_id", "prompt_start", "prompt")


def sft_examples(turns: DataFrame) -> DataFrame:
    """Where the assistant turns lie in the rendered conversation.

    ``(conv_id, turn, loss_start, loss_chars, segment)``, offsets in characters
    from the start of the whole prompt.
    """
    groups = _segments(turns, False, True).with_columns(loss_start=running_sum(F.length("segment")))
    return groups.df.where(F.col("role") == "assistant").select(
        "conv_id",
        "turn",
        F.col("loss_start").cast("bigint"),
        F.length("segment").cast("bigint").alias("loss_chars"),
        "segment",
    )


def _history_forms(turns: DataFrame) -> OrderedGroups:
    """Every turn as it stands in prompts of later turns: with and without its reasoning."""
    groups = _placed(turns, _asked=running_max(_query_turn()))

    def forms(df: DataFrame) -> DataFrame:
        def whole(assistant: Column) -> Column:
            return _with_head(_body(assistant, df.columns), df.columns)

        is_assistant = F.col("role") == "assistant"
        flag = F.col("enable_thinking") if "enable_thinking" in df.columns else F.lit(None).cast("boolean")
        return df.select(
            "conv_id",
            "turn",
            F.when(is_assistant, F.col("_content")).alias("response"),
            "_asked",
            F.col("_prev.turn").alias("_before"),
            whole(_reasoned()).alias("_full"),
            F.when(is_assistant, whole(_plain())).alias("_short"),
            (F.col("_reasoning") != "").alias("_reasons"),
            "_query",
            flag.alias("_thinking"),
            *OrderedGroups.helpers(df),
        )

    return groups.replace(forms)


def _answer_start(enable_thinking: bool) -> Column:
    return template.generation_prompt(F.coalesce("_thinking", F.lit(enable_thinking)))


def history_spans(turns: DataFrame, enable_thinking: bool = True) -> DataFrame:
    """Where the history of each assistant turn lies in two texts of its conversation.

    The short text has all turns without reasoning, the long one with what
    reasoning a turn has. A history is the first ``short_chars`` of the short
    text (up to its last query), then ``long_chars`` of the long text from
    ``long_start``, then the turn right before in its own form with reasoning,
    if that comes after the query (``before_turn``; ``before_chars``).
    ``(conv_id, turn, short_chars, long_start, long_chars, before_turn,
    before_chars, ending_chars)``: a row per assistant turn however long the
    conversation is, so the output grows with the turns and not with their
    square. ``history_examples`` has the texts themselves.
    """
    short = F.coalesce("_short", "_full")
    kept = F.when(F.col("_reasons"), F.col("_full")).otherwise(short)
    sizes = _history_forms(turns).replace(
        lambda df: df.select(
            "conv_id", "turn", "_asked", "_before", "_query", "_thinking",
            F.col("response").isNotNull().alias("_answers"),
            F.length(short).cast("bigint").alias("_short_chars"),
            F.length(kept).cast("bigint").alias("_long_chars"),
            F.length("_full").cast("bigint").alias("_full_chars"),
            *OrderedGroups.helpers(df),
        )
    )
    summed = sizes.with_columns(
        _short_sum=running_sum(F.col("_short_chars")),
        _long_sum=running_sum(F.col("_long_chars")),
        _last=previous(F.struct("_answers", "_long_chars", "_full_chars")),
    ).replace(
        lambda df: df.withColumns(
            {
                "_short_end": F.when(F.col("_query"), F.col("_short_sum") + F.col("_short_chars")),
                "_long_end": F.when(F.col("_query"), F.col("_long_sum") + F.col("_long_chars")),
            }
        )
    )
    placed = summed.with_columns(
        _short_asked=running_max(F.col("_short_end")), _long_asked=running_max(F.col("_long_end"))
    )
    asked = F.col("_asked").isNotNull()
    own = asked & (F.col("_before") > F.col("_asked")) & F.col("_last._answers")
    start = F.when(asked, F.col("_long_asked")).otherwise(F.col("_long_sum"))
    end = F.col("_long_sum") - F.when(own, F.col("_last._long_chars")).otherwise(0)
    return placed.df.where(F.col("_answers")).select(
        "conv_id",
        "turn",
        F.when(asked, F.col("_short_asked")).otherwise(F.col("_short_sum")).alias("short_chars"),
        start.alias("long_start"),
        (end - start).alias("long_chars"),
        F.when(own, F.col("_before")).alias("before_turn"),
        F.when(own, F.col("_last._full_chars")).otherwise(0).alias("before_chars"),
        F.length(_answer_start(enable_thinking)).cast("bigint").alias("ending_chars"),
    )


def history_examples(turns: DataFrame, enable_thinking: bool = True) -> DataFrame:
    """One example per assistant turn, with all earlier turns as its prompt.

    ``(conv_id, turn, history_chars, prompt, response)``. Which reasoning the
    prompt keeps depends on the last query *before* the turn, so each earlier
    assistant turn comes in two forms and the example picks. ``history_chars``
    counts the history with all of its reasoning. Prompts are whole at any
    length, so a conversation's rows grow with the square of its turns;
    ``history_spans`` says the same in linear size. A column ``enable_thinking``
    tells how the prompt of its turn ends, else the argument does.
    """
    groups = _history_forms(turns).with_columns(history_chars=running_sum(F.length("_full")))
    earlier = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    said = F.when(F.col("_full") != "", F.struct("turn", "_reasons", "_full", "_short"))

    def pick(x: Column) -> Column:
        keeps = (x["turn"] > F.col("_asked")) & (x["_reasons"] | (x["turn"] == F.col("_before")))
        return F.when(keeps | x["_short"].isNull(), x["_full"]).otherwise(x["_short"])

    prompt = F.concat(F.array_join(F.transform("_said", pick), ""), _answer_start(enable_thinking))
    return (
        groups.rows.withColumn("_said", F.collect_list(said).over(earlier))
        .where(F.col("response").isNotNull())
        .select("conv_id", "turn", F.col("history_chars").cast("bigint"), prompt.alias("prompt"), "response")
    )
