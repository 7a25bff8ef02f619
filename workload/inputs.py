"""Tables the queries read: the given ones, and tables derived from them.

The given tables hold no markers (thinking, tools, switches, exit words), so
the derived ones add them by rule. ``workload/oracle.py`` has the same rules in
SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.functions import chance
from colloquy.functions.fixed import END_OF_THINKING_ID
from colloquy.operators.answers import config_sweep
from colloquy.operators.preferences import with_rejected
from colloquy.operators.render import render_conversation
from colloquy.operators.turns import qa_pairs
from colloquy.plans.ordered_groups import OrderedGroups, position
from colloquy.sources.tables import read_table, read_turns

C = F.col


def chat_marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns with thinking blocks, switches, tool calls and results, tools and odd roles."""
    return mark_chat(read_turns(spark, sf_dir))


THINKS = "role = 'assistant' AND turn % 4 IN (1, 2)"
CALLS = f"{THINKS} AND conv_id % 5 = 0"
MARKED = f"""
  CASE
    WHEN role = 'assistant' AND conv_id % 11 = 5 AND turn >= 3 THEN NULL
    WHEN {THINKS} THEN concat('<think>\\nplan ', turn, '\\n</think>\\n\\n', content)
    WHEN role = 'assistant' AND conv_id % 4 = 0 THEN concat('a<think>x</think>mid</think>\\n', content)
    WHEN role = 'user' AND turn >= 2 AND conv_id % 7 = 3
      THEN concat('<tool_response>\\n', content, '\\n</tool_response>')
    WHEN role = 'user' AND turn >= 2 AND conv_id % 3 = 1 THEN concat(content, ' /no_think')
    WHEN role = 'user' AND conv_id % 3 = 2 THEN concat(content, ' /think')
    ELSE content
  END"""
TOOL_CALLS = f"""
  CASE WHEN {CALLS} THEN transform(
    IF(conv_id % 10 = 0, array('lookup', 'again'), array('lookup')),
    name -> named_struct('name', name, 'arguments', concat('{{"k": ', conv_id, '}}'))) END"""


def _message(offset: int, role: str, content: str, aside: str = "NULL", calls: str = "NULL") -> str:
    return f"""named_struct('turn', turn * 10 + {offset}, 'role', {role}, 'content', {content},
      'reasoning_content', CAST({aside} AS STRING),
      'tool_calls', CAST({calls} AS ARRAY<STRUCT<name: STRING, arguments: STRING>>))"""


def mark_chat(turns: DataFrame) -> DataFrame:
    aside = "CASE WHEN role = 'assistant' AND conv_id % 13 = 6 THEN concat('kept apart ', turn) END"
    done = "'<think>\\nuse it\\n</think>\\n\\ndone'"
    messages = f"""inline(filter(array(
      {_message(0, "role", MARKED, aside, TOOL_CALLS)},
      IF({CALLS}, {_message(1, "'tool'", "'result one'")}, NULL),
      IF({CALLS}, {_message(2, "'tool'", "'result two'")}, NULL),
      IF({CALLS}, {_message(3, "'assistant'", done)}, NULL),
      IF(role = 'user' AND conv_id % 9 = 4, {_message(4, "'note'", "'aside'")}, NULL),
      IF(role = 'user' AND turn = 1 AND conv_id % 8 = 3,
        {_message(5, "'system'", "'be brief /no_think'")}, NULL)
    ), m -> m IS NOT NULL))"""
    tools = """CASE WHEN conv_id % 6 = 1
      THEN array('{"name": "lookup"}', '{"name": "again"}') END AS tools"""
    return turns.selectExpr("conv_id", messages).selectExpr("*", tools)


def exit_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns with exit words and blank turns."""
    return mark_exits(read_turns(spark, sf_dir))


def mark_exits(turns: DataFrame) -> DataFrame:
    conv, turn, user = C("conv_id"), C("turn"), C("role") == "user"
    return turns.withColumn(
        "content",
        F.when(user & (turn == 4) & (conv % 4 == 1), F.lit("  QUIT\u3000"))
        .when(user & (turn == 2) & (conv % 4 == 2), F.lit("退出"))
        .when(user & (turn == 2) & (conv % 4 == 3), F.lit(" \t\u00a0\n"))
        .otherwise(C("content")),
    )


def rendered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render_conversation(chat_marked(spark, sf_dir)).select("conv_id", "prompt")


def echoed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompts with an output that repeats the prompt for even conversations."""
    answer = F.concat(F.lit("\u2003 answer "), C("conv_id").cast("string"), F.lit("\n"))
    return rendered(spark, sf_dir).withColumn(
        "output", F.when(C("conv_id") % 2 == 0, F.concat("prompt", answer)).otherwise(answer)
    )


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items as answers in the two standard formats, with a gold answer."""
    item = C("item_id")
    math = item % 2 == 0
    boxed = F.concat(
        "text", F.lit(" \\boxed{0} then \\boxed{"), (item % 7).cast("string"), F.lit("}")
    )
    letter = F.concat("text", F.lit(' "answer": "'), F.chr(65 + item % 4), F.lit('"'))
    return read_table(spark, sf_dir, "benchmark").select(
        "item_id",
        "text",
        F.when(math, "math").otherwise("choice").alias("task"),
        F.when(math, boxed).otherwise(letter).alias("output"),
        F.when(math, (item % 5).cast("string")).otherwise(F.chr(65 + item % 3)).alias("gold"),
    )


def pair_logps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probabilities of both sides of a pair, from lengths and the pair's key.

    Some answers are certain (log-probability 0), some have no length.
    """
    pairs = preference_candidates(spark, sf_dir)
    key = (C("conv_id"), C("turn"))
    n_chosen, n_rejected = F.length("chosen"), F.length("rejected")

    def logp(tag: str, length: Column) -> Column:
        return -length * (F.lit(0.5) + chance.unit(tag, *key))

    certain, empty = C("conv_id") % 17 == 3, C("conv_id") % 19 == 5
    return pairs.where(C("rejected").isNotNull()).select(
        "conv_id",
        "turn",
        F.when(certain, 0.0).otherwise(logp("pi_c", n_chosen)).alias("pi_chosen"),
        logp("ref_c", n_chosen).alias("ref_chosen"),
        F.when(certain & (C("conv_id") % 2 == 0), 0.0).otherwise(logp("pi_r", n_rejected)).alias("pi_rejected"),
        logp("ref_r", n_rejected).alias("ref_rejected"),
        F.when(empty, 0).otherwise(n_chosen).alias("len_chosen"),
        n_rejected.alias("len_rejected"),
    )


def preference_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Question-answer pairs with another conversation's answer as the rejected one."""
    return with_rejected(qa_pairs(read_turns(spark, sf_dir)))


def reward_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reward per labelled document and side: chosen has quality 1, rejected quality 0.

    The k-th chosen and the k-th rejected document of a source make a pair.
    """
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality")
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "source")
    ranked = OrderedGroups.of(
        documents.join(labels, "doc_id"), ["source", "quality"], "doc_id"
    ).with_columns(pair=position())
    return ranked.df.select(
        "source",
        "pair",
        F.when(C("quality") == 1, "chosen").otherwise("rejected").alias("side"),
        (chance.unit("reward", C("doc_id")) * 4 - 2).alias("reward"),
    )


def token_logps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixteen log-probabilities per document under two models; none for some documents."""
    docs = read_table(spark, sf_dir, "documents").where(C("doc_id") % 23 != 7).select(
        C("doc_id").alias("seq_id"), F.explode(F.sequence(F.lit(0), F.lit(15))).alias("pos")
    )

    def logp(tag: str) -> Column:
        return -(F.lit(0.1) + chance.unit(tag, C("seq_id"), C("pos")) * 3)

    return docs.withColumns({"logp": logp("pi"), "ref_logp": logp("ref")})


def sequence_rewards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents").select(
        C("doc_id").alias("seq_id"), (chance.unit("seq", C("doc_id")) * 4 - 2).alias("reward")
    )


def distill_logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as teacher logits over their items, with a perturbed student; one item is masked for both."""
    items = read_table(spark, sf_dir, "embeddings").select(
        C("vec_id").alias("pos"), "label", F.posexplode("embedding").alias("item", "_value")
    )
    masked = (C("item") == C("pos") % 5) & (C("item") != C("label"))
    teacher = F.when(masked, float("-inf")).otherwise(C("_value").cast("double") * 8)
    student = teacher + chance.unit("student", C("pos"), C("item")) - 0.5
    return items.select(
        "pos",
        "item",
        teacher.alias("teacher"),
        student.alias("student"),
        (C("item") == C("label")).alias("is_gold"),
    )


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events").select(
        C("user_id").alias("group_id"),
        C("event_id").alias("item_id"),
        (C("value") / 100).alias("score"),
    )


def candidates_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates of which some have no score, or one that is no number."""
    item = C("item_id")
    return candidates(spark, sf_dir).withColumn(
        "score", F.when(item % 7 == 3, None).when(item % 11 == 5, float("nan")).otherwise(C("score"))
    )


def seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates that were bought before."""
    return (
        read_table(spark, sf_dir, "events")
        .where(C("event_type") == "purchase")
        .select(C("user_id").alias("group_id"), C("event_id").alias("item_id"))
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timed runs: every user turn under every sweep setting."""
    prompts = read_turns(spark, sf_dir).where(C("role") == "user").select("conv_id", "turn")
    return config_sweep(prompts).withColumn(
        "elapsed_s", F.lit(0.1) + chance.unit("run", C("config"), C("conv_id"), C("turn"))
    )


def token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word lengths as token ids, with end-of-thinking marks at some places of some turns."""
    marked = (C("turn") % 4).isin(1, 2)

    def one(word: Column, k: Column) -> Column:
        mark = marked & (k % 11 == C("conv_id") % 11)
        return F.when(mark, END_OF_THINKING_ID).otherwise(F.length(word))

    words = F.split("content", " ")
    return read_turns(spark, sf_dir).select("conv_id", "turn", F.transform(words, one).alias("ids"))


def cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items as test cases: every fifth one is plain generation with settings."""
    item = C("item_id")
    params = F.create_map(
        F.lit("max_length"), (item + 200).cast("double"), F.lit("temperature"), F.lit(0.8)
    )
    plain = item % 5 == 4
    return read_table(spark, sf_dir, "benchmark").select(
        F.concat(F.lit("item "), item.cast("string")).alias("name"),
        C("text").alias("input"),
        F.when(plain, "generate").otherwise("chat").alias("type"),
        F.when(plain, params).alias("params"),
    )
