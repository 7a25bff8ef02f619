"""Chat sessions as streams of turns ``(conv_id, turn, role, content)``.

State is Spark's own, on RocksDB, with the values of the sessions of a batch
alone being read for it. Output and checkpoint are paths in storage that all
executors share; a batch that is run again replaces its own output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from colloquy.functions import template, text
from colloquy.operators.turns import drop_empty_turns

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
COMPACT_EVERY = 100


def use_rocksdb(spark: SparkSession) -> None:
    """Keep keyed state on disk; has to be set before a stateful query starts."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def read_turn_stream(
    spark: SparkSession,
    folder: str,
    schema: StructType,
    pattern: str = "*.parquet",
    files_per_batch: int | None = None,
) -> DataFrame:
    """Turns from the Parquet files that arrive in a folder.

    ``folder`` may also be a single file, read as the folder that has just this file.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(path) and files.getFileStatus(path).isFile():
        folder, pattern = path.getParent().toString(), path.getName()
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def take_until_exit(turns: DataFrame, ttl_ms: int | None = None) -> DataFrame:
    """Drop blank user turns, and every turn of a session from its first exit word on.

    A session stays closed in later batches: its state is the turn it closed at.
    ``ttl_ms`` forgets a closed session after that time.
    """
    columns = turns.columns
    leaves = (F.col("role") == "user") & text.is_exit(F.col("content"))
    spoken = drop_empty_turns(turns).withColumn("_closes", F.when(leaves, F.col("turn")))

    from pyspark.sql.streaming.stateful_processor import StatefulProcessor

    # Defined here so that workers get the class by value and need no package of ours.
    class Closing(StatefulProcessor):
        def init(self, handle):
            self.closed = handle.getValueState("closed", "turn LONG", ttl_ms)

        def handleInputRows(self, key, rows, timer_values):
            before = self.closed.get()
            first = None if before is None else before[0]
            chunks = []
            for chunk in rows:
                if chunk.empty:
                    continue
                chunk.columns = [*columns, "_closes"]  # names with an underscore arrive changed
                chunks.append(chunk)
                closing = chunk["_closes"].min()
                if closing == closing and (first is None or closing < first):
                    first = int(closing)
            if first is not None and (before is None or first < before[0]):
                self.closed.update((first,))
            for chunk in chunks:
                kept = chunk if first is None else chunk[chunk["turn"] < first]
                yield kept[columns]

        def close(self):
            pass

    return spoken.groupBy("conv_id").transformWithStateInPandas(
        Closing(),
        outputStructType=turns.schema,
        outputMode="append",
        timeMode="None" if ttl_ms is None else "ProcessingTime",
    )


def _folders(spark: SparkSession, output: str, kind: str) -> list[int]:
    """Numbers of the folders ``kind=number`` of an output."""
    path = spark._jvm.org.apache.hadoop.fs.Path(output)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in files.listStatus(path)] if files.exists(path) else []
    return sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{kind}="))


def latest_response(
    turns: DataFrame, output: str, checkpoint: str, trigger: dict, compact_every: int = COMPACT_EVERY
) -> StreamingQuery:
    """Of the growing answers of each ``(conv_id, role)``, keep the one with the highest turn.

    Each batch writes the keys it changed to ``batch=number``; ``read_latest``
    puts them together. Every ``compact_every`` batches what is there so far is
    put together in ``upto=number``, and the folders it replaces go, so that a
    reader reads each key a bounded number of times.
    """
    use_rocksdb(turns.sparkSession)
    latest = turns.groupBy("conv_id", "role").agg(
        F.max_by("content", "turn").alias("latest"), F.count(F.lit(1)).alias("updates")
    )

    def process(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{output}/batch={number}")
        if (number + 1) % compact_every == 0:
            old = [("batch", n) for n in _folders(spark, output, "batch") if n <= number]
            old += [("upto", n) for n in _folders(spark, output, "upto") if n < number]
            read_latest(spark, output).write.mode("overwrite").parquet(f"{output}/upto={number}")
            for kind, n in old:
                path = spark._jvm.org.apache.hadoop.fs.Path(f"{output}/{kind}={n}")
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

    return (
        latest.writeStream.outputMode("update")
        .foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def read_latest(spark: SparkSession, output: str) -> DataFrame:
    """The latest answers: the last compacted folder and the batches after it."""
    upto = max(_folders(spark, output, "upto"), default=-1)
    parts = [("upto", upto)] if upto >= 0 else []
    parts += [("batch", n) for n in _folders(spark, output, "batch") if n > upto]
    rows = None
    for kind, n in parts:
        part = spark.read.parquet(f"{output}/{kind}={n}").withColumn("_n", F.lit(n))
        rows = part if rows is None else rows.unionByName(part)
    return rows.groupBy("conv_id", "role").agg(
        F.max_by("latest", "_n").alias("latest"), F.max_by("updates", "_n").alias("updates")
    )


def _message_forms(turns: DataFrame, enable_thinking: bool) -> DataFrame:
    """What a turn adds to a prompt, without and with its reasoning; needs no other turn.

    A tool result lacks the marks around its run, which the handler adds. ``head``
    is what stands before the first turn of a session with tools.
    """
    given = set(turns.columns)
    content = F.coalesce("content", F.lit(""))
    aside = (
        F.col("reasoning_content")
        if "reasoning_content" in given
        else F.lit(None).cast("string")
    )
    separate = aside.isNotNull()
    calls = (
        template.tool_call_text(F.col("tool_calls"), F.col("_answer"))
        if "tool_calls" in given
        else F.lit("")
    )
    role = F.col("role")
    parts = turns.withColumns(
        {
            "_reasoning": F.when(separate, aside).otherwise(text.reasoning_of(content)),
            "_answer": F.when(separate, content).otherwise(text.answer_of(content)),
        }
    ).withColumn("_calls", calls)
    short = (
        F.when(role.isin("user", "system"), template.block(role, content))
        .when(role == "assistant", template.assistant_plain(F.col("_answer"), F.col("_calls")))
        .when(role == "tool", template.tool_result(content, F.lit(False), F.lit(False)))
        .otherwise(F.lit(""))
    )
    reasoned = template.assistant_with_reasoning(
        F.col("_reasoning"), F.col("_answer"), F.col("_calls")
    )
    reasons = (role == "assistant") & (F.col("_reasoning") != "")
    head = F.lit(None).cast("string")
    if "tools" in given:
        system = F.when(role == "system", content)
        head = F.when(template.has_tools(F.col("tools")), template.tools_head(system, F.col("tools")))
    flag = F.col("enable_thinking") if "enable_thinking" in given else F.lit(None).cast("boolean")
    return parts.select(
        "conv_id",
        "turn",
        F.coalesce(role, F.lit("")).alias("role"),
        template.is_query(role, F.col("content")).alias("query"),
        short.alias("short"),
        F.when(reasons, reasoned).alias("long"),
        head.alias("head"),
        F.when(role == "user", template.generation_prompt(F.coalesce(flag, F.lit(enable_thinking)))).alias("ending"),
    )


def history_prompts(
    turns: DataFrame, enable_thinking: bool = True, idle_ms: int | None = None
) -> DataFrame:
    """The prompt for each user turn, with the session's history: ``(conv_id, turn, prompt)``.

    The state of a session is the list of its rendered turns, to which a batch
    only appends, and a few numbers. A turn with reasoning is there in both
    forms: a prompt has the long one after the last query. Prompts are whole at
    any length. A column ``tools`` is read at the first turn, ``enable_thinking``
    at the user turn (else the argument). ``idle_ms`` drops sessions after that
    long without a turn.
    """
    forms = _message_forms(turns, enable_thinking)
    kind = turns.schema["conv_id"].dataType.simpleString()

    from pyspark.sql.streaming.stateful_processor import StatefulProcessor

    # Defined here so that workers get the class by value and need no package of ours.
    class Session(StatefulProcessor):
        def init(self, handle):
            self.handle = handle
            self.said = handle.getListState("said", "short STRING, long STRING")
            self.place = handle.getValueState("place", "turns LONG, asked LONG, last STRING")

        def handleInputRows(self, key, rows, timer_values):
            import pandas as pd

            chunks = [chunk for chunk in rows if not chunk.empty]
            if not chunks:
                return
            waiting = pd.concat(chunks).sort_values("turn", kind="stable")
            count, asked, last = self.place.get() or (0, -1, "")
            asks = (waiting["role"] == "user").any()
            said = [tuple(x) for x in self.said.get()] if asks and count else []
            before, new, prompts = len(said), [], []
            for row in waiting.itertuples(index=False):
                mark = "<|im_end|>\n" if last == "tool" and row.role != "tool" else ""
                if row.role == "tool" and last != "tool":
                    mark = "<|im_start|>user"
                short = mark + row.short
                if count == 0 and isinstance(row.head, str):
                    short = row.head + ("" if row.role == "system" else short)
                long = None
                if isinstance(row.long, str):
                    long = short[: len(short) - len(row.short)] + row.long
                new.append((short, long))
                if row.query:
                    asked = count
                if row.role == "user":
                    said += new[len(said) - before :]
                    prompts.append((row.conv_id, row.turn, self.prompt(said, asked) + row.ending))
                count, last = count + 1, row.role
            self.said.appendList(new)
            self.place.update((count, asked, last))
            if idle_ms is not None:
                for timer in list(self.handle.listTimers()):
                    self.handle.deleteTimer(timer)
                self.handle.registerTimer(timer_values.getCurrentProcessingTimeInMs() + idle_ms)
            if prompts:
                yield pd.DataFrame(prompts, columns=["conv_id", "turn", "prompt"])

        def prompt(self, said, asked):
            return "".join(
                long if long is not None and 0 <= asked < n else short for n, (short, long) in enumerate(said)
            )

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):  # called by these names
            self.said.clear()
            self.place.clear()
            return iter([])

        def close(self):
            pass

    return forms.groupBy("conv_id").transformWithStateInPandas(
        Session(),
        outputStructType=f"conv_id {kind}, turn long, prompt string",
        outputMode="append",
        timeMode="None" if idle_ms is None else "ProcessingTime",
    )


def write_batches(stream: DataFrame, output: str, checkpoint: str, trigger: dict) -> StreamingQuery:
    return (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .option("path", output)
        .outputMode("append")
        .trigger(**trigger)
        .start()
    )
