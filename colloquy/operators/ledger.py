"""Generation that can be broken off and taken up again.

A prompt with its settings is known by a digest. Answers are kept in a ledger: a
folder with one committed folder per slice of digests. A run leaves out what the
ledger has, answers the rest slice by slice, and commits each slice by a rename
when all its rows are written. A run that dies costs the slice at hand; the next
run answers only what is missing. Equal prompts with equal settings are answered
once.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.operators.answers import batch_generate
from colloquy.plans.shared import scratch_path

C = F.col
SETTINGS = ("max_length", "temperature", "top_p", "do_sample")
LEDGER = "digest string, slice int, output string, error string, elapsed_s double"
BATCH = 64


def digest_of(prompts: DataFrame) -> Column:
    """SHA-256 of the prompt and its settings; a null prompt is not an empty one."""
    names = [n for n in SETTINGS if n in prompts.columns]
    return F.sha2(F.to_json(F.struct(C("prompt"), *names)), 256)


def slice_of(digest: Column, slices: int) -> Column:
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % slices).cast("int")


def _files(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def read_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """The committed answers, one per digest: of several, one without an error, else that of the first slice by name."""
    at, files = _files(spark, folder)
    names = [f.getPath().getName() for f in files.listStatus(at)] if files.exists(at) else []
    committed = sorted(f"{folder}/{n}" for n in names if n.startswith("slice-"))
    if not committed:
        return spark.createDataFrame([], LEDGER)
    rows = spark.read.schema(LEDGER).parquet(*committed).withColumn("name", C("_metadata.file_path"))
    best = F.min_by(F.struct("slice", "output", "error", "elapsed_s"), F.struct(C("error").isNotNull(), C("name")))
    return rows.groupBy("digest").agg(best.alias("best")).select("digest", "best.*")


def _commit(spark: SparkSession, written: str, committed: str) -> None:
    source, files = _files(spark, written)
    target, _ = _files(spark, committed)
    if not files.rename(source, target):
        raise OSError(f"could not rename {written} to {committed}")


def answer_missing(
    prompts: DataFrame,
    make_generator: Callable[[], Callable[[list[str], list[dict]], list[str]]],
    folder: str,
    slices: int = 64,
    batch_rows: int = BATCH,
    retry_errors: bool = False,
    on_commit: Callable[[int], None] | None = None,
) -> int:
    """Answer what the ledger in ``folder`` lacks; returns the number of slices committed.

    ``prompts`` has ``prompt`` and any settings of ``resolve_params``. What is
    missing is written by slice once. Within a slice, prompts are dealt to tasks
    by ranges of length, so a batch's prompts are about equally long and no range
    is too large: ties are cut by digest. ``retry_errors`` asks again for what gave an error.
    ``on_commit`` is called with each slice's number after its commit. Two runs
    at a time do no harm but double work.
    """
    spark = prompts.sparkSession
    at, files = _files(spark, folder)
    files.mkdirs(at)
    names = [n for n in SETTINGS if n in prompts.columns]
    asked = prompts.select("prompt", *names).withColumn("digest", digest_of(prompts)).withColumn("slice", slice_of(C("digest"), slices))
    known = read_ledger(spark, folder)
    known = (known.where("error IS NULL") if retry_errors else known).select("digest")
    missing = scratch_path(spark, "missing")
    asked.dropDuplicates(["digest"]).join(known, "digest", "left_anti").write.partitionBy("slice").parquet(missing)
    stored = spark.read.schema(asked.schema).parquet(missing)
    todo = sorted(r["slice"] for r in stored.select("slice").distinct().collect())
    run = uuid.uuid4().hex
    for number in todo:
        part = stored.where(C("slice") == number)
        length = F.coalesce(F.char_length("prompt"), F.lit(-1))
        dealt = part.withColumn("length", length).repartitionByRange("length", "digest").sortWithinPartitions("length", "digest")
        answered = batch_generate(dealt, make_generator, batch_rows)
        written = f"{folder}/open-{run}-{number}"
        answered.select("digest", "slice", "output", "error", C("elapsed_s").cast("double")).write.parquet(written)
        _commit(spark, written, f"{folder}/slice-{number:06d}-{run}")
        if on_commit is not None:
            on_commit(number)
    return len(todo)


def with_answers(prompts: DataFrame, folder: str) -> DataFrame:
    """``prompts`` with ``output, error, elapsed_s, slice`` of the ledger; nulls where it has no answer yet."""
    known = read_ledger(prompts.sparkSession, folder).withColumnRenamed("digest", "_digest")
    keyed = prompts.withColumn("_key", digest_of(prompts))
    return keyed.join(known, C("_key") == C("_digest"), "left").drop("_key", "_digest")
