"""The registered queries of the operators: each takes ``(spark, sf_dir)``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.llm import bpe, extraction, licences, multiset, packing, quality, repair, secrets, simhash, tiling, token_counts, variants, warc
from colloquy.llm.common import read
from colloquy.plans.shared import scratch_path

C = F.col
Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(run: Query) -> Query:
    REGISTRY[run.__name__] = run
    return run


def queries() -> dict[str, Query]:
    return dict(REGISTRY)


SHARDS = 16


@query
def op1_packing(spark, sf_dir):
    placed = packing.assign(spark, read(spark, sf_dir, "documents"), SHARDS)
    return placed.select(
        "doc_id", "size", C("crc32").alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op2_secrets(spark, sf_dir):
    found, _ = secrets.scan(spark, read(spark, sf_dir, "documents"), ["doc_id"])
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    kinds = [r.kind for r in secrets.BASE]
    base = F.filter("spans", lambda s: s["kind"].isin(kinds))
    return found.select(
        "doc_id",
        *[count(k) for k in kinds],
        F.sha2(secrets.written(base), 256).alias("base_sha256"),
        secrets.written(C("spans")).alias("spans"),
    )


@query
def op3_simhash(spark, sf_dir):
    near = simhash.near_copies(spark, read(spark, sf_dir, "documents"))
    return near.select("doc_id", simhash.hexadecimal(C("fp")).alias("fingerprint"), C("component").alias("component_id"))


@query
def op4_multiset(spark, sf_dir):
    rows = multiset.compared(spark, read(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint", "edited_fingerprint", "near_edited", "near_next",
    )


@query
def op5_warc(spark, sf_dir):
    folder = scratch_path(spark, "archive")
    warc.write(spark, read(spark, sf_dir, "pages"), folder)
    records = warc.read(spark, folder)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def held_out():
    return F.crc32(C("doc_id").cast("string").cast("binary")) % 4 == 2


@query
def op6_quality(spark, sf_dir):
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    model = quality.fit(docs, labels.where(~held_out()))
    scored = docs.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), quality.score(C("text"), model).alias("score"))
    return scored.withColumn("predicted", (C("score") >= quality.KEEP).cast("int"))


@query
def op7_extraction(spark, sf_dir):
    found = extraction.extract(spark, read(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"), "n_repeated")


@query
def op8_licences(spark, sf_dir):
    known = spark.createDataFrame(list(licences.KNOWN), "licence string, text string")
    found = licences.scan(spark, read(spark, sf_dir, "documents"), known)
    one = lambda n: F.concat_ws(":", n["line"].cast("string"), n["licence"])
    return found.select(
        "doc_id", "licence", F.size("notices").cast("long").alias("n_notices"),
        F.array_join(F.transform("notices", one), ",").alias("notices"),
    )


@query
def op9_tiling(spark, sf_dir):
    matches = tiling.matcher(read(spark, sf_dir, "benchmark"))
    docs = read(spark, sf_dir, "documents").select("doc_id", matches(C("text")).alias("found"))
    hits = F.transform(F.filter("found", lambda m: m["coverage"] >= tiling.COVERED), lambda m: m["item"])
    return docs.select(
        "doc_id", (F.size(hits) > 0).alias("contaminated"), hits.alias("items"),
        F.coalesce(F.array_max(F.transform("found", lambda m: m["coverage"])), F.lit(0.0)).alias("coverage"),
    )


def token_digests(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    coded = bpe.encode(docs, ranks, public_tokenizers.PATTERN)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", C("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op10_bpe(spark, sf_dir):
    return token_digests(read(spark, sf_dir, "documents"))


TOKEN_LIMIT = 512


@query
def op12_token_counts(spark, sf_dir):
    import public_tokenizers

    tokens = token_counts.counter(public_tokenizers.path("byte_bpe_50k.json"))
    counted = read(spark, sf_dir, "documents").select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), tokens(C("text")).alias("n_tokens")
    )
    return counted.withColumn("over_limit", C("n_tokens") > TOKEN_LIMIT)


@query
def op13_variants(spark, sf_dir):
    counts = variants.word_counts(read(spark, sf_dir, "documents"), least=6, dropping=199)
    return variants.grouped(spark, counts.where(C("n") >= 5))


@query
def op11_repair(spark, sf_dir):
    turns = read(spark, sf_dir, "conversations")
    rows = repair.damaged(turns, "conv_id", "turn", "role", "text")
    return repair.report(spark, rows, turns.select("conv_id")).withColumnRenamed("conv", "conv_id")
