"""Secret scans with a ledger of scanned contents.

Every version of every path is addressed by the digest of its content. The
ledger says which rules, in which version, a content has been scanned with and
what they found. A scan reads only contents that lack a rule, and findings go
back to all paths and versions of the content by a join. Built-in functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.llm.common import Stored

C = F.col

SPAN = "struct<start:int,stop:int,kind:string>"
SPANS = f"array<{SPAN}>"
LEDGER = f"blob string, rules array<string>, spans {SPANS}"


@dataclass(frozen=True)
class Rule:
    """A pattern; of its matches count those whose ``group`` has ``at_least`` characters.

    A changed pattern needs a new version, which makes every content unseen for this rule.
    ``hint`` is a pattern that every text with a match has; texts without it are not searched further.
    """

    kind: str
    pattern: str
    group: int = 0
    at_least: int = 1
    version: int = 1
    hint: str | None = None

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


def any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c.lower()}]" if c.isalpha() else c for c in word)


KEYWORD = "|".join(any_case(w) for w in ("password", "passwd", "secret", "token")) + "|" + any_case("api") + "_?" + any_case("key")
#: Base rules, in the order of their kinds.
BASE = (
    Rule("assign", rf"""({KEYWORD})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]{14,}", hint="AKIA"),
    Rule("hex", r"[0-9a-f]{16,}"),
)
#: Secrets with a form of their own.
FORMS = (
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}", hint="gh[pousr]_"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}", hint="xox[abprs]-"),
    Rule("webtoken", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", hint="eyJ"),
    Rule("private", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", hint="PRIVATE KEY-----"),
)
RULES = BASE + FORMS


def matches(text: Column, rule: Rule) -> Column:
    """Spans of the rule in the text: leftmost, non-overlapping, in code points.

    What lies between the matches gives their places: lengths of gaps and
    matches in turn add up to starts and ends.
    """
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    counted = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else found
    gaps = F.split(text, rule.pattern, -1)
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("spans"))

    def step(state: Column, x: Column) -> Column:
        begins = state["at"] + F.char_length(x["gap"])
        ends = begins + F.char_length(x["found"])
        span = F.struct(begins.alias("start"), ends.alias("stop"), F.lit(rule.kind).alias("kind"))
        keep = F.char_length(x["counted"]) >= rule.at_least
        spans = F.when(keep, F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct(ends.alias("at"), spans.alias("spans"))

    # one gap more than matches: the rest behind the last one
    parts = F.arrays_zip(F.slice(gaps, F.lit(1), F.size(found)).alias("gap"), found.alias("found"), counted.alias("counted"))
    spans = F.aggregate(parts, start, step, lambda state: state["spans"])
    return F.when(text.rlike(rule.hint or rule.pattern), spans).otherwise(F.array().cast(SPANS))


def empty_ledger(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], LEDGER)


def scan(
    spark: SparkSession,
    versions: DataFrame,
    keys: list[str],
    text: str = "text",
    ledger: DataFrame | None = None,
    rules: tuple[Rule, ...] = RULES,
    columns: dict[str, Column] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Findings of every version, and the rows to append to the ledger.

    ``versions`` has a row per version of a path, named by ``keys`` (for example
    path and commit). The first result has ``keys, blob, spans`` for each of its
    rows, and the given columns: spans of all rules by start, then order of the
    rules, as ``struct<start, stop, kind>``. The second has a row per content
    that lacked a rule, with the rules it was scanned with and their spans, also
    if there are none. Appending it again does no harm.

    A null text counts as empty. Repeated rows and null keys stay: a content is
    scanned once however often it occurs. Other columns are not read.
    """
    store = Stored(spark, "secrets")
    content = F.coalesce(C(text), F.lit(""))
    named = [C(k).alias(f"key_{n}") for n, k in enumerate(keys)]
    more = columns or {}
    listed = store.put(
        versions.select(*named, F.sha2(content, 256).alias("blob"), *[v.alias(f"more_{k}") for k, v in more.items()])
    )
    key_names = [f"key_{n}" for n in range(len(keys))]
    order = {r.kind: n for n, r in enumerate(rules)}
    wanted = F.array(*[F.lit(r.name) for r in rules])

    blobs = listed.groupBy("blob").agg(F.min(F.struct(*key_names)).alias("rep"))
    if ledger is None:
        unseen = blobs.select("blob", "rep", wanted.alias("lacks"))
    else:
        seen = ledger.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_set("rules"))).alias("seen"))
        lacks = F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>")))
        unseen = blobs.join(seen, "blob", "left").select("blob", "rep", lacks.alias("lacks")).where(F.size("lacks") > 0)
    unseen = unseen.select(
        C("blob").alias("b"), "lacks", *[C(f"rep.{k}").alias(f"r_{n}") for n, k in enumerate(key_names)]
    )
    # a content's text comes from one of its versions; only repeated rows can bring it twice
    texts = versions.select(*named, F.sha2(content, 256).alias("blob"), content.alias("text"))
    same = C("blob") == C("b")
    for n, k in enumerate(key_names):
        same = same & C(k).eqNullSafe(C(f"r_{n}"))
    chosen = texts.join(unseen, same).select("blob", "lacks", "text")
    each = [F.when(F.array_contains("lacks", r.name), matches(C("text"), r)).otherwise(F.array().cast(SPANS)) for r in rules]
    scanned = store.put(chosen.select("blob", C("lacks").alias("rules"), F.concat(*each).alias("spans")))
    fresh = scanned.dropDuplicates(["blob"])

    known = fresh if ledger is None else ledger.select("blob", "rules", "spans").unionByName(fresh)
    current = known.select(
        "blob", F.filter("spans", lambda s: F.exists(rule_of(rules, C("rules")), lambda k: k == s["kind"])).alias("spans")
    )
    rank = F.create_map(*[x for k, n in order.items() for x in (F.lit(k), F.lit(n))])
    placed = lambda s: F.struct(
        s["start"].alias("start"), F.element_at(rank, s["kind"]).alias("rank"), s["stop"].alias("stop"), s["kind"].alias("kind")
    )
    sorted_spans = F.transform(
        F.array_sort(F.array_distinct(F.transform(F.flatten(F.collect_list("spans")), placed))),
        lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), s["kind"].alias("kind")),
    )
    by_blob = current.where(F.size("spans") > 0).groupBy("blob").agg(sorted_spans.alias("spans"))
    found = listed.join(by_blob, "blob", "left").select(
        *[C(f"key_{n}").alias(k) for n, k in enumerate(keys)],
        "blob",
        F.coalesce("spans", F.array().cast(SPANS)).alias("spans"),
        *[C(f"more_{k}").alias(k) for k in more],
    )
    return found, fresh


def rule_of(rules: tuple[Rule, ...], scanned: Column) -> Column:
    """Kinds of the current rules among those that a row of the ledger was scanned with."""
    return F.transform(
        F.filter(F.array(*[F.struct(F.lit(r.name).alias("name"), F.lit(r.kind).alias("kind")) for r in rules]),
                 lambda r: F.array_contains(scanned, r["name"])),
        lambda r: r["kind"],
    )


def written(spans: Column) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")
