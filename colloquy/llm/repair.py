"""Conversation structure repair by iterative-deepening A*.

A conversation is to read as ``(s?(ua)+)?`` in the initials of its roles. A
search edits its rows one after the other (Delete, Insert, Keep, Rerole) and
walks a machine of four states; it tries edits in ASCII order, depth first, under
a bound on cost plus what the rows ahead must cost, and raises the bound to the
least cost that went beyond it. States that failed with some cost left are not
entered again with as little. The first accepting path under the first bound that
has one is cheapest, and the least in ASCII of the cheapest.

The number of bounds grows with the rows, so the rows of a conversation are cut
into spans of ``SPAN`` rows, each searched for every pair of states, and the
spans' paths are put together. Large conversations are cut into blocks that
different tasks search.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain, groupby, islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.llm.common import Stored

C = F.col
SPAN = 10  # rows that one search goes over
LARGE = 20_000  # rows of a conversation that one task takes
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3  # costs
START, SYSTEM, USER, ANSWERED = range(4)
STATES = (START, SYSTEM, USER, ANSWERED)
ACCEPTING = (START, ANSWERED)
#: Where a role's initial leads, by state.
STEP = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ANSWERED}, {"u": USER})
#: The one role, of user and assistant, that may come next, and where it leads.
NEXT = (("user", USER), ("user", USER), ("assistant", ANSWERED), ("user", USER))
LEGAL = {"su", "ua", "au"}
FINE, BLANK, DUPLICATE, CUT_OFF = range(4)
WHITE = "\t\n\x0b\x0c\r "
END = ".!?"


# One search


def search(rows: list[tuple[str, int]], begin: int, goals: tuple[int, ...], trailing: bool) -> tuple[int, str] | None:
    """The least cost from ``begin`` to a goal over rows of ``(initial, fault)``, and its edits; ``None`` if there is no way.

    Without ``trailing``, no insertion comes after the last row: it belongs to
    the rows that follow.
    """
    size = len(rows)
    ahead = [0] * (size + 1)  # what each row costs at least, whatever its state
    for i in range(size - 1, -1, -1):
        fault = rows[i][1]
        ahead[i] = ahead[i + 1] + (DELETE if fault in (BLANK, DUPLICATE) else min(DELETE, TRUNCATED) if fault == CUT_OFF else 0)
    most = DELETE * size + INSERT * len(STATES)  # delete all, insert the rest: no goal in reach costs more
    highest = ANSWERED if max(goals) > SYSTEM else max(goals)  # nothing leads back to the first two states
    bound = ahead[0]
    while bound <= most:
        failed: dict[tuple[int, int], int] = {}
        beyond = most + 1

        def path(i: int, state: int, left: int) -> str | None:
            nonlocal beyond
            if left < ahead[i]:
                beyond = min(beyond, bound - left + ahead[i])
                return None
            if i == size and state in goals:
                return ""
            if state > highest:
                return None
            if failed.get((i, state), -1) >= left:
                return None
            if i < size:
                initial, fault = rows[i]
                found = path(i + 1, state, left - DELETE)
                if found is not None:
                    return "D" + found
            role, to = NEXT[state]
            if i < size or trailing:
                found = path(i, to, left - INSERT)
                if found is not None:
                    return "I" + found
            if i < size and fault not in (BLANK, DUPLICATE):
                more = TRUNCATED if fault == CUT_OFF else 0
                kept = STEP[state].get(initial)
                if kept is not None:
                    found = path(i + 1, kept, left - KEEP - more)
                    if found is not None:
                        return "K" + found
                found = path(i + 1, to, left - REROLE - more)
                if found is not None:
                    return "R" + found
            failed[i, state] = left
            return None

        found = path(0, begin, bound)
        if found is not None:
            return bound, found
        if beyond > most:
            return None
        bound = beyond
    return None


# Spans put together

Way = tuple[int, tuple]  # cost, and the edits as a chain of strings: (this, the ones after)


def least(ways: list[tuple[int, str, tuple]]) -> Way | None:
    """The cheapest, ties by its own edits: none of them begins another, as each ends with an edit of the last row."""
    if not ways:
        return None
    cost, edits, after = min(ways, key=lambda w: w[:2])
    return cost, (edits, after)


def spans_ways(rows: list[tuple[str, int]], goals: dict[int, Way], last: bool) -> dict[int, Way]:
    """By state before the rows, the best way over them and on to one of ``goals``, the ways by state after them."""
    starts = list(range(0, len(rows), SPAN)) or [0]
    for at in reversed(starts):
        part = rows[at : at + SPAN]
        end = last and at == starts[-1]
        before = {}
        for begin in STATES:
            ways = []
            for goal, (cost, after) in goals.items():
                if (goal == START and begin != START) or (goal == SYSTEM and begin in (USER, ANSWERED)):
                    continue
                found = search(part, begin, (goal,), end)
                if found is not None:
                    ways.append((found[0] + cost, found[1], after))
            best = least(ways)
            if best is not None:
                before[begin] = best
        goals = before
    return goals


FINAL: dict[int, Way] = {state: (0, ()) for state in ACCEPTING}


def best_edits(rows: list[tuple[str, int]]) -> tuple[int, str]:
    """Cost and edits of a whole conversation."""
    if len(rows) <= SPAN:
        return search(rows, START, ACCEPTING, True)
    cost, spans = spans_ways(rows, FINAL, True)[START]
    return cost, written(spans)


def written(spans: tuple) -> str:
    parts = []
    while spans:
        part, spans = spans
        parts.append(part)
    return "".join(parts)


def replayed(rows: Iterator[tuple[str, str]], edits: str, state: int = START) -> Iterator[tuple[str, str]]:
    """The repaired rows of ``(role, text)``."""
    for edit in edits:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit == "D":
            continue
        if edit == "K":
            state = STEP[state][role[:1]]
        else:
            role, state = NEXT[state]
        yield role, text


def fault_of(text: str, seen: bool) -> int:
    bare = text.rstrip(WHITE)
    if not bare:
        return BLANK
    return DUPLICATE if seen else FINE if bare[-1] in END else CUT_OFF


# Damage, and the order of rows


def damaged(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``conv, turn, role, text`` with planted faults, by ``crc32('conv:turn') % 20``; nulls stand as one space.

    0 drops the row, 1 empties its text, 2 takes the sentence ends out of it, 3
    repeats it, 4 makes its role ``user``.
    """
    blank = lambda c: F.coalesce(C(c).cast("string"), F.lit(" "))
    how = F.crc32(F.concat_ws(":", blank(conv), blank(turn)).cast("binary")) % 20
    plain = rows.select(C(conv).alias("conv"), C(turn).alias("turn"), blank(role).alias("role"), blank(text).alias("text"), how.alias("how"))
    changed = plain.where("how <> 0").select(
        "conv",
        "turn",
        F.when(C("how") == 4, F.lit("user")).otherwise(C("role")).alias("role"),
        F.when(C("how") == 1, F.lit("")).when(C("how") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(C("text")).alias("text"),
        "how",
    )
    return changed.select("conv", "turn", "role", "text", F.explode(F.array_repeat(F.lit(1), F.when(C("how") == 3, 2).otherwise(1))).alias("copy")).drop("copy")


LONGS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
REPORT = ", ".join(f"{n} long" for n in LONGS) + ", audit string, repaired_sha256 string"
REPORT_FIELDS = [*[(n, pa.int64()) for n in LONGS], ("audit", pa.string()), ("repaired_sha256", pa.string())]
TURNS = "array<struct<role:string,text:string>>"
TURNS_TYPE = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))


class Facts:
    """What is counted over rows in order: of a conversation, or of a block of one, to be put after what came before."""

    def __init__(self, rows: list[tuple[int | None, str, str]], earlier: list[bool] | None = None):
        known = [t for t, _, _ in rows if t is not None]
        self.low, self.high, self.turns = (known[0], known[-1], len(set(known))) if known else (None, None, 0)
        seen: set[tuple[str, str]] = set()
        self.faults = []
        for n, (_, role, text) in enumerate(rows):
            self.faults.append(fault_of(text, (role, text) in seen or bool(earlier and earlier[n])))
            seen.add((role, text))
        self.initials = [role[:1] for _, role, _ in rows]
        self.counts = [self.faults.count(f) for f in (BLANK, DUPLICATE, CUT_OFF)]
        self.illegal = sum(a + b not in LEGAL for a, b in zip(self.initials, self.initials[1:]))

    @property
    def rows(self) -> list[tuple[str, int]]:
        return list(zip(self.initials, self.faults))


def in_order() -> list[Column]:
    return [C("turn").asc_nulls_first(), C("role"), C("text")]


def gaps(low: int | None, high: int | None, turns: int) -> int:
    return 0 if low is None else high - low + 1 - turns


# Conversations that one task holds


def tuples(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def in_batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for held in iter(lambda: list(islice(rows, 1000)), []):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def small(rows: DataFrame, turns: bool) -> DataFrame:
    """One row per conversation: its report, or its repaired turns. One shuffle; Spark's sort puts the rows in order."""
    kind = rows.schema["conv"].dataType.simpleString()

    def reported(stream: Iterator[tuple]) -> Iterator[tuple]:
        for conv, own in groupby(stream, key=lambda r: r[0]):
            own = [r[1:] for r in own]
            facts = Facts(own)
            cost, edits = best_edits(facts.rows)
            repaired = replayed(((role, text) for _, role, text in own), edits)
            if turns:
                yield conv, 0, [{"role": r, "text": t} for r, t in repaired]
            else:
                digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest()
                yield conv, gaps(facts.low, facts.high, facts.turns), *facts.counts, facts.illegal, cost, edits, digest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return
        fields = [("block", pa.int32()), ("turns", TURNS_TYPE)] if turns else REPORT_FIELDS
        schema = pa.schema([("conv", first.schema.field("conv").type), *fields])
        yield from in_batches(reported(tuples(chain([first], batches))), schema)

    ordered = rows.select("conv", "turn", "role", "text").repartition("conv").sortWithinPartitions("conv", *in_order())
    return ordered.mapInArrow(run, f"conv {kind}, block int, turns {TURNS}" if turns else f"conv {kind}, {REPORT}")


# Large conversations, in blocks

WAYS = "array<struct<begin:int,goal:int,cost:long,rank:int,edits:string>>"
FACTS = "low long, high long, turns long, blank long, duplicate long, truncated long, illegal long, first string, last string"


def summarised(key: tuple, table: pa.Table) -> pa.Table:
    """A block's facts, and its best edits from each state to each."""
    conv, block, is_last = (k.as_py() for k in key)
    table = table.sort_by([("place", "ascending")])
    rows = list(zip(*(table.column(c).to_pylist() for c in ("turn", "role", "text"))))
    facts = Facts(rows, table.column("earlier").to_pylist())
    ways = []
    for begin in STATES:
        own = []
        for goal in STATES:
            found = spans_ways(facts.rows, {goal: (0, ())}, is_last).get(begin)
            if found is not None:
                own.append((begin, goal, found[0], written(found[1])))
        ranks = {edits: n for n, edits in enumerate(sorted(w[3] for w in own))}
        ways += [{"begin": b, "goal": g, "cost": c, "rank": ranks[e], "edits": e} for b, g, c, e in own]
    way = pa.struct([("begin", pa.int32()), ("goal", pa.int32()), ("cost", pa.int64()), ("rank", pa.int32()), ("edits", pa.string())])
    longs = dict(zip(("low", "high", "turns", "blank", "duplicate", "truncated", "illegal"), (facts.low, facts.high, facts.turns, *facts.counts, facts.illegal)))
    return pa.table(
        {
            "conv": pa.array([conv], table.schema.field("conv").type),
            "block": pa.array([block], pa.int32()),
            **{n: pa.array([v], pa.int64()) for n, v in longs.items()},
            "first": pa.array([facts.initials[0]], pa.string()),
            "last": pa.array([facts.initials[-1]], pa.string()),
            "ways": pa.array([ways], pa.list_(way)),
        }
    )


def chosen(key: tuple, table: pa.Table) -> pa.Table:
    """The states a conversation's best edits pass, by block: least cost to the end, ties by the edits of the first block that differs."""
    table = table.sort_by([("block", "ascending")])
    blocks, ways = table.column("block").to_pylist(), table.column("ways").to_pylist()
    ahead = {state: 0 for state in ACCEPTING}
    picks = []
    for own in reversed(ways):
        best: dict[int, tuple[int, int, int]] = {}
        for w in own:
            if w["goal"] in ahead:
                offer = (w["cost"] + ahead[w["goal"]], w["rank"], w["goal"])
                best[w["begin"]] = min(best.get(w["begin"], offer), offer)
        picks.append(best)
        ahead = {begin: cost for begin, (cost, _, _) in best.items()}
    state, passed = START, []
    for best in reversed(picks):
        passed.append((state, best[state][2]))
        state = best[state][2]
    return pa.table(
        {
            "of": table.column("conv"),
            "at": pa.array(blocks, pa.int32()),
            "begin": pa.array([b for b, _ in passed], pa.int32()),
            "goal": pa.array([g for _, g in passed], pa.int32()),
        }
    )


def block_turns(key: tuple, rows: pa.Table, way: pa.Table) -> pa.Table:
    """The repaired turns of a block."""
    rows = rows.sort_by([("place", "ascending")])
    own = zip(rows.column("role").to_pylist(), rows.column("text").to_pylist())
    turns = [{"role": r, "text": t} for r, t in replayed(own, way.column("edits")[0].as_py(), way.column("begin")[0].as_py())]
    return pa.table({"conv": rows.column("conv").slice(0, 1), "block": pa.array([key[1].as_py()], pa.int32()), "turns": pa.array([turns], TURNS_TYPE)})


class Large:
    """Conversations that many tasks share, as written tables of blocks."""

    def __init__(self, spark: SparkSession, rows: DataFrame, total: int, store: Stored):
        kind = rows.schema["conv"].dataType.simpleString()
        tied = rows.select("conv", "turn", "role", "text", F.monotonically_increasing_id().alias("tie"))  # equal rows can be split as well
        order = [C("conv"), *in_order(), C("tie")]
        dealt = tied.repartitionByRange(max(1, -(-total // (LARGE // 2))), *order).sortWithinPartitions(*order)
        placed = store.put(dealt.select("*", F.spark_partition_id().alias("block"), F.monotonically_increasing_id().alias("place")))
        content = F.sha2(F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text"), 256)
        named = placed.withColumn("content", content)
        firsts = named.groupBy(C("conv").alias("of"), C("content").alias("same")).agg(F.min("block").alias("first"), F.max("block").alias("last"))
        ends = placed.groupBy(C("conv").alias("ending")).agg(F.max("block").alias("end"))
        met = named.join(firsts.where("first < last"), C("conv").eqNullSafe(C("of")) & (C("content") == C("same")), "left")
        flagged = met.join(ends, C("conv").eqNullSafe(C("ending")))
        self.rows = store.put(
            flagged.select(
                "conv", "turn", "role", "text", "block", "place",
                F.coalesce(C("block") > C("first"), F.lit(False)).alias("earlier"), (C("block") == C("end")).alias("is_last"),
            )
        )
        store.drop(placed)
        blocks = self.rows.groupBy("conv", "block", "is_last").applyInArrow(summarised, f"conv {kind}, block int, {FACTS}, ways {WAYS}")
        blocks = store.put(blocks)
        narrow = blocks.select("conv", "block", F.transform("ways", lambda w: w.dropFields("edits")).alias("ways"))
        path = narrow.groupBy("conv").applyInArrow(chosen, f"of {kind}, at int, begin int, goal int")
        taken = F.filter("ways", lambda w: (w["begin"] == C("begin")) & (w["goal"] == C("goal")))[0]
        joined = blocks.join(path, C("conv").eqNullSafe(C("of")) & (C("block") == C("at"))).withColumn("way", taken)
        facts = [f.split()[0] for f in FACTS.split(", ")]
        self.blocks = store.put(joined.select("conv", "block", *facts, C("way.cost").alias("cost"), C("way.edits").alias("edits"), "begin"))
        way = self.blocks.select("conv", "block", "begin", "edits").groupBy("conv", "block")
        self.turns = store.put(self.rows.groupBy("conv", "block").cogroup(way).applyInArrow(block_turns, f"conv {kind}, block int, turns {TURNS}"))
        self.kind = kind

    def reports(self) -> DataFrame:
        """Blocks put together in order. The digest runs over a conversation's text from its first character
        to its last, so one task reads it through, a block at a time.
        """

        def merged(stream: Iterator[tuple]) -> Iterator[tuple]:
            for conv, own in groupby(stream, key=lambda r: r[0]):
                digest, begun, edits, before = hashlib.sha256(), False, [], None
                least, most, turns, sums = None, None, 0, [0] * 5
                for _, _, low, high, count, *counted, first, last, cost, block_edits, lines in own:
                    if low is not None:
                        least = low if least is None else least
                        turns += count - (low == most)
                        most = high
                    for n, value in enumerate((*counted, cost)):
                        sums[n] += value
                    sums[3] += before is not None and before + first not in LEGAL
                    before = last
                    edits.append(block_edits)
                    for line in lines:
                        digest.update(f"{chr(10) if begun else ''}{line['role']}:{line['text']}".encode())
                        begun = True
                yield conv, gaps(least, most, turns), *sums, "".join(edits), digest.hexdigest()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            first = next(batches, None)
            if first is not None:
                schema = pa.schema([("conv", first.schema.field("conv").type), *REPORT_FIELDS])
                yield from in_batches(merged(tuples(chain([first], batches))), schema)

        lines = self.turns.select(C("conv").alias("of"), C("block").alias("at"), C("turns").alias("lines"))
        joined = self.blocks.drop("begin").join(lines, C("conv").eqNullSafe(C("of")) & (C("block") == C("at"))).drop("of", "at")
        return joined.repartition("conv").sortWithinPartitions("conv", "block").mapInArrow(run, f"conv {self.kind}, {REPORT}")


def parted(spark: SparkSession, rows: DataFrame) -> tuple[DataFrame, Large | None]:
    """Conversations for single tasks, and those above ``LARGE`` rows. At most one in ``LARGE`` rows is a large conversation's."""
    store = Stored(spark, "repair")
    large = store.put(rows.groupBy("conv").count().where(C("count") > LARGE).withColumnRenamed("conv", "which"))
    total = large.agg(F.sum("count")).first()[0]
    if total is None:
        return rows, None
    of = rows["conv"].eqNullSafe(large["which"])
    return rows.join(large, of, "left_anti"), Large(spark, rows.join(large, of, "left_semi"), total, store)


def report(spark: SparkSession, rows: DataFrame, all_convs: DataFrame | None = None) -> DataFrame:
    """One row per conversation of ``conv, turn, role, text``: counts of faults, the cost and edits of its repair, the digest of the result.

    ``gaps`` are turns missing between the first and the last; ``blank``,
    ``duplicate`` and ``truncated`` the rows by their first fault; ``illegal``
    the neighbours whose roles do not follow; ``audit`` the edits' initials;
    ``repaired_sha256`` is of the lines ``role:text``. Rows are taken by turn,
    nulls first, then role and text, so ties and repeated rows have one order;
    a row without a turn counts for no gap. Roles and texts are not null (see
    ``damaged``); a null ``conv`` is a conversation. An empty role has no
    initial, so it is deleted or given a role. Conversations of ``all_convs``
    without rows have zeros, no edits and the digest of nothing.
    """
    ordinary, large = parted(spark, rows)
    found = small(ordinary, turns=False)
    if large is not None:
        found = found.unionByName(large.reports())
    if all_convs is None:
        return found
    ids = all_convs.select(C(all_convs.columns[0]).alias("id")).distinct()
    none = {n: F.lit(0).cast("long") for n in LONGS} | {"audit": F.lit(""), "repaired_sha256": F.lit(hashlib.sha256(b"").hexdigest())}
    joined = ids.join(found, ids["id"].eqNullSafe(found["conv"]), "left")
    return joined.select(C("id").alias("conv"), *[F.coalesce(C(n), value).alias(n) for n, value in none.items()])


def repaired(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """``conv, block, turns``: the repaired turns in order, in one row per conversation or, of a large one, per block."""
    ordinary, large = parted(spark, rows)
    found = small(ordinary, turns=True)
    return found if large is None else found.unionByName(large.turns)
