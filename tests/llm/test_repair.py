import hashlib
import random
import zlib
from functools import lru_cache

import pytest

from colloquy.llm import repair
from colloquy.llm.queries import queries

WHITE = " \t\n\v\f\r"


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        conv_, turn_, role, text = (" " if v is None else v for v in (conv, turn, role, text))
        how = zlib.crc32(f"{conv_}:{turn_}".encode()) % 20
        if how == 0:
            continue
        if how == 1:
            text = ""
        if how == 2:
            text = "".join(c for c in text if c not in ".!?")
        if how == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if how == 3 else 1)
    return out


def plain_report(rows):
    """By a table of best ends, over rows of (turn, role, text)."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    faults = []
    for n, (_, role, text) in enumerate(rows):
        bare = text.strip(WHITE)
        seen = any((r, t) == (role, text) for _, r, t in rows[:n])
        faults.append("blank" if not bare else "duplicate" if seen else "" if bare[-1] in ".!?" else "truncated")
    initials = [role[:1] for _, role, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    legal = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    @lru_cache(None)
    def best(i, last, inserted):
        """Least (cost, edits) from row i on, after a row with initial ``last``."""
        ways = []
        if i == len(rows) and last in ("", "a"):
            ways.append((0, ""))
        if i < len(rows):
            cost, edits = best(i + 1, last, 0)
            ways.append((cost + 4, "D" + edits))
            extra = 3 if faults[i] == "truncated" else 0
            if faults[i] not in ("blank", "duplicate"):
                for how, price, initial in [("K", 0, initials[i]), ("R", 3, "u"), ("R", 3, "a")]:
                    if (last, initial) in legal:
                        cost, edits = best(i + 1, initial, 0)
                        ways.append((cost + price + extra, how + edits))
        if inserted < 3:
            for initial in "ua":
                if (last, initial) in legal:
                    cost, edits = best(i, initial, inserted + 1)
                    ways.append((cost + 3, "I" + edits))
        return min(ways, default=(10**9, ""))

    cost, audit = best(0, "", 0)
    lines, i, last = [], 0, ""
    for edit in audit:
        if edit != "I":
            _, role, text = rows[i]
            i += 1
        if edit == "D":
            continue
        if edit in "IR":
            role = "assistant" if last == "u" else "user"
            text = "" if edit == "I" else text
        lines.append(f"{role}:{text}")
        last = role[:1]
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, illegal, cost, audit, digest), lines


EMPTY = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
NAMES = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def made(count, longest, seed):
    chance = random.Random(seed)
    rows = []
    for conv in range(count):
        size = chance.randrange(1, longest)
        for turn in range(size):
            role = chance.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = chance.choice(["Yes.", "No!", "why", " ", "", None, "so it goes\n", f"text {turn}?", f"text {turn}"])
            rows.append((conv, chance.choice([turn, turn, turn, turn // 2, None, turn * 3]), role, text))
    return rows


def by_conversation(rows):
    out = {}
    for conv, *row in rows:
        out.setdefault(conv, []).append(tuple(row))
    return out


def compare(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, conv string, block string, n string" if rows and len(rows[0]) > 4 else "conv_id long, turn long, role string, text string")
    df = df.repartition(4)
    damaged = repair.damaged(df, "conv_id", "turn", "role", "text")
    plain = by_conversation(plain_damage([r[:4] for r in rows]))
    want = {r[0]: EMPTY for r in rows} | {conv: plain_report(own)[0] for conv, own in plain.items()}
    got = {r["conv"]: tuple(r[n] for n in NAMES) for r in repair.report(spark, damaged, df.select("conv_id")).collect()}
    assert got == want
    lines = {conv: [] for conv in plain}
    for row in sorted(repair.repaired(spark, damaged).collect(), key=lambda r: r.block):
        lines[row["conv"]] += [f"{t.role}:{t.text}" for t in row.turns]
    assert lines == {conv: plain_report(own)[1] for conv, own in plain.items()}


def test_as_brute_force(spark):
    compare(spark, made(250, 9, 1) + [(None, n, "user", f"x {n}.") for n in range(5)] + [(None, None, None, None), (900, 0, "user", None)])


def test_long_conversations_in_spans(spark, monkeypatch):
    rows = made(12, 60, 2)
    compare(spark, rows)
    monkeypatch.setattr(repair, "SPAN", 3)
    compare(spark, rows)


def test_large_conversations_in_blocks(spark, monkeypatch):
    rows = made(6, 90, 3) + [(None, n, ("user", "assistant")[n % 2], f"line {n}.") for n in range(120)]
    rows += [(50, None, "user", "the same row") for _ in range(80)] + [(51, n // 9, "assistant", "   ") for n in range(60)]
    monkeypatch.setattr(repair, "LARGE", 24)
    compare(spark, rows)


def test_clashing_columns_empty_table_and_dropped_rows(spark):
    compare(spark, [(*r, "c", "b", "n") for r in made(20, 7, 4)])
    compare(spark, [])
    gone = [(conv, 0, "user", "x") for conv in range(2000) if zlib.crc32(f"{conv}:0".encode()) % 20 == 0][:5]
    compare(spark, gone)


@pytest.mark.parametrize("seed", range(4))
def test_search_under_bounds(seed):
    chance = random.Random(seed)
    for _ in range(300):
        rows = [(chance.choice("suaatx"), chance.choice([0, 0, 0, 1, 2, 3])) for _ in range(chance.randrange(0, 8))]
        text = {0: "t.", 1: "", 2: "", 3: "t"}
        whole = repair.best_edits(rows)
        plain = [(n, {"s": "system", "u": "user", "a": "assistant"}.get(i, i), text[f] if f in (1, 2) else f"{n}{text[f]}") for n, (i, f) in enumerate(rows)]
        assert whole == plain_report(plain)[0][5:7]


def test_query_as_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{folder}/conversations.parquet").collect()]
    want = {r[0]: EMPTY for r in rows} | {c: plain_report(own)[0] for c, own in by_conversation(plain_damage(rows)).items()}
    got = {r.conv_id: tuple(r[n] for n in NAMES) for r in queries()["op11_repair"](spark, folder).collect()}
    assert got == want
