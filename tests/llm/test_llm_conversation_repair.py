"""Repair of conversations against enumeration of all edits, and of large ones against the program for small ones."""

import hashlib
import heapq
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tidegate.llm import conversation_repair as repair

SCHEMA = "conv_id long, turn long, role string, text string, `no` int, n string, kind string"


def damage(rows):
    out = []
    for conv_id, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        role = "user" if kind == 4 else role
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv_id, turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def cheapest(symbols):
    """Best-first search over single edits: the least (cost, edits); independent of matrices."""
    legal = re.compile("s?(ua)*u?")
    heap, seen = [(0, "", 0, "")], set()
    while heap:
        cost, edits, at, roles = heapq.heappop(heap)
        key = (at, roles[-1:] if roles else "")
        if (key, cost, edits) in seen or any(k == key and (c, e) <= (cost, edits) for k, c, e in seen):
            continue
        seen.add((key, cost, edits))
        if at == len(symbols) and re.fullmatch("(s?(ua)+)?", roles):
            return cost, edits, roles
        for role in "ua":
            if legal.fullmatch(roles + role):
                heapq.heappush(heap, (cost + 3, edits + "I", at, roles + role))
        if at < len(symbols):
            initial, gone, cut = symbols[at]
            heapq.heappush(heap, (cost + 4, edits + "D", at + 1, roles))
            if not gone:
                if initial in "sua" and initial and legal.fullmatch(roles + initial):
                    heapq.heappush(heap, (cost + 3 * cut, edits + "K", at + 1, roles + initial))
                for role in "ua":
                    if legal.fullmatch(roles + role):
                        heapq.heappush(heap, (cost + 3 + 3 * cut, edits + "R", at + 1, roles + role))


def brute(given):
    out = []
    for conv_id in {r[0] for r in given}:
        rows = sorted((r[1:] for r in damage(r for r in given if r[0] == conv_id)), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, symbols, counts = set(), [], [0, 0, 0]
        for _, role, text in rows:
            said = re.findall(r"[^\x20\x09-\x0D]", text)
            blank, again, cut = not said, (role, text) in seen, bool(said) and said[-1] not in ".!?"
            seen.add((role, text))
            for k, fault in enumerate((blank, again, cut)):
                if fault:
                    counts[k] += 1
                    break
            symbols.append((role[:1], blank or again, cut))
        cost, edits, roles = cheapest(symbols)
        turns = {r[0] for r in rows} - {None}
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(symbols, symbols[1:]))
        lines, left, names = [], iter(rows), iter(roles)
        for edit in edits:
            row = next(left) if edit != "I" else None
            if edit != "D":
                name = {"u": "user", "a": "assistant"}.get(next(names)) if edit != "K" else (next(names), row[1])[1]
                lines.append(f"{name}:{row[2] if row else ''}")
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out.append((conv_id, gaps, *counts, illegal, cost, edits, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(map(repr, out))


@pytest.fixture(scope="module")
def planted():
    rnd = random.Random(4)
    texts = ["Yes.", "no", "", " \x0b", "Why? ", "ok.\n", None, "é", "what!", "No."]
    roles = ["user", "assistant", "user", "assistant", "system", None, "", "tool", "Sally"]
    rows = [(c, rnd.choice((None, *range(9))), rnd.choice(roles[: rnd.choice((2, 9))]), rnd.choice(texts)) for c in (*range(60), None) for _ in range(rnd.randint(1, 9))]
    rows += [(500, t, ("user", "assistant")[t % 2], "fine.") for t in range(6)] + [(501, t, ("system", "user", "assistant")[t], f"fine {t}.") for t in range(3)]
    return rows + rows[:30]


@pytest.mark.parametrize("many", [repair.MANY_ROWS, 2])
def test_repairs_are_the_cheapest(spark, planted, many):
    given = spark.createDataFrame([(*r, 1, "n", "k") for r in planted], SCHEMA)
    got = repair.repairs(repair.damaged(given), many_rows=many, chunk_rows=25)
    assert sorted(repr(tuple(r)) for r in got.collect()) == brute(planted)


@pytest.mark.parametrize("many", [repair.MANY_ROWS, 2])
def test_turns_have_the_digest(spark, planted, many):
    rows = repair.damaged(spark.createDataFrame([(*r, 1, "n", "k") for r in planted], SCHEMA))
    turns = repair.repaired_turns(rows, many_rows=many, chunk_rows=25)
    lines = F.transform(F.sort_array(F.collect_list(F.struct("place", "role", "text"))), lambda x: F.concat(x["role"], F.lit(":"), x["text"]))
    digests = {r[0]: r[1] for r in turns.groupBy("conv_id").agg(F.sha2(F.array_join(lines, "\n"), 256)).collect()}
    nothing = hashlib.sha256(b"").hexdigest()
    assert all(digests.get(r.conv_id, nothing) == r.repaired_sha256 for r in repair.repairs(rows).collect())


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert repair.repairs(repair.damaged(none)).count() == 0 == repair.repaired_turns(repair.damaged(none)).count()


def test_one_conversation_with_most_rows(spark):
    """In chunks, with a run of equal rows that is longer than a chunk and a block, and a very long text."""
    rows = spark.range(30_000).selectExpr("7L as conv_id", "id div 2 as turn", "if(id % 2 = 0, 'user', 'assistant') as role", "if(id > 9000, 'same.', concat('text ', id, '.')) as text", "if(id > 29000, 50, 1) as times")
    rows = rows.union(spark.sql("select 7L, 99999L, 'user', repeat('long ', 1000000), 1")).union(spark.sql("select 8L, 1L, 'user', 'x.', 1"))
    small = {r.conv_id: tuple(r) for r in repair.repairs(rows, many_rows=1 << 40, many_bytes=1 << 40).collect()}
    large = {r.conv_id: tuple(r) for r in repair.repairs(rows, chunk_rows=7_000).collect()}
    assert large == small and len(small) == 2 and small[7][6] > 100_000


def test_powers_advance_runs():
    for symbol in ("uw", "at", "sw", "ox", "ow", "ut"):
        step = costs = repair.costs_at_end()
        for _ in range(37):
            step = repair._ahead(repair._power(symbol, 0), step)
        assert repair._run_ahead(symbol, 37, costs) == step == repair._ahead(repair.run_matrix([(symbol, 30), (symbol, 7)]), costs)
