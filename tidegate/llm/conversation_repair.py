"""Repair of conversations at least cost, by a dynamic program over runs of equal rows.

A row is a symbol: the initial of its role, and whether it is whole, truncated or must go. What a symbol does to the four
states of the wanted pattern is a min-plus matrix. Equal consecutive symbols are one run, and a run of n rows is advanced
through the cached powers 1, 2, 4, ... of its matrix. The choices are unrolled from the costs to go, block by block.

A conversation of ordinary size is worked out in one task. One beyond ``MANY_ROWS`` or ``MANY_BYTES`` is cut by ranges of
its order into chunks: chunks become matrices, these give the cost to go at every border, then the state at every
border, then each chunk its own choices. No task holds such a conversation.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator
from functools import cache, lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidegate.llm.store import stored

#: What a conversation that is worked out in one task has at most.
MANY_ROWS, MANY_BYTES = 20_000, 16 << 20
#: Rows of a chunk of a larger one, and of a block whose choices are unrolled at once.
CHUNK_ROWS, BLOCK_ROWS = 50_000, 4_096
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
FAR = 1 << 60
#: States: nothing yet, after the system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
FINAL = {START: 0, ASSISTANT: 0}
#: The state after a row whose role has this initial, by the state before.
STEP = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
#: The state after a row whose role is free to choose (an insertion, a new role).
FREE = {START: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}
ROLE = {USER: "user", ASSISTANT: "assistant"}
LEGAL = ("su", "ua", "au")
GONE, WHOLE, CUT = "x", "w", "t"


# the dynamic program


def _times(a: tuple, b: tuple) -> tuple:
    return tuple(tuple(min(a[i][k] + b[k][j] for k in STATES) for j in STATES) for i in STATES)


def _ahead(matrix: tuple, costs: tuple) -> tuple:
    """Costs to go before the rows of ``matrix``, given those behind them."""
    return tuple(min(matrix[q][r] + costs[r] for r in STATES) for q in STATES)


@cache
def _insertions() -> tuple:
    one = tuple(tuple(0 if i == j else INSERT if FREE[i] == j else FAR for j in STATES) for i in STATES)
    return _times(one, one)


def costs_at_end() -> tuple:
    return _ahead(_insertions(), tuple(FINAL.get(q, FAR) for q in STATES))


@cache
def _power(symbol: str, k: int) -> tuple:
    """Matrix of 2**k rows of ``symbol``, insertions before each included."""
    if k:
        return _times(_power(symbol, k - 1), _power(symbol, k - 1))
    initial, kind = symbol
    row = [[DELETE if i == j else FAR for j in STATES] for i in STATES]
    if kind != GONE:
        more = TRUNCATED if kind == CUT else 0
        for moves, cost in ((STEP.get(initial, {}), 0), (FREE, REROLE)):
            for i, j in moves.items():
                row[i][j] = min(row[i][j], cost + more)
    return _times(_insertions(), tuple(map(tuple, row)))


def _run_ahead(symbol: str, n: int, costs: tuple) -> tuple:
    for k in range(n.bit_length()):
        if n >> k & 1:
            costs = _ahead(_power(symbol, k), costs)
    return costs


def run_matrix(runs: list[tuple[str, int]]) -> tuple:
    """The matrix of a whole list of runs."""
    out = tuple(tuple(0 if i == j else FAR for j in STATES) for i in STATES)
    for symbol, n in runs:
        for k in range(n.bit_length()):
            if n >> k & 1:
                out = _times(out, _power(symbol, k))
    return out


def choices(runs: list[tuple[str, int]], end: tuple, state: int, last: bool) -> Iterator[str]:
    """For each row what is done before and with it (such as D, K, IK), ending with what is inserted behind all.

    Of the cheapest sequences of edits the least in ASCII: at each place the first of D, I, K, R that keeps the cost to
    go. ``end`` are the costs to go behind the rows, ``state`` is the one before; the last string, for rows that others
    follow (not ``last``), is empty. The state behind the rows is given as its ``StopIteration`` value.
    """
    borders = [end]
    for symbol, n in reversed(runs):
        borders.append(_run_ahead(symbol, n, borders[-1]))
    borders.reverse()
    for (symbol, n), behind in zip(runs, borders[1:]):
        initial, kind = symbol
        more, moves = TRUNCATED if kind == CUT else 0, STEP.get(initial, {}) if kind != GONE else {}
        for done in range(0, n, BLOCK_ROWS):
            size = min(BLOCK_ROWS, n - done)
            to_go = [_run_ahead(symbol, n - done - size, behind)]
            for _ in range(size):
                to_go.append(_ahead(_power(symbol, 0), to_go[-1]))
            for here, there in itertools.pairwise(reversed(to_go)):
                edits = ""
                while True:
                    left = here[state]
                    if DELETE + there[state] == left:
                        edits += "D"
                    elif INSERT + here[FREE[state]] == left:
                        edits, state = edits + "I", FREE[state]
                        continue
                    elif state in moves and more + there[moves[state]] == left:
                        edits, state = edits + "K", moves[state]
                    else:
                        edits, state = edits + "R", FREE[state]
                    break
                yield edits
    edits = ""
    while last and state not in FINAL:
        edits, state = edits + "I", FREE[state]
    yield edits
    return state


def _placed(edits: Iterator[str], rows: Iterator[tuple], state: int) -> Iterator[tuple[str, str | None, object]]:
    """(edit, role, row) of each edit: the role is None for a deleted row, the row None for an inserted one."""
    for done, row in itertools.zip_longest(edits, rows):
        for edit in done:
            if edit == "D":
                yield edit, None, row
            elif edit == "K":
                state = STEP[row[0][:1]][state]
                yield edit, row[0], row
            else:
                state = FREE[state]
                yield edit, ROLE[state], row if edit == "R" else None


@lru_cache(1 << 16)
def _short(symbols: tuple[str, ...]) -> tuple[tuple[str, ...], int]:
    """Choices and cost of a whole conversation; most are short and like others."""
    runs = [(symbol, sum(1 for _ in group)) for symbol, group in itertools.groupby(symbols)]
    cost = costs_at_end()
    for symbol, n in reversed(runs):
        cost = _run_ahead(symbol, n, cost)
    return tuple(choices(runs, costs_at_end(), START, True)), cost[START]


# rows


def _key(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(" "))


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, times: rows with planted faults by crc32(``conv_id:turn``) % 20.

    0 drops the row (``times`` is 0), 1 empties its text, 2 removes ``[.!?]`` from it, 3 repeats it (``times`` is 2), 4 makes
    its role user. Null roles and texts are one space, as are null ids and turns in the checked string.
    """
    kind = F.crc32(F.concat(_key(F.col("conv_id")), F.lit(":"), _key(F.col("turn"))).cast("binary")) % 20
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    return conversations.select(
        "conv_id", "turn", kind.alias("kind"), F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
    ).select("conv_id", "turn", "role", "text", F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1).alias("times"))


def _kind(text: Column) -> Column:
    """How a text ends: GONE if blank, else CUT or WHOLE. Only the last character that is no white space counts."""
    last = F.substring(F.rtrim(text, F.lit("\x20\x09\x0a\x0b\x0c\x0d")), -1, 1)
    return F.when(last == "", GONE).when(last.isin(".", "!", "?"), WHOLE).otherwise(CUT)


def repairs(rows: DataFrame, many_rows: int = MANY_ROWS, many_bytes: int = MANY_BYTES, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """One row for each conversation of ``rows`` (conv_id, turn, role, text, times; none of the last three null).

    Columns conv_id, gaps, blank, duplicate, truncated, illegal, cost (long), audit, repaired_sha256. A row stands for
    ``times`` equal ones; a conversation with rows of 0 times only has zeros and the digest of nothing. Rows go by turn,
    nulls first; rows of one turn by role, then text. A null conv_id is a conversation like any other. The audit of a
    conversation is one value, which bounds its edits to 2**31. Extra columns are not looked at; no rows, no result.
    """
    small, large, many = _by_size(rows, many_rows, many_bytes)
    return _whole(small) if many is None else _whole(small).unionByName(_reports(many, large, chunk_rows))


def repaired_turns(rows: DataFrame, many_rows: int = MANY_ROWS, many_bytes: int = MANY_BYTES, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """The repaired conversations: conv_id, place (increasing within a conversation), edit (I, K or R), role, text."""
    small, large, many = _by_size(rows, many_rows, many_bytes)
    if many is None:
        return _whole(small, turns=True)
    ordered, done, _, _ = _in_chunks(many, chunk_rows)
    written = ordered.join(done.drop("audit", "no", "chunk"), "at").select(
        "no", "at", F.posexplode(F.concat(
            F.transform("before", lambda r: F.struct(F.lit("I").alias("edit"), r.alias("role"), F.lit("").alias("text"))),
            F.array_compact(F.array(F.when(F.col("own").isNotNull(), F.struct(F.when(F.col("own") == F.col("role"), "K").otherwise("R").alias("edit"), F.col("own").alias("role"), F.col("text").alias("text"))))),
            F.transform("behind", lambda r: F.struct(F.lit("I").alias("edit"), r.alias("role"), F.lit("").alias("text"))),
        )).alias("k", "line"),
    )
    return _whole(small, turns=True).unionByName(written.join(large, "no").select("conv_id", (F.col("at") * 8 + F.col("k")).alias("place"), "line.*"))


def _by_size(rows: DataFrame, many_rows: int, many_bytes: int) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """Rows of ordinary conversations; the larger conversations with a number ``no``, and their rows."""
    sizes = rows.groupBy("conv_id").agg(F.sum("times").alias("n"), F.sum((F.octet_length("text") + 50) * F.col("times")).alias("bytes"))
    large = stored(sizes.filter((F.col("n") > many_rows) | (F.col("bytes") > many_bytes)).select("conv_id", F.monotonically_increasing_id().alias("no")), "repair-large")
    if large.isEmpty():
        return rows, None, None
    same = rows["conv_id"].eqNullSafe(large["conv_id"])
    return rows.join(large, same, "leftanti"), large, rows.filter("times > 0").join(large, same).drop(large["conv_id"])


RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
TURN = "place long, edit string, role string, text string"


def _whole(rows: DataFrame, turns: bool = False) -> DataFrame:
    """Conversations of bounded size, each in one task, as they follow each other in a sorted partition."""
    kind, id_type = dict(rows.dtypes)["conv_id"], to_arrow_type(rows.schema["conv_id"].dataType)
    names = TURN if turns else RESULT
    types = {"long": pa.int64(), "string": pa.string()}
    schema = pa.schema([("conv_id", id_type), *((c, types[t]) for c, t in (x.split() for x in names.split(", ")))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        light = ("conv_id", "turn", "role", "times", "kind")
        given = (row for b in batches for row in zip(*(b.column(c).to_pylist() for c in light), (t.as_py() for t in b.column("text"))))
        out = []
        for conv_id, group in itertools.groupby(given, key=lambda r: r[0]):
            report, lines = _repaired([r[1:] for r in group])
            if turns:
                out += [(conv_id, place, *line) for place, line in enumerate(lines)]
            else:
                digest = hashlib.sha256("\n".join(f"{role}:{text}" for _, role, text in lines).encode())
                out.append((conv_id, *report, digest.hexdigest()))
            if len(out) >= 1_000:
                yield _batch(out, schema)
                out = []
        if out:
            yield _batch(out, schema)

    text = F.when(F.col("times") > 0, F.col("text")).otherwise("")
    dealt = rows.select("conv_id", "turn", "role", "times", _kind(F.col("text")).alias("kind"), text.alias("text"))
    dealt = dealt.repartition("conv_id").sortWithinPartitions(F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "text")
    return dealt.mapInArrow(run, f"conv_id {kind}, {names}")


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _repaired(given: list[tuple]) -> tuple[tuple, Iterator[tuple[str, str, str]]]:
    """Report and lines (edit, role, text) of one conversation: rows turn, role, times, kind, text in order."""
    rows, symbols, seen, turns = [], [], set(), set()
    blank = duplicate = truncated = 0
    for turn, role, times, kind, text in given:
        for _ in range(times):
            again = (role, text) in seen
            seen.add((role, text))
            turns.add(turn)
            blank += kind == GONE
            duplicate += again and kind != GONE
            truncated += not again and kind == CUT
            initial = role[:1]
            symbols.append((initial if initial in STEP else "o") + (GONE if again else kind))
            rows.append((role, text))
    illegal = sum(a[0][:1] + b[0][:1] not in LEGAL for a, b in itertools.pairwise(rows))
    turns.discard(None)
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    edits, cost = _short(tuple(symbols)) if len(symbols) <= 64 else _short.__wrapped__(tuple(symbols))
    lines = ((edit, role, row[1] if row else "") for edit, role, row in _placed(iter(edits), iter(rows), START) if role is not None)
    return (gaps, blank, duplicate, truncated, illegal, cost, "".join(edits)), lines


# large conversations


def _in_chunks(rows: DataFrame, chunk_rows: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Items in order, what is done with each, summaries of chunks, and their goals; ``rows`` have the number ``no``."""
    items = rows.groupBy("no", "turn", "role", "text").agg(F.sum("times").alias("n"))
    items = items.withColumns({"kind": _kind(F.col("text")), "digest": F.sha2("text", 256)})
    items = stored(items, "repair-items")  # equal rows are one item
    turn = F.struct(F.col("turn").isNotNull(), F.col("turn"))
    first = items.groupBy("no", "role", "digest").agg(F.min(turn).alias("first"))
    known = items.join(first, ["no", "role", "digest"]).withColumn("again", turn != F.col("first"))
    parts = max(1, -(-items.count() // chunk_rows))
    ordered = known.repartitionByRange(parts, "no", F.asc_nulls_first("turn"), "role", F.substring("text", 1, 256))
    ordered = ordered.sortWithinPartitions("no", F.asc_nulls_first("turn"), "role", "text")
    ordered = ordered.select("no", "turn", "role", "text", "n", "kind", "again", F.spark_partition_id().alias("chunk"), F.monotonically_increasing_id().alias("at"))
    ordered = stored(ordered, "repair-ordered")
    light = ordered.select("no", "chunk", "at", "n", "kind", "again", "role")

    chunks = stored(light.groupBy("no", "chunk").applyInPandas(_summary, "no long, chunk int, matrix array<long>, first string, last string, blank long, duplicate long, truncated long, illegal long"), "repair-chunks")
    goals = chunks.select("no", "chunk", "matrix").groupBy("no").applyInPandas(_to_go, "no long, chunk int, last boolean, to_go array<long>, cost long")
    goals = stored(goals, "repair-goals")

    def ends(key, chunk: pd.DataFrame, goal: pd.DataFrame) -> pd.DataFrame:
        runs, to_go, last = _runs(_sorted(chunk)), tuple(map(int, goal["to_go"][0])), bool(goal["last"][0])
        return pd.DataFrame({"no": [key[0]], "chunk": [key[1]], "ends": [[_end(runs, to_go, q, last) for q in STATES]]})

    def decided(key, chunk: pd.DataFrame, goal: pd.DataFrame) -> pd.DataFrame:
        chunk = _sorted(chunk)
        return _decided(chunk, tuple(map(int, goal["to_go"][0])), int(goal["state"][0]), bool(goal["last"][0]))

    passed = light.groupBy("no", "chunk").cogroup(goals.groupBy("no", "chunk")).applyInPandas(ends, "no long, chunk int, ends array<int>")
    states = passed.groupBy("no").applyInPandas(_states, "no long, chunk int, state int")
    goals = stored(goals.join(states, ["no", "chunk"]), "repair-states")
    done = light.groupBy("no", "chunk").cogroup(goals.groupBy("no", "chunk")).applyInPandas(decided, "no long, chunk int, at long, audit string, before array<string>, own string, behind array<string>")
    return ordered, stored(done, "repair-choices"), chunks, goals


def _reports(rows: DataFrame, large: DataFrame, chunk_rows: int) -> DataFrame:
    """The result for conversations of any size."""
    ordered, done, chunks, goals = _in_chunks(rows, chunk_rows)
    borders = chunks.groupBy("no").agg(F.sort_array(F.collect_list(F.struct("chunk", "first", "last"))).alias("c"), *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")))
    between = F.expr("aggregate(sequence(1, size(c)), 0L, (a, i) -> a + if(i < size(c) and concat(c[i - 1].last, get(c, i).first) not in ('su', 'ua', 'au'), 1L, 0L))")
    faults = borders.withColumn("illegal", F.col("illegal") + between).drop("c")
    gaps = ordered.groupBy("no").agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"))
    costs = goals.groupBy("no").agg(F.min_by("cost", "chunk").alias("cost"))
    pieces = done.filter("audit is not null").groupBy("no").agg(F.sort_array(F.collect_list(F.struct("chunk", "audit"))).alias("p"))
    audits = pieces.select("no", F.array_join(F.col("p.audit"), "").alias("audit"))
    lines = ordered.join(done.filter("size(before) > 0 or own is not null or size(behind) > 0").drop("audit", "no", "chunk"), "at")
    result = large.join(gaps, "no").join(faults, "no").join(costs, "no").join(audits, "no").join(_digests(lines), "no", "left")
    return result.select("conv_id", *COUNTS, "audit", F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def _sorted(chunk: pd.DataFrame) -> pd.DataFrame:
    return chunk.sort_values("at", ignore_index=True)


def _symbols(chunk: pd.DataFrame) -> Iterator[tuple[str, int]]:
    """Symbol and number of the rows of each item: of equal rows only the first can stay."""
    for role, kind, again, n in zip(chunk["role"], chunk["kind"], chunk["again"], chunk["n"]):
        initial = role[:1] if role[:1] in STEP else "o"
        if again or kind == GONE:
            yield "o" + GONE, n
        else:
            yield initial + kind, 1
            if n > 1:
                yield "o" + GONE, n - 1


def _runs(chunk: pd.DataFrame) -> list[tuple[str, int]]:
    return [(symbol, int(sum(n for _, n in group))) for symbol, group in itertools.groupby(_symbols(chunk), key=lambda s: s[0])]


def _summary(chunk: pd.DataFrame) -> pd.DataFrame:
    chunk = _sorted(chunk)
    initials = chunk["role"].str[:1].fillna("")
    blank = chunk["kind"] == GONE
    illegal = int((chunk["n"] - 1).sum()) + sum(a + b not in LEGAL for a, b in itertools.pairwise(initials))
    return pd.DataFrame(
        {
            "no": chunk["no"][:1], "chunk": chunk["chunk"][:1], "matrix": [[min(x, FAR) for row in run_matrix(_runs(chunk)) for x in row]],
            "first": initials.iloc[:1], "last": [initials.iloc[-1]], "blank": [chunk["n"][blank].sum()],
            "duplicate": [(chunk["n"] - 1 + chunk["again"])[~blank].sum()], "truncated": [((chunk["kind"] == CUT) & ~chunk["again"]).sum()], "illegal": [illegal],
        }
    )


def _to_go(chunks: pd.DataFrame) -> pd.DataFrame:
    """Costs to go behind each chunk, from the last one on; and before it, from the start."""
    chunks = chunks.sort_values("chunk", ascending=False, ignore_index=True)
    to_go, out = costs_at_end(), []
    for flat in chunks["matrix"]:
        before = _ahead(tuple(tuple(map(int, flat[i * 4 : i * 4 + 4])) for i in STATES), to_go)
        out.append((list(to_go), before[START]))
        to_go = before
    return pd.DataFrame({"no": chunks["no"], "chunk": chunks["chunk"], "last": chunks.index == 0, "to_go": [x[0] for x in out], "cost": [x[1] for x in out]})


def _end(runs: list[tuple[str, int]], to_go: tuple, state: int, last: bool) -> int:
    walk = choices(runs, to_go, state, last)
    while True:
        try:
            next(walk)
        except StopIteration as end:
            return end.value


def _states(chunks: pd.DataFrame) -> pd.DataFrame:
    """The state before each chunk."""
    chunks = chunks.sort_values("chunk", ignore_index=True)
    ends = itertools.accumulate(chunks["ends"], lambda state, ends: int(ends[state]), initial=START)
    return pd.DataFrame({"no": chunks["no"], "chunk": chunks["chunk"], "state": list(ends)[: len(chunks)]})


def _decided(chunk: pd.DataFrame, to_go: tuple, state: int, last: bool) -> pd.DataFrame:
    """The roles that each item writes: inserted ones before it, its own, and, at the end, behind it. One row has the audit."""
    walk, audit, out = choices(_runs(chunk), to_go, state, last), [], []
    for role, n in zip(chunk["role"], chunk["n"]):
        before, own = [], None
        edits = list(itertools.islice(walk, int(n)))
        audit += edits
        for edit in itertools.chain.from_iterable(e for e in edits if e != "D"):
            if edit == "K":
                state, own = STEP[role[:1]][state], role
            elif edit != "D":
                state = FREE[state]
                if edit == "R":
                    own = ROLE[state]
                else:
                    before.append(ROLE[state])
        out.append((before, own, []))
    for edit in (tail := next(walk)):
        state = FREE[state]
        out[-1][2].append(ROLE[state])
    texts = [None] * (len(chunk) - 1) + ["".join(audit) + tail]
    return pd.DataFrame({"no": chunk["no"], "chunk": chunk["chunk"], "at": chunk["at"], "audit": texts, "before": [x[0] for x in out], "own": [x[1] for x in out], "behind": [x[2] for x in out]})


def _digests(lines: DataFrame) -> DataFrame:
    """no, repaired_sha256. A digest of one text is made in order: its lines stream through one task, none is kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        for batch in batches:
            before, behind = batch.column("before").to_pylist(), batch.column("behind").to_pylist()
            for i, (no, own) in enumerate(zip(batch.column("no").to_pylist(), batch.column("own").to_pylist())):
                said = [f"{role}:" for role in before[i]]
                if own is not None:
                    said.append(f"{own}:{batch.column('text')[i].as_py()}")
                said += [f"{role}:" for role in behind[i]]
                if no != now:
                    if digest:
                        yield pa.RecordBatch.from_pydict({"no": [now], "repaired_sha256": [digest.hexdigest()]})
                    now, digest = no, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update("\n".join(said).encode())
        if digest:
            yield pa.RecordBatch.from_pydict({"no": [now], "repaired_sha256": [digest.hexdigest()]})

    dealt = lines.select("no", "at", "before", "own", "behind", F.when(F.col("own").isNotNull(), F.col("text")).alias("text"))
    return dealt.repartition("no").sortWithinPartitions("no", "at").mapInArrow(run, "no long, repaired_sha256 string")


ORACLE_SQL = r"""
with recursive conv as (
    select row_number() over () as no, conv_id from (select distinct conv_id from conversations)
), hashed as (
    select no, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
        coalesce(cast(c.conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ') as k
    from conversations c join conv on c.conv_id is not distinct from conv.conv_id
), kinds as (
    select no, turn, role, text, xor(4294967295, list_reduce(
        list_concat([4294967295::bigint], list_transform(string_split(k, ''), lambda x: cast(ascii(x) as bigint))),
        lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], [0::bigint, 0, 0, 0, 0, 0, 0, 0]), lambda x, bit: xor(x >> 1, 3988292384 * (x & 1)))
    )) % 20 as kind
    from hashed
), damage as (
    select no, turn, case when kind = 4 then 'user' else role end as role,
        case when kind = 1 then '' when kind = 2 then translate(text, '.!?', '') else text end as text, copy
    from kinds, unnest(range(case when kind = 0 then 0 when kind = 3 then 2 else 1 end)) as t(copy)
), entry as (
    select no, turn, role, text, left(role, 1) as initial,
        row_number() over (partition by no order by turn nulls first, role, text, copy) as pos,
        not regexp_matches(text, '[^\x20\x09-\x0D]') as blank,
        not regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') as cut
    from damage
), repeat as (
    select *, row_number() over (partition by no, role, text order by pos) > 1 as again from entry
), fault as (
    select *, blank or again as gone, case when cut then 3 else 0 end as more,
        lag(initial) over (partition by no order by pos) || initial as pair
    from repeat
), counted as (
    select no, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
        count(*) filter (where blank) as blank, count(*) filter (where again and not blank) as duplicate,
        count(*) filter (where cut and not again and not blank) as truncated,
        count(*) filter (where pair not in ('su', 'ua', 'au')) as illegal, max(pos) as n
    from fault group by no
), step as (
    select no, 0::bigint as pos, {'c': 0, 'a': ''} as s0, {'c': 1000000000, 'a': ''} as s1, {'c': 1000000000, 'a': ''} as s2, {'c': 1000000000, 'a': ''} as s3
    from conv
    union all
    select no, pos,
        {'c': t0.c + 4, 'a': t0.a || 'D'},
        list_sort([{'c': t1.c + 4, 'a': t1.a || 'D'}, {'c': t0.c + case when gone or initial <> 's' then 1000000000 else more end, 'a': t0.a || 'K'}])[1],
        list_sort(list_concat([{'c': t2.c + 4, 'a': t2.a || 'D'}], flatten(list_transform([t0, t1, t3], lambda t: [
            {'c': t.c + case when gone or initial <> 'u' then 1000000000 else more end, 'a': t.a || 'K'},
            {'c': t.c + case when gone then 1000000000 else 3 + more end, 'a': t.a || 'R'}]))))[1],
        list_sort([{'c': t3.c + 4, 'a': t3.a || 'D'},
            {'c': t2.c + case when gone or initial <> 'a' then 1000000000 else more end, 'a': t2.a || 'K'},
            {'c': t2.c + case when gone then 1000000000 else 3 + more end, 'a': t2.a || 'R'}])[1]
    from (
        select no, f.pos, gone, initial, more, s0 as t0, s1 as t1, u2 as t2, list_sort([s3, {'c': u2.c + 3, 'a': u2.a || 'I'}])[1] as t3
        from (
            select *, list_sort(list_concat([s2], list_transform([s0, s1, s3], lambda s: {'c': s.c + 3, 'a': s.a || 'I'})))[1] as u2 from step
        ) s join fault f using (no) where f.pos = s.pos + 1
    )
), best as (
    select no, list_sort([s0, s3, {'c': s2.c + 3, 'a': s2.a || 'I'}, {'c': s1.c + 6, 'a': s1.a || 'II'}])[1] as best
    from step join counted using (no) where pos = n
), edit as (
    select no, i, best.a[i] as edit from best, unnest(range(1, len(best.a) + 1)) as t(i)
), placed as (
    select no, i, edit, count(*) filter (where edit <> 'I') over w as pos, count(*) filter (where edit <> 'D') over w as place
    from edit window w as (partition by no order by i)
), written as (
    select p.no, i, edit, role, text, place, bool_or(place = 1 and edit = 'K' and initial = 's') over (partition by p.no) as system
    from placed p left join fault f on f.no = p.no and f.pos = p.pos and edit in ('K', 'R') where edit <> 'D'
), line as (
    select no, i, case when edit = 'K' then role when (place - cast(system as integer)) % 2 = 1 then 'user' else 'assistant' end
        || ':' || case when edit = 'I' then '' else text end as line
    from written
), digest as (
    select no, sha256(string_agg(line, chr(10) order by i)) as repaired_sha256 from line group by no
)
select conv_id, cast(coalesce(gaps, 0) as bigint) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
    coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, cast(coalesce(best.c, 0) as bigint) as cost, coalesce(best.a, '') as audit,
    coalesce(repaired_sha256, sha256('')) as repaired_sha256
from conv left join counted using (no) left join best using (no) left join digest using (no)
"""
