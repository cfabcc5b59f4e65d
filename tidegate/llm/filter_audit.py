"""Audit of how quality filters interact: what each of them removes in every order of application.

Four filters look at a text alone. The fifth is exact duplication, found by compressed radix tries: every task of the
scan inserts its texts into local tries, whose terminals hold the least id, so that of the copies in a task one goes
on. These are range-partitioned by adaptive text prefixes, longer where many texts begin alike, and meet in one trie per
range. What remains of a document is a mask of failed filters; masks are counted, and the orders worked out from counts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidegate.llm.store import stored

FILTERS = "ABCDE"
MIN_WORDS, DISTINCT_PERCENT, UPPER_PERCENT = 50, 65, 5
_UPPER, _SIGNS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"#$%&*|"
DUPLICATE = 16
#: Bytes of distinct text that a trie holds before it is emptied, where that may be.
TRIE_BYTES = 16 << 20
#: Bytes of the first prefixes, how many times longer the next ones are, and the bytes of texts that may begin alike at most.
FIRST_PREFIX, LONGER, ALIKE_BYTES = 8, 8, 64 << 20
#: At the most so many prefixes are lengthened; their hashes are broadcast.
MOST_ALIKE = 1_000_000


def mask(text: bytes, chars: int) -> int:
    """Bits of the filters A to D that a text fails."""
    words = text.split()  # bytes split at \x20 and \x09-\x0d
    upper, signs = len(text) - len(text.translate(None, _UPPER)), len(text) - len(text.translate(None, _SIGNS))
    return (
        (len(words) < MIN_WORDS)
        | (100 * len(set(words)) < DISTINCT_PERCENT * len(words)) << 1
        | (100 * upper > UPPER_PERCENT * chars) << 2
        | (signs > 0) << 3
    )


def _before(a, b) -> bool:
    """Whether id ``a`` is smaller than ``b``; null is the largest."""
    return a is not None and (b is None or a < b)


class _Node:
    __slots__ = ("edge", "children", "least", "rows")

    def __init__(self, edge: bytes):
        self.edge, self.children, self.least, self.rows = edge, {}, None, None


class Trie:
    """A compressed trie of whole texts. A terminal holds the least id of its text and the rows that ended there."""

    def __init__(self):
        self.root, self.held = _Node(b""), 0

    def _terminal(self, text: bytes) -> _Node:
        node, at = self.root, 0
        while at < len(text):
            child = node.children.get(text[at])
            if child is None:
                node.children[text[at]] = child = _Node(text[at:])
                self.held += len(child.edge) + 200
                return child
            if not text.startswith(child.edge, at):
                same = _common(child.edge, text, at)
                middle = _Node(child.edge[:same])
                child.edge = child.edge[same:]
                middle.children[child.edge[0]] = child
                node.children[text[at]] = child = middle
            node, at = child, at + len(child.edge)
        return node

    def insert(self, text: bytes, doc_id, row) -> None:
        node = self._terminal(text)
        if node.rows is None:
            node.rows, node.least = [], doc_id
        elif _before(doc_id, node.least):
            node.least = doc_id
        node.rows.append((doc_id, row))
        self.held += 100

    def flagged(self) -> Iterator[tuple[object, object, bool, bytes]]:
        """Id, row, whether a smaller id has the text, and the text, for all that was inserted."""
        todo = [(self.root, b"")]
        while todo:
            node, text = todo.pop()
            text += node.edge
            todo.extend((child, text) for child in node.children.values())
            for doc_id, row in node.rows or ():
                yield doc_id, row, _before(node.least, doc_id), text


def _common(edge: bytes, text: bytes, at: int) -> int:
    """Bytes that ``edge`` and ``text`` from ``at`` on share."""
    low, high = 0, min(len(edge), len(text) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if edge[low:middle] == text[at + low : at + middle]:
            low = middle
        else:
            high = middle - 1
    return low


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Record batches of some 8 MB of text at most."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[-1] or b"") + 50
        if size > 8 << 20:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _local(trie: Trie) -> Iterator[tuple]:
    """Rows doc_id, source, mask, n, text. Copies of a smaller id are done and have no text; rows of one id go as one."""
    done, going = Counter(), Counter()
    for doc_id, (source, bits), copy, text in trie.flagged():
        if copy:
            done[doc_id, source, bits | DUPLICATE] += 1
        else:
            going[doc_id, source, bits, text] += 1
    for (doc_id, source, bits), n in done.items():
        yield doc_id, source, bits, n, None
    for (doc_id, source, bits, text), n in going.items():
        yield doc_id, source, bits, n, text


def _scanned(docs: DataFrame) -> DataFrame:
    """doc_id, source, mask, n, text of all rows of ``docs`` (doc_id, source, text); only rows that go on have text."""
    kind, id_type = docs.dtypes[0][1], to_arrow_type(docs.schema["doc_id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            trie = Trie()
            for batch in batches:
                ids, sources = batch.column("doc_id").to_pylist(), batch.column("source").to_pylist()
                for doc_id, source, chars, text in zip(ids, sources, batch.column("chars").to_pylist(), batch.column("text")):
                    text = text.as_py()
                    trie.insert(text, doc_id, (source, mask(text, chars)))
                    if trie.held > TRIE_BYTES:
                        yield from _local(trie)
                        trie = Trie()
            yield from _local(trie)

        yield from _batches(rows(), pa.schema([("doc_id", id_type), ("source", pa.string()), ("mask", pa.int32()), ("n", pa.int64()), ("text", pa.binary())]))

    text = F.coalesce("text", F.lit(""))
    given = docs.select("doc_id", "source", F.char_length(text).alias("chars"), text.cast("binary").alias("text"))
    return given.mapInArrow(run, f"doc_id {kind}, source string, mask int, n long, text binary")


def _prefixed(rows: DataFrame) -> DataFrame:
    """Add ``key``, a prefix of ``text`` by which ranges are cut; longer as long as too many bytes of texts share it.

    These are as many as a range has on the average, or ``ALIKE_BYTES``. Equal texts have equal keys. Only hashes of prefixes that are lengthened are broadcast, ``MOST_ALIKE`` at most, as
    each stands for that share of all bytes or more.
    """
    total, longest = rows.agg(F.sum(F.octet_length("text")), F.max(F.octet_length("text"))).first()
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    alike = max(min(ALIKE_BYTES, (total or 0) // ranges), (total or 0) // MOST_ALIKE)
    width = FIRST_PREFIX
    rows = rows.withColumn("key", F.substring("text", 1, width))
    while width < (longest or 0):
        crowded = rows.groupBy("key").agg(F.sum(F.octet_length("text")).alias("bytes")).filter((F.col("bytes") > alike) & (F.octet_length("key") == width))
        crowded = stored(crowded.select(F.xxhash64("key").alias("crowd")).distinct(), "audit-prefixes")
        if crowded.isEmpty():
            break
        width *= LONGER
        rows = rows.withColumn("key_hash", F.xxhash64("key")).join(F.broadcast(crowded), F.col("key_hash") == F.col("crowd"), "left")
        rows = rows.withColumn("key", F.when(F.col("crowd").isNotNull(), F.substring("text", 1, width)).otherwise(F.col("key"))).drop("key_hash", "crowd")
    return rows


def _met(rows: DataFrame) -> DataFrame:
    """doc_id, source, mask, n of the rows that went on, with E. A trie is emptied between two keys only."""
    kind, id_type = rows.select("doc_id").dtypes[0][1], to_arrow_type(rows.schema["doc_id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flags(trie: Trie) -> Iterator[tuple]:
            for doc_id, (source, bits, n), copy, _ in trie.flagged():
                yield doc_id, source, bits | DUPLICATE * copy, n, None

        def found() -> Iterator[tuple]:
            trie, last = Trie(), None
            for batch in batches:
                columns = (batch.column(c).to_pylist() for c in ("doc_id", "source", "mask", "n"))
                for doc_id, source, bits, n, key, text in zip(*columns, batch.column("key"), batch.column("text")):
                    key = key.as_py()
                    if trie.held > TRIE_BYTES and key != last:
                        yield from flags(trie)
                        trie = Trie()
                    trie.insert(text.as_py(), doc_id, (source, bits, n))
                    last = key
            yield from flags(trie)

        for batch in _batches(found(), pa.schema([("doc_id", id_type), ("source", pa.string()), ("mask", pa.int32()), ("n", pa.int64()), ("text", pa.binary())])):
            yield batch.drop_columns(["text"])

    dealt = _prefixed(rows).repartitionByRange("key").sortWithinPartitions("key")
    return dealt.mapInArrow(run, f"doc_id {kind}, source string, mask int, n long")


def masks(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """doc_id, source, mask, n: rows of ``docs`` counted by id, source and the bits of the filters that they fail.

    Bit i stands for letter i of ``FILTERS``. A null text is empty; E is failed by a text that a row of a smaller id has
    too, a null id being larger than all others; rows of one id and text do not fail E by each other. The rows of a text
    that go on to its range are one for each task of the scan at most, however many copies it has.
    """
    given = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"), F.col(text).alias("text"))
    local = stored(_scanned(given), "audit-local")
    return local.filter("text is null").drop("text").unionByName(_met(local.filter("text is not null")))


def audit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row for each source, order of the filters and step.

    Columns part (the source; null as ''), filter_order, step, and as long kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley. ``labels`` (doc_id, quality, toxic) may have several rows for an id, of which one
    with the value is enough; rows without label or id are in neither count. Equal rows of ``docs`` count each. Other
    columns are not looked at. Without documents the result is empty.
    """
    marks = labels.filter("doc_id is not null").groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("long")).alias("good"), F.max((F.col("toxic") == 1).cast("long")).alias("toxic")
    )
    counted = masks(docs, doc_id, text, source).groupBy("doc_id", "source", "mask").agg(F.sum("n").alias("n"))
    known = counted.filter("doc_id is not null").join(marks, "doc_id", "left")
    unknown = counted.filter("doc_id is null").selectExpr("*", "null as good", "null as toxic")
    by_mask = known.unionByName(unknown).groupBy("source", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("good"), F.sum(F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic")
    )
    parts = by_mask.groupBy(F.col("source").alias("part")).agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))  # 32 at most
    steps = parts.select("part", "masks", F.expr(f"inline(array({', '.join(_steps())})) as (filter_order, step, earlier, bit)"))

    def total(value: str) -> str:
        return f"aggregate(masks, 0L, (a, x) -> a + {value})"

    return steps.selectExpr(
        "part", "filter_order", "step",
        total("if(x.mask & (earlier | bit) = 0, x.n, 0L)") + " as kept",
        total("if(x.mask & earlier = 0 and x.mask & bit != 0, x.n, 0L)") + " as removed",
        total("if(x.mask & earlier != 0 and x.mask & bit != 0, x.n, 0L)") + " as redundant",
        total("if(x.mask = bit, x.n, 0L)") + " as unique_fails",
        total("if(x.mask & earlier = 0 and x.mask & bit != 0, x.good, 0L)") + " as good_lost",
        total("if(x.mask & earlier = 0 and x.mask & bit != 0, x.toxic, 0L)") + " as toxic_lost",
        # of the orders of all filters, a filter is the first of those that a document fails in their like share
        total("if(x.mask & bit != 0, x.n * (120 div bit_count(x.mask)), 0L)") + " as shapley",
    )


def _steps() -> Iterator[str]:
    """Order, step, bits of the earlier filters and bit of the step's filter, for all orders and steps."""
    for order in permutations(FILTERS):
        bits = [1 << FILTERS.index(letter) for letter in order]
        for step in range(len(order)):
            yield f"struct('{''.join(order)}', {step + 1}, {sum(bits[:step])}, {bits[step]})"


ORACLE_SQL = r"""
with doc as (
    select row_number() over () as rid, doc_id, coalesce(source, '') as part, coalesce(text, '') as text,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words
    from documents
), failed as (
    select doc_id, part,
        unnest(['A', 'B', 'C', 'D', 'E']) as filter,
        unnest([
            len(words) < 50,
            100 * len(list_distinct(words)) < 65 * len(words),
            100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text),
            regexp_matches(text, '[#$%&*|]'),
            coalesce(min(doc_id) over (partition by text) < coalesce(doc_id, 9223372036854775807), false)
        ]) as fails,
        rid
    from doc
), letter as (
    select unnest(['A', 'B', 'C', 'D', 'E']) as l
), orders as (
    select a.l || b.l || c.l || d.l || e.l as filter_order
    from letter a, letter b, letter c, letter d, letter e
    where len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5
), label as (
    select doc_id, max(cast(quality = 1 as integer)) as good, max(cast(toxic = 1 as integer)) as toxic from labels group by doc_id
), document as (
    select rid, doc_id, part, string_agg(filter, '' order by filter) filter (where fails) as fails from failed group by rid, doc_id, part
), marked as (
    select part, coalesce(fails, '') as fails, count(*) as n, sum(coalesce(good, 0)) as good, sum(coalesce(toxic, 0)) as toxic
    from document left join label using (doc_id) group by all
), step as (
    select part, filter_order, s as step, substr(filter_order, s, 1) as filter, fails, n, good, toxic,
        list_min(list_transform(string_split(nullif(fails, ''), ''), lambda f: strpos(filter_order, f))) as gone
    from marked, orders, unnest(range(1, 6)) as t(s)
), count as (
    select part, filter_order, cast(step as integer) as step, filter,
        cast(sum(case when gone is null or gone > step then n else 0 end) as bigint) as kept,
        cast(sum(case when gone = step then n else 0 end) as bigint) as removed,
        cast(sum(case when gone < step and contains(fails, filter) then n else 0 end) as bigint) as redundant,
        cast(sum(case when fails = filter then n else 0 end) as bigint) as unique_fails,
        cast(sum(case when gone = step then good else 0 end) as bigint) as good_lost,
        cast(sum(case when gone = step then toxic else 0 end) as bigint) as toxic_lost
    from step group by all
)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    cast(sum(removed) over (partition by part, filter) as bigint) as shapley
from count
"""
