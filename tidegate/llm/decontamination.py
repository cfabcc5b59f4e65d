"""Benchmark decontamination: a hash set of the benchmark's word windows meets the windows of all documents.

A window is ``WINDOW`` consecutive words of a benchmark item, or a shorter item as a whole. The set of their hashes is
broadcast if its measured size allows it. Not every place of a document is hashed: each window has an anchor, its
rarest word within the benchmark, and only the windows around anchor words are looked up. Hits are verified word by
word. A set beyond the limit meets the windows of all places in a shuffled join. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidegate.llm.store import stored
from tidegate.operators.computed import with_computed

WINDOW = 10
#: Bytes of the set of windows and their items, as counted, up to which it is broadcast.
SET_BYTES = 32 << 20
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_BREAK_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Lower-cased words (A-Z only): runs of ASCII letters, digits and all characters beyond ASCII. Null has none."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    lowered = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))
    return F.array_remove(F.split(F.coalesce(lowered, F.lit("")), _BREAK), "")


def benchmark_windows(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """Distinct windows (gram, words, hash, anchor, offset, size), and the items of each (gram, item).

    The empty window is one of them, as number -1; it belongs to no item.
    """
    items = with_computed(benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(text).alias("text")), words=words(F.col("text")))
    whole = F.size("words") < window
    starts = F.when(F.size("words") == 0, F.array()).when(whole, F.array(F.lit(1))).otherwise(F.sequence(F.lit(1), F.size("words") - window + 1))
    cut = items.select("item", F.col("words").alias("all"), F.explode(starts).alias("start"))
    cut = stored(cut.select("item", F.slice("all", F.col("start"), F.lit(window)).alias("words")), "benchmark-windows")
    counts = cut.select(F.explode("words").alias("word")).groupBy("word").count()
    distinct = stored(cut.select("words").distinct().withColumn("gram", F.monotonically_increasing_id()), "benchmark-grams")
    placed = distinct.select("gram", F.size("words").alias("size"), F.posexplode("words").alias("offset", "word")).join(counts, "word")
    rarest = F.struct("count", (-F.char_length("word")).alias("short"), "word", "offset")
    anchors = placed.groupBy("gram", "size").agg(F.min(rarest).alias("rarest")).select("gram", "size", F.col("rarest.word").alias("anchor"), "rarest.offset")
    empty = cut.sparkSession.range(1).select(
        F.lit(-1).cast("long").alias("gram"), F.array().cast("array<string>").alias("words"), F.lit(0).alias("size"), F.lit("").alias("anchor"), F.lit(0).alias("offset")
    )
    grams = distinct.join(anchors, "gram").unionByName(empty).withColumn("hash", F.xxhash64("words"))
    pairs = cut.filter("item is not null").distinct().join(distinct, "words").select("gram", "item")
    return stored(grams, "benchmark-set"), stored(pairs, "benchmark-items")


def _bytes(grams: DataFrame, pairs: DataFrame) -> int:
    of_grams = grams.agg(F.sum(64 + F.octet_length(F.array_join("words", "")) + 16 * F.size("words"))).first()[0]
    return of_grams + (pairs.agg(F.sum(64 + F.octet_length("item"))).first()[0] or 0)


def _around_anchors(rows: DataFrame, grams: DataFrame) -> DataFrame:
    """Verified hits of all documents in one pass; both lookups are broadcast."""
    anchors = grams.groupBy(F.xxhash64("anchor").alias("word_hash")).agg(F.collect_set(F.struct("offset", "size")).alias("places"))
    places = rows.select("rid", "doc_id", "words", F.posexplode("words").alias("at", "word")).withColumn("word_hash", F.xxhash64("word"))
    places = places.join(F.broadcast(anchors), "word_hash").select("rid", "doc_id", "words", "at", F.inline("places"))
    inside = places.withColumn("start", F.col("at") - F.col("offset")).filter("start >= 0 and start + size < size(words)")
    window = F.slice("words", F.col("start") + 1, F.col("size"))
    seen = inside.withColumn("hash", F.xxhash64(window))
    found = seen.join(F.broadcast(grams.select("hash", "gram", F.col("words").alias("gram_words"))), "hash").filter(window == F.col("gram_words"))
    return found.select("rid", "doc_id", (F.size("words") - 1).alias("n_words"), "start", (F.col("start") + F.col("size")).alias("end"), "gram")


def _everywhere(rows: DataFrame, grams: DataFrame) -> DataFrame:
    """Verified hits of all documents when the set is too large to be broadcast.

    Only numbers and hashes of windows are shuffled to the set; documents meet their few hits again by row number. Hot
    windows are large partitions of a join, which adaptive execution splits.
    """
    rows = stored(rows, "decontamination-words")
    sizes = [r[0] for r in grams.select("size").distinct().collect()]  # WINDOW + 1 values at most
    places = rows.select("rid", "words", F.explode(F.sequence(F.lit(0), F.size("words") - 1)).alias("start"))
    places = places.select("rid", "words", "start", F.explode(F.array(*map(F.lit, sizes))).alias("size"))
    places = places.filter("if(size = 0, start = size(words) - 1, start + size < size(words))")
    hashed = places.select("rid", "start", F.xxhash64(F.slice("words", F.col("start") + 1, F.col("size"))).alias("hash"))
    hits = stored(hashed.join(grams.select("hash", "gram", "size", F.col("words").alias("gram_words")).hint("merge"), "hash"), "decontamination-hits")
    met = rows.join(hits.hint("merge"), "rid").filter(F.slice("words", F.col("start") + 1, F.col("size")) == F.col("gram_words"))
    return met.select("rid", "doc_id", (F.size("words") - 1).alias("n_words"), "start", (F.col("start") + F.col("size")).alias("end"), "gram")


def _found(rows: DataFrame, benchmark: DataFrame, window: int, set_bytes: int, item_id: str) -> DataFrame:
    """rid, doc_id, n_words, spans (sorted), items (sorted strings) for each of ``rows`` (rid, doc_id, text)."""
    grams, pairs = benchmark_windows(benchmark, item_id=item_id, window=window)
    small = _bytes(grams, pairs) <= set_bytes
    ended = with_computed(rows, words=F.concat(words(F.col("text")), F.array(F.lit(""))))  # the empty window is at the end
    ended = ended.select("rid", "doc_id", "words")
    hits = stored(_around_anchors(ended, grams) if small else _everywhere(ended, grams), "decontamination-found")
    named = hits.filter("gram >= 0").join(F.broadcast(pairs) if small else pairs, "gram", "left")
    rest = hits.filter("gram < 0").withColumn("item", F.lit(None).cast("string"))
    span = F.when(F.col("gram") >= 0, F.struct("start", "end"))
    return (
        named.unionByName(rest)
        .groupBy("rid", "doc_id", "n_words")
        .agg(F.sort_array(F.collect_set(span)).alias("spans"), F.sort_array(F.collect_set("item")).alias("items"))
    )


def contamination(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", window: int = WINDOW, set_bytes: int = SET_BYTES
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    A word is hit if it lies in any occurrence of a window of ``benchmark``. Null and empty texts have no words and are
    clean; items without words have no window. Items are told apart by ``item_id``, compared and sorted as strings; an
    item without id marks words, but is not listed or counted. Equal rows each give a row. Other columns are not looked
    at. Without documents the result is empty, without items all are clean.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    found = _found(rows, benchmark, window, set_bytes, item_id)
    n_hit = F.expr("aggregate(spans, named_struct('n', 0L, 'upto', 0), (a, s) -> named_struct('n', a.n + greatest(s.end - greatest(s.start, a.upto), 0), 'upto', greatest(a.upto, s.end)), a -> a.n)")
    return found.select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", text: str = "text", item_id: str = "item_id", window: int = WINDOW, set_bytes: int = SET_BYTES) -> DataFrame:
    """``docs``, all columns, without contaminated rows, or (``remove="spans"``) with the hit words cut out of ``text``.

    With a stretch of hit words goes what stands between them; what stands before and after it stays.
    """
    if remove not in ("documents", "spans"):
        raise ValueError("remove is 'documents' or 'spans'")
    packed = docs.select(F.monotonically_increasing_id().alias("rid"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    packed = stored(packed, "decontamination-rows")
    rows = packed.select("rid", F.lit(None).cast("long").alias("doc_id"), F.col(f"row.`{text}`").alias("text"))
    hit = stored(_found(rows, benchmark, window, set_bytes, item_id).filter("size(spans) > 0").select("rid", "spans"), "decontamination-hit")
    clean = packed.join(hit, "rid", "leftanti").select("row.*")
    if remove == "documents":
        return clean
    dirty = with_computed(packed.join(hit, "rid"), text_left=_without(F.col(f"row.`{text}`")))
    cut = dirty.select(*(F.col("text_left").alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in docs.columns))
    return clean.unionByName(cut)


def _without(text: Column) -> Column:
    """``text`` without the words of ``spans``. Tokens are each word and what follows it."""
    merged = F.expr(
        "aggregate(spans, cast(array() as array<struct<start: int, end: int>>), (m, s) -> case when size(m) > 0 and element_at(m, -1).end >= s.start"
        " then concat(slice(m, 1, size(m) - 1), array(named_struct('start', element_at(m, -1).start, 'end', greatest(element_at(m, -1).end, s.end))))"
        " else concat(m, array(named_struct('start', s.start, 'end', s.end))) end)"
    )
    between = F.split(text, _WORD_ANY_CASE)
    pairs = F.arrays_zip(F.array_remove(F.split(text, _BREAK_ANY_CASE), "").alias("w"), F.slice(between, F.lit(2), F.size(between)).alias("s"))
    tokens = F.flatten(F.transform(pairs, lambda p: F.array(p["w"], p["s"])))

    def kept(k: Column, spans: Column, tokens: Column) -> Column:
        start = F.when(k == 0, 0).otherwise(2 * F.get(spans, k - 1)["end"] - 1)
        end = F.when(k == F.size(spans), F.size(tokens)).otherwise(2 * F.get(spans, k)["start"])
        return F.slice(tokens, start + 1, F.greatest(end - start, F.lit(0)))

    # one element each, so that lambdas refer to the arrays instead of repeating what makes them
    parts = F.transform(F.array(F.struct(merged.alias("m"), tokens.alias("t"))), lambda x: F.transform(F.sequence(F.lit(0), F.size(x["m"])), lambda k: kept(k, x["m"], x["t"])))
    return F.concat(F.get(between, F.lit(0)), F.array_join(F.flatten(F.flatten(parts)), ""))


ORACLE_SQL = r"""
with item as (
    select item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
    from benchmark
), gram as (
    select distinct item_id, list_slice(words, i, least(i + 9, len(words))) as gram
    from item, unnest(range(1, greatest(len(words) - 9, least(len(words), 1)) + 1)) as t(i)
), size as (
    select distinct len(gram) as n from gram
), doc as (
    select row_number() over () as rid, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
    from documents
), place as (
    select rid, i, n, list_slice(words, i, i + n - 1) as gram
    from doc, size, unnest(range(1, greatest(len(words) - n + 2, 1))) as t(i)
), hit as (
    select rid, i, n, item_id from place join gram using (gram)
), word as (
    select rid, count(distinct i + k) as n_hit from hit, unnest(range(n)) as t(k) group by rid
), named as (
    select rid, list_sort(list(distinct cast(item_id as varchar))) as items from hit where item_id is not null group by rid
)
select doc_id, cast(len(words) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, cast(coalesce(len(items), 0) as bigint) as n_items,
    sha256(coalesce(array_to_string(items, ','), '')) as items_sha256, n_hit is not null as contaminated
from doc left join word using (rid) left join named using (rid)
"""
