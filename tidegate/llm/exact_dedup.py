"""Exact deduplication by distributed MSD radix partitioning.

A text is read as a string of digits, most significant first. The first digit is the byte length with the
first ``FIRST_DIGIT`` bytes; the following ones are longer and longer runs of bytes. Each round splits every
open group by its next digit. A group of one row is done; so is a group whose bytes are used up, and then its
texts are equal byte by byte. Only rows of open groups carry text into the next round.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidegate.llm.store import stored

FIRST_DIGIT = 64
SECOND_DIGIT = 4096
GROWTH = 16
WHITE_SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
CLASS_COLUMNS = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
_KEY = ["group", "n_bytes", "digit"]


def normalised(text: Column) -> Column:
    """The text without white space; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), WHITE_SPACE, "")


def _best(chars: Column, doc_id: Column) -> Column:
    """Orders the rows of a group: most code points first, then smallest id, null last."""
    return F.struct((-chars).alias("minus_chars"), doc_id.isNull().alias("no_id"), doc_id.alias("doc_id"))


def _split(rows: DataFrame, offset: int, width: int) -> DataFrame:
    """One round: rows with the id, size and best row of the group that the digit puts them in.

    The groups grow with the rows, so both sides are dealt by the digit at every size, and large partitions can
    be split.
    """
    cut = rows.withColumn("digit", F.substring("rest", 1, width)).withColumn("rest", F.expr(f"substring(rest, {width + 1})"))
    groups = (
        cut.groupBy(*_KEY)
        .agg(F.count("*").alias("group_size"), F.min(_best(F.col("chars"), F.col("doc_id"))).alias("best"))
        .filter("group_size > 1")
        .withColumn("next", F.monotonically_increasing_id())
    )
    groups = stored(groups, "radix-groups")
    joined = cut.join(groups.hint("merge"), _KEY, "left").drop("group", "digit")
    done = F.col("next").isNull() | (F.col("n_bytes") <= offset + width)
    return stored(
        joined.withColumn("done", done)
        .withColumn("rest", F.when(~done, F.col("rest")))
        .withColumn("rid", F.monotonically_increasing_id()),
        "radix-rows",
    )


def exact_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", carry: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical without white space. The row with the most code points in its original
    text stays, then the one with the smallest id; a null id comes last. Of rows that agree in all of this
    exactly one stays. A null text counts as empty, and all empty texts are one group. Other columns are not
    looked at; with ``carry`` they follow as the struct ``row``. An empty table gives an empty result.
    """
    clean = normalised(F.col(text))
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.char_length(text), F.lit(0)).alias("chars"),
        F.octet_length(clean).alias("n_bytes"),
        F.sha2(clean, 256).alias("text_sha256"),
        F.lit(0).cast("long").alias("group"),
        clean.cast("binary").alias("rest"),
        *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if carry else []),
    )
    keep = ["rid", "round", "doc_id", "chars", "text_sha256", "group_size", "best", "next", *(["row"] if carry else [])]
    finished, offset, width = [], 0, FIRST_DIGIT
    while True:
        split = _split(rows, offset, width)
        finished.append(split.filter("done").withColumn("round", F.lit(len(finished))).select(*keep))
        if split.filter("not done").isEmpty():
            break
        rows = split.filter("not done").withColumnRenamed("next", "group").drop("done", "rid", "group_size", "best")
        offset, width = offset + width, SECOND_DIGIT if width == FIRST_DIGIT else width * GROWTH
    return _with_kept(reduce(DataFrame.unionByName, finished))


def _with_kept(rows: DataFrame) -> DataFrame:
    """Mark the rows that stay. Only rows equal to the best of a larger group are looked at again."""
    extra = [c for c in rows.columns if c == "row"]
    best = (-F.col("chars") == F.col("best.minus_chars")) & F.col("doc_id").eqNullSafe(F.col("best.doc_id"))
    alone, grouped = rows.filter("group_size is null"), rows.filter("group_size is not null")
    first = (
        grouped.filter(best).groupBy("round", "next").agg(F.min("rid").alias("rid"), F.lit(True).alias("first")).drop("next")
    )
    candidates = grouped.filter(best).join(first, ["round", "rid"], "left").withColumn("kept", F.coalesce("first", F.lit(False)))
    parts = (
        alone.withColumns({"keep_id": F.col("doc_id"), "group_size": F.lit(1).cast("long"), "kept": F.lit(True)}),
        candidates.withColumn("keep_id", F.col("best.doc_id")),
        grouped.filter(~best).withColumns({"keep_id": F.col("best.doc_id"), "kept": F.lit(False)}),
    )
    return reduce(DataFrame.unionByName, (p.select(*CLASS_COLUMNS, *extra) for p in parts))


def drop_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without the copies, with all columns."""
    return exact_classes(docs, doc_id, text, carry=True).filter("kept").select("row.*")


ORACLE_SQL = r"""
with rows as (
    select doc_id, coalesce(length(text), 0) as chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as clean
    from documents
)
select doc_id,
    first_value(doc_id) over best as keep_id,
    count(*) over (partition by clean) as group_size,
    row_number() over best = 1 as kept,
    sha256(clean) as text_sha256
from rows
window best as (partition by clean order by chars desc, doc_id nulls last)
"""
