"""Mixing sources to target weights by pivotal dependent rounding.

Each unit (rows that agree in id, source and size) should be taken ``target / size of its source`` times. The
whole part of that number is certain; the fraction is rounded. Two open units of a source meet: words move
from one to the other, in a random direction with odds that keep both expectations, until one of them is at
none or all of its words. That one is settled, the other goes on to the next meeting. The words of a source
are thus kept to within the unit that is open at the end. Large units meet first, so that this one is mostly small.

Meetings run within blocks of some ``FAN_IN`` units. Each block leaves one open unit; these meet in blocks of
the next level, until one is left per source. All of it is DataFrame work: blocks are groups, a block's meetings
one fold over its array.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidegate.llm.store import stored

FAN_IN = 64
WORD = r"[^\x20\x09-\x0D]+"
_UNIT = ["doc_id", "source", "size"]

_OPEN_TYPE = "struct<unit:struct<doc_id:{id},source:string,size:bigint>,mass:double,weight:double>"
_DONE_TYPE = "struct<unit:struct<doc_id:{id},source:string,size:bigint>,up:boolean>"

#: One meeting of the open unit ``s.open`` with the next unit ``x``. ``m.up``: words go from x to the open unit.
_MEETING = """
aggregate(items, named_struct('open', cast(null as {open}), 'done', cast(array() as array<{done}>)), (s, x) ->
  case when s.open is null then named_struct('open', x, 'done', s.done) else
  transform(array(named_struct(
      'room', s.open.weight - s.open.mass,
      'x_room', x.weight - x.mass,
      'up', {uniform} * (least(s.open.weight - s.open.mass, x.mass) + least(s.open.mass, x.weight - x.mass))
            < least(s.open.mass, x.weight - x.mass))),
    m -> case
      when m.up and x.mass <= m.room then named_struct(
        'open', named_struct('unit', s.open.unit, 'mass', s.open.mass + x.mass, 'weight', s.open.weight),
        'done', array_append(s.done, named_struct('unit', x.unit, 'up', false)))
      when m.up then named_struct(
        'open', named_struct('unit', x.unit, 'mass', x.mass - m.room, 'weight', x.weight),
        'done', array_append(s.done, named_struct('unit', s.open.unit, 'up', true)))
      when s.open.mass <= m.x_room then named_struct(
        'open', named_struct('unit', x.unit, 'mass', x.mass + s.open.mass, 'weight', x.weight),
        'done', array_append(s.done, named_struct('unit', s.open.unit, 'up', false)))
      else named_struct(
        'open', named_struct('unit', s.open.unit, 'mass', s.open.mass - m.x_room, 'weight', s.open.weight),
        'done', array_append(s.done, named_struct('unit', x.unit, 'up', true)))
    end)[0] end)
"""


def word_count(text: Column) -> Column:
    """Number of words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(*parts: str) -> str:
    """SQL of a number in [0, 1) that depends on the given SQL values alone."""
    return f"(shiftrightunsigned(xxhash64({', '.join(parts)}), 11) / 9007199254740992D)"


def source_targets(sizes: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """Targets per source: columns source, n, source_size, target.

    ``sizes`` has source and size. Sources in code point order, null last, get the ``weights`` in turn. They
    share ``share`` times all words by weight; no target is above ``most`` times the source's words, and what
    is above is shared anew among the others, until none is above. Sources are numbered within ranges, so no
    task holds them all; the sharing rounds are sums of one row.
    """
    sources = sizes.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("source_size"))
    spark = sources.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = stored(
        sources.repartitionByRange(parts, F.col("source").isNull(), F.col("source")).withColumn("part", F.spark_partition_id()),
        "mix-sources",
    )
    before = ranged.groupBy("part").agg(F.count("*").alias("rows")).selectExpr(
        "part", "coalesce(sum(rows) over (order by part rows between unbounded preceding and 1 preceding), 0) as before"
    )
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = ranged.join(before, "part").selectExpr(
        "source", "n", "source_size", "before + row_number() over (partition by part order by source is null, source) - 1 as place"
    )
    ranked = ranked.withColumn("weight", F.element_at(cycle, (F.col("place") % len(weights) + 1).cast("int")))
    ranked = stored(ranked.withColumn("most", F.col("source_size") * F.lit(float(most))), "mix-ranks")

    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, -1
    while True:  # words for each unit of weight; rises until no further source is at its most
        at_most = F.col("most") <= F.col("weight") * level
        row = ranked.agg(
            F.coalesce(F.sum(F.when(at_most, F.col("most"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~at_most, F.col("weight"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(at_most, 1)), F.lit(0)),
        ).first()
        if row[2] == capped or not row[1]:
            break
        capped, level = row[2], (share * total - row[0]) / row[1]
    target = F.least(F.col("most"), F.col("weight") * F.lit(level)) if total else F.lit(0.0)
    return ranked.select("source", "n", "source_size", target.alias("target"))


def _levels(items: DataFrame, n_max: int, seed: int) -> list[DataFrame]:
    """The reduction tree: for each level the settled units of its blocks."""
    id_type = dict(items.selectExpr("unit.doc_id as doc_id").dtypes)["doc_id"]
    fill = {"open": _OPEN_TYPE.format(id=id_type), "done": _DONE_TYPE.format(id=id_type)}
    settled, level, reach = [], 0, 1
    while True:
        reach *= FAN_IN
        last = reach >= n_max
        meeting = _MEETING.format(**fill, uniform=uniform("s.open.unit", "x.unit", str(seed), str(level)))
        blocks = (
            items.selectExpr(
                "unit.source as source", "n", f"pmod(xxhash64(unit, {seed}, {level}), cast(ceil(n / {reach}D) as bigint)) as block",
                f"struct(-weight as first, xxhash64(unit, {level}, {seed}) as h, struct(unit, mass, weight) as item) as drawn",
            )
            .groupBy("source", "n", "block")
            .agg(F.expr("transform(sort_array(collect_list(drawn)), d -> d.item)").alias("items"))
            .select("n", F.expr(meeting).alias("met"))
        )
        blocks = stored(blocks, "mix-level")
        settled.append(blocks.selectExpr("explode(met.done) as d").select("d.*"))
        if last:
            coin = uniform("met.open.unit", str(seed), "'last'")
            settled.append(blocks.selectExpr("met.open.unit as unit", f"{coin} * met.open.weight < met.open.mass as up"))
            return settled
        items, level = blocks.select("n", "met.open.*"), level + 1


def unit_copies(rows: DataFrame, weights: tuple[float, ...], share: float, most: float, seed: int) -> DataFrame:
    """Columns c_doc_id, c_source, c_size, source_size, target, copies: one row per unit of ``rows``."""
    targets = stored(source_targets(rows.select("source", "size"), weights, share, most), "mix-targets")
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    units = (
        rows.groupBy(*_UNIT)
        .agg(F.count("*").alias("rows"))
        .join(targets.withColumnRenamed("source", "of_source"), F.col("source").eqNullSafe(F.col("of_source")))
        .withColumn("each", each)
        .withColumn("base", F.floor("each"))
        .withColumn("weight", (F.col("size") * F.col("rows")).cast("double"))
        .withColumn("mass", F.col("weight") * (F.col("each") - F.col("base")))
        .select(*_UNIT, "n", "source_size", "target", "base", "weight", "mass")
    )
    units = stored(units, "mix-units")
    n_max = targets.agg(F.max("n")).first()[0] or 1
    items = units.filter("mass > 0 and mass < weight").select(F.struct(*_UNIT).alias("unit"), "mass", "weight", "n")
    settled = reduce(DataFrame.union, (s.select("unit", "up") for s in _levels(items, n_max, seed)))
    ups = settled.filter("up").select(*[F.col(f"unit.{c}").alias(f"u_{c}") for c in _UNIT], F.lit(1).cast("long").alias("up"))
    return units.join(ups, _same_unit("u_"), "left").select(
        *[F.col(c).alias(f"c_{c}") for c in _UNIT], "source_size", "target", (F.col("base") + F.coalesce("up", F.lit(0))).alias("copies")
    )


def _same_unit(prefix: str) -> Column:
    return reduce(Column.__and__, (F.col(c).eqNullSafe(F.col(f"{prefix}{c}")) for c in _UNIT))


def mixed(
    docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0, seed: int = 1
) -> DataFrame:
    """How often each document is taken: doc_id, source, size, source_size, target, copies.

    One row per row of ``docs``, of which doc_id, source (string) and text are read. The same rows and seed
    give the same copies. Rows that agree in id, source and size are one unit and get the same number of
    copies. Null ids and null sources are values like any other; a null text has size 0. Documents of size 0
    bear no words and are taken as often as the whole part says. No document is taken more than ``most`` times.
    An empty table gives an empty result.
    """
    rows = stored(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "mix-rows")
    copies = unit_copies(rows, weights, share, most, seed)
    return rows.join(copies, _same_unit("c_")).select(*_UNIT, "source_size", "target", "copies")


def mixed_documents(
    docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0, seed: int = 1, numbered: bool = False
) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with all columns of ``docs``.

    If asked for, also copy (from 1 within each row of ``docs``) and copies, which ``docs`` must not have.
    """
    packed = docs.select(
        "doc_id", "source", word_count(F.col("text")).alias("size"), F.struct(*[f"`{c}`" for c in docs.columns]).alias("row")
    )
    copies = unit_copies(stored(packed.select(*_UNIT), "mix-rows"), weights, share, most, seed).filter("copies > 0")
    taken = packed.join(copies, _same_unit("c_")).select("row", "copies", F.explode(F.expr("sequence(1L, copies)")).alias("copy"))
    return taken.select("row.*", *(("copy", "copies") if numbered else ()))
