"""Entries of several shards in the order of their timestamps: a low watermark over the cursors of all shards.

A shard gives its entries in order and never cuts within a timestamp, so all that lies at or below the least cursor is
known. These entries are released; later ones are held on shared storage until the frontier passes them. An entry of a
document that has moved to another shard is therefore never released before an older one of the shard that it left.
"""

from __future__ import annotations

import time
from dataclasses import dataclass
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidegate.sinks.manifests import Manifests, drop_folder


@dataclass(frozen=True)
class Step:
    """What a batch releases, and the state that holds once that is published."""

    released: DataFrame
    number: int
    state: dict
    repeated: bool


@dataclass(frozen=True)
class Frontier:
    """The held entries and cursors of a log, below ``path``; one writer.

    ``shards`` are those that the log has; one that has given nothing yet holds everything back. Without
    ``quiet_seconds`` a shard without new entries does so for as long. With it, a shard whose cursor has stood still that long no longer
    counts, until it moves; what it gives then below the frontier is released at once, none is dropped.

    A batch is written once, as its own folder, and read again when the frontier has moved into it. Released are a batch's
    entries and the held ones between the frontiers before and after, so a repeated batch releases the same. Entries without a
    timestamp are released at once.
    """

    spark: SparkSession
    path: str
    shards: Sequence[str]
    quiet_seconds: float | None = None
    clock: Callable[[], float] = time.time

    @property
    def _states(self) -> Manifests:
        return Manifests(self.spark, f"{self.path}/states")

    def _folder(self, key: str) -> str:
        return f"{self.path}/held/batch={key}"

    def value(self) -> int | None:
        """The frontier: the greatest timestamp up to which all is released."""
        _, state = self._states.newest()
        return state["frontier"] if state else None

    def step(self, batch: DataFrame, key: str) -> Step:
        """Hold what lies behind the frontier that this batch leads to, and tell what it releases."""
        number, before = self._states.newest()
        repeated = before is not None and before["key"] == key
        if repeated:  # it was committed here, but not where the batch comes from
            after = before
            before = self._states.read(number - 1) if number else None
        else:
            number += 1
            after = self._moved(batch, key, before)
        old, new = before and before["frontier"], after["frontier"]
        later = _later(new)
        late, early = batch.filter(later), batch.filter(~later)
        if key in after["held"]:
            late.write.mode("overwrite").parquet(self._folder(key))
        due = [k for k, top in (before["held"] if before else {}).items() if k != key and _beyond(top, old)]
        if due and new is not None:
            held = self.spark.read.schema(batch.schema).parquet(*map(self._folder, due))
            early = early.unionByName(held.filter(_later(old) & ~later))
        return Step(early, number, after, repeated)

    def commit(self, step: Step) -> None:
        """The released entries are published. Folders that neither this state nor the one before needs go."""
        if step.repeated:
            return
        self._states.commit(step.number, step.state)
        before = self._states.read(step.number - 1) if step.number else {"held": {}, "frontier": None}
        for key in before["held"].keys() - step.state["held"].keys():
            drop_folder(self.spark, self._folder(key))
        for old in self._states.numbers()[:-2]:
            self._states.drop(old)

    def _moved(self, batch: DataFrame, key: str, before: dict | None) -> dict:
        """The state after a batch, of which one row per shard is looked at."""
        now = self.clock()
        cursors = dict(before["cursors"]) if before else {}
        moved = dict(before["moved"]) if before else {}
        tops = {row["shard"]: row["top"] for row in batch.groupBy("shard").agg(F.max("ts").alias("top")).collect()}
        for shard, top in tops.items():
            if shard is not None and top is not None and _beyond(top, cursors.get(shard)):
                cursors[shard], moved[shard] = top, now
        for shard in self.shards:
            moved.setdefault(shard, now)
        counted = [s for s in moved if self.quiet_seconds is None or moved[s] + self.quiet_seconds > now]
        known = [cursors.get(shard) for shard in counted] or list(cursors.values())
        old = before["frontier"] if before else None
        frontier = None if not known or None in known else (min(known) if counted else max(known))
        frontier = old if frontier is None or not _beyond(frontier, old) else frontier
        # The state before is what a repeated batch goes out from, so what it needs stays one state longer.
        held = {k: top for k, top in (before["held"] if before else {}).items() if _beyond(top, old)}
        top = max((t for t in tops.values() if t is not None), default=None)
        if top is not None and _beyond(top, frontier):
            held[key] = top
        return {"key": key, "cursors": cursors, "moved": moved, "frontier": frontier, "held": held}


def _beyond(ts: int, frontier: int | None) -> bool:
    return frontier is None or ts > frontier


def _later(frontier: int | None) -> Column:
    if frontier is None:
        return F.col("ts").isNotNull()
    return F.coalesce(F.col("ts") > frontier, F.lit(False))


def in_order(messages: DataFrame, by: Sequence[str] = ("ns", "doc_id")) -> DataFrame:
    """Messages of a document one after the other by ``ts``; one with very many goes over several tasks, in their order."""
    return messages.repartitionByRange(*by, "ts").sortWithinPartitions(*by, "ts")
