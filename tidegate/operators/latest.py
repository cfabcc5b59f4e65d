"""Latest state per key."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, functions as F

from tidegate.operators.lookup import fits_broadcast


def latest_per_key(rows: DataFrame, keys: Sequence[str], version: Sequence[str]) -> DataFrame:
    """The row of each key with the highest version; versions of a key must be distinct.

    ``max_by`` reduces within each task before the shuffle, so a key that holds a large share of
    all rows reaches its reducer as one row per task. A window with ``row_number`` would send and
    sort all of them there.
    """
    rest = [c for c in rows.columns if c not in keys]
    newest = rows.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), F.struct(*version)).alias("_newest")
    )
    return newest.select(*(c if c in keys else F.col(f"_newest.{c}").alias(c) for c in rows.columns))


def upserted(
    previous: DataFrame | None,
    changes: DataFrame,
    keys: Sequence[str],
    version: Sequence[str],
) -> DataFrame:
    """State after ``changes``; older versions in the changes lose, so replays change nothing.

    Keys are not NULL and unique in ``previous``. If the changed keys fit a broadcast, rows of the
    state that they do not touch stay where they are and only the touched ones are shuffled.
    """
    if previous is None:
        return latest_per_key(changes, keys, version)
    touched = changes.select(*keys).distinct()
    if not fits_broadcast(touched):
        return latest_per_key(previous.unionByName(changes), keys, version)
    touched = F.broadcast(touched)
    untouched = previous.join(touched, list(keys), "left_anti")
    before = previous.join(touched, list(keys), "left_semi")
    return untouched.unionByName(latest_per_key(before.unionByName(changes), keys, version))


def live(state: DataFrame, deleted: str = "deleted") -> DataFrame:
    """State without the keys whose last change was a delete."""
    return state.filter(~F.coalesce(F.col(deleted), F.lit(False)))
