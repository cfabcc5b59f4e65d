"""What enrichment derives from dimension tables, kept beside the versions that it comes from.

A batch that finds the versions of the batch before starts no job to join, measure or decode dimensions. One that finds
a new version derives anew only what comes from that table: parameters and their decoder from the parameter and field
tables, seas from theirs. Users are read as they are. The sizes, and by them the plan, belong to all versions together.
A new process finds what the one before has stored.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass, field, replace
from typing import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from tidegate.operators import decode as D
from tidegate.operators.lookup import BROADCAST_LIMIT_CONF
from tidegate.plans.clue_enrichment import ClueDimensions, LookupPlan
from tidegate.sinks.manifests import drop_folder, filesystem, names, read_json, write_json

#: The dimension tables that each derived table comes from.
PARAMS, SEAS, DECODER = ("params", "fields"), ("seas",), ("params", "fields")
SCHEMAS = {
    "params": "tenant string, field_key string, param_id string, display string",
    "seas": "id string, name string",
    "decoder": "tenant string, decoder map<string, map<string, variant>>",
}
#: Derived tables of this many versions stay, for batches that still read them.
KEPT = 3


@dataclass
class DerivedDimensions:
    """``versions`` tells the version of params, fields, seas and users without a job; ``open_tables`` opens them."""

    spark: SparkSession
    path: str
    versions: Callable[[], Mapping[str, int]]
    open_tables: Callable[[], ClueDimensions]
    _known: tuple[Mapping[str, int], ClueDimensions] | None = field(default=None, repr=False)

    def current(self) -> ClueDimensions:
        """The dimensions as they are now, with decoder and plan."""
        versions = dict(self.versions())
        if self._known is None or self._known[0] != versions:
            self._known = versions, self._derived(versions)
        return self._known[1]

    def _derived(self, versions: Mapping[str, int]) -> ClueDimensions:
        dims = self.open_tables()
        dims = replace(dims, params=self._stored("params", PARAMS, versions, lambda: dims.params))
        dims = replace(dims, seas=self._stored("seas", SEAS, versions, lambda: dims.seas))
        plan = self._plan(dims, versions)
        if plan.params == "maps":
            dims = replace(dims, decoder=self._stored("decoder", DECODER, versions, lambda: D.decode_maps(dims.params)))
        return replace(dims, plan=plan)

    def _stored(self, name: str, sources: tuple[str, ...], versions: Mapping[str, int], make: Callable[[], DataFrame]) -> DataFrame:
        folder = f"{self.path}/{name}"
        place = f"{folder}/{_of(versions, sources)}"
        fs, done = filesystem(self.spark, f"{place}/_SUCCESS")
        if not fs.exists(done):
            make().write.mode("overwrite").parquet(place)
            self._drop_older(folder)
        return self.spark.read.schema(SCHEMAS[name]).parquet(place)

    def _plan(self, dims: ClueDimensions, versions: Mapping[str, int]) -> LookupPlan:
        """From one aggregation over the dimensions, once for these versions and this limit of a broadcast."""
        limit = self.spark.conf.get(BROADCAST_LIMIT_CONF, "")
        folder = f"{self.path}/plans"
        place = f"{folder}/{_of(versions, sorted(versions))}{'-' + limit if limit else ''}.json"
        fs, done = filesystem(self.spark, place)
        if fs.exists(done):
            return LookupPlan(**read_json(self.spark, place))
        plan = LookupPlan.measured(dims)
        write_json(self.spark, place, asdict(plan))
        self._drop_older(folder)
        return plan

    def _drop_older(self, folder: str) -> None:
        """Versions only grow, and names are in their order."""
        for name in names(self.spark, folder)[:-KEPT]:
            drop_folder(self.spark, f"{folder}/{name}")


def _of(versions: Mapping[str, int], sources) -> str:
    return "-".join(f"{versions[source] + 1:012d}" for source in sources)
