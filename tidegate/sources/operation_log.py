"""The operation log as a stream source of its own: files per shard, read on from a cursor per shard.

An offset of the stream is the ``ts`` behind which each shard goes on. A read of a shard takes the next ``rows`` entries in
order of ``ts`` and all of the same ``ts`` as the last one, so that no ``ts`` is cut. Planning looks at the statistics of
row groups, and at the ``ts`` of those groups only that can hold the next entries; the entries are read by the executors,
each task some row groups.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from typing import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pa_fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from tidegate import fixed_values as V
from tidegate.functions import payload as P
from tidegate.operators import oplog as O

FORMAT = "operation_log"
COLUMNS = ("ts", "ns", "op", "o", "o2")
SCHEMA = "ts bigint, ns string, op string, o string, o2 string, shard string"
#: Compressed bytes of row groups that one task reads.
TASK_BYTES = 64 * 1024 * 1024
#: ``rows`` of a read that takes all there is, as a query that ends does in its one batch.
EVERY_ROW = 1 << 62
_SHARD = "shard="


@dataclass(frozen=True)
class _Group:
    """A row group with entries of ``low`` to ``high``."""

    file: str
    number: int
    low: int
    high: int
    rows: int
    bytes: int


@dataclass
class LogPart(InputPartition):
    """Row groups of one shard, of which the entries behind ``after`` up to ``upto`` are read."""

    shard: str
    groups: list[tuple[str, int]]
    after: int
    upto: int

    def __init__(self, shard: str, groups: list[tuple[str, int]], after: int, upto: int):
        super().__init__((shard, after, upto))
        self.shard, self.groups, self.after, self.upto = shard, groups, after, upto


class OperationLogReader(DataSourceStreamReader):
    def __init__(self, options):
        self.path, self.rows = options["path"], int(options.get("rows", V.OPLOG_READ_ROWS))
        self.saved = {shard: int(ts) for shard, ts in json.loads(options.get("cursors", "{}")).items()}
        self.at: dict[str, int] = {}
        self.known: dict[str, list[_Group]] = {}

    # planning, on the driver

    def _files(self) -> Iterator[tuple[str, str]]:
        files, root = pa_fs.FileSystem.from_uri(self.path) if "://" in self.path or self.path.startswith("file:") else (pa_fs.LocalFileSystem(), self.path)
        for found in files.get_file_info(pa_fs.FileSelector(root, recursive=True, allow_not_found=True)):
            parts = found.path[len(root.rstrip("/")) + 1 :].split("/")
            if found.is_file and len(parts) > 1 and parts[0].startswith(_SHARD) and parts[-1].endswith(".parquet") and parts[-1][0] not in "._":
                yield parts[0].removeprefix(_SHARD), found.path

    def _shards(self) -> dict[str, list[_Group]]:
        """Row groups of each shard; a file's footer is read once, as files are not changed."""
        shards: dict[str, list[_Group]] = {}
        for shard, file in self._files():
            if file not in self.known:
                with pq.ParquetFile(file, filesystem=_filesystem(self.path)) as opened:
                    self.known[file] = list(_groups(file, opened))
            shards.setdefault(shard, []).extend(self.known[file])
        return shards

    def _begin(self, shard: str, groups: list[_Group]) -> int:
        """Behind the saved cursor, else behind the first entry."""
        return self.saved.get(shard, min((g.low for g in groups), default=0))

    def initialOffset(self) -> dict:
        """Spark asks for it after the first ``latestOffset``, so what that one has planned does not count."""
        return {**self.saved, **{shard: self._begin(shard, groups) for shard, groups in self._shards().items()}}

    def latestOffset(self) -> dict:
        for shard, groups in self._shards().items():
            self.at[shard] = self._next(groups, self.at.get(shard, self._begin(shard, groups)))
        return {**self.saved, **self.at}

    def _next(self, groups: list[_Group], after: int) -> int:
        """The ``ts`` of the ``rows``-th entry behind ``after``, or of the last one."""
        left = sorted((g for g in groups if g.high > after), key=lambda g: g.low)
        if sum(g.rows for g in left) < self.rows:
            return max((g.high for g in left), default=after)
        taken, n = [], 0
        while left:
            while left and n < self.rows:
                taken.append(left.pop(0))
                n += taken[-1].rows
            upto = max(g.high for g in taken)
            while left and left[0].low <= upto:  # others may hold entries in between
                taken.append(left.pop(0))
            times = np.concatenate([_times(self.path, g, after, upto) for g in taken])
            if len(times) >= self.rows:
                return int(np.partition(times, self.rows - 1)[self.rows - 1])
            n = len(times)
        return max((g.high for g in taken), default=after)

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        parts: list[LogPart] = []
        for shard, groups in self._shards().items():
            upto = end.get(shard)
            after = start.get(shard, self._begin(shard, groups))
            if upto is None or upto == after:
                continue
            if upto < after:
                raise ValueError(f"shard {shard}: the read up to {upto} lies before {after}, which was read already")
            held, size = [], 0
            for group in sorted((g for g in groups if g.high > after and g.low <= upto), key=lambda g: g.low):
                held.append((group.file, group.number))
                size += group.bytes
                if size >= TASK_BYTES:
                    parts.append(LogPart(shard, held, after, upto))
                    held, size = [], 0
            if held:
                parts.append(LogPart(shard, held, after, upto))
        for shard, upto in end.items():  # a restart plans the last batch again, and so tells where the checkpoint is
            self.at[shard] = max(self.at.get(shard, upto), upto)
        return parts

    # reading, on the executors

    def read(self, partition: LogPart) -> Iterator[pa.RecordBatch]:
        for file, number in partition.groups:
            with pq.ParquetFile(file, filesystem=_filesystem(self.path)) as opened:
                for batch in opened.iter_batches(row_groups=[number], columns=list(COLUMNS)):
                    ts = batch.column("ts")
                    batch = batch.filter(pc.and_(pc.greater(ts, partition.after), pc.less_equal(ts, partition.upto)))
                    if batch.num_rows:
                        columns = [pc.cast(batch.column(c), pa.int64() if c == "ts" else pa.string()) for c in COLUMNS]
                        yield pa.RecordBatch.from_arrays([*columns, pa.array([partition.shard] * batch.num_rows)], [*COLUMNS, "shard"])


def _filesystem(path: str):
    return pa_fs.FileSystem.from_uri(path)[0] if "://" in path or path.startswith("file:") else pa_fs.LocalFileSystem()


def _groups(file: str, opened: pq.ParquetFile) -> Iterator[_Group]:
    at = opened.schema_arrow.get_field_index("ts")
    for number in range(opened.num_row_groups):
        group = opened.metadata.row_group(number)
        if not group.num_rows:
            continue
        stats = group.column(at).statistics
        if stats is not None and stats.has_min_max:
            low, high = stats.min, stats.max
        else:
            bounds = pc.min_max(opened.read_row_group(number, columns=["ts"]).column("ts")).as_py()
            low, high = bounds["min"], bounds["max"]
        if low is not None:
            yield _Group(file, number, low, high, group.num_rows, group.total_byte_size)


def _times(path: str, group: _Group, after: int, upto: int) -> np.ndarray:
    with pq.ParquetFile(group.file, filesystem=_filesystem(path)) as opened:
        times = opened.read_row_group(group.number, columns=["ts"]).column("ts").drop_null().to_numpy()
    return times[(times > after) & (times <= upto)]


class OperationLogSource(DataSource):
    """Options: ``path``, ``rows`` of a read of a shard, ``cursors`` as JSON of shard to ts."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return OperationLogReader(self.options)


def oplog_stream(spark: SparkSession, path: str, saved: DataFrame | None = None, rows: int = V.OPLOG_READ_ROWS) -> DataFrame:
    """Entries ``ts, ns, op, o, o2, shard`` as a stream, with parsed payloads, a bounded read of each shard per batch.

    ``path`` has a folder ``shard=<name>`` of Parquet files for each shard. Files appear whole, in order of ``ts`` on the
    whole; entries without ``ts``, and those that come later than greater ones were read, are not read. A query without
    checkpoint begins behind the ``saved`` cursors (shard, cursor_ts), a shard without one behind its first entry.
    ``saved`` is small, a row per shard. A query with a checkpoint goes on where that says, whatever the cursors are.
    """
    cursors = {row["shard"]: row["cursor_ts"] for row in saved.select("shard", "cursor_ts").collect()} if saved is not None else {}
    spark.dataSource.register(OperationLogSource)
    stream = spark.readStream.format(FORMAT).option("path", path).option("rows", rows).option("cursors", json.dumps(cursors)).load()
    return stream.withColumns({c: P.parse_object(F.col(c)) for c in ("o", "o2")})


def next_entries(log: DataFrame, saved: DataFrame | None, rows: int = V.OPLOG_READ_ROWS) -> DataFrame:
    """What one batch of ``oplog_stream`` reads, from a log in a table: the bounded read of each shard behind its cursor."""
    return O.bounded_read(O.after_cursor(log, O.start_cursor(log, saved, ["shard"]), ["shard"]), rows, ["shard"])
