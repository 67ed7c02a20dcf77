"""A streaming source over exported tables whose offsets are the tenants' watermarks.

``readStream.format("tenant_changes")`` reads parquet files below ``<path>/tenant_id=<tenant>/``.
An offset is ``{tenant: microseconds}``, the newest version seen of each tenant; a batch holds
each tenant's rows above its old and up to its new watermark.  This is the incremental extract as
a stream: the watermark lives in the stream's checkpoint, and a batch that is replayed reads the
same interval again.  A tenant not seen before starts at the epoch.

The driver reads file footers only (or, in a file without statistics, the version column); rows
are read by tasks, a task per run of row groups that overlap the interval, in batches.  As with
every watermark, a row that is committed late with an older stamp is not seen; rows without a
version are never read.  When old files are removed, a tenant's watermark may fall back to what
is left; rows then read twice collapse by version.
"""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

from storelake.sources.catalog import TENANT, TableSpec

FORMAT = "tenant_changes"
ROWS_PER_TASK = 1_000_000
FOOTERS_AT_ONCE = 16
_STAMP = pa.timestamp("us", tz="UTC")
# How Spark names the folder of a null partition value.
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class _Group:
    number: int
    rows: int
    low: int
    high: int


@dataclass
class _Slice(InputPartition):
    """Row groups of one file, of which the rows in (since, upto] are wanted."""

    tenant: str
    file: str
    groups: list[int]
    since: int
    upto: int


def _micros(stamps: pa.Array | pa.ChunkedArray) -> pa.Array | pa.ChunkedArray:
    return stamps.cast(_STAMP, safe=False).cast(pa.int64())


def _opened(files: fs.FileSystem, path: str) -> pq.ParquetFile:
    return pq.ParquetFile(files.open_input_file(path), coerce_int96_timestamp_unit="us")


def _groups(files: fs.FileSystem, path: str, version: str) -> list[_Group]:
    """Row groups that hold a version, with its range."""
    with _opened(files, path) as file:
        paths = [file.schema.column(i).path for i in range(len(file.schema))]
        at = paths.index(version)
        found = []
        for number in range(file.num_row_groups):
            group = file.metadata.row_group(number)
            stats = group.column(at).statistics
            # The old 12-byte time stamps have statistics that cannot be read.
            if stats is not None and stats.physical_type == "INT64" and stats.has_min_max:
                ends = pa.array([stats.min, stats.max])
            else:
                stamps = file.read_row_group(number, [version])[version]
                span = pc.min_max(stamps).as_py()
                ends = pa.array([span["min"], span["max"]], stamps.type)
            low, high = _micros(ends).to_pylist()
            if high is not None:
                found.append(_Group(number, group.num_rows, low, high))
        return found


class ChangeReader(DataSourceStreamReader):
    def __init__(self, path: str, version: str, schema: T.StructType):
        self.path, self.version, self.schema = path, version, schema

    def _files(self) -> list[tuple[str, str]]:
        """(tenant, file) of all data files."""
        files, root = fs.FileSystem.from_uri(self.path)
        found = []
        for entry in files.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)):
            folders = entry.path[len(root) :].strip("/").split("/")
            tenant = folders[0].partition("=")
            hidden = any(f.startswith(("_", ".")) for f in folders)
            if entry.type == fs.FileType.File and entry.size and tenant[0] == TENANT and not hidden:
                found.append((unquote(tenant[2]), entry.path))
        return sorted(found)

    def _footers(self, wanted: list[tuple[str, str]]) -> list[tuple[str, str, list[_Group]]]:
        files, _ = fs.FileSystem.from_uri(self.path)
        with ThreadPoolExecutor(FOOTERS_AT_ONCE) as pool:
            groups = pool.map(lambda f: _groups(files, f[1], self.version), wanted)
            return [(*f, g) for f, g in zip(wanted, groups)]

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        newest: dict[str, int] = {}
        for tenant, _, groups in self._footers(self._files()):
            newest[tenant] = max([newest.get(tenant, 0), *(g.high for g in groups)])
        return newest

    def partitions(self, start: dict, end: dict) -> list[_Slice]:
        moved = {t: (start.get(t, 0), upto) for t, upto in end.items() if upto > start.get(t, 0)}
        slices = []
        for tenant, file, groups in self._footers([f for f in self._files() if f[0] in moved]):
            since, upto = moved[tenant]
            run: list[int] = []
            rows = 0
            for g in groups:
                if g.high <= since or g.low > upto:
                    continue
                if run and rows + g.rows > ROWS_PER_TASK:
                    slices.append(_Slice(tenant, file, run, since, upto))
                    run, rows = [], 0
                run.append(g.number)
                rows += g.rows
            if run:
                slices.append(_Slice(tenant, file, run, since, upto))
        # Spark wants a partition even of an interval without rows.
        return slices or [_Slice("", "", [], 0, 0)]

    def read(self, partition: _Slice) -> Iterator[pa.RecordBatch]:
        if not partition.groups:
            return
        files, _ = fs.FileSystem.from_uri(self.path)
        target = to_arrow_schema(self.schema)
        columns = [n for n in self.schema.names if n != TENANT]
        tenant = None if partition.tenant == _NO_VALUE else partition.tenant
        with _opened(files, partition.file) as file:
            wanted = list(dict.fromkeys([*columns, self.version]))
            for batch in file.iter_batches(row_groups=partition.groups, columns=wanted):
                stamps = _micros(batch[self.version])
                inside = pc.and_(pc.greater(stamps, partition.since), pc.less_equal(stamps, partition.upto))
                batch = batch.filter(inside, null_selection_behavior="drop")
                if batch.num_rows:
                    arrays = [
                        pa.array([tenant] * batch.num_rows, f.type) if f.name == TENANT else batch[f.name].cast(f.type)
                        for f in target
                    ]
                    yield pa.RecordBatch.from_arrays(arrays, schema=target)


class TenantChanges(DataSource):
    """Options: ``path`` and ``version`` (the column that orders a key's versions)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamReader(self, schema: T.StructType) -> ChangeReader:
        return ChangeReader(self.options["path"], self.options.get("version", "updated_at"), schema)


def tenant_changes(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame:
    """The changed rows of all tenants of one exported table, as a stream."""
    spark.dataSource.register(TenantChanges)
    loose = [T.StructField(f.name, f.dataType, True) for f in spec.source_schema.fields]
    schema = T.StructType([T.StructField(TENANT, T.StringType()), *loose])
    return spark.readStream.format(FORMAT).schema(schema).option("version", spec.version).load(path)
