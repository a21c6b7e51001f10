"""A key-ordered Parquet folder as a SQL data source with one input partition per key range.

    register_key_ranges(spark)
    spark.sql("CREATE TEMPORARY VIEW orders USING key_ranges OPTIONS (path '/out/orders.parquet', key 'o_orderkey', ranges '64')")

Ranges are planned from the row-group statistics in the footers: cuts of about equal rows where row groups end. Tasks read
Arrow batches. The options ``lower`` and ``upper`` bound the key: only partitions whose range they meet are there, and only their row groups
are read. Conditions of a query do not prune: in Spark 4.1.2 a filter that a Python source accepts stays with the relation, so that
another scan of the same view, even one without a condition, would lose rows.
The folder's file system must be one that Arrow opens (local, hdfs, s3, gs); for others use ``register_source``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.dataset as ds
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import StructType

FORMAT = "key_ranges"
# Rows of a range where neither their number nor the table says more.
RANGE_ROWS = 1_000_000
# Rows read over all ranges, of the table's rows: more means that its row groups are not in key order.
MOST_READ = 2.0
_BATCH_ROWS = 1 << 16

_LOWEST, _HIGHEST = -(2**63), 2**63 - 1


def register_key_ranges(spark: SparkSession) -> None:
    """Make ``USING key_ranges`` known to a session."""
    spark.dataSource.register(KeyRangeSource)


@dataclass(frozen=True)
class Group:
    """A row group: its file's place in the folder, its number, and its rows and bounds of the key."""

    file: int
    number: int
    rows: int
    lo: int
    hi: int


@dataclass
class KeyRangePartition(InputPartition):
    """Keys in [lo, hi], and the row groups by file that may hold some."""

    lo: int
    hi: int
    groups: dict[str, list[int]] = field(default_factory=dict)


def plan_row_groups(groups: list[Group], ranges: int) -> list[tuple[int, int]]:
    """(lo, hi) of at most ``ranges`` disjoint, gap-free key ranges of about equal rows that end where row groups end."""
    total = sum(g.rows for g in groups)
    by_end = sorted(groups, key=lambda g: (g.hi, g.lo))
    out, start, done, target = [], _LOWEST, 0, total / ranges
    for i, g in enumerate(by_end):
        done += g.rows
        after = by_end[i + 1] if i + 1 < len(by_end) else None
        # close where the rows so far come nearest to a whole number of shares
        if after is None or (after.hi > g.hi and done + after.rows / 2 > target):
            out.append((start, _HIGHEST if after is None else g.hi))
            start = g.hi + 1
            target = (round(done * ranges / total) + 1) * total / ranges
    return out


class KeyRangeSource(DataSource):
    """Options: ``path``; ``key``, an integer column; ``ranges``, about so many partitions of the whole; ``lower`` and ``upper``,
    bounds of the key, inclusive; ``rescan`` ``true`` to read a folder that is not in key order, each range over all of it."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def _option(self, name: str) -> str:
        if name not in self.options:
            raise ValueError(f"{FORMAT} needs the option {name!r}")
        return self.options[name]

    def _dataset(self) -> ds.Dataset:
        return open_folder(self._option("path"))

    def schema(self) -> StructType:
        return from_arrow_schema(self._dataset().schema, prefer_timestamp_ntz=True)

    def reader(self, schema: StructType) -> DataSourceReader:
        ranges, rescan = self.options.get("ranges"), self.options.get("rescan", "false").lower() == "true"
        bounds = int(self.options.get("lower", _LOWEST)), int(self.options.get("upper", _HIGHEST))
        return KeyRangeReader(self._option("path"), self._option("key"), int(ranges) if ranges else None, schema.fieldNames(), *bounds, rescan)


def open_folder(path: str) -> ds.Dataset:
    """Parquet files below a path or URI, by name; names that begin with ``_`` or ``.`` are left out."""
    return ds.dataset(path.removeprefix("file:") if path.startswith("file:/") and not path.startswith("file://") else path, format="parquet")


class KeyRangeReader(DataSourceReader):
    def __init__(self, path: str, key: str, ranges: int | None, columns: list[str], lo: int, hi: int, rescan: bool):
        self.path, self.key, self.ranges, self.columns, self.lo, self.hi, self.rescan = path, key, ranges, columns, lo, hi, rescan
        if key not in columns:
            raise ValueError(f"no column {key!r} in {path}")

    def _groups(self) -> tuple[list[str], list[Group]]:
        """Row groups of all files from their footers."""
        files, groups = [], []
        for i, fragment in enumerate(open_folder(self.path).get_fragments()):
            files.append(fragment.path)
            footer = fragment.metadata
            place = footer.schema.names.index(self.key)
            for number in range(footer.num_row_groups):
                row_group = footer.row_group(number)
                if not row_group.num_rows:
                    continue
                facts = row_group.column(place).statistics
                if facts is None or facts.null_count != 0 or not facts.has_min_max or type(facts.min) is not int:
                    raise ValueError(f"{fragment.path}: the footer must hold integer bounds of {self.key!r} and no NULL")
                groups.append(Group(i, number, row_group.num_rows, facts.min, facts.max))
        return files, groups

    def partitions(self) -> list[KeyRangePartition]:
        files, groups = self._groups()
        total = sum(g.rows for g in groups)
        ranges = plan_row_groups(groups, self.ranges or max(1, -(-total // RANGE_ROWS)))
        out, read = [], 0
        for lo, hi in ranges:
            part = KeyRangePartition(lo, hi)
            for g in groups:
                if g.lo <= hi and g.hi >= lo:
                    part.groups.setdefault(files[g.file], []).append(g.number)
                    read += g.rows
            out.append(part)
        if read > MOST_READ * total and not self.rescan:
            raise ValueError(f"{self.path} is not in order of {self.key!r}: {len(out)} ranges would read {read / total:.1f} times its rows")
        kept = [p for p in out if p.lo <= self.hi and p.hi >= self.lo]
        return kept or [KeyRangePartition(0, -1)]

    def read(self, partition: KeyRangePartition) -> Iterator[pa.RecordBatch]:
        lo, hi = max(partition.lo, self.lo), min(partition.hi, self.hi)
        condition = (ds.field(self.key) >= lo) & (ds.field(self.key) <= hi)
        if not partition.groups:
            return
        whole = open_folder(self.path)
        for fragment in whole.get_fragments():
            numbers = partition.groups.get(fragment.path)
            if numbers:
                rows = fragment.subset(row_group_ids=numbers).scanner(schema=whole.schema, columns=self.columns, filter=condition, batch_size=_BATCH_ROWS, batch_readahead=1, fragment_readahead=1, use_threads=False)
                for batch in rows.to_batches():
                    if batch.num_rows:
                        yield batch
