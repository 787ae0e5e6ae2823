"""A change log in Parquet files as a streaming source with offsets of its own.

An offset is a place (t, i, n): cluster time, number within it, arrival. A stream starts at a given (t, i) or goes on after the place its checkpoint
holds; each batch takes the next ``batch_changes`` changes in the order of places, and all that share the last one's place. Only the key columns of the row groups
that can hold the next places are read to find where a batch ends, by the statistics in the files' footers; tasks read the row groups that
meet the batch and filter them. So neither reads what lies before or behind.

Files are opened by Arrow's file systems (a path, or a URI that Arrow knows). A log grows by whole files; changes that turn up with a place that was already
passed are not read, as in any log with one order.

Options: ``path`` (a file or a folder), ``start_t`` and ``start_i`` (default: the first change), ``batch_changes`` (default 10,000), ``checkpoint`` (that
of the query, without which a restarted query cannot limit its batches and takes all that is left at once). Columns t, i and event_id give the
place; changes without a whole place are passed over. An empty folder has no schema, which is an error at once.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

FORMAT = "tidemark_changes"
KEYS = ("t", "i", "event_id")
LAST = 2**63 - 1


def _opened(path: str) -> tuple[pafs.FileSystem, str]:
    if re.match(r"[a-z0-9+.-]+://|file:/", path):
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), os.path.abspath(path)


def _files(path: str) -> tuple[pafs.FileSystem, list[tuple[str, int]]]:
    """The Parquet files under ``path`` with their sizes, in order of their names."""
    fs, top = _opened(path)
    info = fs.get_file_info(top)
    found = [info] if info.type == pafs.FileType.File else fs.get_file_info(pafs.FileSelector(top, recursive=True, allow_not_found=True))
    return fs, sorted((f.path, f.size) for f in found if f.type == pafs.FileType.File and f.path.endswith(".parquet") and not f.base_name.startswith(("_", ".")))


class Rows(InputPartition):
    """Row groups of a file, of which the changes after one place and up to another are asked for."""

    def __init__(self, file: str, groups: list[int], start: tuple, end: tuple):
        self.file, self.groups, self.start, self.end = file, groups, start, end


def _beyond(table: pa.Table | pa.RecordBatch, place: tuple):
    """A mask of the changes behind ``place``; null where a change has no whole place."""
    t, i, n = (table.column(k).cast(pa.int64()) for k in KEYS)
    later = pc.or_kleene(pc.greater(i, place[1]), pc.and_kleene(pc.equal(i, place[1]), pc.greater(n, place[2])))
    return pc.and_kleene(pc.or_kleene(pc.greater(t, place[0]), pc.and_kleene(pc.equal(t, place[0]), later)), pc.is_valid(pc.add(i, n)))


class ChangeLogReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.most = int(options.get("batch_changes", 10_000))
        self.first = (int(options.get("start_t", -LAST)), int(options.get("start_i", -LAST)) - 1, LAST)
        self.checkpoint = options.get("checkpoint")
        self.at: tuple | None = None
        self.groups: dict[tuple, list] = {}

    def initialOffset(self) -> dict:
        return dict(zip(KEYS, self.first, strict=True))

    def _resumed(self) -> tuple:
        """The place that the checkpoint holds, else the start."""
        if not self.checkpoint:
            return self.first
        fs, top = _opened(f"{self.checkpoint}/offsets")
        found = [f for f in fs.get_file_info(pafs.FileSelector(top, allow_not_found=True)) if f.base_name.isdigit()]
        if not found:
            return self.first
        with fs.open_input_stream(max(found, key=lambda f: int(f.base_name)).path) as f:
            place = json.loads(f.read().decode().splitlines()[-1])
        return tuple(place[k] for k in KEYS)

    def _row_groups(self) -> list[tuple]:
        """(least t, greatest t, file, number) of all row groups; footers are read once a file."""
        fs, files = _files(self.path)
        for file in files:
            if file not in self.groups:
                meta = pq.read_metadata(file[0], filesystem=fs)
                found = []
                for g in range(meta.num_row_groups):
                    s = next((c.statistics for c in (meta.row_group(g).column(j) for j in range(meta.num_columns)) if c.path_in_schema == "t"), None)
                    known = s is not None and s.has_min_max
                    found.append((s.min if known else -LAST, s.max if known else LAST, file[0], g))
                self.groups[file] = found
        return [g for file in files for g in self.groups[file]]

    def latestOffset(self) -> dict:
        if self.at is None:
            self.at = self._resumed()
        fs, _ = _opened(self.path)
        nearest = np.empty((len(KEYS), 0), np.int64)  # the next places, ``most`` at most
        for least, _, file, g in sorted(x for x in self._row_groups() if x[1] >= self.at[0]):
            if nearest.shape[1] >= self.most and least > nearest[0].max():
                break  # what follows lies behind the places that are known
            keys = pq.ParquetFile(file, filesystem=fs).read_row_group(g, columns=list(KEYS))
            keys = keys.filter(_beyond(keys, self.at))
            found = np.stack([keys.column(k).cast(pa.int64()).to_numpy() for k in KEYS])
            nearest = np.concatenate([nearest, found], axis=1)
            if nearest.shape[1] > self.most:
                nearest = nearest[:, np.lexsort(nearest[::-1])[: self.most]]
        if nearest.shape[1]:
            self.at = tuple(int(x) for x in nearest[:, np.lexsort(nearest[::-1])[-1]])
        return dict(zip(KEYS, self.at, strict=True))

    def partitions(self, start: dict, end: dict) -> list[Rows]:
        a, b = (tuple(x[k] for k in KEYS) for x in (start, end))
        by_file: dict[str, list[int]] = {}
        for least, greatest, file, g in self._row_groups():
            if greatest >= a[0] and least <= b[0]:
                by_file.setdefault(file, []).append(g)
        return [Rows(file, groups, a, b) for file, groups in by_file.items()]

    def read(self, partition: Rows) -> Iterator[pa.RecordBatch]:
        fs, _ = _opened(self.path)
        for batch in pq.ParquetFile(partition.file, filesystem=fs).iter_batches(row_groups=partition.groups):
            inside = pc.and_kleene(_beyond(batch, partition.start), pc.invert(_beyond(batch, partition.end)))
            found = batch.filter(inside)
            if found.num_rows:
                yield found


class ChangeLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self):
        from pyspark.sql.pandas.types import from_arrow_schema

        fs, files = _files(self.options["path"])
        if not files:
            raise ValueError(f"no Parquet file under {self.options['path']}")
        return from_arrow_schema(pq.read_schema(files[0][0], filesystem=fs))

    def streamReader(self, schema) -> ChangeLogReader:
        return ChangeLogReader(dict(self.options))


def stream(spark: SparkSession, path: str, checkpoint: str, start: tuple[int, int] | None = None, batch_changes: int = 10_000) -> DataFrame:
    """The log under ``path`` as a streaming DataFrame, in batches of ``batch_changes`` from ``start`` (t, i) on or after what ``checkpoint`` holds."""
    spark.dataSource.register(ChangeLog)
    options = {"path": path, "checkpoint": checkpoint, "batch_changes": str(batch_changes)}
    options |= {"start_t": str(start[0]), "start_i": str(start[1])} if start else {}
    return spark.readStream.format(FORMAT).options(**options).load()
