"""Tables of a stream that change together.

A table is a set of *segments*: folders that are written once and never changed.
Which segments are live is said by the commit log: a batch writes its segments
and then, last, one file that lists the live segments of all tables. Readers go
by the newest such file, so they see all of a batch or nothing of it, whatever
happens in between; a batch that runs again after a crash starts anew, and one
that was committed before is not run again.

When a table has ``FANOUT`` segments of one level, they are merged into one of the
next level as part of the commit, so the segments that are live, and with them
the files a reader opens, grow with the logarithm of the number of batches, and
each row is rewritten as often. Segments that no longer count are removed one
version later: a reader may still be on the version before.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..session import CODEC, delete_below, folders
from ..sources.files import by_partition, path_exists

#: Segments of one level that are merged into one of the next, and versions whose segments are kept.
FANOUT, KEPT = 8, 2
LOG_SCHEMA = "batch long, name string, segment string, level int"
LOG, WORK = "commits", "work"

Merge = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Table:
    """What the log needs to know of a table: its columns, how segments are laid out, and how rows of several
    segments become those of one. Rows that are ``grouped`` come out of an aggregation, whose tasks adaptive execution
    has fitted to their size: they are written from there."""

    name: str
    schema: StructType
    merge: Merge
    by: tuple[str, ...] = ()
    sort: tuple[str, ...] = ()
    grouped: bool = False


@dataclass(frozen=True)
class Version:
    """The last committed batch (-1 before the first) and (table, segment, level) of all that is live."""

    batch: int = -1
    segments: tuple[tuple[str, str, int], ...] = field(default=())

    def of(self, name: str) -> list[str]:
        return [segment for table, segment, _ in self.segments if table == name]


class StreamTables:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _log(self) -> list:
        path = f"{self.root}/{LOG}"
        if not path_exists(self.spark, path):
            return []
        # One small file per kept version.
        return self.spark.read.schema(LOG_SCHEMA).option("recursiveFileLookup", "true").json(path).collect()

    def live(self) -> Version:
        rows = self._log()
        if not rows:
            return Version()
        last = max(r.batch for r in rows)
        return Version(last, tuple((r.name, r.segment, r.level) for r in rows if r.batch == last and r.name))

    def read(self, table: Table, version: Version | None = None) -> DataFrame:
        """A table's rows in a version (by default the newest), unmerged."""
        return self._read(table, (version or self.live()).of(table.name))

    def _read(self, table: Table, segments: list[str]) -> DataFrame:
        if not segments:
            return self.spark.createDataFrame([], table.schema)
        reader = self.spark.read.schema(table.schema).option("basePath", f"{self.root}/{table.name}")
        return reader.parquet(*[f"{self.root}/{s}" for s in segments]).select(*table.schema.fieldNames())

    def write(self, table: Table, rows: DataFrame) -> str:
        """A new segment, not live yet."""
        segment = f"{table.name}/segment={uuid.uuid4().hex}"
        rows = rows.select(*table.schema.fieldNames())
        if not table.grouped:
            rows = by_partition(rows, *table.by)
        if table.sort:
            rows = rows.sortWithinPartitions(*table.by, *table.sort)
        rows.write.option("compression", CODEC).partitionBy(*table.by).parquet(f"{self.root}/{segment}")
        return segment

    def segment(self, table: Table, segment: str) -> DataFrame:
        return self._read(table, [segment])

    def work_folder(self) -> str:
        """A folder, not made yet, that the next commit removes."""
        return f"{self.root}/{WORK}/{uuid.uuid4().hex}"

    def stage(self, rows: DataFrame, folder: str | None = None) -> DataFrame:
        """Rows written once to a work folder."""
        path = folder or self.work_folder()
        rows.write.option("compression", CODEC).parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def drop_stage(self, folder: str) -> None:
        """Remove a work folder that is not read again before the next commit."""
        delete_below(self.spark, self.root, folder)

    def commit(self, batch: int, base: Version, tables: list[Table], added: dict[str, str]) -> Version:
        """Make ``added`` (table name -> segment) live on top of ``base``, all at once."""
        live = [*base.segments, *((name, segment, 0) for name, segment in added.items())]
        for table in tables:
            live = self._merged(table, live)
        rows = [(batch, "", "", 0), *((batch, *s) for s in live)]
        one = self.spark.createDataFrame(rows, LOG_SCHEMA).coalesce(1)
        one.write.mode("overwrite").json(f"{self.root}/{LOG}/{batch:012d}")
        self._sweep()
        return Version(batch, tuple(live))

    def _merged(self, table: Table, live: list[tuple[str, str, int]]) -> list[tuple[str, str, int]]:
        level = 0
        while True:
            same = [s for s in live if s[0] == table.name and s[2] == level]
            if len(same) >= FANOUT:
                merged = self.write(table, table.merge(self._read(table, [s for _, s, _ in same])))
                live = [s for s in live if s not in same] + [(table.name, merged, level + 1)]
            elif not any(s[0] == table.name and s[2] > level for s in live):
                return live
            level += 1

    def _sweep(self) -> None:
        """Remove versions beyond the kept ones, and segments and staged rows that no kept version names."""
        rows = self._log()
        kept = sorted({r.batch for r in rows})[-KEPT:]
        named = {r.segment for r in rows if r.batch in kept}
        for batch in {r.batch for r in rows} - set(kept):
            delete_below(self.spark, self.root, f"{self.root}/{LOG}/{batch:012d}")
        for name in folders(self.spark, self.root):
            if name != LOG:
                for segment in folders(self.spark, f"{self.root}/{name}"):
                    if f"{name}/{segment}" not in named:
                        delete_below(self.spark, self.root, f"{self.root}/{name}/{segment}")
