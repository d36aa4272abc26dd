"""A small growing table as a bounded number of immutable files.

Every append is a segment of its own, numbered in order. Segments of like spans are merged
by eights, so N appends leave some 7 log8(N) of them, and a row is rewritten log8(N) times. A
segment is written under a name that readers pass over and then moved into place; a merged
one has the numbers of those it replaces, which are passed over from then on and go with
the next append. So a writer may stop anywhere: readers see the one or the other, never both,
and those who listed the table before a merge can still read what they listed.

There is one writer at a time. The greatest time of a segment is part of its name, so the
newest row is found by listing names and reading one segment.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Segments of one size that are merged into one of the next.
FAN = 8

_NAME = re.compile(r"segment-(\d+)-(\d+)-(-?\d+|none)")
_UNFINISHED = "_unfinished-"


@dataclass(frozen=True)
class Segment:
    """Appends ``first`` to ``last``; ``newest`` is the greatest time in microseconds."""

    first: int
    last: int
    newest: int | None

    @property
    def name(self) -> str:
        newest = "none" if self.newest is None else self.newest
        return f"segment-{self.first:012d}-{self.last:012d}-{newest}"

    @classmethod
    def of(cls, name: str) -> Segment | None:
        found = _NAME.fullmatch(name)
        if found is None:
            return None
        first, last, newest = found.groups()
        return cls(int(first), int(last), None if newest == "none" else int(newest))


def live(segments: Sequence[Segment]) -> list[Segment]:
    """In order, without those that a merged one holds."""
    kept: list[Segment] = []
    for segment in sorted(segments, key=lambda s: (s.first, -s.last)):
        if not kept or segment.last > kept[-1].last:
            kept.append(segment)
    return kept


def to_merge(spans: Sequence[int], fan: int = FAN) -> int:
    """How many of the last segments go into one, by their numbers of appends; 0: none.

    Merges that would follow from the merge are taken along, so there is one of them.
    """

    def size(span: int) -> int:
        level = 0
        while span >= fan:
            span //= fan
            level += 1
        return level

    merged, rest = 0, list(spans)
    while len(rest) >= fan and len({size(span) for span in rest[-fan:]}) == 1:
        together = sum(rest[-fan:])
        merged += fan - 1 if merged else fan
        rest[-fan:] = [together]
    return merged


class Segments:
    """The table at ``path``. Rows lie sorted by ``sort_by``; ``newest_by`` is a time column.

    With ``keys``, rows are entries numbered in ``entry``, and a merge keeps only the greatest of a key.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        *,
        newest_by: str = "",
        keys: Sequence[str] = (),
        entry: str = "entry",
        sort_by: Sequence[str] = (),
        fan: int = FAN,
    ) -> None:
        self.spark, self.path, self.schema = spark, path, schema
        self.newest_by, self.keys, self.entry = newest_by, tuple(keys), entry
        self.sort_by, self.fan = tuple(sort_by), fan

    def _folder(self, name: str = ""):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self) -> list[str]:
        folder, files = self._folder()
        if not files.exists(folder):
            return []
        return [status.getPath().getName() for status in files.listStatus(folder)]

    def segments(self) -> list[Segment]:
        return live([s for s in map(Segment.of, self._names()) if s is not None])

    def _read(self, segments: Sequence[Segment]) -> DataFrame:
        if not segments:
            return self.spark.createDataFrame([], self.schema)
        paths = [f"{self.path}/{segment.name}" for segment in segments]
        return self.spark.read.schema(self.schema).parquet(*paths)

    def read(self) -> DataFrame:
        return self._read(self.segments())

    def newest(self) -> DataFrame:
        """The rows of the one segment that has the greatest time, of equal ones the last."""
        timed = [s for s in self.segments() if s.newest is not None]
        return self._read([max(timed, key=lambda s: (s.newest, s.last))] if timed else [])

    def create(self) -> None:
        folder, files = self._folder()
        files.mkdirs(folder)

    def next_number(self) -> int:
        found = self.segments()
        return found[-1].last + 1 if found else 0

    def append(self, rows: DataFrame) -> None:
        """One more segment, and the merge that is due with it."""
        self._clear()
        found = self.segments()
        number = found[-1].last + 1 if found else 0
        spans = [s.last - s.first + 1 for s in found] + [1]
        self._write(rows, number, number)
        count = to_merge(spans, self.fan)
        if count:
            self.merge(count)

    def merge(self, count: int) -> None:
        """The last ``count`` segments as one."""
        found = self.segments()[-count:]
        if len(found) < 2:
            return
        rows = self._read(found)
        if self.keys:
            rest = [f.name for f in self.schema.fields if f.name not in self.keys]
            newest = F.max_by(F.struct(*rest), F.col(self.entry)).alias("newest")
            rows = rows.groupBy(*self.keys).agg(newest).select(*self.keys, "newest.*")
        self._write(rows, found[0].first, found[-1].last)

    def replace(self, rows: DataFrame) -> None:
        """Another content altogether: a segment that holds all there were."""
        self._clear()
        self._write(rows, 0, self.next_number())

    def _write(self, rows: DataFrame, first: int, last: int) -> None:
        unfinished = f"{_UNFINISHED}{uuid4().hex}"
        ordered = rows.select(*self.schema.fieldNames()).coalesce(1)
        if self.sort_by:
            ordered = ordered.sortWithinPartitions(*self.sort_by)
        newest = None
        if self.newest_by:
            written = Observation()
            time = F.max(F.unix_micros(self.newest_by)).alias("newest")
            ordered.observe(written, time).write.parquet(f"{self.path}/{unfinished}")
            newest = written.get["newest"]
        else:
            ordered.write.parquet(f"{self.path}/{unfinished}")
        segment = Segment(first, last, newest)
        folder, files = self._folder(unfinished)
        if not files.rename(folder, self._folder(segment.name)[0]):
            raise OSError(f"{self.path}: {segment.name} could not be moved into place")

    def _clear(self) -> None:
        """Drop what a writer left behind and what an earlier merge replaced."""
        names = self._names()
        kept = {segment.name for segment in self.segments()}
        for name in names:
            if name.startswith(_UNFINISHED) or (Segment.of(name) is not None and name not in kept):
                folder, files = self._folder(name)
                files.delete(folder, True)
