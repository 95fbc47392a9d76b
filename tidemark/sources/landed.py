"""Raw files as collection leaves them: landed=<date>/name=<name>/<file>, read by a Python data source.

``spark.read.format("landed").load(path)`` gives a row for each file: landed, name, file, size and bytes. Each file is a
partition of its own or shares one with others up to `batch_bytes`; filters on landed and name are pushed down, so
that files they rule out are neither opened nor planned for. Folders are listed once, by pyarrow, which
knows local paths, HDFS and object stores. Collecting pages over HTTP is left to what fills the folder.

Edge cases: an empty or missing folder gives no rows; files outside the layout, hidden ones and Spark's marks are
passed over; a date that isn't one, or a name that is missing, gives null there.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

SCHEMA = "landed date, name string, file string, size long, bytes binary"
_PUSH = "spark.sql.python.filterPushdown.enabled"


@dataclass
class _Files(InputPartition):
    files: tuple[tuple, ...]  # landed, name, path, size


def _file_system(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _date(text: str | None) -> dt.date | None:
    try:
        return dt.date.fromisoformat(text or "")
    except ValueError:
        return None


class _Reader(DataSourceReader):
    def __init__(self, path: str, batch_bytes: int) -> None:
        self.path, self.batch_bytes, self.tests = path, batch_bytes, []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Tests on landed and name are kept here; Spark applies the others."""
        tests = {
            EqualTo: lambda v, x: v == x, In: lambda v, x: v in x, GreaterThan: lambda v, x: v > x,
            GreaterThanOrEqual: lambda v, x: v >= x, LessThan: lambda v, x: v < x, LessThanOrEqual: lambda v, x: v <= x,
        }
        for f in filters:
            test, place = tests.get(type(f)), {("landed",): 0, ("name",): 1}.get(getattr(f, "attribute", None))
            if test is None or place is None:
                yield f
            else:
                self.tests.append((place, test, f.value))

    def _found(self) -> Iterator[tuple]:
        from pyarrow import fs

        system, root = _file_system(self.path)
        for info in system.get_file_info(fs.FileSelector(root, allow_not_found=True, recursive=True)):
            rest = info.path[len(root.rstrip("/")) + 1 :]
            parts = dict(p.split("=", 1) for p in rest.split("/")[:-1] if "=" in p)
            if info.type != fs.FileType.File or re.search(r"(^|/)[._]", rest) or "landed" not in parts:
                continue
            row = (_date(parts["landed"]), parts.get("name"), info.path, info.size)
            if all(row[place] is not None and test(row[place], value) for place, test, value in self.tests):
                yield row

    def partitions(self) -> list[InputPartition]:
        out: list[list[tuple]] = []
        room = 0
        for row in sorted(self._found(), key=lambda r: r[2]):
            if not out or room + row[3] > self.batch_bytes:
                out.append([])
                room = 0
            out[-1].append(row)
            room += row[3]
        return [_Files(tuple(x)) for x in out] or [_Files(())]

    def read(self, partition: _Files) -> Iterator[tuple]:
        system = _file_system(self.path)[0]
        for landed, name, path, size in partition.files:
            with system.open_input_stream(path) as stream:
                yield landed, name, path.rsplit("/", 1)[-1], size, stream.read()


class LandedFiles(DataSource):
    """Options: path, and batch_bytes (files of a task, 32 MiB unless said)."""

    @classmethod
    def name(cls) -> str:
        return "landed"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"], int(self.options.get("batch_bytes", 32 << 20)))


def landed_files(spark: SparkSession, path: str, batch_bytes: int = 32 << 20):
    """The files under path; filters on landed and name reach the listing."""
    spark.conf.set(_PUSH, "true")
    spark.dataSource.register(LandedFiles)
    return spark.read.format("landed").option("batch_bytes", str(batch_bytes)).load(path)


def write_lines(lines: DataFrame, path: str, day: str, order: str, parts: int = 8) -> None:
    """Lines (name, value, order) as a day's landed files: up to `parts` for each name, their lines in order, so that the
    same lines give the same bytes however tasks deal and fetch them.

    Spark drops a sort below the one that it adds for partition columns. It adds none to rows that are
    sorted by them already, which takes a name that can't be null, and the day in the path.
    """
    named = lines.select(F.coalesce("name", F.lit("")).alias("name"), "value", order)
    dealt = named.repartition(parts, F.pmod(F.xxhash64(order), F.lit(64))).sortWithinPartitions("name", order, "value")
    dealt.drop(order).write.partitionBy("name").text(f"{path}/landed={day}")
