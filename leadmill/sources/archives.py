"""Packed and sorted result files as a table: one partition a file, read as a stream.

`register(spark)` makes `spark.read.format("leadmill_results")` known. A .tar or .tar.gz is opened from its path and its members pass by one after another; nothing
is unpacked, and an archive may be of any size. Files that are sorted by score (option `sorted`) are left at the first score over a
cutoff that a filter sets, so a table of best results costs what its best rows cost.
"""

from __future__ import annotations

import csv
import io
import tarfile
from collections.abc import Iterator

from pyarrow import fs as filesystems
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, Filter, InputPartition, LessThan, LessThanOrEqual

SCHEMA = "title long, score double, member string"
COLUMNS = ("title", "r_i_docking_score")


class Forward(io.RawIOBase):
    """Bytes of a stream that cannot go back."""

    def __init__(self, stream):
        self.stream = stream

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        got = self.stream.read(len(buffer))
        buffer[: len(got)] = got
        return len(got)


class File(InputPartition):
    def __init__(self, path: str):
        self.path = path


def is_result(name: str) -> bool:
    name = name.rpartition("/")[2]
    return name.startswith("glide_") and name.endswith(".csv") and not name.endswith("_skip.csv")


class Reader(DataSourceReader):
    def __init__(self, options):
        self.folder = options["path"]
        self.sorted = str(options.get("sorted", "false")).lower() == "true"
        self.skip = int(options.get("skip", 0))  # records at the head of each member that are no results
        self.cutoff: float | None = None
        self.rows_read = 0

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """The least upper bound of the score is used to stop early; Spark tests every filter again."""
        for f in filters:
            if isinstance(f, (LessThan, LessThanOrEqual)) and tuple(f.attribute) == ("score",) and isinstance(f.value, (int, float)):
                self.cutoff = float(f.value) if self.cutoff is None else min(self.cutoff, float(f.value))
            yield f

    def partitions(self) -> list[File]:
        where, root = filesystems.FileSystem.from_uri(self.folder)
        files = where.get_file_info(filesystems.FileSelector(root))
        names = sorted(f.path for f in files if f.type == filesystems.FileType.File and (f.path.endswith((".tar.gz", ".tgz", ".tar")) or is_result(f.path)))
        return [File(name) for name in names]

    def read(self, partition: File) -> Iterator[tuple]:
        where, _ = filesystems.FileSystem.from_uri(self.folder)
        with where.open_input_stream(partition.path, compression=None) as stream:
            if is_result(partition.path):
                yield from self._rows(stream, partition.path)
                return
            # A stream mode: members are met in order, and what is not asked for is passed over.
            with tarfile.open(fileobj=stream, mode="r|*") as tar:
                for member in tar:
                    if member.isfile() and is_result(member.name):
                        yield from self._rows(tar.extractfile(member), member.name)
                    tar.members = []  # a stream never goes back, so no member needs to be kept

    def _rows(self, stream, name: str) -> Iterator[tuple]:
        lines = csv.DictReader(io.TextIOWrapper(io.BufferedReader(Forward(stream), 1 << 16), encoding="utf-8", newline=""))
        missing = [c for c in COLUMNS if c not in (lines.fieldnames or ())]
        if missing:
            raise ValueError(f"{name}: missing columns: {', '.join(missing)}")
        for n, line in enumerate(lines):
            self.rows_read += 1
            if n < self.skip:
                continue
            title, score = (line[c] for c in COLUMNS)
            value = float(score) if score else None
            if self.sorted and self.cutoff is not None and value is not None and value > self.cutoff:
                return
            yield int(title), value, name


class Results(DataSource):
    @classmethod
    def name(cls) -> str:
        return "leadmill_results"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> Reader:
        return Reader(self.options)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Results)


def results(spark: SparkSession, folder: str, *, in_order: bool = False, skip: int = 0) -> DataFrame:
    """title, score, member of all result files of a folder, packed or not. With `in_order`, every member is sorted by score from its lowest on; the
    first `skip` records of a member are no results. A member without rows gives none, a missing score is null."""
    register(spark)
    return spark.read.format("leadmill_results").option("sorted", str(in_order)).option("skip", skip).load(folder)


def pack(rows: DataFrame, folder: str, parts: int) -> None:
    """Writes rows (title, score) as `parts` archives of one sorted result file each."""

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        where, root = filesystems.FileSystem.from_uri(folder)
        where.create_dir(root)
        number = TaskContext.get().partitionId()
        text = io.StringIO()
        text.write(",".join(COLUMNS) + "\n")
        for batch in batches:
            for title, score in zip(batch.column("title").to_pylist(), batch.column("score").to_pylist()):
                text.write(f"{title},{'' if score is None else repr(score)}\n")
        content = text.getvalue().encode()
        with where.open_output_stream(f"{root}/part_{number}.tar.gz", compression=None) as out, tarfile.open(fileobj=out, mode="w|gz") as tar:
            info = tarfile.TarInfo(f"glide_{number}.csv")
            info.size = len(content)
            tar.addfile(info, io.BytesIO(content))
        yield pa.RecordBatch.from_pydict({"number": pa.array([number], pa.int32())})

    rows.select("title", "score").repartition(parts, "title").sortWithinPartitions("score", "title").mapInArrow(run, "number int").collect()
