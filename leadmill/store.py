"""Where tables lie: the shared folder for intermediate ones, a folder a campaign for its state."""

from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or one below the
    working folder where the session names none and runs on one machine."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named and not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return named or f"file://{os.path.abspath('spark-warehouse')}/checkpoints"


def file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


_SCRATCH: list[list[str]] = []


def written(df: DataFrame, tag: str) -> tuple[DataFrame, str]:
    """`df` written once to the shared folder and read back, and the folder, which goes when the JVM ends at the latest."""
    spark = df.sparkSession
    folder = f"{shared_dir(spark)}/leadmill-{uuid.uuid4().hex}"
    df.write.parquet(f"{folder}/{tag}")
    fs, where = file_system(spark, folder)
    fs.deleteOnExit(where)
    return spark.read.schema(df.schema).parquet(f"{folder}/{tag}"), folder


def drop(spark: SparkSession, folder: str) -> None:
    fs, where = file_system(spark, folder)
    fs.delete(where, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What is spooled inside goes at the end: for steps whose result has been written by then."""
    _SCRATCH.append([])
    try:
        yield
    finally:
        for folder in _SCRATCH.pop():
            drop(spark, folder)


def spool(df: DataFrame, tag: str) -> DataFrame:
    """Writes `df` once to the shared folder and reads it back: cuts lineage, survives lost
    executors, and gives the next plan true sizes. The files go with the `scratch` around it, or when the JVM ends."""
    done, folder = written(df, tag)
    if _SCRATCH:
        _SCRATCH[-1].append(folder)
    return done


def _moved(spark: SparkSession, path: str, to: str) -> None:
    fs, where = file_system(spark, path)
    _, target = file_system(spark, to)
    if fs.exists(target):
        raise FileExistsError(to)
    if not fs.exists(where):
        raise FileNotFoundError(path)
    fs.mkdirs(target.getParent())
    if not fs.rename(where, target):
        raise OSError(f"cannot move {path} to {to}")


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Writes a small file that is there as a whole or not at all; refuses to replace one."""
    fs, where = file_system(spark, path)
    _, draft = file_system(spark, f"{path}.{uuid.uuid4().hex}.draft")
    out = fs.create(draft)
    out.write(bytearray(text.encode()))
    out.close()
    if fs.exists(where) or not fs.rename(draft, where):
        fs.delete(draft, False)
        raise FileExistsError(path)


def get_text(spark: SparkSession, path: str) -> str:
    fs, where = file_system(spark, path)
    stream = fs.open(where)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


class Campaign:
    """A campaign's tables, one folder a version: a round writes a new one, none is changed.

    A manifest names the version of every table that counts. The tables of a step are written first and published together, by one
    manifest, when the step ends; what a broken step has written is never read, and the step can run again from the state before it. Counters are
    columns of the `counters` table, kept explicitly so that a cycle that finds nothing still advances them.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._pending: dict[str, int] | None = None

    def _names(self, folder: str) -> list[str]:
        fs, where = file_system(self.spark, f"{self.path}/{folder}".rstrip("/"))
        return [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []

    def _folders(self, name: str) -> list[int]:
        """All versions of a table that have a folder, whole or not."""
        return sorted(int(n[2:]) for n in self._names(name) if re.fullmatch(r"v=[0-9]+", n))

    def _whole(self, name: str, version: int) -> bool:
        fs, where = file_system(self.spark, f"{self.path}/{name}/v={version}/_SUCCESS")
        return fs.exists(where)

    def _manifests(self) -> list[int]:
        return sorted(int(n) for n in self._names("manifest") if n.isdigit())

    def published(self) -> dict[str, int]:
        """The version of each table that counts; of a campaign without manifests the last whole one."""
        numbers = self._manifests()
        if numbers:
            return json.loads(get_text(self.spark, f"{self.path}/manifest/{numbers[-1]:08d}"))
        last = {name: [v for v in self._folders(name) if self._whole(name, v)] for name in self._names("")}
        return {name: found[-1] for name, found in last.items() if found}

    def _publish(self, versions: dict[str, int]) -> None:
        number = (self._manifests() or [0])[-1] + 1
        put_text(self.spark, f"{self.path}/manifest/{number:08d}", json.dumps(self.published() | versions))

    @contextmanager
    def step(self) -> Iterator[None]:
        """The tables written inside are seen there at once, and count for others when the step has ended; after an error none of them
        does. A step inside a step belongs to it."""
        if self._pending is not None:
            yield
            return
        self._pending = {}
        try:
            yield
            if self._pending:
                self._publish(self._pending)
        finally:
            self._pending = None

    def versions(self, name: str) -> list[int]:
        """The whole versions of a table up to the one that counts."""
        last = (self.published() | (self._pending or {})).get(name, 0)
        return [v for v in self._folders(name) if v <= last and self._whole(name, v)]

    def read(self, name: str) -> DataFrame | None:
        version = (self.published() | (self._pending or {})).get(name)
        return None if version is None else self.spark.read.parquet(f"{self.path}/{name}/v={version}")

    def write(self, name: str, df: DataFrame) -> DataFrame:
        """The next version, published at once outside a step; refuses to overwrite one."""
        version = (self._folders(name) or [0])[-1] + 1
        df.write.mode("errorifexists").parquet(f"{self.path}/{name}/v={version}")
        if self._pending is None:
            self._publish({name: version})
        else:
            self._pending[name] = version
        return self.spark.read.parquet(f"{self.path}/{name}/v={version}")

    def _row(self, name: str, default: dict[str, int]) -> dict[str, int]:
        df = self.read(name)
        return df.first().asDict() if df is not None else default

    def counters(self) -> dict[str, int]:
        return self._row("counters", {"cycle": 0, "iteration": 0, "models": 0})

    def _set(self, name: str, row: dict[str, int]) -> None:
        self.write(name, self.spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} long" for k in row)))

    def advance(self, **new: int) -> dict[str, int]:
        row = self.counters() | new
        self._set("counters", row)
        return row

    def progress(self) -> int:
        """Steps of the round that are done; 0 between rounds."""
        return self._row("progress", {"done": 0})["done"]

    def set_progress(self, done: int) -> None:
        self._set("progress", {"done": done})

    def archive(self, to: str) -> None:
        """Moves the whole campaign to `to`."""
        _moved(self.spark, self.path, to)

    @classmethod
    def restore(cls, spark: SparkSession, archived: str, path: str) -> "Campaign":
        """Moves an archived campaign back to `path`, which must be free."""
        _moved(spark, archived.rstrip("/"), path.rstrip("/"))
        return cls(spark, path)

    def clean(self, keep: int = 1) -> None:
        """Drops all but the latest `keep` versions of every table, and what broken steps left behind."""
        fs, _ = file_system(self.spark, self.path)
        kept = {name: set(self.versions(name)[-keep:]) for name in self._names("") if name not in ("manifest", "model_files")}
        for number in self._manifests()[:-1]:
            fs.delete(file_system(self.spark, f"{self.path}/manifest/{number:08d}")[1], False)
        for name, versions in kept.items():
            for v in set(self._folders(name)) - versions:
                fs.delete(file_system(self.spark, f"{self.path}/{name}/v={v}")[1], True)
