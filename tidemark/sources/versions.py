"""Stored tables that change: parts by key, written anew where touched, and a small list per version.

A table is cut into parts by a hash of its keys. A change reads and writes only the parts that hold
the keys it names; a new version is a list saying in which folder each part lies. The list is
written last, under the next number, so a change that was killed leaves the version before it, and
what it did not touch stays the same files. Readers of an older version are not disturbed until
``forget`` removes folders no kept version names.

A list has one entry per part, whatever the rows. One writer at a time; any number of readers.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PART = "_part"


class _Files:
    """Small files and folders of a file system every executor reaches."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.jvm = spark.sparkContext._jvm
        self.fs = self._path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def names(self, path: str) -> list[str]:
        where = self._path(path)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(where)) if self.fs.exists(where) else []

    def read(self, path: str) -> str:
        stream = self.fs.open(self._path(path))
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        """Whole or not at all: written under another name first. An existing file is an error."""
        draft, target = self._path(f"{path}.{uuid.uuid4().hex}.draft"), self._path(path)
        stream = self.fs.create(draft)
        stream.write(text.encode())
        stream.close()
        if self.fs.exists(target) or not self.fs.rename(draft, target):
            self.fs.delete(draft, False)
            raise RuntimeError(f"{path} was written by someone else")

    def delete(self, path: str) -> None:
        self.fs.delete(self._path(path), True)


@dataclass(frozen=True)
class VersionedTable:
    """One version of a stored table."""

    spark: SparkSession
    path: str
    version: int
    schema: T.StructType
    keys: tuple[str, ...]
    parts: int
    #: Folder of each part that has rows.
    places: Mapping[int, str]
    #: Names of changes already applied, newest last.
    done: tuple[str, ...] = field(default=())

    def part_of(self) -> Column:
        """Part a row belongs to; equal keys of other types fall into the same part."""
        typed = [F.col(f"`{k}`").cast(self.schema[k].dataType) for k in self.keys]
        return F.pmod(F.xxhash64(*typed), F.lit(self.parts)).cast("int")

    def read(self, only: Sequence[int] | None = None) -> DataFrame:
        """Rows of all parts, or of some."""
        chosen = [self.places[p] for p in sorted(self.places) if only is None or p in set(only)]
        if not chosen:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{c}" for c in chosen])

    def touched(self, rows: DataFrame) -> list[int]:
        """Parts that hold the keys of ``rows``; at most as many numbers as the table has parts."""
        return sorted(r[0] for r in rows.select(self.part_of().alias(_PART)).distinct().collect())

    def near(self, rows: DataFrame) -> DataFrame:
        """Rows of the parts that hold the keys of ``rows``."""
        return self.read(self.touched(rows))

    def change(self, rows: DataFrame, make: Callable[[DataFrame], DataFrame], name: str | None = None) -> VersionedTable:
        """The next version: parts with keys of ``rows`` become what ``make`` returns for them.

        ``make`` gets these parts' rows and returns their new rows, whose keys must lie in the same
        parts. A ``name`` that was applied before changes nothing, so a repeated job has no effect.
        """
        if name is not None and name in self.done:
            return self
        numbers = self.touched(rows)
        done = self.done if name is None else (*self.done, name)
        places = dict(self.places)
        if numbers:
            inside = self.part_of().isin(numbers)
            stray = F.raise_error(F.lit("a changed row lies outside the parts that were touched"))
            new = make(self.read(numbers)).select([F.col(f"`{f.name}`").cast(f.dataType) for f in self.schema])
            checked = new.withColumn(_PART, F.when(inside, self.part_of()).otherwise(stray.cast("int")))
            written = _write(checked, self.path, self.version + 1)
            places = {p: d for p, d in places.items() if p not in set(numbers)} | written
        return _commit(self.spark, self.path, self.version + 1, self.schema, self.keys, self.parts, places, done)

    def at(self, version: int) -> VersionedTable:
        return _read_list(self.spark, self.path, version)

    def forget(self, keep: int = 1) -> int:
        """Remove all but the newest ``keep`` versions and folders none of these name; returns how many folders went."""
        files = _Files(self.spark, self.path)
        numbers = _versions(files, self.path)
        kept = {place for n in numbers[-keep:] for place in _read_list(self.spark, self.path, n).places.values()}
        for n in numbers[:-keep]:
            files.delete(f"{self.path}/versions/{n:08d}.json")
        gone = 0
        for folder in files.names(f"{self.path}/data"):
            for part in files.names(f"{self.path}/data/{folder}"):
                if part.startswith(_PART) and f"data/{folder}/{part}" not in kept:
                    files.delete(f"{self.path}/data/{folder}/{part}")
                    gone += 1
        return gone


def _write(rows: DataFrame, path: str, version: int) -> dict[int, str]:
    """Write rows with their part; uneven parts are written by several tasks."""
    folder = f"data/{version:08d}-{uuid.uuid4().hex}"
    rows.hint("rebalance", _PART).write.partitionBy(_PART).parquet(f"{path}/{folder}")
    names = _Files(rows.sparkSession, path).names(f"{path}/{folder}")
    return {int(n.split("=")[1]): f"{folder}/{n}" for n in names if n.startswith(f"{_PART}=")}


def _commit(spark, path, version, schema, keys, parts, places, done) -> VersionedTable:
    told = {"schema": schema.jsonValue(), "keys": list(keys), "parts": parts, "places": places, "done": list(done)}
    _Files(spark, path).write(f"{path}/versions/{version:08d}.json", json.dumps(told))
    return VersionedTable(spark, path, version, schema, tuple(keys), parts, places, tuple(done))


def _versions(files: _Files, path: str) -> list[int]:
    return sorted(int(n[:8]) for n in files.names(f"{path}/versions") if n[8:] == ".json")


def _read_list(spark: SparkSession, path: str, version: int) -> VersionedTable:
    told = json.loads(_Files(spark, path).read(f"{path}/versions/{version:08d}.json"))
    schema, places = T.StructType.fromJson(told["schema"]), {int(p): d for p, d in told["places"].items()}
    return VersionedTable(spark, path, version, schema, tuple(told["keys"]), told["parts"], places, tuple(told["done"]))


def create(df: DataFrame, path: str, keys: Sequence[str], parts: int = 64) -> VersionedTable:
    """Store ``df`` as version 0 of a new table. Rows may lack keys; NULL is a key like any other."""
    spark, path = df.sparkSession, path.rstrip("/")
    # Columns may be without a value in later rows, whatever they are now.
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema])
    empty = VersionedTable(spark, path, -1, schema, tuple(keys), parts, {})
    places = _write(df.withColumn(_PART, empty.part_of()), path, 0)
    return _commit(spark, path, 0, schema, keys, parts, places, ())


def open_table(spark: SparkSession, path: str) -> VersionedTable:
    """The newest version."""
    path = path.rstrip("/")
    numbers = _versions(_Files(spark, path), path)
    if not numbers:
        raise ValueError(f"no versioned table at {path}")
    return _read_list(spark, path, numbers[-1])
