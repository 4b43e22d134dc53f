"""Tables whose replacement is all or nothing: staged versions and one pointer.

A version is a folder of its own, complete once Spark has committed the write.
Publishing it moves one small pointer file over the old one, so a reader finds
the old rows or the new ones, and a write that fails half-way leaves an unused
folder behind and nothing else.  Old versions stay until ``vacuum``.
"""
from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import (ArrayType, ByteType, DataType, DateType, DoubleType, FloatType, IntegerType, LongType, MapType,
                               ShortType, StringType, StructType, TimestampNTZType, TimestampType)

POINTER = "_current"


class Files:
    """Small files and folders of any file system that Spark reaches (metadata only, never data)."""

    def __init__(self, spark: SparkSession):
        self.jvm = spark.sparkContext._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self.jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.conf), p

    def read(self, path: str) -> str | None:
        fs, p = self._at(path)
        if not fs.exists(p):
            return None
        stream = fs.open(p)
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def replace(self, path: str, text: str) -> None:
        """Write the text beside ``path``, then rename it over: readers see the old or the new text."""
        fresh = f"{path}.{uuid.uuid4().hex[:12]}"
        fs, p = self._at(fresh)
        stream = fs.create(p, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        options = self.jvm.org.apache.hadoop.fs.Options.Rename
        overwrite = self.jvm.java.lang.reflect.Array.newInstance(self.jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 1)
        overwrite[0] = options.OVERWRITE
        self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.conf).rename(p, self._at(path)[1], overwrite)

    def folders(self, path: str) -> list[str]:
        fs, p = self._at(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()) if fs.exists(p) else []

    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.exists(p)

    def delete(self, path: str) -> None:
        fs, p = self._at(path)
        fs.delete(p, True)


class VersionedTable:
    """A Parquet table at ``root``: ``root/v-<id>`` folders and ``root/_current``, the name of the one that counts."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.files = spark, root.rstrip("/"), Files(spark)

    def stage(self, df: DataFrame) -> str:
        """Write the rows as a new version, which no reader sees yet; its name."""
        name = f"v-{uuid.uuid4().hex[:16]}"
        df.write.parquet(f"{self.root}/{name}")
        return name

    def complete(self, name: str) -> None:
        """Raise unless the version was written to its end."""
        if not self.files.exists(f"{self.root}/{name}/_SUCCESS"):
            raise ValueError(f"version {name} of {self.root} was not written completely")

    def publish(self, name: str) -> str:
        """Make a staged version the current one; its path."""
        self.complete(name)
        self.files.replace(f"{self.root}/{POINTER}", name)
        return f"{self.root}/{name}"

    def replace(self, df: DataFrame) -> str:
        return self.publish(self.stage(df))

    def current(self) -> str | None:
        """The path of the current version, or None."""
        name = self.files.read(f"{self.root}/{POINTER}")
        return f"{self.root}/{name.strip()}" if name else None

    def read(self) -> DataFrame:
        path = self.current()
        if path is None:
            raise ValueError(f"no version of {self.root} is published")
        return self.spark.read.parquet(path)

    def vacuum(self) -> list[str]:
        """Delete all versions but the current one (when no job reads or stages them); the names deleted."""
        keep = (self.current() or "").rsplit("/", 1)[-1]
        old = [v for v in self.files.folders(self.root) if v.startswith("v-") and v != keep]
        for v in old:
            self.files.delete(f"{self.root}/{v}")
        return old


class Lake:
    """The datasets under ``<base>/raw``, whose current versions one file names: a run publishes all of its datasets at once.

    A dataset that was never published is its folder as it is (files that something else put there).
    """

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.root, self.files = spark, f"{base.rstrip('/')}/raw", Files(spark)

    def _dataset(self, name: str) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.root}/{name}")

    def stage(self, dataset: str, df: DataFrame) -> str:
        return self._dataset(dataset).stage(df)

    def published(self) -> dict[str, str]:
        return json.loads(self.files.read(f"{self.root}/_published") or "{}")

    def publish(self, versions: dict[str, str]) -> None:
        """Switch the given datasets to staged versions in one step; the others stay."""
        for dataset, version in versions.items():
            self._dataset(dataset).complete(version)
        self.files.replace(f"{self.root}/_published", json.dumps({**self.published(), **versions}, sort_keys=True))

    def path(self, dataset: str) -> str:
        version = self.published().get(dataset)
        return f"{self.root}/{dataset}" + (f"/{version}" if version else "")


class Run:
    """The manifest of one ingest run: ``<base>/_runs/<id>/<source>`` holds the version that a source has staged."""

    def __init__(self, spark: SparkSession, base: str, run_id: str | None = None):
        self.id = run_id or uuid.uuid4().hex[:16]
        self.files, self.root = Files(spark), f"{base.rstrip('/')}/_runs/{self.id}"

    def version(self, source: str) -> str | None:
        return self.files.read(f"{self.root}/{source}")

    def record(self, source: str, version: str) -> None:
        self.files.replace(f"{self.root}/{source}", version)


# ---- reading files whose schemas have drifted apart ------------------------------------------

WHOLE = (ByteType, ShortType, IntegerType, LongType)


def wider(a: DataType, b: DataType) -> DataType:
    """The narrowest type for the values of both: wider whole numbers, doubles for any numbers, time stamps for dates; else text."""
    if a == b:
        return a
    kinds = {type(a), type(b)}
    if kinds <= set(WHOLE):
        return max(a, b, key=lambda t: WHOLE.index(type(t)))
    if kinds <= {*WHOLE, FloatType, DoubleType}:
        return DoubleType()
    if DateType in kinds and kinds <= {DateType, TimestampNTZType, TimestampType}:
        return b if isinstance(a, DateType) else a
    return StringType()


def as_type(c: Column, source: DataType, target: DataType) -> Column:
    """A cast; lists, maps and structs become JSON text."""
    if source == target:
        return c
    return F.to_json(c) if isinstance(source, (ArrayType, MapType, StructType)) else c.cast(target)


def read_drifted(spark: SparkSession, path: str) -> DataFrame:
    """All Parquet files under ``path``, columns matched by name, missing ones NULL, drifted types widened.

    Files whose schemas merge are one scan.  Where they do not (a column that
    was whole numbers and is text now), the files are halved until each part
    merges, and the parts are cast to the wider types: as many scans as there
    are stretches of files with one type, not one per file.
    """
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").option("mergeSchema", True)

    def parts(files: list[str] | None) -> list[DataFrame]:
        try:
            return [reader.parquet(*(files or [path]))]
        except Exception as e:  # noqa: BLE001 - only schemas that do not merge are handled
            if "CANNOT_MERGE" not in str(e):
                raise
            files = files or sorted(spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
                                    .format("binaryFile").load(path).inputFiles())
            if len(files) < 2:
                raise
            half = len(files) // 2
            return parts(files[:half]) + parts(files[half:])

    found = parts(None)
    if len(found) == 1:
        return found[0]
    types: dict[str, DataType] = {}
    for df in found:
        for f in df.schema.fields:
            types[f.name] = wider(types[f.name], f.dataType) if f.name in types else f.dataType
    out = None
    for df in found:
        have = {f.name: f.dataType for f in df.schema.fields}
        cast = df.select(*[as_type(F.col(f"`{n}`"), have[n], t).alias(n) if n in have else F.lit(None).cast(t).alias(n) for n, t in types.items()])
        out = cast if out is None else out.unionByName(cast)
    return out

