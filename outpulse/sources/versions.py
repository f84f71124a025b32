"""Tables of versioned partition folders, swapped by one rename of a manifest.

A table is a folder with ``data/<version>/_part=<value>/`` and
``manifest/<number>.json``.  A write puts whole new partitions into a version
folder of its own and then renames the next manifest into place; the rename
fails where that number exists.  Readers take the newest manifest and the
folders it names, so they see the table before a write or after it, never
half; a writer that dies leaves the old version, and folders nobody names.
The manifest holds one entry per partition value (a day or a bucket), never one
per row or file.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from outpulse.session import stabilise


class Conflict(RuntimeError):
    """Another writer has committed since the manifest was read."""


@dataclass(frozen=True)
class Manifest:
    number: int = 0
    schema: str | None = None
    parts: dict[str, str] = field(default_factory=dict)  # partition value as text -> folder below the table
    marks: dict[str, str] = field(default_factory=dict)  # of writers: what they have committed


class VersionedTable:
    """A partitioned Parquet table whose partitions are replaced together or not at all."""

    def __init__(self, spark: SparkSession, path: str, partition: str):
        self.spark, self.path, self.partition = spark, path.rstrip("/"), partition
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self):
        return self._at(self.path).getFileSystem(self._conf)

    def _numbers(self) -> list[int]:
        folder = self._at(f"{self.path}/manifest")
        if not self._fs().exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs().listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def manifest(self, number: int | None = None) -> Manifest:
        """The newest manifest, or an older one; an empty one where the table is new."""
        if number is None:
            number = max(self._numbers(), default=0)
        if not number:
            return Manifest()
        stream = self._fs().open(self._at(f"{self.path}/manifest/{number:012d}.json"))
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return Manifest(**json.loads(text))

    def read(self, values: Iterable | None = None, at: Manifest | None = None) -> DataFrame | None:
        """All rows, or those of some partition values, whose folders alone are listed; None where the table is new."""
        at = at or self.manifest()
        if at.schema is None:
            return None
        schema = StructType.fromJson(json.loads(at.schema))
        wanted = at.parts if values is None else {v: at.parts[v] for v in map(str, values) if v in at.parts}
        if not wanted:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{folder}" for folder in wanted.values()])

    def stage(self, rows: DataFrame) -> dict[str, str]:
        """Writes ``rows`` into a version folder nobody names yet; its partitions by value.

        Rows of a null partition value are an error, since such a partition
        could never be named.  Partitions with many rows are split over tasks.
        """
        version = f"data/{uuid.uuid4().hex}"
        part = F.coalesce(F.col(self.partition).cast("string"), F.raise_error(F.lit(f"{self.partition} is null")).cast("string"))
        rows.withColumn("_part", part).hint("rebalance", "_part").write.partitionBy("_part").parquet(f"{self.path}/{version}")
        found = self._fs().listStatus(self._at(f"{self.path}/{version}"))
        names = [s.getPath().getName() for s in found if s.isDirectory() and s.getPath().getName().startswith("_part=")]
        unescape = self._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
        return {unescape(n[len("_part="):]): f"{version}/{n}" for n in names}

    def publish(self, before: Manifest, schema: StructType, parts: dict[str, str], marks: dict[str, str]) -> Manifest:
        """Makes the manifest after ``before`` visible by one rename, or raises ``Conflict``."""
        after = Manifest(before.number + 1, schema.json(), parts, marks)
        fs, context = self._fs(), self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._at(self.path).toUri(), self._conf)
        hidden = self._at(f"{self.path}/manifest/.{uuid.uuid4().hex}")
        out = fs.create(hidden, False)
        try:
            out.write(bytearray(json.dumps(after.__dict__).encode()))
        finally:
            out.close()
        kind = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self.spark.sparkContext._gateway.new_array(kind, 1)
        options[0] = kind.NONE
        try:
            context.rename(hidden, self._at(f"{self.path}/manifest/{after.number:012d}.json"), options)
        except Exception as error:
            fs.delete(hidden, False)
            if "FileAlreadyExists" in str(error):
                raise Conflict(f"{self.path}: version {after.number} is there already") from error
            raise
        return after

    def replace(self, rows: DataFrame, gone: Iterable = (), marks: dict[str, str] | None = None, at: Manifest | None = None) -> Manifest:
        """Replaces the partitions that ``rows`` hold, drops those of ``gone``, keeps all others; one commit."""
        before = at or self.manifest()
        kept = {v: f for v, f in before.parts.items() if v not in set(map(str, gone))}
        return self.publish(before, rows.schema, {**kept, **self.stage(rows)}, {**before.marks, **(marks or {})})

    def overwrite(self, rows: DataFrame) -> Manifest:
        before = self.manifest()
        return self.publish(before, rows.schema, self.stage(rows), before.marks)

    def change(self, batch: DataFrame, merge: Callable[[DataFrame | None, DataFrame], DataFrame], marks: dict[str, str] | None = None, tries: int = 5) -> Manifest | None:
        """Replaces the partitions of ``batch`` by ``merge(old rows of them, batch)``.

        The batch is computed once.  A commit of another writer in between is met
        by merging anew with what it has left.
        """
        rows = stabilise(batch)
        values = [r[0] for r in rows.select(F.col(self.partition).cast("string")).distinct().collect()]  # one per partition
        if not values and not marks:
            return None
        for n in range(tries):
            at = self.manifest()
            try:
                return self.replace(merge(self.read(values, at), rows) if values else rows, (), marks, at)
            except Conflict:
                if n == tries - 1:
                    raise
        return None

    def expire(self, keep: int = 1) -> int:
        """Removes all but the newest ``keep`` manifests and the folders only they name; how many partitions went.

        Not to be run beside a writer, whose new folders no manifest names yet,
        or a reader of an older version.
        """
        numbers = self._numbers()
        named = {f for n in numbers[-keep:] for f in self.manifest(n).parts.values()}
        fs, removed = self._fs(), 0
        for n in numbers[:-keep]:
            fs.delete(self._at(f"{self.path}/manifest/{n:012d}.json"), False)
        data = self._at(f"{self.path}/data")
        for version in fs.listStatus(data) if fs.exists(data) else ():
            at = version.getPath()
            held = [s.getPath() for s in fs.listStatus(at) if s.getPath().getName().startswith("_part=")]
            unnamed = [p for p in held if f"data/{at.getName()}/{p.getName()}" not in named]
            for p in unnamed:
                fs.delete(p, True)
            removed += len(unnamed)
            if len(unnamed) == len(held):
                fs.delete(at, True)
        return removed
