"""Tables whose reloads are one commit.

A table is a set of partition folders and numbered manifests; a manifest names
the folder that is current for each partition.  A reload writes new folders next
to the old ones and then publishes the next manifest by one rename: readers see
either all of it or nothing, a stopped reload leaves only unnamed folders, and of
two writers that start from the same manifest one fails.  Manifests also record
the last batch of a stream, so that a replayed batch is not applied twice.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PART = "__part"


class ConflictError(RuntimeError):
    """Another writer has published a manifest meanwhile."""


@dataclass
class Manifest:
    number: int = 0
    schema: str | None = None
    folders: dict[str, str] = field(default_factory=dict)   # partition value -> folder below the table
    batches: dict[str, int] = field(default_factory=dict)   # stream -> last batch applied


class SnapshotTable:
    """A partitioned table below ``path`` on any Hadoop file system; ``by`` is the partition column (as text)."""

    def __init__(self, spark: SparkSession, path: str, by: str):
        self.spark, self.path, self.by = spark, path.rstrip("/"), by
        self._Path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._Path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, *names: str):
        return self._Path("/".join([self.path, *names]))

    def _numbers(self) -> list[int]:
        folder = self._at("_manifests")
        if not self._fs.exists(folder):
            return []
        names = [f.getPath().getName() for f in self._fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def manifest(self, number: int | None = None) -> Manifest:
        """The current manifest, or an earlier one."""
        numbers = self._numbers()
        if not numbers:
            return Manifest()
        stream = self._fs.open(self._at("_manifests", f"{number or numbers[-1]}.json"))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return Manifest(**json.loads(text))

    def _publish(self, now: Manifest) -> None:
        text = json.dumps({"number": now.number, "schema": now.schema, "folders": now.folders, "batches": now.batches})
        draft = self._at("_manifests", f".{uuid.uuid4().hex}.draft")
        out = self._fs.create(draft)
        out.write(text.encode())
        out.close()
        target = self._at("_manifests", f"{now.number}.json")
        if self._fs.exists(target) or not self._fs.rename(draft, target):
            self._fs.delete(draft, False)
            raise ConflictError(f"{self.path}: manifest {now.number} exists")

    def read(self, number: int | None = None, parts: Sequence[str] | None = None) -> DataFrame:
        """The rows of the current manifest (or of an earlier one), of some partitions if named."""
        now = self.manifest(number)
        if now.schema is None:
            raise ValueError(f"{self.path} holds no manifest")
        schema = T.StructType.fromJson(json.loads(now.schema))
        folders = sorted({f for p, f in now.folders.items() if parts is None or p in parts})
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{f}" for f in folders])

    def write_parts(self, df: DataFrame) -> dict[str, str]:
        """Write ``df`` by partition into new folders that no manifest names yet: partition value -> folder."""
        version = f"data/{uuid.uuid4().hex[:12]}"
        part = F.coalesce(F.col(self.by).cast("string"), F.lit("__null"))
        # the folder is named by a hash: a value may hold any character
        hashed = F.sha2(part, 256)
        df.withColumn(_PART, hashed).write.partitionBy(_PART).parquet(f"{self.path}/{version}")
        written = self.spark.read.parquet(f"{self.path}/{version}") if self._any(version) else None
        if written is None:
            return {}
        # one row for each partition written
        rows = written.select(F.coalesce(F.col(self.by).cast("string"), F.lit("__null")).alias("p"), _PART).distinct().collect()
        return {r["p"]: f"{version}/{_PART}={r[_PART]}" for r in rows}

    def _any(self, folder: str) -> bool:
        return any(f.isDirectory() for f in self._fs.listStatus(self._at(*folder.split("/"))))

    def commit(self, base: Manifest, schema: T.StructType, folders: dict[str, str], gone: Sequence[str] = (),
               batch: tuple[str, int] | None = None) -> Manifest:
        """Publish ``base`` with new folders for some partitions and without those ``gone``: one rename."""
        kept = {p: f for p, f in base.folders.items() if p not in gone}
        now = Manifest(base.number + 1, schema.json(), kept | folders, dict(base.batches))
        if batch is not None:
            now.batches[batch[0]] = batch[1]
        self._publish(now)
        return now

    def replace(self, df: DataFrame, parts: Sequence[str] = ()) -> Manifest:
        """Replace the partitions found in ``df``; of ``parts``, those without a row now disappear."""
        base = self.manifest()
        folders = self.write_parts(df)
        return self.commit(base, df.schema, folders, gone=[p for p in parts if p not in folders])

    def expire(self, keep: int = 2) -> int:
        """Delete all but the last ``keep`` manifests and the folders that none of those names."""
        numbers = self._numbers()
        named = {f.split("/")[1] for n in numbers[-keep:] for f in self.manifest(n).folders.values()}
        for n in numbers[:-keep]:
            self._fs.delete(self._at("_manifests", f"{n}.json"), False)
        gone = 0
        if self._fs.exists(self._at("data")):
            for f in self._fs.listStatus(self._at("data")):
                if f.getPath().getName() not in named:
                    self._fs.delete(f.getPath(), True)
                    gone += 1
        return gone
