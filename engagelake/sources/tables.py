"""Versioned Parquet tables: each write adds folders, and a numbered manifest says which ones are the table."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import merge as keyed

_MANIFESTS = "_manifests"


class VersionedTable:
    """A keyed table that readers see whole: the readable manifest of the highest number is the current one.

    A write adds data first and its manifest last, under the next number, and never replaces a
    file: whenever it breaks off, the table is the one before. Two writers cannot both have a
    number; the later one fails. Rows are dealt to ``buckets`` by a hash of their keys, so that an upsert
    rewrites the buckets of its rows only. Folders go through Hadoop's file systems, so that
    any store that Spark reads will do.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str] | None = None, buckets: int = 1):
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), keys or [], buckets if keys else 1
        jvm = spark._jvm
        self._at = lambda p: jvm.org.apache.hadoop.fs.Path(p)
        self._fs = self._at(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _numbers(self) -> list[int]:
        """Numbers of manifests, the highest first."""
        folder = self._at(f"{self.path}/{_MANIFESTS}")
        if not self._fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return sorted((int(n) for n in names if n.isdigit()), reverse=True)

    def _manifest(self) -> dict | None:
        for number in self._numbers():
            try:
                text = "".join(r[0] for r in self.spark.read.text(f"{self.path}/{_MANIFESTS}/{number:012d}").collect())  # one line
                return json.loads(text) | {"number": number}
            except ValueError:  # broken off while it was written
                continue
        return None

    def exists(self) -> bool:
        return self._manifest() is not None

    def mark(self) -> int | None:
        m = self._manifest()
        return m and m["mark"]

    def _rows(self, manifest: dict, buckets: list[int] | None = None) -> DataFrame:
        schema = T.StructType.fromJson(manifest["schema"])
        folders = [f"{self.path}/{folder}" for b, folder in manifest["folders"].items() if buckets is None or int(b) in buckets]
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def read(self) -> DataFrame:
        m = self._manifest()
        if not m:
            raise FileNotFoundError(self.path)
        return self._rows(m)

    def _bucket(self):
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int") if self.keys else F.lit(0)

    def _add(self, df: DataFrame) -> dict[str, str]:
        """Writes rows to folders of their own: bucket -> folder."""
        version = f"v-{uuid.uuid4().hex}"
        df.withColumn("bucket_", self._bucket()).write.partitionBy("bucket_").parquet(f"{self.path}/{version}")
        found = [s.getPath().getName() for s in self._fs.listStatus(self._at(f"{self.path}/{version}"))]
        return {n.split("=")[1]: f"{version}/{n}" for n in found if n.startswith("bucket_=")}

    def _publish(self, folders: dict[str, str], schema: T.StructType, mark: int | None) -> None:
        number = max(self._numbers(), default=0) + 1
        line = json.dumps({"folders": folders, "schema": schema.jsonValue(), "mark": mark, "buckets": self.buckets})
        staged = f"{self.path}/_staged-{uuid.uuid4().hex}"
        stream = self._fs.create(self._at(staged), False)
        stream.write(bytearray(line.encode()))
        stream.close()
        self._fs.mkdirs(self._at(f"{self.path}/{_MANIFESTS}"))
        if not self._fs.rename(self._at(staged), self._at(f"{self.path}/{_MANIFESTS}/{number:012d}")):
            raise FileExistsError(f"another writer has taken version {number} of {self.path}")

    def write(self, df: DataFrame, mark: int | None = None) -> None:
        """Replaces the whole table."""
        self._publish(self._add(df), df.schema, mark)

    def upsert(self, rows: DataFrame, policy: dict[str, str], mark: int | None = None) -> None:
        """Merges rows (each key once) by key; buckets without any stay as they are."""
        m = self._manifest()
        if m is None:
            return self.write(rows, mark)
        if m["buckets"] != self.buckets:
            raise ValueError(f"{self.path} has {m['buckets']} buckets")
        touched = [r[0] for r in rows.select(self._bucket()).distinct().collect()]  # a row for each bucket
        old = self._rows(m, touched)
        merged = keyed.merge(old, rows.select(*old.columns), self.keys, policy)
        self._publish(m["folders"] | (self._add(merged) if touched else {}), old.schema, mark)

    def vacuum(self, keep: int = 2) -> None:
        """Deletes manifests but for the last ``keep``, and folders that none of these names; only what readers left long ago."""
        numbers = self._numbers()
        for number in numbers[keep:]:
            self._fs.delete(self._at(f"{self.path}/{_MANIFESTS}/{number:012d}"), False)
        named = set()
        for number in numbers[:keep]:
            text = "".join(r[0] for r in self.spark.read.text(f"{self.path}/{_MANIFESTS}/{number:012d}").collect())
            named |= {f.split("/")[0] for f in json.loads(text)["folders"].values()}
        for s in self._fs.listStatus(self._at(self.path)):
            if (name := s.getPath().getName()).startswith("v-") and name not in named:
                self._fs.delete(s.getPath(), True)
