"""Pages of a remote walk as a source: landed as files, read as rows, resumed where the walk was.

A page answers a request (target, offset, size) with a total and some items; the walk of a target goes on from offset + items until a page is empty,
is short, reaches the total, or the walk's maximum is reached. ``land`` writes a page as ``<target>/<offset>-<asked>-<items>-<total>.json``:
what the stop rules need is in the name, so that a walk is followed by listing names, and only tasks read contents.

* ``read``, ``stream``: the Python data source ``landed_pages``. A stream's offset is where each target's walk is; it lists at most ``most_targets``
  targets, more fail: they take several streams, or
* ``walked``: the same rules as windows over a table of pages, for any number of targets.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from . import files

SCHEMA = "target string, offset long, position int, total long, item string"


def land(spark: SparkSession, path: str, target: str, offset: int, asked: int, total: int, items: Sequence[dict]) -> bool:
    """Writes a page unless it has landed already."""
    name = f"{offset:012d}-{asked}-{len(items)}-{total}.json"
    return files.put_new(spark, f"{path}/{target}/{name}", json.dumps({"count": total, "items": list(items)}))


def stops(offset: int, asked: int, items: int, total: int, maximum: int) -> bool:
    """Whether a walk ends with this page."""
    return items == 0 or items < asked or offset + items >= total or offset + items >= maximum


class Page(InputPartition):
    def __init__(self, path: str, target: str, offset: int):
        self.path, self.target, self.offset = path, target, offset


class Store:
    """The landed pages of a folder of any store that pyarrow knows."""

    def __init__(self, options: dict):
        self.path, self.maximum = options["path"], int(options.get("maximum", 1 << 60))
        self.most_targets = int(options.get("most_targets", 10_000))

    def folder(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.path) if "://" in self.path else (fs.LocalFileSystem(), self.path)

    def landed(self) -> dict[str, dict[int, tuple[int, int, int, str]]]:
        """target -> offset -> (asked, items, total, name)."""
        from pyarrow import fs

        store, root = self.folder()
        out: dict[str, dict] = {}
        for f in store.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)):
            if f.is_file and f.base_name.endswith(".json") and not f.base_name.startswith("."):
                offset, asked, items, total = map(int, f.base_name[:-5].split("-"))
                out.setdefault(f.path.rstrip("/").split("/")[-2], {})[offset] = (asked, items, total, f.path)
        if len(out) > self.most_targets:
            raise ValueError(f"{len(out)} targets: a stream follows {self.most_targets} at most")
        return out

    def walk(self, pages: dict[int, tuple], offset: int) -> Iterator[tuple[int, str, int]]:
        """(offset, path, where the walk is after it; below zero: at its end) of the pages from ``offset`` on that have landed."""
        while 0 <= offset < self.maximum and offset in pages:
            asked, items, total, path = pages[offset]
            after = offset + items
            after = -1 - after if stops(offset, asked, items, total, self.maximum) else after
            yield offset, path, after
            offset = after

    def rows(self, page: Page) -> Iterator[tuple]:
        store, _ = self.folder()
        with store.open_input_stream(page.path) as f:
            body = json.loads(f.read())
        for k, item in enumerate(body["items"][: max(0, self.maximum - page.offset)]):
            yield page.target, page.offset, k, body["count"], json.dumps(item, sort_keys=True, ensure_ascii=False)


class Walked(DataSourceReader):
    def __init__(self, store: Store):
        self.store = store

    def partitions(self) -> list[Page]:
        return [Page(path, t, o) for t, pages in sorted(self.store.landed().items()) for o, path, _ in self.store.walk(pages, 0)] or [Page("", "", 0)]

    def read(self, page: Page) -> Iterator[tuple]:
        yield from self.store.rows(page) if page.path else ()


class Walking(DataSourceStreamReader):
    """An offset is {target: where its walk is}; a walk at its end is below zero and stays there, whatever lands later.

    Pages do not change once they have landed, so that a reader that is started anew finds the same walks from their names.
    """

    def __init__(self, store: Store):
        self.store, self.at = store, {}

    def initialOffset(self) -> dict:  # noqa: N802
        return {}

    def latestOffset(self) -> dict:  # noqa: N802
        for target, pages in self.store.landed().items():
            for _, _, after in self.store.walk(pages, self.at.get(target, 0)):
                self.at[target] = after
        return dict(sorted(self.at.items()))

    def partitions(self, start: dict, end: dict) -> list[Page]:
        out, landed = [], self.store.landed()
        for target, upto in end.items():
            at = start.get(target, 0)
            for offset, path, after in self.store.walk(landed[target], at) if at != upto else ():
                out.append(Page(path, target, offset))
                if after == upto:
                    break
        return out or [Page("", "", 0)]

    def read(self, page: Page) -> Iterator[tuple]:
        yield from self.store.rows(page) if page.path else ()


class LandedPages(DataSource):
    @classmethod
    def name(cls) -> str:
        return "landed_pages"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return Walked(Store(self.options))

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:  # noqa: N802
        return Walking(Store(self.options))


def read(spark: SparkSession, path: str, maximum: int | None = None) -> DataFrame:
    """All items (SCHEMA) that the walks over the landed pages take."""
    spark.dataSource.register(LandedPages)
    options = {"path": path} | ({} if maximum is None else {"maximum": str(maximum)})
    return spark.read.format("landed_pages").options(**options).load()


def stream(spark: SparkSession, path: str, maximum: int | None = None) -> DataFrame:
    """As ``read``, as pages land; a query that is started again goes on where its walks were."""
    spark.dataSource.register(LandedPages)
    options = {"path": path} | ({} if maximum is None else {"maximum": str(maximum)})
    return spark.readStream.format("landed_pages").options(**options).load()


def walked(pages: DataFrame, maximum: int = 1 << 60) -> DataFrame:
    """The pages (target, offset, asked, items, total) that walks take: from offset 0, each where the one before has ended, none after a stop.

    Adds ``last`` (the walk ends with it) and ``reason`` (empty, short, total, maximum; null where it does not end). Of pages that landed twice
    the one with more items counts.
    """
    once = pages.groupBy("target", "offset").agg(F.max_by(F.struct("asked", "items", "total"), F.struct("items", "total", "asked")).alias("p"))
    once = once.select("target", "offset", "p.*").where(F.col("offset") < maximum)
    end = F.col("offset") + F.col("items")
    reason = F.when(F.col("items") == 0, "empty").when(F.col("items") < F.col("asked"), "short").when(end >= F.col("total"),
        "total").when(end >= maximum, "maximum")
    w = W.partitionBy("target").orderBy("offset")
    before = w.rowsBetween(W.unboundedPreceding, -1)
    x = once.withColumn("reason", reason).withColumns({"expected": F.coalesce(F.lag(end).over(w), F.lit(0))})
    x = x.withColumn("bad", (F.col("offset") != F.col("expected")) | F.coalesce(F.lag("reason").over(w).isNotNull(), F.lit(False)))
    x = x.withColumn("broken", F.col("bad") | F.coalesce(F.max("bad").over(before), F.lit(False)))
    return x.where(~F.col("broken")).select("target", "offset", "asked", "items", "total", F.col("reason").isNotNull().alias("last"), "reason")
