"""Claiming of jobs by several workers without a lock: a log whose next entry only one of them can write.

An entry is a small file with the next number, made by ``files.put_new``. A worker reads the log, picks the next ready jobs that nobody holds, and writes
them as entry n + 1; if another has written that entry meanwhile, its pick is void and it picks again from the longer log. So two workers
never hold one job, and a worker that dies holds its jobs until their lease is over. Every ``every`` entries whoever wrote the last one sums the log up as
a table, so that what is read does not grow with the past.
"""

from __future__ import annotations

import datetime
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import files

ENTRY = "job_id long, worker string, until double, done boolean"


class ClaimLog:
    def __init__(self, spark: SparkSession, path: str, lease_seconds: int = 900, every: int = 50):
        self.spark, self.path, self.lease_seconds, self.every = spark, path, lease_seconds, every

    def head(self) -> int:
        """The number of the last entry; 0 of an empty log."""
        return max((int(n.split(".")[0]) for n in files.names(self.spark, f"{self.path}/log") if n[0].isdigit()), default=0)

    def state(self, head: int) -> DataFrame:
        """(job_id, worker, until, done) by the last entry of each job, up to ``head``."""
        sums = [int(n) for n in files.names(self.spark, f"{self.path}/sums") if files.exists(self.spark, f"{self.path}/sums/{n}/_SUCCESS")]
        start = max((n for n in sums if n <= head), default=0)
        late = [f"{self.path}/log/{n:012d}.json" for n in range(start + 1, head + 1)]
        number = F.regexp_extract(F.input_file_name(), r"(\d+)\.json$", 1).cast("long")
        rows = self.spark.read.schema(ENTRY).json(late).withColumn("n", number) if late else self.spark.createDataFrame([], f"{ENTRY}, n long")
        if start:
            rows = rows.unionByName(self.spark.read.parquet(f"{self.path}/sums/{start}").withColumn("n", F.lit(start).cast("long")))
        last = rows.groupBy("job_id").agg(F.max_by(F.struct("worker", "until", "done"), "n").alias("x"))
        return last.select("job_id", "x.*")

    def append(self, head: int, rows: Sequence[dict]) -> bool:
        """Writes entry ``head`` + 1; False if another worker has."""
        text = "".join(json.dumps(r) + "\n" for r in rows)
        won = files.put_new(self.spark, f"{self.path}/log/{head + 1:012d}.json", text)
        if won and (head + 1) % self.every == 0:
            self.state(head + 1).write.mode("overwrite").parquet(f"{self.path}/sums/{head + 1}")
        return won

    def claim(self, ready: DataFrame, worker: str, n: int, now: datetime.datetime) -> list[int]:
        """The next ``n`` jobs of ``ready`` (job_id, priority, created) that are neither done nor held by a lease; they are the worker's from now on."""
        at = now.timestamp()
        while True:
            head = self.head()
            taken = self.state(head).where(F.col("done") | (F.col("until") > at)).select("job_id")
            free = ready.select("job_id", "priority", "created").join(taken, "job_id", "left_anti")
            jobs = [r.job_id for r in free.orderBy("priority", "created", "job_id").limit(n).collect()]
            if not jobs or self.append(head, [{"job_id": j, "worker": worker, "until": at + self.lease_seconds, "done": False} for j in jobs]):
                return jobs

    def finish(self, worker: str, jobs: Sequence[int], now: datetime.datetime) -> list[int]:
        """Jobs are done; only those that the worker still holds, which are given back."""
        at = now.timestamp()
        while True:
            head = self.head()
            held = self.state(head).where((F.col("worker") == worker) & ~F.col("done") & (F.col("until") > at) & F.col("job_id").isin(list(jobs)))
            own = sorted(r.job_id for r in held.collect())
            if not own or self.append(head, [{"job_id": j, "worker": worker, "until": at, "done": True} for j in own]):
                return own
