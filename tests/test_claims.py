import datetime
from concurrent.futures import ThreadPoolExecutor

from engagelake import bindings as b
from engagelake.operators.claims import ClaimLog
from engagelake.plans import stateful

NOW = datetime.datetime(2024, 1, 1, tzinfo=datetime.UTC)


def test_two_claimants_get_disjoint_jobs(spark, sf_dir, tmp_path):
    ready = stateful.ready(b.jobs(spark, sf_dir), "1999-01-01 00:00:00").cache()

    def work(worker):
        log, out = ClaimLog(spark, str(tmp_path / "log"), every=3), []
        for _ in range(4):
            out.append(log.claim(ready, worker, 5, NOW))
        return out

    with ThreadPoolExecutor(3) as pool:
        got = list(pool.map(work, ["a", "b", "c"]))
    jobs = [j for w in got for batch in w for j in batch]
    order = [r.job_id for r in ready.orderBy("priority", "created", "job_id").limit(60).collect()]
    assert len(jobs) == len(set(jobs)) == 60 and set(jobs) == set(order)  # none twice, none passed over
    log = ClaimLog(spark, str(tmp_path / "log"), every=3)
    assert log.head() == 12 and (tmp_path / "log/sums/12/_SUCCESS").exists()
    held = {(r.job_id, r.worker) for r in log.state(12).collect()}
    assert held == {(j, w) for w, batches in zip("abc", got, strict=True) for x in batches for j in x}


def test_leases_and_finished_jobs(spark, tmp_path):
    ready = spark.createDataFrame([(i, i % 2, NOW) for i in range(6)], "job_id long, priority int, created timestamp")
    log = ClaimLog(spark, str(tmp_path / "log"), lease_seconds=60)
    assert log.claim(ready, "a", 2, NOW) == [0, 2] and log.claim(ready, "b", 2, NOW) == [4, 1]
    assert log.finish("a", [0, 4], NOW) == [0]  # 4 is not a's
    later = NOW + datetime.timedelta(seconds=61)
    assert log.finish("a", [2], later) == []  # its lease is over
    assert log.claim(ready, "c", 9, later) == [2, 4, 1, 3, 5] and log.claim(ready, "c", 9, later) == []
    assert log.finish("c", range(9), later) == [1, 2, 3, 4, 5] and log.claim(ready, "d", 9, later + datetime.timedelta(days=1)) == []
