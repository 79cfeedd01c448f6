"""Queries over the queue, leases, breakers, clocks and alerts: pure transformations with a fixed moment."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import bindings as b
from ..functions import columns as c
from ..operators import windows
from ..sources import paged

READY = ("pending", "retry_wait")


def ready(jobs, as_of: str):
    return jobs.where(F.col("status").isin(*READY) & (F.col("next_attempt").isNull() | (F.col("next_attempt") <= b.moment(as_of))))


def claim(jobs, as_of: str, n: int):
    """The next ``n`` ready jobs by priority, age and number; they run, with one more attempt."""
    return ready(jobs, as_of).orderBy("priority", "created", "job_id").limit(n).withColumns({"status": F.lit("running"),
        "attempts": F.col("attempts") + 1})


def claim_order(spark, sf_dir):
    return claim(b.jobs(spark, sf_dir), "1999-01-01 00:00:00", 30).select("job_id", "status", "attempts")


def claim_per_type(spark, sf_dir):
    """A batch for each type of job."""
    top = windows.top_per_group(ready(b.jobs(spark, sf_dir), "1999-01-01 00:00:00"), ["job_type"],
        [F.asc("priority"), F.asc("created"), F.asc("job_id")], 20)
    return top.select("job_type", "job_id", "rank")


def lease_recovery(spark, sf_dir):
    """Running jobs whose lease is over are pending again, and the attempt does not count."""
    j = b.jobs(spark, sf_dir)
    over = (F.col("status") == "running") & (F.col("created") < b.moment("2000-01-01 00:00:00") - F.expr("INTERVAL 900 SECOND"))
    return j.where("status = 'running'").select("job_id", F.when(over, "pending").otherwise(F.col("status")).alias("status"),
        F.when(over, F.greatest(F.col("attempts") - 1, F.lit(0))).otherwise(F.col("attempts")).alias("attempts"),
        F.when(over, "lease_expired").alias("reason"))


def run_rollup(spark, sf_dir):
    """A run is done when nothing of it is active; with failures it is done with errors."""
    s = F.col("status")
    r = b.jobs(spark, sf_dir).groupBy("run_id").agg(F.count("*").alias("total"), F.count_if(s == "completed").alias("completed"),
        F.count_if(s == "failed").alias("failed"), F.count_if(s.isin("pending", "running", "retry_wait")).alias("active"))
    return r.select("run_id", "total", "completed", "failed", F.when(F.col("active") > 0, "running").when(F.col("failed") > 0,
        "completed_with_errors").otherwise("completed").alias("status"), c.percent_bucket(F.col("completed") + F.col("failed"),
        F.col("total")).alias("bucket"))


def miss_ladder(spark, sf_dir):
    """Three misses in a batch lead to single mode, two single misses are final."""
    misses = F.col("attempts")
    return b.jobs(spark, sf_dir).where("job_type = 'profile'").select("job_id", F.when(misses < 3, "batch").when(misses < 5,
        "single").otherwise("terminal").alias("mode"))


def breaker_cooldowns(spark, sf_dir):
    """Hits since the last success for each token, method and code; the cooldown doubles with each."""
    calls = windows.islands(b.calls(spark, sf_dir), ["token", "method"], [F.asc("ts"), F.asc("event_id")], F.col("code") == 0)
    hits = F.row_number().over(W.partitionBy("token", "method", "island", "code").orderBy("ts", "event_id"))
    return calls.where("code <> 0").select("event_id", hits.alias("hits"), c.cooldown(hits).alias("cooldown"))


def trailing_distinct_methods(spark, sf_dir):
    """Tokens whose limited methods in the last six hours are three or more: a global pause."""
    limited = b.calls(spark, sf_dir).where("code <> 0").withColumn("sec", F.unix_seconds(F.col("ts").cast("timestamp")))
    w = W.partitionBy("token").orderBy("sec").rangeBetween(-6 * 3600, 0)
    return limited.select("event_id", F.size(F.collect_set("method").over(w)).cast("long").alias("methods"),
        (F.size(F.collect_set("method").over(w)) >= 3).alias("escalates"))


def latest_cause(spark, sf_dir):
    return b.calls(spark, sf_dir).where("code <> 0").groupBy("token").agg(F.max_by("code", F.struct("ts", "event_id")).alias("code"),
        F.max("ts").alias("at"))


def next_available(spark, sf_dir):
    """Per token the latest of its clocks, over all tokens the earliest of these."""
    per = b.calls(spark, sf_dir).groupBy("token").agg(F.max("ts").alias("slot"), F.max(F.when(F.col("code") == 6,
        F.col("ts") + F.expr("INTERVAL 30 SECOND"))).alias("block"), F.max(F.when(F.col("code") == 9,
        F.col("ts") + F.expr("INTERVAL 1 HOUR"))).alias("probe"))
    return per.agg(F.min(F.greatest("slot", F.least("block", "probe"))).alias("next_available"), F.count("*").alias("tokens"))


def wakeup(spark, sf_dir):
    now = b.moment("1999-01-01 00:00:00")
    j = b.jobs(spark, sf_dir).where("status = 'retry_wait'")
    return j.agg(F.min(F.when(F.col("next_attempt") > now, F.col("next_attempt"))).alias("wakeup"),
        F.count_if(F.col("next_attempt") <= now).alias("due"))


def prefix_until_cutoff(spark, sf_dir):
    """A wall is read until its first old post that is not pinned; old pinned ones are skipped."""
    p = b.posts(spark, sf_dir).withColumn("pinned", F.col("post_id") % 10 == 0)
    old = F.col("published") < b.moment("1997-01-01 00:00:00")
    read = windows.until(p, ["group_id"], [F.desc("pinned"), F.desc("published"), F.asc("post_id")], old & ~F.col("pinned"))
    return read.where(~old).select("group_id", "post_id")


def snapshots(spark, sf_dir):
    """A series of daily snapshots of the calls: finished and pending work, retries, bytes."""
    day = F.date_trunc("day", F.col("ts").cast("timestamp")).cast("timestamp_ntz")
    d = b.calls(spark, sf_dir).groupBy(day.alias("day")).agg(F.count_if((F.col("code") == 0) & (F.col("token") < 10)).alias("completed"),
        F.count_if(F.col("code") == 9).alias("retries"), F.sum("k").alias("bytes"), F.count_if(F.col("code") == 6).alias("pending"))
    return d


def stall_flags(spark, sf_dir):
    """Days whose count did not grow over that of the day before, though work is pending."""
    w = W.partitionBy(F.lit(1)).orderBy("day")  # a row for each day
    return snapshots(spark, sf_dir).select("day", F.coalesce((F.col("completed") <= F.lag("completed").over(w)) & (F.col("pending") > 0),
        F.lit(False)).alias("stalled"), F.coalesce(F.col("retries") - F.lag("retries").over(w) >= 5, F.lit(False)).alias("retry_spike"),
        F.coalesce(F.col("bytes") - F.lag("bytes").over(w) > F.greatest(F.lit(100), F.floor(F.lag("bytes").over(w) / 20)),
        F.lit(False)).alias("growth"))


def trailing_24h(spark, sf_dir):
    now = b.moment(b.EVENTS_AS_OF)
    recent = F.col("ts") >= now - F.expr("INTERVAL 24 HOUR")
    return b.calls(spark, sf_dir).agg(F.count_if(recent).alias("calls"), F.count_if(recent & (F.col("method") == "error")).alias("errors"),
        F.count_if(recent & (F.col("code") == 9)).alias("rate_limited"), F.max("ts").alias("newest"))


def alert_cycles(spark, sf_dir):
    """Issues as hourly checks see them: a method's limited calls, critical with a long limit."""
    hour = F.date_trunc("hour", F.col("ts").cast("timestamp")).cast("timestamp_ntz")
    return b.calls(spark, sf_dir).where("code <> 0").groupBy(F.concat(F.lit("api."), "method").alias("key"),
        hour.alias("ts")).agg(F.when(F.max("code") == 9, "critical").otherwise("warning").alias("severity"))


def alert_dedup(spark, sf_dir, repeat_hours: int = 3):
    """Messages: an alert for a new key, a changed severity, or ``repeat_hours`` after the last one sent; a recovery in the first check without it.

    A fold over each key's checks in order, of which there is one in an hour at most.
    """
    hour = F.expr("INTERVAL 1 HOUR")
    checks = F.array_sort(F.collect_list(F.struct("ts", "severity")))
    messages = "array<struct<at:timestamp_ntz,kind:string,severity:string>>"
    state = f"struct<severity:string,sent:timestamp_ntz,seen:timestamp_ntz,out:{messages}>"
    message = lambda at, kind, severity: F.struct(at.alias("at"), F.lit(kind).alias("kind"), severity.alias("severity"))

    def step(acc, x):
        gone = F.coalesce(x["ts"] > acc["seen"] + hour, F.lit(False))
        due = acc["seen"].isNull() | gone | (acc["severity"] != x["severity"]) | (x["ts"] - acc["sent"] >= F.expr(f"INTERVAL {repeat_hours} HOUR"))
        news = F.concat(F.when(gone, F.array(message(acc["seen"] + hour, "recovery", acc["severity"]))).otherwise(F.array()),
            F.when(due, F.array(message(x["ts"], "alert", x["severity"]))).otherwise(F.array()))
        return F.struct(x["severity"].alias("severity"), F.when(due, x["ts"]).otherwise(acc["sent"]).alias("sent"), x["ts"].alias("seen"),
            F.concat(F.coalesce(acc["out"], F.array().cast(messages)), news).alias("out")).cast(state)

    def finish(acc):
        over = acc["seen"] + hour < b.moment(b.EVENTS_AS_OF)
        return F.concat(acc["out"], F.when(over, F.array(message(acc["seen"] + hour, "recovery", acc["severity"]))).otherwise(F.array()))

    folded = alert_cycles(spark, sf_dir).groupBy("key").agg(checks.alias("checks")).select("key",
        F.explode(F.aggregate("checks", F.lit(None).cast(state), step, finish)).alias("m"))
    return folded.select("key", "m.*")


def daily_once(spark, sf_dir):
    """The first event of each local day is the day's report."""
    local = F.to_date(F.col("ts") + F.expr("INTERVAL 3 HOUR")).cast("string")
    return b.table(spark, sf_dir, "events").groupBy(local.alias("day")).agg(F.min_by("event_id", F.struct("ts", "event_id")).alias("event_id"))


def page_walk(spark, sf_dir):
    """Pages of a wall: offsets, and whether a page is the last."""
    size = 4
    n = b.posts(spark, sf_dir).groupBy("group_id").agg(F.count("*").alias("total"))
    pages = n.select("group_id", "total", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("total") - 1) / size))).alias("page"))
    return pages.select("group_id", "page", (F.col("page") * size).alias("offset"),
        F.least(F.lit(size).cast("long"), F.col("total") - F.col("page") * size).alias("rows"),
        ((F.col("page") + 1) * size >= F.col("total")).alias("complete"))


def wall_pages(spark, sf_dir, size: int = 3):
    """Pages of the groups' walls as they have landed: some walls say that they are shorter than they are, and some pages are lost."""
    w = W.partitionBy("group_id").orderBy(F.desc("published"), "post_id")
    rows = b.posts(spark, sf_dir).select("group_id", (F.row_number().over(w) - 1).alias("k"))
    pages = rows.groupBy(F.col("group_id").cast("string").alias("target"), (F.floor(F.col("k") / size) * size).alias("offset")).agg(F.count("*").alias("items"))
    n = b.posts(spark, sf_dir).groupBy(F.col("group_id").cast("string").alias("target"), "group_id").agg(F.count("*").alias("n"))
    x = pages.join(n, "target").where(~((F.col("group_id") % 7 == 0) & (F.col("offset") == size)))
    return x.select("target", "offset", F.lit(size).cast("long").alias("asked"), "items", (F.col("n") - F.when(F.col("group_id") % 5 == 0,
        2).otherwise(0)).alias("total"))


def walked_pages(spark, sf_dir):
    """The pages that the walks over the walls take, by the stop rules, and why each walk ends."""
    return paged.walked(wall_pages(spark, sf_dir), maximum=12)


def tumbling_counts(spark, sf_dir):
    """Beyond the reference: events in windows of six hours."""
    w = F.window(F.col("ts").cast("timestamp"), "6 hours")
    return b.table(spark, sf_dir, "events").groupBy(w,
        "event_type").agg(F.count("*").alias("n")).select(F.col("window.start").cast("timestamp_ntz").alias("start"), "event_type", "n")


J, C = b.JOBS_SQL, b.CALLS_SQL
QUERIES = {
    "claim_order": (claim_order, f"""WITH {J} SELECT job_id, 'running' AS status, attempts + 1 AS attempts FROM jobs WHERE status IN
        ('pending','retry_wait') AND (next_attempt IS NULL OR next_attempt <= TIMESTAMP '1999-01-01') ORDER BY priority, created, job_id LIMIT 30"""),
    "claim_per_type": (claim_per_type, f"""WITH {J}, r AS (SELECT *, row_number() OVER (PARTITION BY job_type ORDER BY priority, created, job_id) AS
        rank FROM jobs WHERE status IN ('pending','retry_wait') AND (next_attempt IS NULL OR next_attempt <= TIMESTAMP '1999-01-01')) SELECT job_type,
        job_id, CAST(rank AS INT) AS rank FROM r WHERE rank <= 20"""),
    "lease_recovery": (lease_recovery, f"""WITH {J}, o AS (SELECT *, created < TIMESTAMP '2000-01-01' - INTERVAL 900 SECOND AS gone FROM jobs WHERE
        status = 'running') SELECT job_id, CASE WHEN gone THEN 'pending' ELSE status END AS status, CASE WHEN gone THEN greatest(attempts - 1, 0) ELSE
        attempts END AS attempts, CASE WHEN gone THEN 'lease_expired' END AS reason FROM o"""),
    "run_rollup": (run_rollup, f"""WITH {J}, r AS (SELECT run_id, count(*) AS total, count(*) FILTER (WHERE status = 'completed') AS completed,
        count(*) FILTER (WHERE status = 'failed') AS failed, count(*) FILTER (WHERE status IN ('pending','running','retry_wait')) AS active FROM jobs
        GROUP BY 1) SELECT run_id, total, completed, failed, CASE WHEN active > 0 THEN 'running' WHEN failed > 0 THEN 'completed_with_errors' ELSE
        'completed' END AS status, least(100, (completed + failed) * 100 // total) // 10 * 10 AS bucket FROM r"""),
    "miss_ladder": (miss_ladder, f"""WITH {J} SELECT job_id, CASE WHEN attempts < 3 THEN 'batch' WHEN attempts < 5 THEN 'single' ELSE 'terminal' END
        AS mode FROM jobs WHERE job_type = 'profile'"""),
    "breaker_cooldowns": (breaker_cooldowns, f"""WITH {C}, i AS (SELECT *, sum(CASE WHEN code = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY token, method
        ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS island FROM calls), h AS (SELECT event_id, row_number() OVER (PARTITION BY token, method,
        island, code ORDER BY ts, event_id) AS hits FROM i WHERE code <> 0) SELECT event_id, CAST(hits AS INT) AS hits, CAST(least(3600, 30 * pow(2,
        hits - 1)) AS BIGINT) AS cooldown FROM h"""),
    "trailing_distinct_methods": (trailing_distinct_methods, f"""WITH {C}, l AS (SELECT *, CAST(floor(epoch(ts)) AS BIGINT) AS sec FROM calls WHERE
        code <> 0), m AS (SELECT a.event_id, count(DISTINCT b.method) AS methods FROM l a JOIN l b ON a.token = b.token AND b.sec BETWEEN a.sec -
        21600 AND a.sec GROUP BY 1) SELECT event_id, methods, methods >= 3 AS escalates FROM m"""),
    "latest_cause": (latest_cause, f"""WITH {C} SELECT DISTINCT ON (token) token, code, ts AS at FROM calls WHERE code <> 0 ORDER BY token, ts DESC,
        event_id DESC"""),
    "next_available": (next_available, f"""WITH {C}, p AS (SELECT token, max(ts) AS slot, max(ts + INTERVAL 30 SECOND) FILTER (WHERE code = 6) AS
        block, max(ts + INTERVAL 1 HOUR) FILTER (WHERE code = 9) AS probe FROM calls GROUP BY 1) SELECT min(greatest(slot, least(block, probe))) AS
        next_available, count(*) AS tokens FROM p"""),
    "wakeup": (wakeup, f"""WITH {J} SELECT min(next_attempt) FILTER (WHERE next_attempt > TIMESTAMP '1999-01-01') AS wakeup, count(*) FILTER (WHERE
        next_attempt <= TIMESTAMP '1999-01-01') AS due FROM jobs WHERE status = 'retry_wait'"""),
    "prefix_until_cutoff": (prefix_until_cutoff, f"""WITH {b.POSTS_SQL}, s AS (SELECT *, sum(CASE WHEN published < TIMESTAMP '1997-01-01' AND post_id
        % 10 <> 0 THEN 1 ELSE 0 END) OVER (PARTITION BY group_id ORDER BY (post_id % 10 = 0) DESC, published DESC, post_id ROWS UNBOUNDED PRECEDING)
        AS seen FROM posts) SELECT group_id, post_id FROM s WHERE seen = 0 AND published >= TIMESTAMP '1997-01-01'"""),
    "stall_flags": (stall_flags, f"""WITH {C}, d AS (SELECT date_trunc('day', ts) AS day, count(*) FILTER (WHERE code = 0 AND token < 10) AS
        completed, count(*) FILTER (WHERE code = 9) AS retries, CAST(sum(k) AS BIGINT) AS bytes, count(*) FILTER (WHERE code = 6) AS pending FROM
        calls GROUP BY 1)
        SELECT CAST(day AS TIMESTAMP) AS day, coalesce(completed <= lag(completed) OVER w AND pending > 0, false) AS stalled, coalesce(retries -
        lag(retries) OVER w >= 5, false) AS retry_spike, coalesce(bytes - lag(bytes) OVER w > greatest(100, lag(bytes) OVER w // 20), false) AS growth
        FROM d WINDOW w AS (ORDER BY day)"""),
    "trailing_24h": (trailing_24h, f"""WITH {C} SELECT count(*) FILTER (WHERE ts >= TIMESTAMP '{b.EVENTS_AS_OF}' - INTERVAL 24 HOUR) AS calls,
        count(*) FILTER (WHERE ts >= TIMESTAMP '{b.EVENTS_AS_OF}' - INTERVAL 24 HOUR AND method = 'error') AS errors, count(*) FILTER (WHERE ts >=
        TIMESTAMP '{b.EVENTS_AS_OF}' - INTERVAL 24 HOUR AND code = 9) AS rate_limited, max(ts) AS newest FROM calls"""),
    # every check of a run is an hour after the one before: messages stand at each third row of a stretch of one severity
    "alert_dedup": (alert_dedup, f"""WITH {C}, a AS (SELECT 'api.' || method AS key, date_trunc('hour', ts)::TIMESTAMP AS ts, CASE WHEN max(code) = 9
        THEN 'critical' ELSE 'warning' END AS severity FROM calls WHERE code <> 0 GROUP BY 1, 2),
        r AS (SELECT *, ts - INTERVAL 1 HOUR * row_number() OVER (PARTITION BY key ORDER BY ts) AS run, lag(severity) OVER (PARTITION BY key ORDER BY
        ts) AS before FROM a),
        s AS (SELECT *, sum(CASE WHEN severity <> before THEN 1 ELSE 0 END) OVER (PARTITION BY key, run ORDER BY ts) AS stretch FROM r),
        n AS (SELECT *, row_number() OVER (PARTITION BY key, run, stretch ORDER BY ts) AS nth FROM s)
        SELECT key, ts AS at, 'alert' AS kind, severity FROM n WHERE nth % 3 = 1
        UNION ALL SELECT key, max(ts) + INTERVAL 1 HOUR, 'recovery', max_by(severity, ts) FROM a JOIN r USING (key, ts, severity) GROUP BY key, run
        HAVING max(ts) + INTERVAL 1 HOUR < TIMESTAMP '{b.EVENTS_AS_OF}'"""),
    "daily_once": (daily_once, """SELECT DISTINCT ON (day) CAST(CAST(ts + INTERVAL 3 HOUR AS DATE) AS VARCHAR) AS day, event_id FROM events ORDER BY
        day, ts, event_id"""),
    "page_walk": (page_walk, """WITH n AS (SELECT o_custkey AS group_id, count(*) AS total FROM orders GROUP BY 1), p AS (SELECT group_id, total,
        unnest(range((total + 3) // 4)) AS page FROM n) SELECT group_id, page, page * 4 AS offset, least(4, total - page * 4) AS rows, (page + 1) * 4
        >= total AS complete FROM p"""),
    "walked_pages": (walked_pages, f"""WITH RECURSIVE {b.POSTS_SQL}, r AS (SELECT group_id, row_number() OVER (PARTITION BY group_id ORDER BY published DESC,
        post_id) - 1 AS k, count(*) OVER (PARTITION BY group_id) AS n FROM posts), p AS (SELECT CAST(group_id AS VARCHAR) AS target, k // 3 * 3 AS "offset",
        CAST(3 AS BIGINT) AS asked, count(*) AS items, max(n) - CASE WHEN group_id % 5 = 0 THEN 2 ELSE 0 END AS total FROM r GROUP BY group_id, k // 3),
        q AS (SELECT *, CASE WHEN items = 0 THEN 'empty' WHEN items < asked THEN 'short' WHEN "offset" + items >= total THEN 'total' WHEN "offset" + items >= 12
        THEN 'maximum' END AS reason FROM p WHERE NOT (target::BIGINT % 7 = 0 AND "offset" = 3) AND "offset" < 12),
        walk AS (SELECT * FROM q WHERE "offset" = 0 UNION ALL SELECT q.* FROM walk w JOIN q ON q.target = w.target AND q."offset" = w."offset" + w.items WHERE
        w.reason IS NULL) SELECT target, "offset", asked, items, total, reason IS NOT NULL AS last, reason FROM walk"""),
    "tumbling_counts": (tumbling_counts, """SELECT time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '2024-01-01') AS start, event_type, count(*) AS n FROM
        events GROUP BY 1, 2"""),
}
