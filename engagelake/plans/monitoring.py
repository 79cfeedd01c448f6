"""Monitoring: all rules over snapshots of the system, and the progress clock over a series of snapshots.

A snapshot is a row. The rules are data (``rules``): a key, a severity, a condition, and a
detail; conditions are SQL that any dialect reads. Rules that exclude one another say so in their conditions.

A probe that fails leaves fields null, or does not give the column at all. Each field then counts as ``MISSING`` says, which is
how a monitor must read it: a service of unknown status is stopped, a database that does not answer is unavailable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import bindings as b

# Limits of the rules.
LIMITS = {
    "stall_minutes": 30, "disk_critical_percent": 95, "disk_warning_percent": 85, "disk_min_free_bytes": 1024**3, "ram_warning_bytes": 100 * 1024**2,
    "swap_warning_percent": 90,
    "growth_bytes": 512 * 1024**2, "retry_growth": 25, "auth_errors": 5, "auth_errors_critical": 20, "rate_limits": 50, "errors": 100, "restarts": 3,
    "restarts_critical": 5, "constraints": 3,
}

# What a field counts as that a snapshot lacks. Of two more nothing is known: no earlier size, and no health of the worker
# from which a stall could be told.
MISSING = {
    "pg_present": "false", "pg_status": "'unknown'", "pg_health": "''", "pg_oom": "false", "pg_restarts": "0",
    "worker_present": "false", "worker_status": "'unknown'", "worker_health": "''", "worker_oom": "false", "worker_restarts": "0",
    "deploying": "false", "available": "false", "run_status": "'absent'", "run_error": "''", "active_runs": "0", "subscriptions_enabled": "false",
    "stale_running": "0", "rejected_jobs": "0", "constraints_found": "0", "schema_head": "''", "schema_revision": "''",
    "auth_24h": "0", "rate_24h": "0", "errors_24h": "0", "previous_bytes": "0", "database_bytes": "0",
    "pending": "0", "retry_wait": "0", "retry_in_seconds": "0", "stalled_minutes": "0", "run_changed": "true", "retries": "0",
    "tg_present": "false", "tg_readable": "false", "tg_count": "0", "vk_present": "false", "vk_readable": "false", "vk_count": "0",
    "disk_percent": "0", "disk_free": "0", "memory_available": "0", "swap_percent": "0",
    "runner_active": "false", "runner_enabled": "false", "runner_pid": "0", "deploy_status": "''", "git_sha": "''", "worker_revision": "''",
    "deploy_sha": "''", "backup_verified": "false", "state_corrupt": "false",
    "previous_age_hours": "CAST(NULL AS DOUBLE)", "previous_retries": "CAST(NULL AS BIGINT)",
}


def service_rules(key: str, p: str, when: str, limits: dict) -> list[tuple[str, str, str, str]]:
    """Rules of a service whose columns begin with ``p``; an absent one has no other issue."""
    there = f"{when} AND {p}_present"
    return [
        (f"{key}.absent", "critical", f"{when} AND NOT {p}_present", "'absent'"),
        (f"{key}.stopped", "critical", f"{there} AND {p}_status <> 'running'", f"{p}_status"),
        (f"{key}.unhealthy", "critical", f"{there} AND {p}_status = 'running' AND {p}_health NOT IN ('', 'healthy')", f"{p}_health"),
        (f"{key}.oom", "critical", f"{there} AND {p}_oom", "'oom'"),
        (f"{key}.restarts", "critical", f"{there} AND {p}_restarts >= {limits['restarts_critical']}", f"{p}_restarts"),
        (f"{key}.restarts", "warning", f"{there} AND {p}_restarts >= {limits['restarts']} AND {p}_restarts < {limits['restarts_critical']}",
        f"{p}_restarts"),
    ]


def token_rules(key: str, p: str, absent: str) -> list[tuple[str, str, str, str]]:
    return [
        (f"{key}_{absent}", "critical", f"NOT {p}_present", "'missing'"),
        (f"{key}_permission", "critical", f"{p}_present AND NOT {p}_readable", "'unreadable'"),
        (f"{key}_empty", "critical", f"{p}_present AND {p}_readable AND {p}_count = 0", "'empty'"),
    ]


_UP = "available"
_IDLE = "NOT deploying"
def rules(limits: dict = LIMITS) -> list[tuple[str, str, str, str]]:
    """(key, severity, condition, detail). Keys and severities are fixed values; so are the statuses that conditions name."""
    return [
        *service_rules("postgres", "pg", "TRUE", limits),
        *service_rules("worker", "worker", _IDLE, limits),
        ("database.unavailable", "critical", "NOT available", "'unavailable'"),
        ("collection.status", "critical", f"{_UP} AND run_status IN ('failed', 'cancelled', 'paused_no_tokens', 'paused_capacity_limit')", "run_status"),
        ("collection.status", "warning", f"{_UP} AND run_status = 'paused'", "run_status"),
        ("collection.method_limit_wait", "warning", f"{_UP} AND run_status = 'waiting_method_limit'", "run_status"),
        ("collection.error", "critical", f"{_UP} AND run_error <> ''", "run_error"),
        ("collection.no_active_run", "critical", f"{_UP} AND subscriptions_enabled AND active_runs = 0", "active_runs"),
        ("collection.stale_leases", "critical", f"{_UP} AND stale_running <> 0", "stale_running"),
        ("collection.verify", "critical", f"{_UP} AND rejected_jobs > 0", "rejected_jobs"),
        ("database.uniqueness_constraints", "critical", f"{_UP} AND constraints_found <> {limits['constraints']}", "constraints_found"),
        ("collection.multiple_active", "warning", f"{_UP} AND active_runs > 1", "active_runs"),
        ("database.alembic", "critical", f"{_UP} AND schema_head <> '' AND schema_revision <> schema_head", "schema_revision"),
        ("vk.auth_errors", "critical", f"{_UP} AND auth_24h >= {limits['auth_errors_critical']}", "auth_24h"),
        ("vk.auth_errors", "warning", f"{_UP} AND auth_24h >= {limits['auth_errors']} AND auth_24h < {limits['auth_errors_critical']}", "auth_24h"),
        ("vk.rate_limit", "warning", f"{_UP} AND rate_24h >= {limits['rate_limits']}", "rate_24h"),
        ("collection.errors", "warning", f"{_UP} AND errors_24h >= {limits['errors']}", "errors_24h"),
        (
            "database.growth", "warning",
            f"{_UP} AND previous_age_hours BETWEEN 20 AND 72 AND database_bytes - previous_bytes > greatest({limits['growth_bytes']}, floor(previous_bytes / 4))",
            "database_bytes - previous_bytes",
        ),
        (
            "collection.stalled", "critical",
            f"{_UP} AND run_status = 'running' AND pending > 0 AND worker_status = 'running' AND worker_health_known AND worker_health IN ('', 'healthy') AND {_IDLE}"
            f" AND NOT (retry_wait > 0 AND retry_in_seconds > 0) AND stalled_minutes >= {limits['stall_minutes']}", "stalled_minutes",
        ),
        ("collection.retry_spike", "warning", f"{_UP} AND NOT run_changed AND retries - coalesce(previous_retries, retries) >= {limits['retry_growth']}",
        "retries - previous_retries"),
        *token_rules("telegram.token", "tg", "missing"),
        *token_rules("vk.tokens", "vk", "missing"),
        ("resources.disk", "critical", f"disk_percent >= {limits['disk_critical_percent']}", "disk_percent"),
        (
            "resources.disk", "warning",
            f"disk_percent < {limits['disk_critical_percent']} AND (disk_percent >= {limits['disk_warning_percent']} OR (disk_free <> 0 AND disk_free < {limits['disk_min_free_bytes']}))",
            "disk_percent",
        ),
        ("resources.ram", "critical", f"memory_available <> 0 AND memory_available < {limits['ram_warning_bytes'] // 2}", "memory_available"),
        ("resources.ram", "warning", f"memory_available >= {limits['ram_warning_bytes'] // 2} AND memory_available < {limits['ram_warning_bytes']}",
        "memory_available"),
        ("resources.swap", "warning", f"swap_percent >= {limits['swap_warning_percent']}", "swap_percent"),
        ("runner.inactive", "critical", "NOT runner_active", "'inactive'"),
        ("runner.disabled", "critical", "NOT runner_enabled", "'disabled'"),
        ("runner.not_listening", "critical", "runner_active AND runner_pid <= 0", "runner_pid"),
        ("deployment.failed", "critical", f"{_IDLE} AND deploy_status NOT IN ('', 'success')", "deploy_status"),
        ("deployment.revision_mismatch", "critical", f"{_IDLE} AND git_sha <> '' AND worker_revision <> '' AND git_sha <> worker_revision",
        "worker_revision"),
        ("deployment.report_mismatch", "critical", f"{_IDLE} AND deploy_sha <> '' AND worker_revision <> '' AND deploy_sha <> worker_revision",
        "deploy_sha"),
        ("backup.unverified", "warning", f"{_IDLE} AND NOT backup_verified", "'unverified'"),
        ("monitor.state_corrupt", "warning", "state_corrupt", "'corrupt'"),
    ]


def completed(snapshots: DataFrame) -> DataFrame:
    """``snapshots`` with every field of ``MISSING``: what is null or not a column at all counts as that says."""
    there = set(snapshots.columns)
    known = F.col("worker_health").isNotNull() if "worker_health" in there else F.lit(False)
    return snapshots.select("id", known.alias("worker_health_known"), *(F.expr(f"coalesce({c}, {e})" if c in there else e).alias(c) for c,
        e in MISSING.items()))


def evaluated(snapshots: DataFrame, limits: dict = LIMITS) -> DataFrame:
    """(id, key, severity, detail, rank): every rule that holds for a snapshot, the most severe first, then by key. One pass, no shuffle.

    ``limits`` overrides some of ``LIMITS``.
    """
    held = [F.when(F.expr(condition), F.struct(F.lit(int(severity != "critical")).alias("o"), F.lit(key).alias("key"),
        F.lit(severity).alias("severity"), F.expr(detail).cast("string").alias("detail"))) for key, severity, condition, detail in rules(LIMITS | limits)]
    found = F.array_sort(F.filter(F.array(*held), lambda x: x.isNotNull()))
    return completed(snapshots).select("id", F.posexplode(found).alias("rank", "i")).select("id", "i.key", "i.severity", "i.detail", "rank")


#: Columns of made snapshots, one for each customer: most are well, each is off for some ids.
SNAPSHOT = {
    "pg_present": "i % 41 <> 0", "pg_status": "CASE WHEN i % 29 = 0 THEN 'exited' ELSE 'running' END",
    "pg_health": "CASE WHEN i % 31 = 0 THEN 'starting' WHEN i % 5 = 0 THEN '' ELSE 'healthy' END", "pg_oom": "i % 37 = 1",
    "pg_restarts": "i % 7 - i % 3",
    "worker_present": "i % 43 <> 0", "worker_status": "CASE WHEN i % 23 = 0 THEN 'paused' ELSE 'running' END",
    "worker_health": "CASE WHEN i % 19 = 0 THEN 'unhealthy' ELSE 'healthy' END", "worker_oom": "i % 47 = 2", "worker_restarts": "i % 6",
    "deploying": "i % 11 = 0", "available": "i % 53 <> 0", "run_error": "CASE WHEN i % 17 = 0 THEN 'lost' ELSE '' END", "active_runs": "i % 4",
    "subscriptions_enabled": "i % 2 = 0", "stale_running": "CASE WHEN i % 13 = 0 THEN i % 5 ELSE 0 END",
    "run_status": "CASE i % 9 WHEN 0 THEN 'failed' WHEN 1 THEN 'cancelled' WHEN 2 THEN 'paused_no_tokens' WHEN 3 THEN 'paused' WHEN 4 THEN 'waiting_method_limit' ELSE 'running' END",
    "rejected_jobs": "CASE WHEN i % 59 = 0 THEN 3 ELSE 0 END", "constraints_found": "CASE WHEN i % 61 = 0 THEN 2 ELSE 3 END",
    "schema_head": "CASE WHEN i % 6 = 0 THEN '' ELSE 'r9' END", "schema_revision": "CASE WHEN i % 10 = 0 THEN 'r8' ELSE 'r9' END",
    "auth_24h": "i % 25", "rate_24h": "i % 60", "errors_24h": "i % 110", "previous_age_hours": "CASE WHEN i % 8 <> 0 THEN i % 90 END",
    "previous_bytes": "1000000000 + i % 5 * 1000000000", "database_bytes": "2000000000 + i % 7 * 1000000000",
    "pending": "i % 3", "retry_wait": "i % 2", "retry_in_seconds": "CASE WHEN i % 3 = 0 THEN i % 50 END", "stalled_minutes": "i % 45",
    "run_changed": "i % 12 = 0", "retries": "i % 80", "previous_retries": "CASE WHEN i % 14 <> 0 THEN i % 33 END",
    "tg_present": "i % 67 <> 0", "tg_readable": "i % 22 <> 0", "tg_count": "i % 18", "vk_present": "i % 71 <> 0", "vk_readable": "i % 21 <> 0",
    "vk_count": "i % 16", "disk_percent": "i % 100", "disk_free": "i % 15 * 200000000",
    "memory_available": "i % 40 * 5000000", "swap_percent": "i % 97", "runner_active": "i % 27 <> 0", "runner_enabled": "i % 26 <> 0",
    "runner_pid": "i % 24 - 1", "deploy_status": "CASE i % 10 WHEN 0 THEN '' WHEN 1 THEN 'failed' ELSE 'success' END",
    "git_sha": "CASE WHEN i % 20 = 0 THEN '' ELSE 'a1' END",
    "worker_revision": "CASE WHEN i % 28 = 0 THEN '' WHEN i % 32 = 0 THEN 'b2' ELSE 'a1' END",
    "deploy_sha": "CASE WHEN i % 34 = 0 THEN 'c3' ELSE 'a1' END", "backup_verified": "i % 33 <> 0", "state_corrupt": "i % 73 = 0",
}
# a probe of each field fails now and then
SNAPSHOT = {c: f"CASE WHEN (i * 7 + {k}) % 101 = 0 THEN NULL ELSE {e} END" for k, (c, e) in enumerate(SNAPSHOT.items())}


def made_snapshots(spark, sf_dir) -> DataFrame:
    ids = b.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("i"))
    return ids.select(F.col("i").alias("id"), *(F.expr(e).alias(c) for c, e in SNAPSHOT.items()))


def monitor_issues(spark, sf_dir):
    """All rules over all snapshots."""
    return evaluated(made_snapshots(spark, sf_dir))


def monitor_issue_counts(spark, sf_dir):
    return evaluated(made_snapshots(spark, sf_dir)).groupBy("key", "severity").agg(F.count("*").alias("snapshots"))


def progress_clock(spark, sf_dir):
    """Per worker and check: when it last made progress, and for how many minutes it has not.

    The clock advances when finished work or requests have grown since the check before, or when the run has changed. A worker has a row
    an hour, so that ten windows of a few thousand rows a year are small however many calls there are.
    """
    hour = F.date_trunc("hour", F.col("ts").cast("timestamp")).cast("timestamp_ntz")
    checks = b.calls(spark, sf_dir).groupBy((F.col("token") % 10).alias("worker"),
        hour.alias("at")).agg(F.count_if((F.col("code") == 0) & (F.col("method") == "purchase")).alias("done"),
        F.max(F.floor(F.col("token") / 75)).alias("run"))
    w = W.partitionBy("worker").orderBy("at")
    moved = checks.select("worker", "at", "run", "done",
        (F.lag("run").over(w).isNull() | (F.lag("run").over(w) != F.col("run")) | (F.col("done") > 0)).alias("moved"))
    clock = moved.withColumn("progress_at", F.max(F.when(F.col("moved"), F.col("at"))).over(w))
    return clock.select("worker", "at", "progress_at",
        F.floor((F.unix_seconds(F.col("at").cast("timestamp")) - F.unix_seconds(F.col("progress_at").cast("timestamp"))) / 60).alias("stalled_minutes"))


_SNAPSHOTS = "snapshots AS (SELECT i AS id, " + ", ".join(f"{e} AS {c}" for c, e in SNAPSHOT.items()) + " FROM (SELECT c_custkey AS i FROM customer))"
# The twin is written from the specification of the monitor, not from ``rules``: nulls are tested where they stand.
_SERVICE = """SELECT id, '{key}.absent', 'critical', 'absent' FROM s WHERE {when} AND {p}_present IS NOT TRUE
    UNION ALL SELECT id, '{key}.stopped', 'critical', ifnull({p}_status, 'unknown') FROM s WHERE {when} AND {p}_present AND {p}_status IS DISTINCT FROM 'running'
    UNION ALL SELECT id, '{key}.unhealthy', 'critical', {p}_health FROM s WHERE {when} AND {p}_present AND {p}_status = 'running' AND {p}_health <> '' AND {p}_health <> 'healthy'
    UNION ALL SELECT id, '{key}.oom', 'critical', 'oom' FROM s WHERE {when} AND {p}_present AND {p}_oom
    UNION ALL SELECT id, '{key}.restarts', CASE WHEN {p}_restarts >= 5 THEN 'critical' ELSE 'warning' END, {p}_restarts::VARCHAR FROM s
        WHERE {when} AND {p}_present AND {p}_restarts >= 3"""
_TOKENS = """SELECT id, '{key}_' || CASE WHEN {p}_present IS NOT TRUE THEN 'missing' WHEN {p}_readable IS NOT TRUE THEN 'permission' ELSE 'empty' END,
    'critical', CASE WHEN {p}_present IS NOT TRUE THEN 'missing' WHEN {p}_readable IS NOT TRUE THEN 'unreadable' ELSE 'empty' END
    FROM s WHERE {p}_present IS NOT TRUE OR {p}_readable IS NOT TRUE OR ifnull({p}_count, 0) = 0"""
_HELD = f"""s AS (SELECT *, deploying IS NOT TRUE AS idle FROM snapshots), up AS (SELECT * FROM s WHERE available),
    held(id, key, severity, detail) AS (
    {_SERVICE.format(key="postgres", p="pg", when="TRUE")} UNION ALL {_SERVICE.format(key="worker", p="worker", when="idle")}
    UNION ALL {_TOKENS.format(key="telegram.token", p="tg")} UNION ALL {_TOKENS.format(key="vk.tokens", p="vk")}
    UNION ALL SELECT id, 'database.unavailable', 'critical', 'unavailable' FROM s WHERE available IS NOT TRUE
    UNION ALL SELECT id, 'collection.status', CASE run_status WHEN 'paused' THEN 'warning' ELSE 'critical' END, run_status FROM up
        WHERE run_status IN ('failed', 'cancelled', 'paused', 'paused_no_tokens', 'paused_capacity_limit')
    UNION ALL SELECT id, 'collection.method_limit_wait', 'warning', run_status FROM up WHERE run_status = 'waiting_method_limit'
    UNION ALL SELECT id, 'collection.error', 'critical', run_error FROM up WHERE length(run_error) > 0
    UNION ALL SELECT id, 'collection.no_active_run', 'critical', '0' FROM up WHERE subscriptions_enabled AND (active_runs IS NULL OR active_runs = 0)
    UNION ALL SELECT id, 'collection.stale_leases', 'critical', stale_running::VARCHAR FROM up WHERE stale_running <> 0
    UNION ALL SELECT id, 'collection.verify', 'critical', rejected_jobs::VARCHAR FROM up WHERE rejected_jobs > 0
    UNION ALL SELECT id, 'database.uniqueness_constraints', 'critical', ifnull(constraints_found, 0)::VARCHAR FROM up WHERE constraints_found IS DISTINCT FROM 3
    UNION ALL SELECT id, 'collection.multiple_active', 'warning', active_runs::VARCHAR FROM up WHERE active_runs > 1
    UNION ALL SELECT id, 'database.alembic', 'critical', ifnull(schema_revision, '') FROM up WHERE length(schema_head) > 0 AND schema_revision IS DISTINCT FROM schema_head
    UNION ALL SELECT id, 'vk.auth_errors', CASE WHEN auth_24h >= 20 THEN 'critical' ELSE 'warning' END, auth_24h::VARCHAR FROM up WHERE auth_24h >= 5
    UNION ALL SELECT id, 'vk.rate_limit', 'warning', rate_24h::VARCHAR FROM up WHERE rate_24h >= 50
    UNION ALL SELECT id, 'collection.errors', 'warning', errors_24h::VARCHAR FROM up WHERE errors_24h >= 100
    UNION ALL SELECT id, 'database.growth', 'warning', growth::VARCHAR FROM (SELECT *, ifnull(database_bytes, 0) - ifnull(previous_bytes, 0) AS growth FROM up)
        WHERE previous_age_hours >= 20 AND previous_age_hours <= 72 AND growth > 536870912 AND growth > ifnull(previous_bytes, 0) // 4
    UNION ALL SELECT id, 'collection.stalled', 'critical', stalled_minutes::VARCHAR FROM up WHERE run_status = 'running' AND pending > 0 AND worker_status = 'running'
        AND (worker_health = '' OR worker_health = 'healthy') AND idle AND stalled_minutes >= 30
        AND NOT (retry_wait IS NOT NULL AND retry_wait > 0 AND retry_in_seconds IS NOT NULL AND retry_in_seconds > 0)
    UNION ALL SELECT id, 'collection.retry_spike', 'warning', (ifnull(retries, 0) - previous_retries)::VARCHAR FROM up
        WHERE run_changed = FALSE AND previous_retries IS NOT NULL AND ifnull(retries, 0) - previous_retries >= 25
    UNION ALL SELECT id, 'resources.disk', CASE WHEN disk_percent >= 95 THEN 'critical' ELSE 'warning' END, ifnull(disk_percent, 0)::VARCHAR FROM s
        WHERE disk_percent >= 85 OR (disk_free > 0 AND disk_free < 1073741824)
    UNION ALL SELECT id, 'resources.ram', CASE WHEN memory_available < 52428800 THEN 'critical' ELSE 'warning' END, memory_available::VARCHAR FROM s
        WHERE memory_available > 0 AND memory_available < 104857600
    UNION ALL SELECT id, 'resources.swap', 'warning', swap_percent::VARCHAR FROM s WHERE swap_percent >= 90
    UNION ALL SELECT id, 'runner.inactive', 'critical', 'inactive' FROM s WHERE runner_active IS NOT TRUE
    UNION ALL SELECT id, 'runner.disabled', 'critical', 'disabled' FROM s WHERE runner_enabled IS NOT TRUE
    UNION ALL SELECT id, 'runner.not_listening', 'critical', ifnull(runner_pid, 0)::VARCHAR FROM s WHERE runner_active AND NOT ifnull(runner_pid, 0) > 0
    UNION ALL SELECT id, 'deployment.failed', 'critical', deploy_status FROM s WHERE idle AND length(deploy_status) > 0 AND deploy_status <> 'success'
    UNION ALL SELECT id, 'deployment.revision_mismatch', 'critical', worker_revision FROM s
        WHERE idle AND length(git_sha) > 0 AND length(worker_revision) > 0 AND git_sha <> worker_revision
    UNION ALL SELECT id, 'deployment.report_mismatch', 'critical', deploy_sha FROM s
        WHERE idle AND length(deploy_sha) > 0 AND length(worker_revision) > 0 AND deploy_sha <> worker_revision
    UNION ALL SELECT id, 'backup.unverified', 'warning', 'unverified' FROM s WHERE idle AND backup_verified IS NOT TRUE
    UNION ALL SELECT id, 'monitor.state_corrupt', 'warning', 'corrupt' FROM s WHERE state_corrupt)"""
QUERIES = {
    "monitor_issues": (monitor_issues, f"""WITH {_SNAPSHOTS}, {_HELD} SELECT *, CAST(row_number() OVER (PARTITION BY id ORDER BY severity,
        key) - 1 AS INT) AS rank FROM held"""),
    "monitor_issue_counts": (monitor_issue_counts, f"""WITH {_SNAPSHOTS}, {_HELD} SELECT key, severity, count(*) AS snapshots FROM held
        GROUP BY 1, 2"""),
    "progress_clock": (progress_clock, f"""WITH {b.CALLS_SQL}, c AS (SELECT token % 10 AS worker, date_trunc('hour', ts)::TIMESTAMP AS "at", count(*)
        FILTER (WHERE code = 0 AND method = 'purchase') AS done, max(token // 75) AS run FROM calls GROUP BY 1, 2),
        m AS (SELECT *, lag(run) OVER w IS DISTINCT FROM run OR done > 0 AS moved FROM c WINDOW w AS (PARTITION BY worker ORDER BY "at")),
        p AS (SELECT worker, "at", max("at") FILTER (WHERE moved) OVER (PARTITION BY worker ORDER BY "at") AS progress_at FROM m) SELECT *,
        CAST(floor(epoch("at" - progress_at) / 60) AS BIGINT) AS stalled_minutes FROM p"""),
}
