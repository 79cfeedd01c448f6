"""Capacity of a campaign: what a measured pilot says of the growth of the whole, and what stands against it.

One row for each plan; every number is a column, so that any number of plans is judged in one pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import bindings as b

# The least reserve, bytes of a safe database, bytes of a snapshot's row and of its key.
RESERVE, SAFE_BYTES, ROW_BYTES, KEY_BYTES = 1.30, 7 * 1024**3, 64, 48


def aggregate_capacity(plans: DataFrame, warning_percent: float = 85.0, safe_bytes: int = SAFE_BYTES, min_free: int = 0) -> DataFrame:
    """``plans`` with growth, projections, reasons and decision.

    Columns: snapshot_users, resolved_users, due_users, heap_bytes, key_bytes (of the snapshot), target_users, target_growth, reserve (of the pilot's
    report), database_bytes, disk_total, disk_free, disk_warning, disk_stop. Nulls are numbers that the preview or the report has not: counts are then
    wrong, sizes are nothing, and a plan without a measured growth never passes.
    """
    n = lambda c, d: F.coalesce(F.col(c), F.lit(d))
    snapshot, resolved, due = (n(c, -1) for c in ("snapshot_users", "resolved_users", "due_users"))
    measured = (F.col("target_users") > 0) & F.col("target_growth").isNotNull()
    product = F.col("target_growth").cast("decimal(19,0)") * due.cast("decimal(19,0)")  # of two longs: more than a long holds
    discovery = F.when(measured, F.ceil(product.cast("double") / F.col("target_users").cast("double"))).otherwise(0)
    reserve = F.greatest(F.lit(RESERVE), n("reserve", 0.0))
    x = plans.withColumns({"discovery_growth": discovery.cast("long"),
        "snapshot_growth": F.ceil((n("heap_bytes", 0) + n("key_bytes", 0)) * reserve).cast("long"), "reserve_factor": reserve})
    x = x.withColumn("growth", F.col("discovery_growth") + F.col("snapshot_growth"))
    used = F.when(F.col("disk_total") > 0, 100.0 * (F.col("disk_total") - F.col("disk_free") + F.col("growth")) / F.col("disk_total")).otherwise(100.0)
    disk_room = F.greatest(F.lit(0), F.col("disk_free") - min_free)
    x = x.withColumns({"projected_database": F.col("database_bytes") + F.col("growth"), "projected_used": used,
        "available": F.least(F.greatest(F.lit(0), safe_bytes - F.col("database_bytes")), disk_room)})
    bad = {
        "negative_counts": (snapshot < 0) | (resolved < 0) | (due < 0), "counts_do_not_add_up": resolved + due != snapshot,
        "no_target": ~F.coalesce(F.col("target_users") > 0, F.lit(False)), "no_growth_measured": ~F.coalesce(F.col("target_growth") > 0, F.lit(False)),
        "negative_snapshot": (n("heap_bytes", 0) < 0) | (n("key_bytes", 0) < 0),
        "wrong_measurements": (F.col("database_bytes") < 0) | (F.col("disk_free") < 0) | (F.col("disk_total") <= 0),
        "database_limit": F.col("projected_database") > safe_bytes, "disk_room": F.col("growth") > disk_room,
        "disk_warning": F.col("disk_warning") | F.col("disk_stop") | (F.col("projected_used") >= warning_percent),
    }
    reasons = F.filter(F.array(*(F.when(F.coalesce(holds, F.lit(False)), name) for name, holds in bad.items())), lambda r: r.isNotNull())
    x = x.withColumn("reasons", reasons).withColumn("additional", F.greatest(F.lit(0), F.col("growth") - F.col("available")))
    return x.withColumn("decision", F.when(F.size("reasons") == 0, "passed").otherwise("rejected"))


#: Plans made from the customers' keys.
_PLAN = {
    "plan_id": "c_custkey", "snapshot_users": "CASE WHEN c_custkey % 31 = 0 THEN NULL ELSE c_custkey * 100 END",
    "resolved_users": "c_custkey * 40", "due_users": "c_custkey * 60 + CASE WHEN c_custkey % 17 = 0 THEN 1 ELSE 0 END",
    "heap_bytes": "c_custkey * 6400", "key_bytes": "CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_custkey * 4800 END",
    "target_users": "CASE c_custkey % 11 WHEN 0 THEN NULL WHEN 1 THEN 0 ELSE 10000 END", "target_growth": "CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE c_custkey * 1000000 + 7 END",
    "reserve": "CASE c_custkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 1.5 ELSE 1.1 END", "database_bytes": "c_custkey % 8 * 1000000000",
    "disk_total": "CASE WHEN c_custkey % 41 = 0 THEN 0 ELSE 10737418240 END", "disk_free": "(1 + c_custkey % 10) * 1000000000",
    "disk_warning": "c_custkey % 23 = 0", "disk_stop": "c_custkey % 29 = 0",
}


def plan_capacity(spark, sf_dir):
    plans = b.table(spark, sf_dir, "customer").select(*(F.expr(e).cast("double" if n == "reserve" else "boolean" if n in ("disk_warning",
        "disk_stop") else "long").alias(n) for n, e in _PLAN.items()))
    return aggregate_capacity(plans).select("plan_id", "discovery_growth", "snapshot_growth", "growth", "projected_database", F.round("projected_used",
        6).alias("projected_used"), "available", "additional", "decision", F.array_join("reasons", ",").alias("reasons"))


QUERIES = {
    "plan_capacity": (plan_capacity, f"""WITH p AS (SELECT {', '.join(f'{e} AS {n}' for n, e in _PLAN.items())} FROM customer),
        a AS (SELECT *, CAST(CASE WHEN target_users > 0 AND target_growth IS NOT NULL THEN ceil(target_growth * due_users / target_users::DOUBLE) ELSE 0 END AS
        BIGINT) AS discovery_growth, CAST(ceil((heap_bytes + ifnull(key_bytes, 0)) * greatest(1.3::DOUBLE, ifnull(reserve, 0)::DOUBLE)) AS BIGINT) AS snapshot_growth FROM p),
        g AS (SELECT *, discovery_growth + snapshot_growth AS growth FROM a), u AS (SELECT *, database_bytes + growth AS projected_database, CASE WHEN
        disk_total > 0 THEN 100.0::DOUBLE * (disk_total - disk_free + growth) / disk_total ELSE 100 END AS used,
        least(greatest(0, {SAFE_BYTES} - database_bytes), disk_free) AS available FROM g),
        r AS (SELECT *, concat_ws(',', CASE WHEN snapshot_users IS NULL THEN 'negative_counts' END,
        CASE WHEN resolved_users + due_users <> ifnull(snapshot_users, -1) THEN 'counts_do_not_add_up' END,
        CASE WHEN target_users IS NULL OR target_users <= 0 THEN 'no_target' END, CASE WHEN target_growth IS NULL THEN 'no_growth_measured' END,
        CASE WHEN disk_total <= 0 THEN 'wrong_measurements' END, CASE WHEN projected_database > {SAFE_BYTES} THEN 'database_limit' END,
        CASE WHEN growth > disk_free THEN 'disk_room' END, CASE WHEN disk_warning OR disk_stop OR used >= 85 THEN 'disk_warning' END) AS reasons FROM u)
        SELECT plan_id, discovery_growth, snapshot_growth, growth, projected_database, round(used, 6) AS projected_used, available,
        greatest(0, growth - available) AS additional, CASE WHEN reasons = '' THEN 'passed' ELSE 'rejected' END AS decision, reasons FROM r"""),
}
