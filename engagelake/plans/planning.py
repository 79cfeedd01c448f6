"""Queries over eligibility, cohorts, campaigns and capacity limits."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import bindings as b
from ..functions import columns as c


def _eligible(spark, sf_dir):
    """Users with access and a current membership in an approved group's country."""
    members = b.edges(spark, sf_dir).where("last_seen >= timestamp_ntz'2000-06-01'").select(F.col("user_id").alias("group_id"))
    access = c.has_access(F.when(F.col("group_id") % 13 == 0, "deleted"), F.col("group_id") % 4 == 0, F.col("balance") > 3000)
    return b.groups(spark, sf_dir).where(access).join(members, "group_id", "left_semi")


def eligible_users(spark, sf_dir):
    return _eligible(spark, sf_dir).select("group_id", "segment")


def resolved_users(spark, sf_dir):
    """Eligible users whose state is fresh or final; the others are due."""
    seen = b.posts(spark, sf_dir).where("kind = 'F'").groupBy("group_id").agg(F.max("published").alias("seen"))
    fresh = ~c.stale(F.col("seen"), b.moment(b.ORDERS_AS_OF), 400 * 86400)
    return _eligible(spark, sf_dir).join(seen, "group_id", "left").groupBy(F.when(fresh,
        "resolved").otherwise("due").alias("state")).agg(F.count("*").alias("users"))


def cohort_plan(spark, sf_dir):
    """The next cohort: due users over the cursor, by number, without those that have a job already."""
    busy = b.jobs(spark, sf_dir).where("status = 'running'").select(F.col("entity_id").alias("group_id"))
    return _eligible(spark, sf_dir).where("group_id > 200").join(busy, "group_id", "left_anti").orderBy("group_id").limit(50).select("group_id")


def campaign_status(spark, sf_dir):
    """Per campaign (segment): its snapshot, how many of it are done, what is left, and the phase that follows."""
    done = b.posts(spark, sf_dir).where("kind = 'F' and published >= timestamp_ntz'1999-01-01'").select("group_id").distinct().withColumn("done",
        F.lit(True))
    g = b.groups(spark, sf_dir).join(done, "group_id", "left").groupBy("segment").agg(F.count("*").alias("snapshot"),
        F.count_if("done").alias("done"))
    left = F.col("snapshot") - F.col("done")
    return g.select("segment", "snapshot", "done", left.alias("left"), F.round(c.percent(F.col("done"), F.col("snapshot")), 4).alias("percent"),
        F.when(left == 0, "completed").when(F.col("done") == 0, "discovery").otherwise("metadata").alias("phase"))


def plan_keys(spark, sf_dir):
    """Plans by key over active runs: a key that is there already is not planned again."""
    key = F.sha2(F.concat_ws("|", "job_type", F.col("priority").cast("string")), 256)
    active = b.jobs(spark, sf_dir).where("status in ('pending', 'running')").select(key.alias("plan_key")).distinct()
    wanted = b.jobs(spark, sf_dir).select(key.alias("plan_key"), "job_type", "priority").distinct()
    return wanted.join(active.withColumn("known", F.lit(True)), "plan_key", "left").select("job_type", "priority",
        F.coalesce("known", F.lit(False)).alias("known"))


def subscription_totals(spark, sf_dir):
    e = b.edges(spark, sf_dir)
    return e.agg(F.count("*").alias("edges"), F.countDistinct("user_id").alias("users"), F.countDistinct("community_id").alias("communities"),
        F.count_if(F.col("last_seen") >= b.moment("2001-01-01")).alias("current"))


def theoretical_capacity(spark, sf_dir):
    """Upper bounds in bytes: users by links, and by links and posts."""
    g = b.groups(spark, sf_dir).agg(F.count("*").alias("users"))
    return g.select("users", (F.col("users") * 50 * 1280).alias("links_bytes"), (F.col("users") * 50 * 20 * 2304).alias("posts_bytes"))


def pilot_metrics(spark, sf_dir):
    """What a pilot's users brought: users, posts, attachments, and their means."""
    users = b.groups(spark, sf_dir).where("segment = 'MACHINERY'").select("group_id")
    p = b.posts(spark, sf_dir).join(users, "group_id", "left_semi")
    a = b.table(spark, sf_dir, "lineitem").join(p, F.col("l_orderkey") == F.col("post_id"), "left_semi").agg(F.count("*").alias("attachments"))
    n = p.agg(F.countDistinct("group_id").alias("users"), F.count("*").alias("posts"))
    return n.crossJoin(a).withColumn("posts_per_user", F.round(F.try_divide(F.col("posts"), F.col("users")), 6))  # a row each


def iso_moments(spark, sf_dir):
    """ISO texts with Z, without a zone, or broken: a moment in UTC, or none."""
    text = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    text = F.when(F.col("o_orderkey") % 3 == 0, F.concat(text, F.lit("Z"))).when(F.col("o_orderkey") % 3 == 1, text).otherwise(F.lit("never"))
    return b.table(spark, sf_dir, "orders").select("o_orderkey", F.try_to_timestamp(F.regexp_replace(text, "Z$", ""),
        F.lit("yyyy-MM-dd'T'HH:mm:ss")).cast("timestamp_ntz").alias("moment"))


def token_slots(spark, sf_dir):
    """Slots of a token at one call in two hours: each call's start, pushed on by those before it."""
    w = W.partitionBy("token").orderBy("ts", "event_id")
    nth = F.row_number().over(w) - 1
    sec = F.unix_seconds(F.col("ts").cast("timestamp"))
    # the closed form of max(own time, last slot + interval): running maximum of time less the slots before
    calls = b.calls(spark, sf_dir).withColumn("shifted", sec - nth * 7200).withColumn("nth", nth)
    run = F.max("shifted").over(w.rowsBetween(W.unboundedPreceding, 0))
    return calls.select("event_id", (run + F.col("nth") * 7200).alias("slot"), (run + F.col("nth") * 7200 - sec).alias("wait"))


def review_log(spark, sf_dir):
    """Labels that a review adds to what is there, and a line of its log for each document."""
    old = b.table(spark, sf_dir, "labels").where("quality = 1").select("doc_id", F.lit("good").alias("label"))
    added = b.table(spark, sf_dir, "labels").where("toxic = 1 or quality = 1").select("doc_id",
        F.when(F.col("toxic") == 1, "rude").otherwise("good").alias("label"))
    new = added.join(old, ["doc_id", "label"], "left_anti")
    both = old.unionByName(new)
    return both.groupBy("doc_id").agg(F.array_join(F.array_sort(F.collect_set("label")), "|").alias("labels"), F.count("*").alias("n"))


_ELIGIBLE = f"""{b.GROUPS_SQL}, {b.EDGES_SQL}, el AS (SELECT * FROM groups WHERE group_id % 13 <> 0 AND (group_id % 4 <> 0 OR balance > 3000) AND
    group_id IN (SELECT user_id FROM edges WHERE last_seen >= TIMESTAMP '2000-06-01'))"""
QUERIES = {
    "eligible_users": (eligible_users, f"WITH {_ELIGIBLE} SELECT group_id, segment FROM el"),
    "resolved_users": (resolved_users, f"""WITH {_ELIGIBLE}, s AS (SELECT o_custkey AS group_id, max(o_orderdate) AS seen FROM orders WHERE
        o_orderstatus = 'F' GROUP BY 1) SELECT CASE WHEN seen >= TIMESTAMP '{b.ORDERS_AS_OF}' - INTERVAL 400 DAY THEN 'resolved' ELSE 'due' END AS
        state, count(*) AS users FROM el LEFT JOIN s USING (group_id) GROUP BY 1"""),
    "cohort_plan": (cohort_plan, f"""WITH {_ELIGIBLE}, {b.JOBS_SQL} SELECT group_id FROM el WHERE group_id > 200 AND group_id NOT IN (SELECT entity_id
        FROM jobs WHERE status = 'running') ORDER BY 1 LIMIT 50"""),
    "campaign_status": (campaign_status, f"""WITH {b.GROUPS_SQL}, d AS (SELECT DISTINCT o_custkey AS group_id FROM orders WHERE o_orderstatus = 'F'
        AND o_orderdate >= TIMESTAMP '1999-01-01'), s AS (SELECT segment, count(*) AS snapshot, count(d.group_id) AS done FROM groups g LEFT JOIN d ON
        g.group_id = d.group_id GROUP BY 1)
        SELECT segment, snapshot, done, snapshot - done AS left, round(CASE WHEN snapshot = 0 THEN 100.0 ELSE done * 100.0 / snapshot END, 4)::DOUBLE
        AS percent, CASE WHEN snapshot = done THEN 'completed' WHEN done = 0 THEN 'discovery' ELSE 'metadata' END AS phase FROM s"""),
    "plan_keys": (plan_keys, f"""WITH {b.JOBS_SQL}, a AS (SELECT DISTINCT job_type, priority FROM jobs WHERE status IN ('pending','running')) SELECT
        DISTINCT j.job_type, j.priority, a.priority IS NOT NULL AS known FROM jobs j LEFT JOIN a ON a.job_type = j.job_type AND a.priority =
        j.priority"""),
    "subscription_totals": (subscription_totals, f"""WITH {b.EDGES_SQL} SELECT count(*) AS edges, count(DISTINCT user_id) AS users, count(DISTINCT
        community_id) AS communities, count(*) FILTER (WHERE last_seen >= TIMESTAMP '2001-01-01') AS current FROM edges"""),
    "theoretical_capacity": (theoretical_capacity, """SELECT count(*) AS users, count(*) * 64000 AS links_bytes, count(*) * 2304000 AS posts_bytes
        FROM customer"""),
    "pilot_metrics": (pilot_metrics, """WITH p AS (SELECT * FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment =
        'MACHINERY')), n AS (SELECT count(DISTINCT o_custkey) AS users, count(*) AS posts FROM p), a AS (SELECT count(*) AS attachments FROM lineitem
        WHERE l_orderkey IN (SELECT o_orderkey FROM p)) SELECT *, round(posts / users::DOUBLE, 6) AS posts_per_user FROM n, a"""),
    "iso_moments": (iso_moments, "SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 2 THEN o_orderdate END AS moment FROM orders"),
    "token_slots": (token_slots, f"""WITH {b.CALLS_SQL}, n AS (SELECT event_id, token, ts, CAST(floor(epoch(ts)) AS BIGINT) AS sec, row_number() OVER
        (PARTITION BY token ORDER BY ts, event_id) - 1 AS nth FROM calls), m AS (SELECT event_id, sec, nth, max(sec - nth * 7200) OVER (PARTITION BY
        token ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run FROM n) SELECT event_id, run + nth * 7200 AS slot, run + nth * 7200 - sec AS wait
        FROM m"""),
    "review_log": (review_log, """WITH o AS (SELECT doc_id, 'good' AS label FROM labels WHERE quality = 1), a AS (SELECT doc_id, CASE WHEN toxic = 1
        THEN 'rude' ELSE 'good' END AS label FROM labels WHERE toxic = 1 OR quality = 1), u AS (SELECT * FROM o UNION SELECT * FROM a) SELECT doc_id,
        string_agg(label, '|' ORDER BY label) AS labels, count(*) AS n FROM u GROUP BY 1"""),
}
