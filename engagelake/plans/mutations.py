"""Queries over keyed merges, snapshot closing, replacement and erasure.

Old and new tables are orders by status: those of status O are in both, the others in one.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import bindings as b
from ..operators import merge as m


def _old(spark, sf_dir):
    return b.posts(spark, sf_dir).where("kind <> 'P'").select("post_id", "group_id", "kind", "published", F.col("published").alias("first_seen"),
        F.col("published").alias("last_seen"), F.lit(1).cast("long").alias("hits"), F.when(F.col("post_id") % 2 == 0, F.col("label")).alias("label"))


def _new(spark, sf_dir):
    later = F.col("published") + F.expr("INTERVAL 10 DAY")
    return b.posts(spark, sf_dir).where("kind <> 'F'").select("post_id", (F.col("group_id") + 1).alias("group_id"), F.lit("N").alias("kind"),
        later.alias("published"), later.alias("first_seen"), F.when(F.col("post_id") % 5 == 0,
        F.col("published") - F.expr("INTERVAL 3 DAY")).otherwise(later).alias("last_seen"), F.lit(2).cast("long").alias("hits"),
        F.when(F.col("post_id") % 4 == 0, F.lit("relabelled")).alias("label"))


OLD_SQL = f"""{b.POSTS_SQL}, o AS (SELECT post_id, group_id, kind, published, published AS first_seen, published AS last_seen, 1::BIGINT AS hits, CASE
    WHEN post_id % 2 = 0 THEN label END AS label FROM posts WHERE kind <> 'P')"""
NEW_SQL = """n AS (SELECT post_id, group_id + 1 AS group_id, 'N' AS kind, published + INTERVAL 10 DAY AS published, published + INTERVAL 10 DAY AS
    first_seen, CASE WHEN post_id % 5 = 0 THEN published - INTERVAL 3 DAY ELSE published + INTERVAL 10 DAY END AS last_seen, 2::BIGINT AS hits, CASE
    WHEN post_id % 4 = 0 THEN 'relabelled' END AS label FROM posts WHERE kind <> 'F')"""


def merge_upsert_posts(spark, sf_dir):
    """Known posts take kind, label and last_seen and keep the rest."""
    return m.merge(_old(spark, sf_dir), _new(spark, sf_dir), ["post_id"], {"kind": "take", "label": "take", "last_seen": "take"})


def merge_user_posts(spark, sf_dir):
    """The same for user posts, where the date of publication is taken, too."""
    return m.merge(_old(spark, sf_dir), _new(spark, sf_dir), ["post_id"], {"kind": "take", "label": "take", "last_seen": "take", "published": "take"})


def merge_greatest(spark, sf_dir):
    return m.merge(_old(spark, sf_dir), _new(spark, sf_dir), ["post_id"], {"last_seen": "greatest", "label": "coalesce"}).select("post_id",
        "last_seen", "label")


def increment_counter(spark, sf_dir):
    return m.merge(_old(spark, sf_dir), _new(spark, sf_dir), ["post_id"], {"hits": "increment"}).groupBy("hits").agg(F.count("*").alias("posts"))


def merge_last_wins(spark, sf_dir):
    """A source with several rows for a key: the latest one is merged."""
    source = b.calls(spark, sf_dir).select(F.col("token").alias("id"), "ts", "code")
    latest = m.last_wins(source, ["id"], [F.desc("ts")])
    target = b.groups(spark, sf_dir).select(F.col("group_id").alias("id"), F.lit(None).cast("timestamp_ntz").alias("ts"), F.lit(-1).alias("code"))
    return m.merge(target, latest, ["id"], {"ts": "take", "code": "take"})


def insert_missing(spark, sf_dir):
    return m.insert_missing(_old(spark, sf_dir), _new(spark, sf_dir), ["post_id"]).select("post_id", "kind", "hits")


def was_new_flags(spark, sf_dir):
    """Which rows of a page are new, against what was there before the page."""
    known = _old(spark, sf_dir).select("post_id", F.lit(True).alias("known"))
    return _new(spark, sf_dir).join(known, "post_id", "left").select("post_id", F.col("known").isNull().alias("was_new"))


def replace_labels(spark, sf_dir):
    old = b.posts(spark, sf_dir).where("kind <> 'O'").select("group_id", "label").distinct()
    new = b.posts(spark, sf_dir).where("kind = 'O' and published > timestamp_ntz'2000-06-01'").select("group_id",
        F.lower("label").alias("label")).distinct()
    return m.replace_sets(old, new, ["group_id"])


def snapshot_close(spark, sf_dir):
    """Edges of completely walked users that the last run did not touch are no longer current; runs of null stay."""
    e = b.edges(spark, sf_dir).select("user_id", "community_id", F.when(F.col("source_run") % 9 != 0,
        F.col("source_run") % 4).alias("source_run")).withColumn("is_current", F.lit(True))
    return m.close_snapshot(e, b.groups(spark, sf_dir).where("status = 'approved'").withColumnRenamed("group_id", "user_id"), "user_id",
        F.lit(3)).groupBy("is_current").agg(F.count("*").alias("edges"), F.sum("user_id").alias("users"))


def snapshot_close_null_flavour(spark, sf_dir):
    e = b.edges(spark, sf_dir).select("user_id", "community_id", F.when(F.col("source_run") % 9 != 0,
        F.col("source_run") % 4).alias("source_run")).withColumn("is_current", F.lit(True))
    return m.close_snapshot(e, b.groups(spark, sf_dir).where("status = 'approved'").withColumnRenamed("group_id", "user_id"), "user_id", F.lit(3),
        nulls=True).groupBy("is_current").agg(F.count("*").alias("edges"), F.sum("user_id").alias("users"))


def attachments_replace(spark, sf_dir):
    """Positions that the new list has not are dropped, the others taken."""
    li = b.table(spark, sf_dir, "lineitem")
    old = li.groupBy("l_orderkey", "l_linenumber").agg(F.max("l_quantity").alias("quantity"))
    new = old.join(b.posts(spark, sf_dir).where("kind = 'F'").select(F.col("post_id").alias("l_orderkey")), "l_orderkey",
        "left_semi").where("l_linenumber <= 2").withColumn("quantity", F.col("quantity") * 10)
    return m.replace_sets(old, new, ["l_orderkey"]).groupBy("l_linenumber").agg(F.count("*").alias("n"),
        F.round(F.sum("quantity"), 4).alias("quantity"))


def attachments_upsert(spark, sf_dir):
    """Lists of attachments that have grown, shrunk or become empty: positions are upserted, those beyond the new length go."""
    pos = F.col("l_linenumber") - 1
    old = b.table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("post_id"), pos.alias("position")).agg(F.max("l_quantity").alias("quantity"),
        F.min("l_partkey").alias("part"))
    n = F.when(F.col("post_id") % 6 == 0, 0).when(F.col("post_id") % 6 == 1, 2).otherwise(F.col("post_id") % 9)
    posts = b.posts(spark, sf_dir).where("kind = 'F'").select("post_id", n.cast("int").alias("n"))
    new = posts.select("post_id", F.explode_outer(F.when(F.col("n") > 0, F.sequence(F.lit(0), F.col("n") - 1))).alias("position"))
    new = new.select("post_id", F.col("position"), F.lit(7.5).alias("quantity"), (F.col("post_id") + F.col("position")).alias("part"))
    return m.replace_positions(old, new, ["post_id"], "position", {"quantity": "take", "part": "coalesce"})


def bulk_update(spark, sf_dir):
    decisions = b.groups(spark, sf_dir).where("balance > 5000").select("group_id", F.lit("approved").alias("new_status"))
    return b.groups(spark, sf_dir).join(decisions, "group_id", "left").select("group_id", F.coalesce("new_status", "status").alias("status"))


def erase_cascade(spark, sf_dir):
    """Counts of what an erased user has, and what is left."""
    gone = b.groups(spark, sf_dir).where("balance < -900").select("group_id")
    counts, left = m.erase("group_id", gone, posts=b.posts(spark, sf_dir), edges=b.edges(spark, sf_dir).withColumnRenamed("user_id", "group_id"))
    after = left["posts"].agg(F.lit("posts_left").alias("name"), F.count("*").alias("n"))
    return counts.unionByName(after)


def retry_reset(spark, sf_dir):
    j = b.jobs(spark, sf_dir).withColumn("new_status", F.when(F.col("status") == "failed",
        "pending").otherwise(F.col("status"))).withColumn("new_attempts", F.when(F.col("status") == "failed", 0).otherwise(F.col("attempts")))
    return j.groupBy("new_status").agg(F.count("*").alias("jobs"), F.sum(F.col("new_attempts").cast("long")).alias("attempts"))


def config_merge(spark, sf_dir):
    """A shallow merge of two maps: the right side wins."""
    left = F.create_map(F.lit("status"), F.col("status"), F.lit("segment"), F.col("segment"))
    right = F.create_map(F.lit("status"), F.lit("checked"), F.lit("nation"), F.col("nation").cast("string"))
    both = F.map_concat(F.map_filter(left, lambda k, v: ~F.map_contains_key(right, k)), right)
    return b.groups(spark, sf_dir).select("group_id", both["status"].alias("status"), both["segment"].alias("segment"),
        both["nation"].alias("nation"), F.size(both).cast("long").alias("keys"))


def incremental_plan(spark, sf_dir):
    """Approved groups without a baseline, and without a completed job of the type."""
    baseline = b.posts(spark, sf_dir).where("published < timestamp_ntz'1995-06-01'").select("group_id")
    done = b.jobs(spark, sf_dir).where("status = 'completed' and job_type = 'posts'").select(F.col("entity_id").alias("group_id"))
    return b.groups(spark, sf_dir).where("status = 'approved'").join(baseline, "group_id", "left_anti").join(done, "group_id",
        "left_anti").select("group_id")


_MERGE = "coalesce(o.post_id, n.post_id) AS post_id"
_BOTH = "FROM o FULL OUTER JOIN n ON o.post_id = n.post_id"


def _pick(c, policy):
    v = {"keep": f"o.{c}", "take": f"n.{c}"}[policy]
    return f"CASE WHEN n.post_id IS NULL THEN o.{c} WHEN o.post_id IS NULL THEN n.{c} ELSE {v} END AS {c}"


_EDGE = f"""{b.EDGES_SQL}, e AS (SELECT user_id, CASE WHEN source_run % 9 <> 0 THEN source_run % 4 END AS run FROM edges), f AS (SELECT user_id, NOT
    (c_mktsegment IN ('BUILDING','MACHINERY') AND %s) AS is_current FROM e JOIN customer ON c_custkey = user_id)"""
QUERIES = {
    "merge_upsert_posts": (merge_upsert_posts, f"WITH {OLD_SQL}, {NEW_SQL} SELECT {_MERGE}, " + ", ".join(_pick(c,
    "take" if c in ("kind", "label", "last_seen") else "keep") for c in ("group_id", "kind", "published", "first_seen", "last_seen", "hits",
    "label")) + f" {_BOTH}"),
    "merge_user_posts": (merge_user_posts, f"WITH {OLD_SQL}, {NEW_SQL} SELECT {_MERGE}, " + ", ".join(_pick(c,
    "take" if c in ("kind", "label", "last_seen", "published") else "keep") for c in ("group_id", "kind", "published", "first_seen", "last_seen",
    "hits", "label")) + f" {_BOTH}"),
    "merge_greatest": (merge_greatest, f"""WITH {OLD_SQL}, {NEW_SQL} SELECT {_MERGE}, greatest(o.last_seen, n.last_seen) AS last_seen,
        coalesce(n.label, o.label) AS label {_BOTH}"""),
    "increment_counter": (increment_counter, f"""WITH {OLD_SQL}, {NEW_SQL}, x AS (SELECT coalesce(o.hits, 0) + coalesce(n.hits, 0) AS hits {_BOTH})
        SELECT hits, count(*) AS posts FROM x GROUP BY 1"""),
    "merge_last_wins": (merge_last_wins, f"""WITH {b.CALLS_SQL}, l AS (SELECT DISTINCT ON (token) token AS id, ts, code FROM calls ORDER BY token, ts
        DESC), t AS (SELECT c_custkey AS id FROM customer) SELECT coalesce(t.id, l.id) AS id, l.ts, coalesce(l.code, -1) AS code FROM t FULL OUTER
        JOIN l ON t.id = l.id"""),
    "insert_missing": (insert_missing, f"""WITH {OLD_SQL}, {NEW_SQL} SELECT post_id, kind, hits FROM o UNION ALL SELECT post_id, kind, hits FROM n
        WHERE post_id NOT IN (SELECT post_id FROM o)"""),
    "was_new_flags": (was_new_flags, f"WITH {OLD_SQL}, {NEW_SQL} SELECT post_id, post_id NOT IN (SELECT post_id FROM o) AS was_new FROM n"),
    "replace_labels": (replace_labels, f"""WITH {b.POSTS_SQL}, o AS (SELECT DISTINCT group_id, label FROM posts WHERE kind <> 'O'), n AS (SELECT
        DISTINCT group_id, lower(label) AS label FROM posts WHERE kind = 'O' AND published > TIMESTAMP '2000-06-01') SELECT * FROM o WHERE group_id
        NOT IN (SELECT group_id FROM n) UNION ALL SELECT * FROM n"""),
    "snapshot_close": (snapshot_close, "WITH " + _EDGE.replace("%s",
    "coalesce(run <> 3, false)") + " SELECT is_current, count(*) AS edges, CAST(sum(user_id) AS BIGINT) AS users FROM f GROUP BY 1"),
    "snapshot_close_null_flavour": (snapshot_close_null_flavour, "WITH " + _EDGE.replace("%s",
    "(run IS NULL OR run <> 3)") + " SELECT is_current, count(*) AS edges, CAST(sum(user_id) AS BIGINT) AS users FROM f GROUP BY 1"),
    "attachments_replace": (attachments_replace, """WITH o AS (SELECT l_orderkey, l_linenumber, max(l_quantity) AS q FROM lineitem GROUP BY 1, 2), n
        AS (SELECT l_orderkey, l_linenumber, q * 10 AS q FROM o WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') AND
        l_linenumber <= 2), u AS (SELECT * FROM o WHERE l_orderkey NOT IN (SELECT l_orderkey FROM n) UNION ALL SELECT * FROM n) SELECT l_linenumber,
        count(*) AS n, round(sum(q), 4) AS quantity FROM u GROUP BY 1"""),
    "attachments_upsert": (attachments_upsert, f"""WITH {b.POSTS_SQL}, o AS (SELECT l_orderkey AS post_id, l_linenumber - 1 AS position, max(l_quantity) AS
        quantity, min(l_partkey) AS part FROM lineitem GROUP BY 1, 2), w AS (SELECT post_id, CAST(CASE post_id % 6 WHEN 0 THEN 0 WHEN 1 THEN 2 ELSE post_id % 9
        END AS INT) AS n FROM posts WHERE kind = 'F'), new AS (SELECT post_id, CAST(unnest(range(n)) AS INT) AS position FROM w)
        SELECT post_id, position, 7.5::DOUBLE AS quantity, post_id + position AS part FROM new
        UNION ALL SELECT o.* FROM o WHERE post_id NOT IN (SELECT post_id FROM w)"""),
    "bulk_update": (bulk_update, f"""WITH {b.GROUPS_SQL} SELECT group_id, CASE WHEN balance > 5000 THEN 'approved' ELSE status END AS status FROM
        groups"""),
    "erase_cascade": (erase_cascade, f"""WITH {b.EDGES_SQL}, gone AS (SELECT c_custkey FROM customer WHERE c_acctbal < -900) SELECT 'posts' AS name,
        count(*) AS n FROM orders WHERE o_custkey IN (SELECT * FROM gone) UNION ALL SELECT 'edges', count(*) FROM edges WHERE user_id IN (SELECT *
        FROM gone) UNION ALL SELECT 'posts_left', count(*) FROM orders WHERE o_custkey NOT IN (SELECT * FROM gone)"""),
    "retry_reset": (retry_reset, f"""WITH {b.JOBS_SQL} SELECT CASE WHEN status = 'failed' THEN 'pending' ELSE status END AS new_status, count(*) AS
        jobs, CAST(sum(CASE WHEN status = 'failed' THEN 0 ELSE attempts END) AS BIGINT) AS attempts FROM jobs GROUP BY 1"""),
    "config_merge": (config_merge, f"""WITH {b.GROUPS_SQL} SELECT group_id, 'checked' AS status, segment, CAST(nation AS VARCHAR) AS nation, 3::BIGINT
        AS keys FROM groups"""),
    "incremental_plan": (incremental_plan, f"""WITH {b.GROUPS_SQL}, {b.POSTS_SQL}, {b.JOBS_SQL} SELECT group_id FROM groups WHERE status = 'approved'
        AND group_id NOT IN (SELECT group_id FROM posts WHERE published < TIMESTAMP '1995-06-01') AND group_id NOT IN (SELECT entity_id FROM jobs
        WHERE status = 'completed' AND job_type = 'posts')"""),
}
