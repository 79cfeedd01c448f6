"""The canonical backlog, the operational report and the capacity projection of user posts.

States are made from ids (``TABLES``): clocks are whole days, today is day ``TODAY``. The
expressions are SQL that any dialect reads, so that both sides of a comparison start from the same rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import bindings as b
from ..functions import columns as c
from ..operators import aggregates

TODAY = 200
#: Days after which a profile and a community's metadata are stale.
PROFILE_DAYS, METADATA_DAYS = 30, 60

#: name -> (source table, condition, columns): rows of the domain, derived from ids.
TABLES = {
    "candidates": ("customer", "TRUE", {"group_id": "c_custkey",
    "status": "CASE c_custkey % 5 WHEN 0 THEN 'rejected' WHEN 1 THEN 'pending' ELSE 'approved' END"}),
    "group_states": ("customer", "c_custkey % 7 <> 0", {
        "group_id": "c_custkey", "group_ok": "CASE WHEN c_custkey % 3 <> 0 THEN c_custkey % 200 END",
        "posts_ok": "CASE WHEN c_custkey % 4 <> 0 THEN c_custkey % 150 END", "members_ok": "CASE WHEN c_custkey % 6 <> 0 THEN 1 END",
        "unavailable": "CASE WHEN c_custkey % 13 = 0 THEN TRUE WHEN c_custkey % 2 = 0 THEN FALSE END",
    }),
    "users": ("customer", "TRUE", {
        "user_id": "c_custkey", "deactivated": "CASE WHEN c_custkey % 11 = 0 THEN 'deleted' END",
        "is_closed": "CASE WHEN c_custkey % 17 <> 0 THEN c_custkey % 3 = 0 END",
        "can_access": "CASE WHEN c_custkey % 19 <> 0 THEN c_custkey % 2 = 0 END",
        "profile_day": "CASE WHEN c_custkey % 8 <> 0 THEN c_custkey % 200 END",
    }),
    "memberships": ("orders", "TRUE", {"user_id": "o_custkey", "group_id": "1 + o_orderkey % 150", "is_current": "o_orderkey % 4 <> 0"}),
    "subscription_states": ("customer", "c_custkey % 6 <> 0", {
        "user_id": "c_custkey", "last_success": "CASE WHEN c_custkey % 5 < 2 THEN c_custkey % 200 END",
        "terminal": "CASE c_custkey % 9 WHEN 0 THEN 'privacy_or_access' WHEN 1 THEN 'deleted_or_unavailable' END",
        "next_day": "CASE WHEN c_custkey % 4 <> 0 THEN 150 + c_custkey % 100 END", "truncated": "c_custkey % 10 = 0",
    }),
    "wall_states": ("customer", "c_custkey % 9 <> 0", {
        "user_id": "c_custkey", "last_success": "CASE WHEN c_custkey % 3 = 0 THEN c_custkey % 200 END", "wall_private": "c_custkey % 7 = 0",
        "unavailable": "c_custkey % 21 = 0", "next_day": "CASE WHEN c_custkey % 5 <> 0 THEN 170 + c_custkey % 60 END",
    }),
    "communities": ("supplier", "TRUE", {"community_id": "s_suppkey", "metadata_day": "CASE WHEN s_suppkey % 4 <> 0 THEN 100 + s_suppkey % 100 END",
    "deactivated": "CASE WHEN s_suppkey % 7 = 0 THEN 'banned' END", "is_closed": "s_suppkey % 5 = 0"}),
    "community_states": ("supplier", "s_suppkey % 3 <> 0", {"community_id": "s_suppkey", "last_success": "CASE WHEN s_suppkey % 2 = 0 THEN 1 END",
    "wall_private": "s_suppkey % 11 = 0", "unavailable": "s_suppkey % 13 = 0"}),
    "subscriptions": ("lineitem", "TRUE", {"user_id": "l_orderkey % 150", "community_id": "l_suppkey", "is_current": "l_linenumber < 4"}),
    "queue": ("orders", "TRUE", {
        "job_id": "o_orderkey", "run_id": "o_custkey % 40",
        "job_type": "CASE o_orderkey % 3 WHEN 0 THEN 'posts' WHEN 1 THEN 'members' ELSE 'subscriptions' END",
        "entity_type": "CASE o_orderkey % 2 WHEN 0 THEN 'group' ELSE 'user' END", "entity_id": "o_custkey",
        "status": "CASE WHEN o_orderstatus = 'F' THEN 'completed' WHEN o_orderkey % 4 = 0 THEN 'running' WHEN o_orderkey % 5 = 0 THEN 'retry_wait' WHEN o_orderkey % 6 = 0 THEN 'failed' ELSE 'pending' END",
        "locked_day": "CASE WHEN o_orderkey % 4 = 0 THEN o_orderkey % 220 END", "next_day": "CASE WHEN o_orderkey % 5 = 0 THEN o_orderkey % 260 END",
        "requests": "o_orderkey % 9", "inserted": "o_orderkey % 50", "updated": "o_orderkey % 20", "attempts": "o_orderkey % 5",
        "finished_day": "CASE WHEN o_orderstatus = 'F' OR o_orderkey % 6 = 0 THEN o_orderkey % 201 END",
        "heartbeat_day": "CASE WHEN o_orderkey % 8 = 0 THEN o_orderkey % 210 END", "updated_day": "o_orderkey % 199",
    }),
    "runs": ("customer", "c_custkey <= 120", {
        "run_id": "c_custkey",
        "scope": "CASE c_custkey % 4 WHEN 0 THEN 'groups' WHEN 1 THEN 'subscriptions' WHEN 2 THEN 'pilot_groups' ELSE 'user_posts_pilot' END",
        "status": "CASE c_custkey % 6 WHEN 0 THEN 'completed' WHEN 1 THEN 'running' WHEN 2 THEN 'failed' WHEN 3 THEN 'planned' WHEN 4 THEN 'cancelled' ELSE 'completed_with_errors' END",
        "jobs": "c_custkey % 70", "failed_jobs": "c_custkey % 6", "config": "c_custkey % 3",
        "created_day": "CASE WHEN c_custkey < 40 THEN 130 ELSE 0 END + c_custkey * 37 % 61",
        "started_day": "CASE WHEN c_custkey % 6 <> 3 THEN 1 + c_custkey * 37 % 61 END",
        "wakeup_day": "CASE WHEN c_custkey % 4 = 1 THEN 190 + c_custkey % 20 END",
        "error": "CASE WHEN c_custkey % 6 = 2 THEN repeat('lost ', CAST(c_custkey AS INT)) END",
    }),
    "campaigns": ("customer", "c_custkey <= 30", {"campaign_id": "c_custkey",
    "kind": "CASE c_custkey % 5 WHEN 0 THEN 'subscriptions' WHEN 1 THEN 'user_posts' ELSE 'k' || CAST(c_custkey AS VARCHAR(9)) END",
    "status": "CASE c_custkey % 3 WHEN 0 THEN 'completed' WHEN 1 THEN 'running' ELSE 'paused' END", "users": "c_custkey * 10",
    "phase": "CASE c_custkey % 4 WHEN 0 THEN 'discovery' WHEN 1 THEN 'metadata' ELSE 'completed' END", "created_day": "c_custkey * 17 % 31",
    "error": "CASE WHEN c_custkey % 7 = 0 THEN repeat('x', CAST(c_custkey * 30 AS INT)) END"}),
    "method_states": ("customer", "TRUE", {"token": "c_custkey % 40", "method": "'m' || CAST(c_custkey % 7 AS VARCHAR(9))",
    "blocked_day": "CASE WHEN c_custkey % 3 = 0 THEN c_custkey % 260 END"}),
    "errors": ("events", "event_id % 3 = 0", {"endpoint": "event_type",
    "category": "CASE event_id % 4 WHEN 0 THEN 'access' WHEN 1 THEN 'rate' WHEN 2 THEN 'network' ELSE 'VK_Token' END",
    "code": "CASE WHEN event_id % 4 < 2 THEN 9 - event_id % 4 END", "number": "event_id", "run_id": "user_id",
    "created_day": "event_id % 201"}),
}


def rows(spark, sf_dir, name: str) -> DataFrame:
    source, condition, columns = TABLES[name]
    return b.table(spark, sf_dir, source).where(condition).select(*(F.expr(e).alias(c) for c, e in columns.items()))


def sql(*names: str) -> str:
    """CTEs of the same rows."""
    parts = []
    for name in names:
        source, condition, columns = TABLES[name]
        parts.append(f"{name} AS (SELECT {', '.join(f'{e} AS {c}' for c, e in columns.items())} FROM {source} WHERE {condition})")
    return ",\n ".join(parts)


def accessible():
    return F.col("deactivated").isNull() & ((F.col("is_closed") == F.lit(False)) | (F.col("can_access") == F.lit(True)))


def eligible_users(spark, sf_dir) -> DataFrame:
    """Accessible users with a current membership in an approved group."""
    approved = rows(spark, sf_dir, "candidates").where("status = 'approved'").select("group_id")
    members = rows(spark, sf_dir, "memberships").where("is_current").join(approved, "group_id", "left_semi").select("user_id")
    return rows(spark, sf_dir, "users").where(accessible()).join(members, "user_id", "left_semi")


def _group_counts(spark, sf_dir):
    g = rows(spark, sf_dir, "candidates").where("status = 'approved'").join(rows(spark, sf_dir, "group_states").withColumn("known", F.lit(True)),
        "group_id", "left")
    open_ = ~F.coalesce("unavailable", F.lit(False))
    return g.agg(
        F.count("*").alias("groups"), F.count_if(F.col("known").isNull()).alias("groups_without_state"),
        F.count_if(F.col("group_ok").isNull() & open_).alias("groups_metadata_missing"),
        F.count_if(F.col("posts_ok").isNull() & open_).alias("groups_posts_missing"),
        F.count_if(F.col("members_ok").isNull() & open_).alias("groups_members_missing"), F.count_if(~open_).alias("groups_unavailable"),
    )


def _user_counts(spark, sf_dir):
    return rows(spark, sf_dir, "users").agg(
        F.count("*").alias("users"), F.count_if(accessible()).alias("users_accessible"),
        F.count_if(F.col("profile_day").isNull()).alias("users_profile_missing"),
        F.count_if(F.col("profile_day") < TODAY - PROFILE_DAYS).alias("users_profile_stale"),
        F.count_if(F.col("deactivated").isNotNull()).alias("users_deactivated"),
        F.count_if((F.col("is_closed") == F.lit(True)) & (F.col("can_access") == F.lit(False))).alias("users_closed"),
    )


def _subscription_counts(spark, sf_dir):
    """Users without a state are unresolved; those without a next day are in neither of the two transient counts."""
    s = eligible_users(spark, sf_dir).select("user_id").join(rows(spark, sf_dir, "subscription_states"), "user_id", "left")
    not_yet, reason = F.col("last_success").isNull(), F.col("terminal")
    return s.agg(
        F.count("*").alias("eligible"), F.count("last_success").alias("successful"),
        F.count_if(not_yet & (reason == "privacy_or_access")).alias("terminal_privacy"),
        F.count_if(not_yet & (reason == "deleted_or_unavailable")).alias("terminal_deleted"),
        F.count_if(not_yet & reason.isNull() & (F.col("next_day") > TODAY)).alias("transient_deferred"),
        F.count_if(not_yet & reason.isNull() & (F.col("next_day") <= TODAY)).alias("transient_due"),
        F.count_if(F.col("truncated")).alias("truncated"), F.count_if(not_yet & reason.isNull()).alias("unresolved"),
    )


def _community_counts(spark, sf_dir):
    """Each community with a current subscription counts once: one grouping, no distinct counts."""
    current = rows(spark, sf_dir, "subscriptions").where("is_current").select("community_id").distinct()
    c = rows(spark, sf_dir, "communities").join(current, "community_id", "left_semi").join(rows(spark, sf_dir, "community_states").withColumn("known",
        F.lit(True)), "community_id", "left")
    there = F.col("deactivated").isNull()
    return c.agg(
        F.count("*").alias("communities"), F.count_if(F.col("metadata_day").isNull()).alias("communities_metadata_missing"),
        F.count_if(F.col("metadata_day") < TODAY - METADATA_DAYS).alias("communities_metadata_stale"),
        F.count("deactivated").alias("communities_deactivated"), F.count_if("is_closed").alias("communities_closed"),
        F.count_if(there).alias("walls"), F.count_if(there & F.col("known").isNull()).alias("walls_without_state"),
        F.count_if(there & F.col("last_success").isNotNull()).alias("walls_collected"),
        F.count_if(there & F.col("wall_private")).alias("walls_private"), F.count_if(there & F.col("unavailable")).alias("walls_unavailable"),
    )


def _run_counts(spark, sf_dir):
    active = F.col("status").isin("running", "paused", "planned")
    runs = rows(spark, sf_dir, "runs").agg(
        F.count_if(F.col("scope").like("%pilot%") & ~F.col("status").isin("completed", "completed_with_errors", "failed",
        "cancelled")).alias("unfinished_pilots"),
        F.count_if(F.col("status").isin("planned", "running", "waiting_method_limit") & (F.col("config") != 1)).alias("configuration_mismatches"),
    )
    jobs = rows(spark, sf_dir, "queue").agg(
        F.count_if((F.col("status") == "running") & (F.col("locked_day") < TODAY)).alias("stale_leases"),
        F.min(F.when((F.col("job_type") == "subscriptions") & (F.col("status") == "retry_wait") & (F.col("next_day") > TODAY),
        F.col("next_day"))).alias("nearest_retry"),
    )
    campaigns = rows(spark, sf_dir, "campaigns").where(active)
    several = campaigns.groupBy("kind").count().where("count > 1").agg(F.count("*").alias("kinds_with_several"))
    return runs.crossJoin(jobs).crossJoin(campaigns.agg(F.count("*").alias("campaigns"),
        F.coalesce(F.sum("users"), F.lit(0)).alias("campaign_users"))).crossJoin(several)  # a row each


def canonical_backlog(spark, sf_dir):
    """One row from canonical states, never from job totals; coverage counts successes and final refusals of all eligible users."""
    parts = [f(spark, sf_dir) for f in (_group_counts, _user_counts, _subscription_counts, _community_counts, _run_counts)]
    one = reduce(DataFrame.crossJoin, parts)  # a row each
    resolved = F.col("successful") + F.col("terminal_privacy") + F.col("terminal_deleted")
    light = F.when(F.col("groups_metadata_missing") > 0,
        "approved_group_metadata").when(F.col("users_profile_missing") + F.col("users_profile_stale") > 0, "user_profiles")
    return one.select("*", F.when(F.col("eligible") == 0, 100.0).otherwise(F.round(resolved * 100.0 / F.col("eligible"),
        2)).cast("double").alias("coverage"), light.alias("next_light_backlog"))


def backlog_jobs(spark, sf_dir):
    """Jobs by type and status, with distinct entities: history, not backlog."""
    return rows(spark, sf_dir, "queue").groupBy("job_type", "status").agg(F.count("*").alias("jobs"),
        F.countDistinct("entity_type", "entity_id").alias("entities"))


# --- the operational report, a query for each kind of statement ---


def report_totals(spark, sf_dir):
    """Labelled counts of what has been collected."""
    users, walls, subs = rows(spark, sf_dir, "users"), rows(spark, sf_dir, "wall_states"), rows(spark, sf_dir, "subscription_states")
    return aggregates.labelled_counts(
        spark, group_candidates=rows(spark, sf_dir, "candidates"), communities=rows(spark, sf_dir, "communities"),
        communities_with_metadata=rows(spark, sf_dir, "communities").where("metadata_day is not null"), group_posts=b.posts(spark, sf_dir),
        post_attachments=b.table(spark, sf_dir, "lineitem"), user_post_states=walls, processed_user_posts=walls.where("last_success is not null"),
        private_user_walls=walls.where("wall_private"), users=users, accessible_users=users.where(accessible()),
        memberships=rows(spark, sf_dir, "memberships"), current_memberships=rows(spark, sf_dir, "memberships").where("is_current"),
        subscriptions=rows(spark, sf_dir, "subscriptions"), current_subscriptions=rows(spark, sf_dir, "subscriptions").where("is_current"),
        processed_subscription_users=subs.where("last_success is not null"), community_post_states=rows(spark, sf_dir, "community_states"),
        communities_with_posts=rows(spark, sf_dir, "community_states").where("last_success is not null"),
    )


def report_coverage(spark, sf_dir):
    """Of eligible users: due, fresh and finally refused, for subscriptions and for walls."""
    users = eligible_users(spark, sf_dir).select("user_id")
    s, w = users.join(rows(spark, sf_dir, "subscription_states"), "user_id", "left"), users.join(rows(spark, sf_dir, "wall_states"), "user_id",
        "left")
    ahead = F.col("next_day") > TODAY

    def part(df, scope, done, refused):
        x = df.agg(F.count("*").alias("eligible"), F.count_if(ahead & (done | refused)).alias("fresh"), F.count_if(ahead & refused).alias("terminal"))
        return x.select(F.lit(scope).alias("scope"), "eligible", (F.col("eligible") - F.col("fresh")).alias("due"), "fresh", "terminal")

    success = F.col("last_success").isNotNull()
    return part(s, "subscriptions", success, F.col("terminal").isNotNull()).unionByName(part(w, "user_posts", success,
        F.col("wall_private") | F.col("unavailable")))


def report_runs(spark, sf_dir):
    return rows(spark, sf_dir, "runs").groupBy("scope", "status").agg(F.count("*").alias("runs"), F.sum("jobs").alias("jobs"),
        F.sum("failed_jobs").alias("failed"))


def report_queue(spark, sf_dir):
    return rows(spark, sf_dir, "queue").groupBy("job_type", "status").agg(F.count("*").alias("jobs"), F.sum("requests").alias("requests"),
        F.sum("inserted").alias("inserted"), F.sum("updated").alias("updated"))


def report_errors(spark, sf_dir):
    """The thirty commonest kinds of error."""
    e = rows(spark, sf_dir, "errors").groupBy("endpoint", "category", F.coalesce("code", F.lit(0)).alias("code")).agg(F.count("*").alias("errors"))
    return e.orderBy(F.desc("errors"), "endpoint", "category", "code").limit(30)


def report_latest_errors(spark, sf_dir):
    """The latest error of each kind."""
    return rows(spark, sf_dir, "errors").groupBy("endpoint", "category", F.coalesce("code",
        F.lit(0)).alias("code")).agg(F.max("number").alias("number"), F.max_by("run_id", "number").alias("run_id"))


def report_failed_jobs(spark, sf_dir):
    """The thirty latest failed jobs with their run's scope."""
    j = rows(spark, sf_dir, "queue").where("status = 'failed'").join(rows(spark, sf_dir, "runs").select("run_id", "scope"), "run_id")
    return j.select("scope", "job_type", "entity_type", "entity_id", "job_id").orderBy(F.desc("job_id")).limit(30)


def report_latest_runs(spark, sf_dir):
    """The ten latest runs, with the beginning of their error."""
    r = rows(spark, sf_dir, "runs").orderBy(F.desc("created_day"), "run_id").limit(10)
    return r.select("run_id", "scope", "status", "created_day", "started_day", "jobs", "failed_jobs", "wakeup_day",
        F.left(F.coalesce("error", F.lit("")), F.lit(180)).alias("error"))


def report_latest_campaigns(spark, sf_dir):
    """The ten latest campaigns, with the beginning of their error."""
    r = rows(spark, sf_dir, "campaigns").orderBy(F.desc("created_day"), "campaign_id").limit(10)
    return r.select("campaign_id", "kind", "status", "phase", "created_day", F.left(F.coalesce("error", F.lit("")), F.lit(180)).alias("error"))


def table_sizes(spark, sf_dir, most: int = 15) -> DataFrame:
    """(relation, bytes, size, rows): the largest tables of a folder by the sizes of their files, which are not read but for their rows."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(sf_dir).select("path", "length")
    relation = F.regexp_extract("path", r"/([^/]+)\.parquet(?:/[^/]+)?$", 1)
    sizes = files.groupBy(relation.alias("relation")).agg(F.sum("length").alias("bytes")).where("relation <> ''")
    names = [r.relation for r in sizes.orderBy(F.desc("bytes"), "relation").limit(most).select("relation").collect()]
    counted = aggregates.labelled_counts(spark, **{n: b.table(spark, sf_dir, n) for n in names}).withColumnRenamed("name", "relation")
    return sizes.join(counted.withColumnRenamed("n", "rows"), "relation").select("relation", "bytes", c.bytes_text(F.col("bytes")).alias("size"), "rows")


def report_table_sizes(spark, sf_dir):
    return table_sizes(spark, sf_dir)


def report_database_size(spark, sf_dir):
    """One row: bytes of all tables' files."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(sf_dir).where("path like '%.parquet%'")
    return files.agg(F.sum("length").alias("bytes")).select("bytes", c.bytes_text(F.col("bytes")).alias("size"))


def chosen_run(runs: DataFrame, queue: DataFrame, explicit: int | None = None) -> DataFrame:
    """One row: the run asked for, else a running one, else one with jobs to do, else any; of several the latest."""
    open_ = queue.where("status in ('pending', 'retry_wait')").select("run_id").distinct().withColumn("open", F.lit(True))
    first = F.when(F.col("run_id") == explicit, 0) if explicit is not None else F.when(F.lit(False), 0)
    place = first.when(F.col("status") == "running", 1).when(F.col("open"), 2).otherwise(3)
    return runs.join(open_, "run_id", "left").orderBy(place, F.desc("created_day"), "run_id").limit(1)


def database_snapshot(spark, sf_dir, explicit: int | None = None, lease_days: int = 1):
    """One row: the chosen run, its jobs by status, sums and clocks, its errors of a day, checks, and what is blocked and collected everywhere."""
    runs, queue = rows(spark, sf_dir, "runs"), rows(spark, sf_dir, "queue")
    run = chosen_run(runs, queue, explicit).select("run_id", F.col("status").alias("run_status"), F.col("error").alias("run_error"),
        F.col("created_day").alias("run_created"))
    own = queue.join(F.broadcast(run.select("run_id")), "run_id")  # of one row
    s, day = F.col("status"), F.col("finished_day") >= TODAY - 1
    at = lambda holds, x: F.coalesce(F.sum(F.when(holds, F.col(x))), F.lit(0)).cast("long")
    counts = own.groupBy("status").count().agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("status", "count"))))).alias("counts"))
    totals = own.agg(*(at(F.lit(True), x).alias(n) for n, x in (("api_requests", "requests"), ("rows_inserted", "inserted"), ("rows_updated", "updated"))),
        F.coalesce(F.sum(F.greatest(F.col("attempts") - 1, F.lit(0))), F.lit(0)).cast("long").alias("retries"),
        F.max(F.when(s == "completed", F.col("finished_day"))).alias("last_completed"), F.max(F.when(F.col("requests") > 0,
        F.col("updated_day"))).alias("last_api"), F.min(F.when(s == "retry_wait", F.col("next_day"))).alias("next_retry"),
        F.count_if((s == "running") & (F.coalesce("heartbeat_day", "locked_day", "updated_day") < TODAY - lease_days)).alias("stale_running"),
        F.count_if(day & (s == "completed")).alias("completed_24h"), at(day, "requests").alias("api_24h"), at(day, "inserted").alias("inserted_24h"),
        at(day, "updated").alias("updated_24h"))
    late = F.col("created_day") >= TODAY - 1
    errors = rows(spark, sf_dir, "errors").join(F.broadcast(run.select("run_id")), "run_id").agg(F.count_if(late).alias("errors_24h"),
        F.count_if(late & F.col("category").rlike("(?i)(auth|token)")).alias("auth_24h"),
        F.count_if(late & F.col("category").rlike("(?i)(rate|limit|flood)")).alias("rate_24h"))
    unique = None
    for table, keys in ((b.posts(spark, sf_dir), ["post_id"]), (rows(spark, sf_dir, "memberships"), ["user_id", "group_id"]),
        (rows(spark, sf_dir, "subscriptions"), ["user_id", "community_id"])):
        one = aggregates.duplicates(table, *keys).select((F.col("duplicates") == 0).cast("long").alias("u"))
        unique = one if unique is None else unique.unionByName(one)
    rejected = own.where("entity_type = 'group'").join(rows(spark, sf_dir, "candidates").where("status = 'rejected'").select(F.col("group_id").alias("entity_id")),
        "entity_id", "left_semi").agg(F.count("*").alias("rejected_jobs"))
    active = runs.agg(F.count_if(s.isin("planned", "running", "waiting_method_limit")).alias("active_runs"))
    blocked = F.col("blocked_day") > TODAY
    methods = rows(spark, sf_dir, "method_states").agg(F.count_if(blocked).alias("blocked_token_methods"),
        F.min(F.when(blocked, F.col("blocked_day"))).alias("next_method_retry"))
    people = rows(spark, sf_dir, "subscription_states").agg(F.count_if(F.col("terminal") == "privacy_or_access").alias("private_subscriptions"),
        F.count("last_success").alias("subscription_users"))
    links = rows(spark, sf_dir, "subscriptions").agg(F.count("*").alias("subscription_links"))
    communities = rows(spark, sf_dir, "communities").agg(F.count("*").alias("communities"))
    posted = b.posts(spark, sf_dir).agg(F.count_distinct("group_id").alias("communities_with_posts"))
    jobs = queue.where("job_type = 'posts'").agg(F.count_if(s.isin("pending", "retry_wait")).alias("post_jobs_pending"), F.count_if(s == "completed").alias(
        "post_jobs_completed"), F.count_if(s == "failed").alias("post_jobs_failed"))
    out = run
    for part in (counts, totals, errors, unique.agg(F.sum("u").alias("uniqueness_constraints")), rejected, active, methods, people, links, communities,
        posted, jobs):
        out = out.crossJoin(part)  # a row each
    return out


# --- capacity of user posts ---

# Bytes of rows, the reserve, and the limit of the database.
STATE_BYTES, JOB_BYTES, INDEX_BYTES, POST_BYTES, ATTACHMENT_BYTES, SNAPSHOT_BYTES, RESERVE, SAFE_BYTES = 256, 768, 160, 1024, 384, 64 + 48, 1.30, 7 * 1024**3


def user_posts_capacity(df: DataFrame, warning_percent: int = 85, safe_bytes: int = SAFE_BYTES, least_free: int = 0) -> DataFrame:
    """A projection for each row: snapshot_users, due_users, measured_users, growth_bytes, posts, attachments, database_bytes, disk_total, disk_free, disk_warning, disk_stop.

    A missing or impossible input counts as 0 and is a reason, like a limit that would be passed; without reasons the plan passes.
    """
    ok = {
        "snapshot_users": F.col("snapshot_users") >= 0, "due_users": (F.col("due_users") >= 0) & (F.col("due_users") <= F.greatest("snapshot_users",
        F.lit(0))), "measured_users": F.col("measured_users") > 0,
        "growth_bytes": F.col("growth_bytes") >= 0, "posts": F.col("posts") >= 0, "attachments": F.col("attachments") >= 0,
    }
    v = {c: F.when(good, F.col(c)).otherwise(0) for c, good in ok.items()}
    per = lambda c: F.when(v["measured_users"] > 0, F.ceil(v[c] / v["measured_users"])).otherwise(0)
    x = df.withColumns({"measured": per("growth_bytes"),
        "modeled": per("posts") * (POST_BYTES + INDEX_BYTES) + per("attachments") * ATTACHMENT_BYTES})
    x = x.withColumn("payload_growth", F.ceil(v["due_users"] * (F.greatest("measured",
        "modeled") + STATE_BYTES + JOB_BYTES) * RESERVE)).withColumn("snapshot_growth", F.ceil(v["snapshot_users"] * SNAPSHOT_BYTES * RESERVE))
    x = x.withColumn("growth", F.col("payload_growth") + F.col("snapshot_growth")).withColumn("final_bytes",
        F.col("database_bytes") + F.col("growth"))
    used = F.when(F.col("disk_total") > 0,
        (F.col("disk_total") - F.col("disk_free") + F.col("growth")) * 100.0 / F.col("disk_total")).otherwise(100.0)
    free = F.greatest(F.lit(0), F.col("disk_free") - least_free)
    x = x.withColumn("available", F.least(F.greatest(F.lit(0), F.lit(safe_bytes) - F.col("database_bytes")), free)).withColumn("used_percent",
        F.round(used, 6))
    limits = {"database_limit": F.col("final_bytes") > safe_bytes, "disk_free": F.col("growth") > free,
        "disk_warning": F.col("disk_warning") | F.col("disk_stop") | (used >= warning_percent)}
    reasons = [F.when(~F.coalesce(good, F.lit(False)), c) for c, good in ok.items()] + [F.when(bad, c) for c, bad in limits.items()]
    listed = F.concat_ws(",", *reasons)
    return x.select(
        *df.columns, "measured", "modeled", "payload_growth", "snapshot_growth", "growth", "final_bytes", "used_percent", "available",
        F.greatest(F.lit(0), F.col("growth") - F.col("available")).alias("additional"),
        listed.alias("reasons"), F.when(listed == "", "passed").otherwise("rejected").alias("decision"),
    )


_PLANS = {
    "id": "c_custkey", "snapshot_users": "c_custkey % 9 * 4000 - 4000", "due_users": "CASE WHEN c_custkey % 7 <> 0 THEN c_custkey % 5 * 3000 END",
    "measured_users": "c_custkey % 4 * 50", "growth_bytes": "c_custkey % 6 * 9000000 - 1000000", "posts": "c_custkey % 8 * 300",
    "attachments": "c_custkey % 3 * 500", "database_bytes": "CAST(c_custkey % 10 AS BIGINT) * 900000000",
    "disk_total": "CASE WHEN c_custkey % 23 = 0 THEN 0 ELSE CAST(20000000000 AS BIGINT) END",
    "disk_free": "CAST(c_custkey % 12 AS BIGINT) * 1600000000", "disk_warning": "c_custkey % 15 = 0", "disk_stop": "c_custkey % 31 = 0",
}


def user_posts_projection(spark, sf_dir):
    plans = b.table(spark, sf_dir, "customer").select(*(F.expr(e).cast("boolean" if "% 15" in e or "% 31" in e else "long").alias(c) for c,
        e in _PLANS.items()))
    return user_posts_capacity(plans, least_free=1 << 30).select("id", "measured", "modeled", "payload_growth", "snapshot_growth", "growth",
        "final_bytes", "used_percent", "available", "additional", "reasons", "decision")


_ELIGIBLE = """eligible_users AS (SELECT user_id FROM users u WHERE deactivated IS NULL AND (is_closed = FALSE OR can_access = TRUE) AND EXISTS
    (SELECT 1 FROM memberships m JOIN candidates g USING (group_id) WHERE m.user_id = u.user_id AND m.is_current AND g.status = 'approved'))"""
_N = "count(*) FILTER (WHERE {}) AS {}"


def _counts(**conditions: str) -> str:
    return ", ".join(_N.format(c, name) for name, c in conditions.items())


_BACKLOG = f"""WITH
    {sql("candidates", "group_states", "users", "memberships", "subscription_states", "communities", "community_states", "subscriptions", "queue", "runs", "campaigns")},
    {_ELIGIBLE},
 g AS (SELECT
    {_counts(groups="TRUE", groups_without_state="s.group_id IS NULL", groups_metadata_missing="group_ok IS NULL AND NOT coalesce(unavailable, FALSE)", groups_posts_missing="posts_ok IS NULL AND NOT coalesce(unavailable, FALSE)",
   groups_members_missing="members_ok IS NULL AND NOT coalesce(unavailable, FALSE)", groups_unavailable="coalesce(unavailable, FALSE)")} FROM
    candidates c LEFT JOIN group_states s ON s.group_id = c.group_id WHERE c.status = 'approved'),
 u AS (SELECT
    {_counts(users="TRUE", users_accessible="deactivated IS NULL AND (is_closed = FALSE OR can_access = TRUE)", users_profile_missing="profile_day IS NULL", users_profile_stale=f"profile_day < {TODAY - PROFILE_DAYS}",
   users_deactivated="deactivated IS NOT NULL", users_closed="is_closed AND NOT can_access")} FROM users),
 s AS (SELECT
    {_counts(eligible="TRUE", successful="last_success IS NOT NULL", terminal_privacy="last_success IS NULL AND terminal = 'privacy_or_access'", terminal_deleted="last_success IS NULL AND terminal = 'deleted_or_unavailable'",
   transient_deferred=f"last_success IS NULL AND terminal IS NULL AND next_day > {TODAY}", transient_due=f"last_success IS NULL AND terminal IS NULL AND next_day <= {TODAY}", truncated="truncated", unresolved="last_success IS NULL AND terminal IS NULL")}
   FROM eligible_users LEFT JOIN subscription_states USING (user_id)),
 j AS (SELECT c.*, t.community_id AS known, last_success, wall_private, unavailable FROM subscriptions b JOIN communities c USING (community_id) LEFT
    JOIN community_states t ON t.community_id = b.community_id WHERE b.is_current),
 c AS (SELECT
    {", ".join(f"count(DISTINCT community_id) FILTER (WHERE {x}) AS {n}" for n, x in dict(communities="TRUE", communities_metadata_missing="metadata_day IS NULL", communities_metadata_stale=f"metadata_day < {TODAY - METADATA_DAYS}",
   communities_deactivated="deactivated IS NOT NULL", communities_closed="is_closed", walls="deactivated IS NULL", walls_without_state="deactivated IS NULL AND known IS NULL", walls_collected="deactivated IS NULL AND last_success IS NOT NULL",
   walls_private="deactivated IS NULL AND wall_private", walls_unavailable="deactivated IS NULL AND unavailable").items())} FROM j),
 r AS (SELECT
    {_counts(unfinished_pilots="scope LIKE '%pilot%' AND status NOT IN ('completed','completed_with_errors','failed','cancelled')", configuration_mismatches="status IN ('planned','running','waiting_method_limit') AND config <> 1")}
    FROM runs),
 q AS (SELECT {_counts(stale_leases=f"status = 'running' AND locked_day < {TODAY}")}, min(next_day) FILTER (WHERE job_type = 'subscriptions' AND
    status = 'retry_wait' AND next_day > {TODAY}) AS nearest_retry FROM queue),
 a AS (SELECT * FROM campaigns WHERE status IN ('running','paused','planned')), p AS (SELECT count(*) AS campaigns, CAST(coalesce(sum(users), 0) AS
    BIGINT) AS campaign_users FROM a),
 k AS (SELECT count(*) AS kinds_with_several FROM (SELECT 1 FROM a GROUP BY kind HAVING count(*) > 1))
 SELECT *, CASE WHEN eligible = 0 THEN 100.0 ELSE round((successful + terminal_privacy + terminal_deleted) * 100.0 / eligible, 2) END::DOUBLE AS
    coverage,
   CASE WHEN groups_metadata_missing > 0 THEN 'approved_group_metadata' WHEN users_profile_missing + users_profile_stale > 0 THEN 'user_profiles' END
    AS next_light_backlog FROM g, u, s, c, r, q, p, k"""
_TOTALS = {
    "group_candidates": "candidates", "communities": "communities", "communities_with_metadata": "communities WHERE metadata_day IS NOT NULL",
    "group_posts": "orders", "post_attachments": "lineitem", "user_post_states": "wall_states",
    "processed_user_posts": "wall_states WHERE last_success IS NOT NULL",
    "private_user_walls": "wall_states WHERE wall_private", "users": "users",
    "accessible_users": "users WHERE deactivated IS NULL AND (NOT is_closed OR can_access)", "memberships": "memberships",
    "current_memberships": "memberships WHERE is_current", "subscriptions": "subscriptions",
    "current_subscriptions": "subscriptions WHERE is_current", "processed_subscription_users": "subscription_states WHERE last_success IS NOT NULL",
    "community_post_states": "community_states", "communities_with_posts": "community_states WHERE last_success IS NOT NULL",
}
_CAPACITY = f"""WITH p AS (SELECT {", ".join(f"{e} AS {c}" for c, e in _PLANS.items())} FROM customer), v AS (SELECT *, CASE WHEN snapshot_users >= 0
    THEN snapshot_users ELSE 0 END AS su, CASE WHEN due_users BETWEEN 0 AND greatest(snapshot_users, 0) THEN due_users ELSE 0 END AS du,
  CASE WHEN measured_users > 0 THEN measured_users ELSE 0 END AS mu, greatest(growth_bytes, 0) AS gb FROM p),
 m AS (SELECT *, CASE WHEN mu > 0 THEN (gb + mu - 1) // mu ELSE 0 END AS measured, CASE WHEN mu > 0 THEN (posts + mu - 1) // mu * 1184 + (attachments
    + mu - 1) // mu * 384 ELSE 0 END AS modeled FROM v),
 g AS (SELECT *, CAST(ceil(du * (greatest(measured, modeled) + 1024) * 1.3::DOUBLE) AS BIGINT) AS payload_growth, CAST(ceil(su * 112 * 1.3::DOUBLE) AS
    BIGINT) AS snapshot_growth FROM m),
 t AS (SELECT *, payload_growth + snapshot_growth AS growth, database_bytes + payload_growth + snapshot_growth AS final_bytes, greatest(0, disk_free -
    1073741824) AS free FROM g),
 x AS (SELECT *, CASE WHEN disk_total > 0 THEN (disk_total - disk_free + growth) * 100.0::DOUBLE / disk_total ELSE 100 END AS used, least(greatest(0,
    {SAFE_BYTES} - database_bytes), free) AS available FROM t),
 y AS (SELECT *, concat_ws(',', CASE WHEN snapshot_users < 0 THEN 'snapshot_users' END, CASE WHEN due_users IS NULL OR due_users >
    greatest(snapshot_users, 0) THEN 'due_users' END, CASE WHEN measured_users <= 0 THEN 'measured_users' END, CASE WHEN growth_bytes < 0 THEN
    'growth_bytes' END,
   CASE WHEN final_bytes > {SAFE_BYTES} THEN 'database_limit' END, CASE WHEN growth > free THEN 'disk_free' END, CASE WHEN disk_warning OR disk_stop
    OR used >= 85 THEN 'disk_warning' END) AS reasons FROM x)
 SELECT id, CAST(measured AS BIGINT) AS measured, CAST(modeled AS BIGINT) AS modeled, payload_growth, snapshot_growth, growth, final_bytes,
    round(used, 6) AS used_percent, available, greatest(0, growth - available) AS additional, reasons, CASE WHEN reasons = '' THEN 'passed' ELSE
    'rejected' END AS decision FROM y"""
QUERIES = {
    "canonical_backlog": (canonical_backlog, _BACKLOG),
    "backlog_jobs": (backlog_jobs, f"""WITH {sql('queue')} SELECT job_type, status, count(*) AS jobs, count(DISTINCT (entity_type, entity_id)) AS
        entities FROM queue GROUP BY 1, 2"""),
    "report_totals": (report_totals, f"""WITH
        {sql('candidates', 'communities', 'wall_states', 'users', 'memberships', 'subscriptions', 'subscription_states', 'community_states')} """ + " UNION ALL ".join(f"SELECT '{n}' AS name, count(*) AS n FROM {t}" for n,
        t in _TOTALS.items())),
    "report_coverage": (report_coverage, f"""WITH {sql('candidates', 'users', 'memberships', 'subscription_states', 'wall_states')}, {_ELIGIBLE},
        s AS (SELECT count(*) AS e, count(*) FILTER (WHERE next_day > {TODAY} AND (last_success IS NOT NULL OR terminal IS NOT NULL)) AS f, count(*)
        FILTER (WHERE next_day > {TODAY} AND terminal IS NOT NULL) AS t FROM eligible_users LEFT JOIN subscription_states USING (user_id)),
        w AS (SELECT count(*) AS e, count(*) FILTER (WHERE next_day > {TODAY} AND (last_success IS NOT NULL OR wall_private OR unavailable)) AS f,
        count(*) FILTER (WHERE next_day > {TODAY} AND (wall_private OR unavailable)) AS t FROM eligible_users LEFT JOIN wall_states USING (user_id))
        SELECT 'subscriptions' AS scope, e AS eligible, e - f AS due, f AS fresh, t AS terminal FROM s UNION ALL SELECT 'user_posts', e, e - f, f, t
        FROM w"""),
    "report_runs": (report_runs, f"""WITH {sql('runs')} SELECT scope, status, count(*) AS runs, CAST(sum(jobs) AS BIGINT) AS jobs,
        CAST(sum(failed_jobs) AS BIGINT) AS failed FROM runs GROUP BY 1, 2"""),
    "report_queue": (report_queue, f"""WITH {sql('queue')} SELECT job_type, status, count(*) AS jobs, CAST(sum(requests) AS BIGINT) AS requests,
        CAST(sum(inserted) AS BIGINT) AS inserted, CAST(sum(updated) AS BIGINT) AS updated FROM queue GROUP BY 1, 2"""),
    "report_errors": (report_errors, f"""WITH {sql('errors')} SELECT endpoint, category, coalesce(code, 0) AS code, count(*) AS errors FROM errors
        GROUP BY 1, 2, 3 ORDER BY errors DESC, 1, 2, 3 LIMIT 30"""),
    "report_latest_errors": (report_latest_errors, f"""WITH {sql('errors')} SELECT DISTINCT ON (endpoint, category, coalesce(code, 0)) endpoint,
        category, coalesce(code, 0) AS code, number, run_id FROM errors ORDER BY endpoint, category, coalesce(code, 0), number DESC"""),
    "report_failed_jobs": (report_failed_jobs, f"""WITH {sql('queue', 'runs')} SELECT scope, job_type, entity_type, entity_id, job_id FROM queue JOIN
        runs USING (run_id) WHERE queue.status = 'failed' ORDER BY job_id DESC LIMIT 30"""),
    "report_latest_runs": (report_latest_runs, f"""WITH {sql('runs')} SELECT run_id, scope, status, created_day, started_day, jobs, failed_jobs, wakeup_day,
        substr(coalesce(error, ''), 1, 180) AS error FROM runs ORDER BY created_day DESC, run_id LIMIT 10"""),
    "report_latest_campaigns": (report_latest_campaigns, f"""WITH {sql('campaigns')} SELECT campaign_id, kind, status, phase, created_day,
        substr(coalesce(error, ''), 1, 180) AS error FROM campaigns ORDER BY created_day DESC, campaign_id LIMIT 10"""),
    "report_table_sizes": (report_table_sizes, None),
    "report_database_size": (report_database_size, None),
    "database_snapshot": (database_snapshot, f"""WITH {sql('runs', 'queue', 'errors', 'memberships', 'subscriptions', 'candidates', 'method_states', 'subscription_states', 'communities')},
        chosen AS (SELECT * FROM runs r ORDER BY CASE WHEN status = 'running' THEN 1 WHEN EXISTS (SELECT 1 FROM queue j WHERE j.run_id = r.run_id AND
        j.status IN ('pending', 'retry_wait')) THEN 2 ELSE 3 END, created_day DESC, run_id LIMIT 1),
        own AS (SELECT j.* FROM queue j, chosen r WHERE j.run_id = r.run_id), counts AS (SELECT status, count(*) AS n FROM own GROUP BY 1),
        dup(n) AS (SELECT count(*) - count(DISTINCT o_orderkey) FROM orders UNION ALL SELECT count(*) - count(DISTINCT (user_id, group_id)) FROM memberships
        UNION ALL SELECT count(*) - count(DISTINCT (user_id, community_id)) FROM subscriptions)
        SELECT r.run_id, r.status AS run_status, r.error AS run_error, r.created_day AS run_created,
        (SELECT '{{' || coalesce(string_agg('"' || status || '":' || n, ',' ORDER BY status), '') || '}}' FROM counts) AS counts,
        t.*, e.*, (SELECT count(*) FROM dup WHERE n = 0) AS uniqueness_constraints,
        (SELECT count(*) FROM own WHERE entity_type = 'group' AND entity_id IN (SELECT group_id FROM candidates WHERE status = 'rejected')) AS rejected_jobs,
        (SELECT count(*) FROM runs WHERE status IN ('planned', 'running', 'waiting_method_limit')) AS active_runs,
        (SELECT count(*) FROM method_states WHERE blocked_day > {TODAY}) AS blocked_token_methods,
        (SELECT min(blocked_day) FROM method_states WHERE blocked_day > {TODAY}) AS next_method_retry,
        (SELECT count(*) FROM subscription_states WHERE terminal = 'privacy_or_access') AS private_subscriptions,
        (SELECT count(*) FROM subscription_states WHERE last_success IS NOT NULL) AS subscription_users,
        (SELECT count(*) FROM subscriptions) AS subscription_links, (SELECT count(*) FROM communities) AS communities,
        (SELECT count(DISTINCT o_custkey) FROM orders) AS communities_with_posts,
        (SELECT count(*) FROM queue WHERE job_type = 'posts' AND status IN ('pending', 'retry_wait')) AS post_jobs_pending,
        (SELECT count(*) FROM queue WHERE job_type = 'posts' AND status = 'completed') AS post_jobs_completed,
        (SELECT count(*) FROM queue WHERE job_type = 'posts' AND status = 'failed') AS post_jobs_failed
        FROM chosen r, (SELECT CAST(coalesce(sum(requests), 0) AS BIGINT) AS api_requests, CAST(coalesce(sum(inserted), 0) AS BIGINT) AS rows_inserted,
        CAST(coalesce(sum(updated), 0) AS BIGINT) AS rows_updated, CAST(coalesce(sum(greatest(attempts - 1, 0)), 0) AS BIGINT) AS retries,
        max(finished_day) FILTER (WHERE status = 'completed') AS last_completed, max(updated_day) FILTER (WHERE requests > 0) AS last_api,
        min(next_day) FILTER (WHERE status = 'retry_wait') AS next_retry, count(*) FILTER (WHERE status = 'running' AND coalesce(heartbeat_day, locked_day,
        updated_day) < {TODAY - 1}) AS stale_running, count(*) FILTER (WHERE finished_day >= {TODAY - 1} AND status = 'completed') AS completed_24h,
        CAST(coalesce(sum(requests) FILTER (WHERE finished_day >= {TODAY - 1}), 0) AS BIGINT) AS api_24h, CAST(coalesce(sum(inserted) FILTER (WHERE
        finished_day >= {TODAY - 1}), 0) AS BIGINT) AS inserted_24h, CAST(coalesce(sum(updated) FILTER (WHERE finished_day >= {TODAY - 1}), 0) AS BIGINT)
        AS updated_24h FROM own) t,
        (SELECT count(*) FILTER (WHERE x.created_day >= {TODAY - 1}) AS errors_24h, count(*) FILTER (WHERE x.created_day >= {TODAY - 1} AND category ~*
        '.*(auth|token).*') AS auth_24h, count(*) FILTER (WHERE x.created_day >= {TODAY - 1} AND category ~* '.*(rate|limit|flood).*') AS rate_24h
        FROM errors x, chosen c WHERE x.run_id = c.run_id) e"""),
    "user_posts_projection": (user_posts_projection, _CAPACITY),
}
