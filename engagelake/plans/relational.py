"""Queries over joins, aggregations, windows, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import bindings as b
from ..functions import columns as c
from ..operators import aggregates, merkle, windows
from ..operators import quantiles as exact_quantiles

# --- joins ---


def join_inner(spark, sf_dir):
    g = b.groups(spark, sf_dir).where("status = 'approved'")
    return b.posts(spark, sf_dir).join(g, "group_id").select("post_id", "group_id", "name", "published")


def join_multiway(spark, sf_dir):
    p, g = b.posts(spark, sf_dir), b.groups(spark, sf_dir)
    n, r = b.table(spark, sf_dir, "nation"), b.table(spark, sf_dir, "region")
    return p.join(g, "group_id").join(n, F.col("nation") == F.col("n_nationkey")).join(r,
        F.col("n_regionkey") == F.col("r_regionkey")).groupBy("r_name", "status").agg(F.count("*").alias("posts"))


def join_left_state(spark, sf_dir):
    state = b.posts(spark, sf_dir).where("kind = 'F'").groupBy("group_id").agg(F.max("published").alias("last_success"))
    return b.groups(spark, sf_dir).join(state, "group_id", "left").select("group_id", "status", "last_success")


def join_left_agg(spark, sf_dir):
    label = b.posts(spark, sf_dir).where("label < '3'").groupBy("group_id").agg(F.min("label").alias("label"))
    return b.groups(spark, sf_dir).join(label, "group_id", "left").select("group_id",
        F.coalesce("label", F.lit("customer_acquisition")).alias("subject"))


def join_tagged_key(spark, sf_dir):
    j = b.jobs(spark, sf_dir).withColumn("entity_type", F.when(F.col("job_type") == "profile", "user").otherwise("group"))
    g = b.groups(spark, sf_dir).where("status = 'rejected'")
    return g.join(j, (F.col("entity_type") == "group") & (F.col("entity_id") == F.col("group_id"))).select("job_id", "group_id", "job_type")


def semi_exists(spark, sf_dir):
    p = b.posts(spark, sf_dir).join(b.table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'"), F.col("post_id") == F.col("l_orderkey"))
    return b.groups(spark, sf_dir).join(p, "group_id", "left_semi").select("group_id", "name")


def semi_in(spark, sf_dir):
    return b.posts(spark, sf_dir).join(b.groups(spark, sf_dir).where("balance < 0"), "group_id", "left_semi").select("post_id", "group_id")


def anti_not_in(spark, sf_dir):
    return b.groups(spark, sf_dir).join(b.posts(spark, sf_dir).where("kind = 'F'"), "group_id", "left_anti").select("group_id", "status")


def anti_outer_null(spark, sf_dir):
    state = b.posts(spark, sf_dir).where("kind = 'F'").select("group_id").distinct().withColumn("state_id", F.col("group_id"))
    return b.groups(spark, sf_dir).join(state, "group_id", "left").agg(F.count_if(F.col("state_id").isNull()).alias("without_state"),
        F.count("*").alias("groups"))


def or_exists(spark, sf_dir):
    p = b.posts(spark, sf_dir)
    urgent = p.where("label = '1-URGENT'").select("group_id").distinct().withColumn("urgent", F.lit(True))
    large = p.where("reach > 400000").select("group_id").distinct().withColumn("large", F.lit(True))
    return b.groups(spark, sf_dir).join(urgent, "group_id", "left").join(large, "group_id", "left").where("urgent or large").select("group_id")


def cross_single_rows(spark, sf_dir):
    one = b.posts(spark, sf_dir).agg(F.count("*").alias("posts"), F.max("published").alias("newest"))
    return one.crossJoin(b.groups(spark, sf_dir).agg(F.count("*").alias("groups"),
        F.count_if(F.col("status") == "approved").alias("approved")))  # a row each


def set_difference_keys(spark, sf_dir):
    a = b.posts(spark, sf_dir).where("kind = 'F'").select("group_id").distinct()
    d = b.posts(spark, sf_dir).where("kind = 'O'").select("group_id").distinct()
    return a.join(d, "group_id", "left_anti").withColumn("side", F.lit("first")).unionByName(d.join(a, "group_id", "left_anti").withColumn("side",
        F.lit("second")))


def update_from(spark, sf_dir):
    """Posts take their group's address; how many find none must be 0."""
    joined = b.posts(spark, sf_dir).join(b.groups(spark, sf_dir).select("group_id", "name"), "group_id", "left")
    return joined.agg(F.count("*").alias("posts"), F.count_if(F.col("name").isNull()).alias("orphans"), F.countDistinct("name").alias("names"))


def existence_probe(spark, sf_dir):
    return b.jobs(spark, sf_dir).groupBy("run_id").agg(F.max(F.col("status").isin("pending", "running", "retry_wait")).alias("active"),
        F.max(F.col("status") == "failed").alias("failed"))


# --- aggregations ---


def filtered_counts(spark, sf_dir):
    s = F.col("status")
    return b.jobs(spark, sf_dir).agg(F.count("*").alias("jobs"), *(F.count_if(s == x).alias(x) for x in ("completed", "pending", "running", "failed",
        "retry_wait")), F.count_if(F.col("next_attempt").isNull()).alias("unscheduled"))


def distinct_filtered_counts(spark, sf_dir):
    s = F.col("status")
    return aggregates.distinct_where(b.jobs(spark, sf_dir), "entity_id", completed=s == "completed", pending=s == "pending", failed=s == "failed",
        many=F.col("attempts") > 5, scheduled=F.col("next_attempt").isNotNull())


def count_distinct_pair(spark, sf_dir):
    return b.table(spark, sf_dir, "lineitem").agg(F.countDistinct(F.struct("l_orderkey", "l_linenumber")).alias("pairs"),
        F.countDistinct("l_suppkey").alias("suppliers"), F.count("*").alias("n"))


def group_status(spark, sf_dir):
    return b.jobs(spark, sf_dir).groupBy("job_type", "status").agg(F.count("*").alias("n"))


def group_three_keys(spark, sf_dir):
    return b.jobs(spark, sf_dir).groupBy("run_id", "job_type", "priority").agg(F.count("*").alias("n"),
        F.sum(F.col("attempts").cast("long")).alias("attempts"))


def having_duplicates(spark, sf_dir):
    return aggregates.duplicates(b.table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")


def sums_with_defaults(spark, sf_dir):
    late = b.posts(spark, sf_dir).where("published > timestamp_ntz'2001-07-15'").groupBy("group_id").agg(F.sum("post_id").alias("total"),
        F.max("published").alias("newest"))
    return b.groups(spark, sf_dir).join(late, "group_id", "left").select("group_id", F.coalesce("total", F.lit(0)).alias("total"), "newest")


def retry_sum(spark, sf_dir):
    return b.jobs(spark, sf_dir).groupBy("job_type").agg(F.coalesce(F.sum(F.greatest(F.col("attempts") - 1, F.lit(0)).cast("long")),
        F.lit(0)).alias("retries"))


def minmax_by_type(spark, sf_dir):
    cols = []
    for t in ("posts", "members", "profile"):
        when = F.when(F.col("job_type") == t, F.col("entity_id"))
        cols += [F.min(when).alias(f"{t}_first"), F.max(when).alias(f"{t}_last")]
    return b.jobs(spark, sf_dir).where("status = 'pending'").groupBy("run_id").agg(*cols)


def ordered_collect(spark, sf_dir):
    turns = F.array_sort(F.collect_list(F.struct("turn", "role")))
    return b.table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_join(F.transform(turns, lambda x: x["role"]), ",").alias("roles"),
        F.count("*").alias("turns"))


def status_map(spark, sf_dir):
    counted = b.jobs(spark, sf_dir).groupBy("job_type", "status").count()
    entries = F.array_sort(F.collect_list(F.struct("status", "count")))
    return counted.groupBy("job_type").agg(F.to_json(F.map_from_entries(entries)).alias("statuses"))


def ordered_fingerprint(spark, sf_dir):
    """Of the groups, by the root of their tree: one digest that no order of rows changes."""
    g = b.groups(spark, sf_dir)
    return merkle.root(g, F.concat_ws(":", F.col("group_id").cast("string"), "name", "status"), leaf_rows=64).select(F.col("digest").alias("fingerprint"),
        F.col("rows").alias("n"))


def coverage_percent(spark, sf_dir):
    done = F.count_if(F.col("status") == "completed")
    none = F.count_if(F.col("status") == "absent")
    return b.jobs(spark, sf_dir).groupBy("run_id").agg(F.round(c.percent(done, F.count("*")), 4).alias("coverage"),
        c.percent(none, none).alias("empty_coverage"))


def quantiles(spark, sf_dir):
    q33, q66 = exact_quantiles.terciles(b.table(spark, sf_dir, "documents"), F.col("n_chars"))
    return spark.createDataFrame([(round(q33, 6), round(q66, 6))], "q33 double, q66 double")


def row_sizes(spark, sf_dir):
    """Mean bytes of a row's values as text: what a row weighs, by an engine-neutral measure."""
    g = b.groups(spark, sf_dir)
    text = F.concat_ws("|", F.col("group_id").cast("string"), "name", "segment", "status")
    return g.agg(F.round(F.avg(F.octet_length(text)), 6).alias("bytes_per_row"), F.count("*").alias("n"))


def first_last_seen(spark, sf_dir):
    return b.edges(spark, sf_dir).groupBy("community_id").agg(F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"),
        F.count("*").alias("users"))


# --- windows, sorts, limits ---


def top_posts_per_group(spark, sf_dir):
    """The flagship: recent posts of approved groups, the newest first, with the group's label."""
    posts = b.posts(spark, sf_dir).where(F.col("published") >= b.moment("1999-08-01"))
    label = posts.where("label < '3'").groupBy("group_id").agg(F.min("label").alias("subject"))
    approved = b.groups(spark, sf_dir).where("status = 'approved'").select("group_id", "name")
    top = windows.top_per_group(posts.join(approved, "group_id"), ["group_id"], [F.desc("published"), F.asc("post_id")], 3)
    return top.join(label, "group_id", "left").select("group_id", "post_id", "published", "rank",
        F.coalesce("subject", F.lit("customer_acquisition")).alias("subject"), c.modality(F.col("reach") > 100000, F.col("post_id") % 2 == 0,
        F.col("post_id") % 3 == 0).alias("modality"))


def top_events_per_user(spark, sf_dir):
    return windows.top_per_group(b.table(spark, sf_dir, "events"), ["user_id"], [F.desc("ts"), F.asc("event_id")], 20).select("user_id", "event_id",
        "rank")


def latest_per_key(spark, sf_dir):
    return windows.latest_per_key(b.table(spark, sf_dir, "events"), ["user_id", "event_type"], [F.desc("ts"), F.desc("event_id")]).select("user_id",
        "event_type", "event_id", "ts")


def rank_in_stratum(spark, sf_dir):
    p = b.posts(spark, sf_dir).withColumn("hash_rank", c.hash_rank(F.concat_ws(":", F.lit("7"), "post_id", "group_id")))
    return windows.top_per_group(p, ["kind", "label"], [F.asc("hash_rank"), F.asc("post_id")], 10).select("kind", "label", "post_id", "rank")


def pair_difference(spark, sf_dir):
    w = W.partitionBy("user_id").orderBy("ts", "event_id")
    return b.table(spark, sf_dir, "events").select("event_id", F.round(F.abs(F.col("value") - F.lag("value").over(w)), 6).alias("step"))


def priority_pick(spark, sf_dir):
    """The run to look at: with failures first, then active ones, then by number; a flag is joined before the sort."""
    runs = b.jobs(spark, sf_dir).groupBy("run_id").agg(F.max(F.col("status") == "failed").alias("failed"),
        F.max(F.col("status").isin("pending", "running")).alias("active"), F.count("*").alias("jobs"))
    rank = F.when(F.col("failed"), 0).when(F.col("active"), 1).otherwise(2)
    return runs.orderBy(rank, F.desc("jobs"), "run_id").limit(1).select("run_id", "jobs")


def topk_errors(spark, sf_dir):
    errors = b.calls(spark, sf_dir).where("method = 'error'").groupBy("k").agg(F.count("*").alias("n"))
    return errors.orderBy(F.desc("n"), F.asc("k")).limit(10)


def nulls_last_sort(spark, sf_dir):
    return b.jobs(spark, sf_dir).orderBy(F.desc_nulls_last("next_attempt"), F.asc("job_id")).limit(50).select("job_id", "next_attempt")


def nulls_first_page(spark, sf_dir):
    return b.jobs(spark, sf_dir).orderBy(F.desc_nulls_first("next_attempt"), F.asc("job_id")).limit(50).select("job_id")


def distinct_limit(spark, sf_dir):
    return b.edges(spark, sf_dir).select("community_id").distinct().orderBy("community_id").limit(40)


def two_stage_fill(spark, sf_dir):
    """Groups with gaps first, then users up to the budget."""
    gaps = b.groups(spark, sf_dir).join(b.posts(spark, sf_dir).where("kind = 'F'"), "group_id", "left_anti").select(F.lit(0).alias("stage"),
        F.col("group_id").alias("entity_id"))
    users = b.table(spark, sf_dir, "events").select(F.lit(1).alias("stage"), F.col("user_id").alias("entity_id")).distinct()
    return gaps.unionByName(users).orderBy("stage", "entity_id").limit(100)


def round_robin(spark, sf_dir):
    """Pending jobs in turn by type: the first of each, then the second of each."""
    nth = F.row_number().over(W.partitionBy("job_type").orderBy("priority", "created", "job_id"))
    return b.jobs(spark, sf_dir).where("status = 'pending'").withColumn("turn", nth).where("turn <= 40").orderBy("turn",
        "job_type").limit(60).select("turn", "job_type", "job_id")


# --- set operations ---


def union_counts(spark, sf_dir):
    return aggregates.labelled_counts(spark, groups=b.groups(spark, sf_dir), posts=b.posts(spark, sf_dir), edges=b.edges(spark, sf_dir),
        calls=b.calls(spark, sf_dir), pages=b.table(spark, sf_dir, "pages"))


def coverage_union(spark, sf_dir):
    users = b.table(spark, sf_dir, "events").select("user_id").distinct()
    seen = b.table(spark, sf_dir, "events").where("event_type = 'purchase' and value > 90").select("user_id").distinct()
    walls = b.posts(spark, sf_dir).where("kind = 'F'").select("group_id").distinct()
    groups = b.groups(spark, sf_dir).select("group_id")
    one = users.join(seen.withColumn("seen", F.lit(True)), "user_id", "left").agg(F.lit("users").alias("area"), F.count("*").alias("eligible"),
        F.count_if(F.col("seen")).alias("done"))
    two = groups.join(walls.withColumn("seen", F.lit(True)), "group_id", "left").agg(F.lit("walls").alias("area"), F.count("*").alias("eligible"),
        F.count_if(F.col("seen")).alias("done"))
    return one.unionByName(two).withColumn("percent", F.round(c.percent(F.col("done"), F.col("eligible")), 4))


def distinct_projection(spark, sf_dir):
    return b.jobs(spark, sf_dir).select("job_type", "status", "priority").distinct()


def union_probe(spark, sf_dir):
    hit = b.groups(spark, sf_dir).where("segment = 'FURNITURE'").select("group_id").unionByName(b.posts(spark,
        sf_dir).where("label = 'none'").select("group_id")).limit(1)
    return hit.agg((F.count("*") > 0).alias("found"))


G, P, J, C, E = b.GROUPS_SQL, b.POSTS_SQL, b.JOBS_SQL, b.CALLS_SQL, b.EDGES_SQL
_HASH7 = "list_reduce(list_prepend(0::BIGINT, list_transform(range(8), lambda i: ('0x' || substr(sha256('7:' || post_id || ':' || group_id), CAST(8*i+1 AS BIGINT), 8))::BIGINT)), lambda a, w: (a * 294967296 + w) % 1000000000)"
QUERIES = {
    "join_inner": (join_inner, f"""WITH {G}, {P} SELECT post_id, group_id, name, published FROM posts JOIN groups USING (group_id) WHERE status =
        'approved'"""),
    "join_multiway": (join_multiway, f"""WITH {G}, {P} SELECT r_name, status, count(*) AS posts FROM posts JOIN groups USING (group_id) JOIN nation ON
        nation = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2"""),
    "join_left_state": (join_left_state, f"""WITH {G}, {P}, s AS (SELECT group_id, max(published) AS last_success FROM posts WHERE kind = 'F' GROUP BY
        1) SELECT group_id, status, last_success FROM groups LEFT JOIN s USING (group_id)"""),
    "join_left_agg": (join_left_agg, f"""WITH {G}, {P}, l AS (SELECT group_id, min(label) AS label FROM posts WHERE label < '3' GROUP BY 1) SELECT
        group_id, coalesce(label, 'customer_acquisition') AS subject FROM groups LEFT JOIN l USING (group_id)"""),
    "join_tagged_key": (join_tagged_key, f"""WITH {G}, {J} SELECT job_id, group_id, job_type FROM groups JOIN jobs ON job_type <> 'profile' AND
        entity_id = group_id WHERE groups.status = 'rejected'"""),
    "semi_exists": (semi_exists, f"""WITH {G}, {P} SELECT group_id, name FROM groups g WHERE EXISTS (SELECT 1 FROM posts p JOIN lineitem ON post_id =
        l_orderkey WHERE p.group_id = g.group_id AND l_returnflag = 'R')"""),
    "semi_in": (semi_in, f"WITH {G}, {P} SELECT post_id, group_id FROM posts WHERE group_id IN (SELECT group_id FROM groups WHERE balance < 0)"),
    "anti_not_in": (anti_not_in, f"""WITH {G}, {P} SELECT group_id, status FROM groups WHERE group_id NOT IN (SELECT group_id FROM posts WHERE kind =
        'F')"""),
    "anti_outer_null": (anti_outer_null, f"""WITH {G}, {P} SELECT count(*) FILTER (WHERE s.group_id IS NULL) AS without_state, count(*) AS groups FROM
        groups g LEFT JOIN (SELECT DISTINCT group_id FROM posts WHERE kind = 'F') s ON g.group_id = s.group_id"""),
    "or_exists": (or_exists, f"""WITH {G}, {P} SELECT group_id FROM groups g WHERE EXISTS (SELECT 1 FROM posts p WHERE p.group_id = g.group_id AND
        label = '1-URGENT') OR EXISTS (SELECT 1 FROM posts p WHERE p.group_id = g.group_id AND reach > 400000)"""),
    "cross_single_rows": (cross_single_rows, f"""WITH {G}, {P} SELECT * FROM (SELECT count(*) AS posts, max(published) AS newest FROM posts), (SELECT
        count(*) AS groups, count(*) FILTER (WHERE status = 'approved') AS approved FROM groups)"""),
    "set_difference_keys": (set_difference_keys, f"""WITH {P}, a AS (SELECT DISTINCT group_id FROM posts WHERE kind = 'F'), d AS (SELECT DISTINCT
        group_id FROM posts WHERE kind = 'O') SELECT group_id, 'first' AS side FROM (SELECT * FROM a EXCEPT SELECT * FROM d) UNION ALL SELECT
        group_id, 'second' FROM (SELECT * FROM d EXCEPT SELECT * FROM a)"""),
    "update_from": (update_from, f"""WITH {G}, {P} SELECT count(*) AS posts, count(*) FILTER (WHERE name IS NULL) AS orphans, count(DISTINCT name) AS
        names FROM posts LEFT JOIN groups USING (group_id)"""),
    "existence_probe": (existence_probe, f"""WITH {J} SELECT run_id, bool_or(status IN ('pending','running','retry_wait')) AS active, bool_or(status =
        'failed') AS failed FROM jobs GROUP BY 1"""),
    "filtered_counts": (filtered_counts,
    f"WITH {J} SELECT count(*) AS jobs, " + ", ".join(f"count(*) FILTER (WHERE status = '{x}') AS {x}" for x in ("completed", "pending", "running",
    "failed", "retry_wait")) + ", count(*) FILTER (WHERE next_attempt IS NULL) AS unscheduled FROM jobs"),
    "distinct_filtered_counts": (distinct_filtered_counts,
    f"WITH {J} SELECT " + ", ".join(f"count(DISTINCT entity_id) FILTER (WHERE status = '{x}') AS {x}" for x in ("completed", "pending",
    "failed")) + """,
        count(DISTINCT entity_id) FILTER (WHERE attempts > 5) AS many, count(DISTINCT entity_id) FILTER (WHERE next_attempt IS NOT NULL) AS scheduled
        FROM jobs"""),
    "count_distinct_pair": (count_distinct_pair, """SELECT count(DISTINCT (l_orderkey, l_linenumber)) AS pairs, count(DISTINCT l_suppkey) AS
        suppliers, count(*) AS n FROM lineitem"""),
    "group_status": (group_status, f"WITH {J} SELECT job_type, status, count(*) AS n FROM jobs GROUP BY 1, 2"),
    "group_three_keys": (group_three_keys, f"""WITH {J} SELECT run_id, job_type, priority, count(*) AS n, CAST(sum(attempts) AS BIGINT) AS attempts
        FROM jobs GROUP BY 1, 2, 3"""),
    "having_duplicates": (having_duplicates, """SELECT count(*) AS duplicates FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING
        count(*) > 1)"""),
    "sums_with_defaults": (sums_with_defaults, f"""WITH {G}, {P}, s AS (SELECT group_id, CAST(sum(post_id) AS BIGINT) AS total, max(published) AS
        newest FROM posts WHERE published > TIMESTAMP '2001-07-15' GROUP BY 1) SELECT group_id, coalesce(total, 0) AS total, newest FROM groups LEFT
        JOIN s USING (group_id)"""),
    "retry_sum": (retry_sum,
    f"""WITH {J} SELECT job_type, CAST(coalesce(sum(greatest(attempts - 1, 0)), 0) AS BIGINT) AS retries FROM jobs GROUP BY 1"""),
    "minmax_by_type": (minmax_by_type,
    f"WITH {J} SELECT run_id, " + ", ".join(f"min(entity_id) FILTER (WHERE job_type = '{t}') AS {t}_first, max(entity_id) FILTER (WHERE job_type = '{t}') AS {t}_last" for t in ("posts",
    "members", "profile")) + " FROM jobs WHERE status = 'pending' GROUP BY 1"),
    "ordered_collect": (ordered_collect, """SELECT conv_id, string_agg(role, ',' ORDER BY turn, role) AS roles, count(*) AS turns FROM conversations
        GROUP BY 1"""),
    "status_map": (status_map, f"""WITH {J}, c AS (SELECT job_type, status, count(*) AS n FROM jobs GROUP BY 1, 2) SELECT job_type,
        '{{' || string_agg('"' || status || '":' || n, ',' ORDER BY status) || '}}' AS statuses FROM c GROUP BY 1"""),
    "ordered_fingerprint": (ordered_fingerprint, "WITH " + G + ", " + b.merkle_sql("SELECT concat_ws(':', CAST(group_id AS VARCHAR), name, status) AS text FROM groups",
        64) + " SELECT digest AS fingerprint, rows AS n FROM root"),
    "coverage_percent": (coverage_percent, f"""WITH {J} SELECT run_id, round(count(*) FILTER (WHERE status = 'completed') * 100.0 / count(*),
        4)::DOUBLE AS coverage, 100.0::DOUBLE AS empty_coverage FROM jobs GROUP BY 1"""),
    "quantiles": (quantiles, "SELECT round(quantile_cont(n_chars, 0.33), 6) AS q33, round(quantile_cont(n_chars, 0.66), 6) AS q66 FROM documents"),
    "row_sizes": (row_sizes, f"""WITH {G} SELECT round(avg(strlen(concat_ws('|', CAST(group_id AS VARCHAR), name, segment, status))), 6) AS
        bytes_per_row, count(*) AS n FROM groups"""),
    "first_last_seen": (first_last_seen, f"""WITH {E} SELECT community_id, min(first_seen) AS first_seen, max(last_seen) AS last_seen, count(*) AS
        users FROM edges GROUP BY 1"""),
    "top_posts_per_group": (top_posts_per_group, f"""WITH {G}, {P}, w AS (SELECT * FROM posts WHERE published >= TIMESTAMP '1999-08-01'), l AS (SELECT
        group_id, min(label) AS subject FROM w WHERE label < '3' GROUP BY 1),
        r AS (SELECT w.*, row_number() OVER (PARTITION BY group_id ORDER BY published DESC, post_id) AS rank FROM w JOIN groups USING (group_id) WHERE
        status = 'approved')
        SELECT group_id, post_id, published, CAST(rank AS INT) AS rank, coalesce(subject, 'customer_acquisition') AS subject, CASE WHEN post_id % 6 =
        0 THEN 'trimodal' WHEN reach > 100000 AND post_id % 3 = 0 THEN 'text_video' WHEN reach > 100000 AND post_id % 2 = 0 THEN 'text_image'
        WHEN post_id % 3 = 0 THEN 'video_only' WHEN post_id % 2 = 0 THEN 'image_only' WHEN reach > 100000 THEN 'text_only' ELSE 'empty' END AS
        modality FROM r LEFT JOIN l USING (group_id) WHERE rank <= 3"""),
    "top_events_per_user": (top_events_per_user, """SELECT user_id, event_id, CAST(rank AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION
        BY user_id ORDER BY ts DESC, event_id) AS rank FROM events) WHERE rank <= 20"""),
    "latest_per_key": (latest_per_key, """SELECT DISTINCT ON (user_id, event_type) user_id, event_type, event_id, ts FROM events ORDER BY user_id,
        event_type, ts DESC, event_id DESC"""),
    "rank_in_stratum": (rank_in_stratum, f"""WITH {P}, h AS (SELECT *, {_HASH7} AS h FROM posts) SELECT kind, label, post_id, CAST(rank AS INT) AS
        rank FROM (SELECT *, row_number() OVER (PARTITION BY kind, label ORDER BY h, post_id) AS rank FROM h) WHERE rank <= 10"""),
    "pair_difference": (pair_difference, """SELECT event_id, round(abs(value - lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id)), 6) AS
        step FROM events"""),
    "priority_pick": (priority_pick, f"""WITH {J}, r AS (SELECT run_id, bool_or(status = 'failed') AS failed, bool_or(status IN ('pending','running'))
        AS active, count(*) AS jobs FROM jobs GROUP BY 1) SELECT run_id, jobs FROM r ORDER BY CASE WHEN failed THEN 0 WHEN active THEN 1 ELSE 2 END,
        jobs DESC, run_id LIMIT 1"""),
    "topk_errors": (topk_errors, f"WITH {C} SELECT k, count(*) AS n FROM calls WHERE method = 'error' GROUP BY 1 ORDER BY n DESC, k LIMIT 10"),
    "nulls_last_sort": (nulls_last_sort, f"WITH {J} SELECT job_id, next_attempt FROM jobs ORDER BY next_attempt DESC NULLS LAST, job_id LIMIT 50"),
    "nulls_first_page": (nulls_first_page, f"WITH {J} SELECT job_id FROM jobs ORDER BY next_attempt DESC NULLS FIRST, job_id LIMIT 50"),
    "distinct_limit": (distinct_limit, f"WITH {E} SELECT DISTINCT community_id FROM edges ORDER BY 1 LIMIT 40"),
    "two_stage_fill": (two_stage_fill, f"""WITH {G}, {P}, u AS (SELECT 0 AS stage, group_id AS entity_id FROM groups WHERE group_id NOT IN (SELECT
        group_id FROM posts WHERE kind = 'F') UNION ALL SELECT DISTINCT 1, user_id FROM events) SELECT * FROM u ORDER BY stage, entity_id LIMIT 100"""),
    "round_robin": (round_robin, f"""WITH {J}, n AS (SELECT *, row_number() OVER (PARTITION BY job_type ORDER BY priority, created, job_id) AS turn
        FROM jobs WHERE status = 'pending') SELECT CAST(turn AS INT) AS turn, job_type, job_id FROM n ORDER BY turn, job_type LIMIT 60"""),
    "union_counts": (union_counts, f"""WITH {E} SELECT 'groups' AS name, count(*) AS n FROM customer UNION ALL SELECT 'posts', count(*) FROM orders
        UNION ALL SELECT 'edges', count(*) FROM edges UNION ALL SELECT 'calls', count(*) FROM events UNION ALL SELECT 'pages', count(*) FROM pages"""),
    "coverage_union": (coverage_union, f"""WITH {G}, {P}, u AS (SELECT DISTINCT user_id FROM events), s AS (SELECT DISTINCT user_id FROM events WHERE
        event_type = 'purchase' AND value > 90), a AS (SELECT 'users' AS area, count(*) AS eligible, count(s.user_id) AS done FROM u LEFT JOIN s USING
        (user_id)
        UNION ALL SELECT 'walls', count(*), count(w.group_id) FROM groups g LEFT JOIN (SELECT DISTINCT group_id FROM posts WHERE kind = 'F') w ON
        w.group_id = g.group_id) SELECT *, round(CASE WHEN eligible = 0 THEN 100.0 ELSE done * 100.0 / eligible END, 4)::DOUBLE AS percent FROM a"""),
    "distinct_projection": (distinct_projection, f"WITH {J} SELECT DISTINCT job_type, status, priority FROM jobs"),
    "union_probe": (union_probe, "SELECT count(*) > 0 AS found FROM (SELECT c_custkey FROM customer WHERE c_mktsegment = 'FURNITURE' LIMIT 1)"),
}
