"""Composite reports: backlog, runs, invariants, coverage, classification, capacity, issues, exports."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import bindings as b
from ..functions import columns as c
from ..operators import aggregates, windows


def backlog_wide(spark, sf_dir):
    """One row: groups, users, posts and jobs by state, and coverage. Rows without a state count as unresolved."""
    state = b.posts(spark, sf_dir).groupBy("group_id").agg(F.max(F.when(F.col("kind") == "F", F.col("published"))).alias("last_success"),
        F.max(F.when(F.col("kind") == "P", F.col("published"))).alias("deferred"))
    g = b.groups(spark, sf_dir).join(state, "group_id", "left")
    approved = F.col("status") == "approved"
    groups = g.agg(
        F.count("*").alias("groups"), F.count_if(approved).alias("approved"),
        F.count_if(approved & F.col("last_success").isNull()).alias("unresolved"),
        F.count_if(approved & c.stale(F.col("last_success"), b.moment(b.ORDERS_AS_OF), 365 * 86400)).alias("due"),
        F.count_if(approved & F.col("last_success").isNull() & (F.col("deferred") > b.moment("2001-01-01"))).alias("deferred"),
        F.count_if(approved & F.col("last_success").isNotNull()).alias("successful"),
    )
    s = F.col("status")
    jobs = b.jobs(spark, sf_dir).agg(F.count("*").alias("jobs"), F.count_if(s.isin("pending", "retry_wait")).alias("open_jobs"),
        F.count_if(s == "running").alias("leased_jobs"), F.countDistinct("run_id").alias("runs"))
    users = aggregates.distinct_where(b.calls(spark, sf_dir), "token", users=F.lit(True), limited=F.col("code") != 0)
    return groups.crossJoin(jobs).crossJoin(users).withColumn("coverage", F.round(c.percent(F.col("successful"), F.col("approved")), 4))  # a row each


def run_summary(spark, sf_dir):
    s = F.col("status")
    counts = [F.count_if(s == x).alias(x) for x in ("completed", "pending", "running", "failed", "retry_wait")]
    return b.jobs(spark, sf_dir).groupBy("run_id").agg(F.count("*").alias("jobs"), *counts, F.sum(F.col("attempts").cast("long")).alias("attempts"),
        F.sum(F.greatest(F.col("attempts") - 1, F.lit(0)).cast("long")).alias("retries"), F.min("created").alias("first"),
        F.max("created").alias("last"))


def global_summary(spark, sf_dir):
    return aggregates.labelled_counts(spark, **{t: b.table(spark, sf_dir, t) for t in ("region", "nation", "customer", "supplier", "part", "orders",
        "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")})


def verify_invariants(spark, sf_dir):
    """What must be zero: duplicate attachments, posts, edges; orphans; approved and rejected at once."""
    dup = lambda df, name, *k: aggregates.duplicates(df, *k).select(F.lit(name).alias("rule"), F.col("duplicates").alias("violations"))
    orphans = b.posts(spark, sf_dir).join(b.groups(spark, sf_dir), "group_id", "left_anti").agg(F.lit("orphan_posts").alias("rule"),
        F.count("*").alias("violations"))
    rejected = b.posts(spark, sf_dir).join(b.groups(spark, sf_dir).where("status = 'rejected'"), "group_id",
        "left_semi").agg(F.lit("rejected_posts").alias("rule"), F.count("*").alias("violations"))
    out = dup(b.table(spark, sf_dir, "lineitem"), "duplicate_attachments", "l_orderkey", "l_linenumber")
    for part in (dup(b.posts(spark, sf_dir), "duplicate_posts", "post_id"), dup(b.posts(spark, sf_dir), "duplicate_group_dates", "group_id",
        "published"), orphans, rejected):
        out = out.unionByName(part)
    return out.withColumn("holds", F.col("violations") == 0)


def error_categories(spark, sf_dir):
    kind = F.when(F.col("code") == 9, "flood").when(F.col("code") == 6, "rate").otherwise("other")
    return b.calls(spark, sf_dir).where("method = 'error'").groupBy(kind.alias("category")).agg(F.count("*").alias("n"),
        F.countDistinct("token").alias("tokens"), F.max("ts").alias("newest"))


def classification_summary(spark, sf_dir):
    """By language (the subject) and over all: documents, decided, approved, with several labels."""
    d = b.table(spark, sf_dir, "documents").join(b.table(spark, sf_dir, "labels"), "doc_id", "left")
    cols = [F.count("*").alias("documents"), F.count("quality").alias("decided"), F.count_if(F.col("quality") == 1).alias("approved"),
        F.count_if((F.col("quality") == 1) & (F.col("toxic") == 1)).alias("several_labels"),
        F.round(c.percent(F.count("quality"), F.count("*")), 4).alias("coverage")]
    return d.groupBy(F.col("lang").alias("subject")).agg(*cols).unionByName(d.agg(F.lit("all").alias("subject"), *cols))


def search_run_summary(spark, sf_dir):
    """Pages found for each host: all, new ones (first of their path), known ones."""
    p = b.table(spark, sf_dir, "pages").withColumn("host", F.regexp_extract("url", "^https?://([^/]+)", 1)).withColumn("path",
        F.regexp_extract("url", "^https?://[^/]+([^?#]*)", 1))
    first = F.row_number().over(W.partitionBy("host", "path").orderBy("page_id")) == 1
    return p.withColumn("new", first).groupBy("host").agg(F.count("*").alias("found"), F.count_if("new").alias("new"),
        F.count_if(~F.col("new")).alias("known"))


def monitor_snapshot(spark, sf_dir):
    """One row with one JSON object: the chosen run, its jobs, recent calls and totals."""
    runs = run_summary(spark, sf_dir)
    chosen = runs.orderBy(F.when(F.col("running") > 0, 0).when(F.col("pending") > 0, 1).otherwise(2), F.desc("jobs"), "run_id").limit(1)
    recent = b.calls(spark, sf_dir).where(F.col("ts") >= b.moment(b.EVENTS_AS_OF) - F.expr("INTERVAL 24 HOUR")).agg(F.count("*").alias("calls"),
        F.count_if(F.col("code") != 0).alias("limited"))
    totals = b.posts(spark, sf_dir).agg(F.count("*").alias("posts"))
    return chosen.crossJoin(recent).crossJoin(totals).select(F.to_json(F.struct("run_id", "jobs", "completed", "pending", "failed", "retries",
        "calls", "limited", "posts")).alias("snapshot"))  # a row each


def issues(spark, sf_dir):
    """Rules over every run's row: those that hold, the most severe first in order of key."""
    r = run_summary(spark, sf_dir)
    rule = lambda key, severity, holds, detail: F.when(holds, F.struct(F.lit(key).alias("key"), F.lit(severity).alias("severity"),
        detail.cast("string").alias("detail")))
    rules = F.array(
        rule("collection.error", "critical", F.col("failed") > 10, F.col("failed")),
        rule("collection.no_active_run", "critical", F.col("running") + F.col("pending") == 0, F.col("jobs")),
        rule("collection.stalled", "critical", (F.col("pending") > 0) & (F.col("running") == 0), F.col("pending")),
        rule("collection.retry_spike", "warning", F.col("retries") >= F.col("jobs") * 3, F.col("retries")),
        rule("collection.errors", "warning", (F.col("failed") > 0) & (F.col("failed") <= 10), F.col("failed")),
        rule("collection.method_limit_wait", "warning", F.col("retry_wait") > F.col("completed") / 2, F.col("retry_wait")),
    )
    return r.select("run_id", F.explode(F.filter(rules, lambda x: x.isNotNull())).alias("i")).select("run_id", "i.*")


def keyword_effectiveness(spark, sf_dir):
    """For each subject: distinct groups and keywords, and links between them."""
    links = b.posts(spark, sf_dir).select("group_id", "label").distinct().join(b.groups(spark, sf_dir), "group_id")
    return links.groupBy(F.col("segment").alias("subject")).agg(F.countDistinct("group_id").alias("groups"), F.count("*").alias("links"),
        F.countDistinct("label").alias("keywords"))


def cooldown_summary(spark, sf_dir):
    now = b.moment("2024-01-30 00:00:00")
    until = F.when(F.col("code") != 0, F.col("ts") + F.expr("INTERVAL 2 HOUR"))
    return b.calls(spark, sf_dir).groupBy("method").agg(F.count_if(until > now).alias("blocked"),
        F.min(F.when(until > now, until)).alias("next_free"), F.count_if(F.col("code") == 0).alias("successes"))


def pilot_decisions(spark, sf_dir):
    """A decision for each run, by its jobs."""
    r = run_summary(spark, sf_dir)
    open_ = F.col("pending") + F.col("running") + F.col("retry_wait")
    return r.select("run_id", F.when(F.col("jobs") == 0, "empty").when(open_ == 0, "finished").when(F.col("running") > 0,
        "active").when(F.col("pending") > 0, "resumable").otherwise("waiting").alias("classification"), open_.alias("open"))


def plan_preview(spark, sf_dir):
    """Requests and bytes that collecting the due groups would need."""
    g = b.posts(spark, sf_dir).groupBy("group_id").agg(F.count("*").alias("posts")).join(b.groups(spark, sf_dir).where("status = 'approved'"),
        "group_id")
    pages = c.pages_needed(F.col("posts"), 5)
    return g.agg(F.count("*").alias("jobs"), F.sum(pages).alias("requests"), F.sum(F.col("posts") * 768).alias("bytes"))


def capacity_projection(spark, sf_dir):
    """Growth per measured user carried to all, a snapshot's bytes, a reserve of 30 %, and what stands against it."""
    due = b.groups(spark, sf_dir).agg(F.count("*").alias("due"))
    measured = b.edges(spark, sf_dir).agg(F.countDistinct("user_id").alias("measured"), F.count("*").alias("rows")).withColumn("growth_bytes",
        F.col("rows") * 101)
    x = due.crossJoin(measured)  # a row each
    x = x.withColumn("growth", F.ceil(F.col("growth_bytes") * F.col("due") / F.col("measured").cast("double"))).withColumn("snapshot",
        F.col("due") * 112).withColumn("total", F.ceil((F.col("growth") + F.col("snapshot")) * 1.3))
    reasons = F.filter(F.array(F.when(F.col("total") > 10_000_000, "over_limit"), F.when(F.col("measured") < 500, "small_pilot")),
        lambda r: r.isNotNull())
    return x.select("due", "measured", "growth", "snapshot", "total", F.array_join(reasons, ",").alias("reasons"),
        (F.size(reasons) == 0).alias("passes"))


def eligible_posts(spark, sf_dir):
    """Posts for export with their attachments in order, as JSON; posts of approved groups in the window, five for each."""
    p = b.posts(spark, sf_dir).where("published >= timestamp_ntz'2001-03-01'").join(b.groups(spark,
        sf_dir).where("status = 'approved'").select("group_id", "name"), "group_id")
    top = windows.top_per_group(p, ["group_id"], [F.desc("published"), F.asc("post_id")], 5)
    a = b.table(spark, sf_dir,
        "lineitem").groupBy(F.col("l_orderkey").alias("post_id")).agg(F.transform(F.array_sort(F.collect_list(F.struct(F.col("l_linenumber").alias("position"),
        F.col("l_partkey").alias("part")))), lambda x: x).alias("attachments"))
    items = F.transform(F.coalesce("attachments", F.array()), lambda x: F.concat_ws(":", x["position"].cast("string"), x["part"].cast("string")))
    return top.join(a, "post_id", "left").select("group_id", "post_id", "rank", F.array_join(items, ",").alias("attachments"))


def eligible_profiles(spark, sf_dir):
    """Users with a recent post and a current subscription, both listed; the largest communities first."""
    sizes = b.edges(spark, sf_dir).groupBy("community_id").agg(F.count("*").alias("members"))
    subs = b.edges(spark, sf_dir).where("last_seen >= timestamp_ntz'2001-06-01'").join(sizes, "community_id")
    listed = subs.groupBy("user_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("members")).alias("m"),
        "community_id"))), lambda x: x["community_id"].cast("string")), ",").alias("communities"))
    posts = b.posts(spark,
        sf_dir).where("published >= timestamp_ntz'2001-03-01'").groupBy(F.col("group_id").alias("user_id")).agg(F.array_join(F.transform(F.array_sort(F.collect_list("post_id")),
        lambda x: x.cast("string")), ",").alias("posts"))
    return posts.join(listed, "user_id")


def pending_batch(spark, sf_dir):
    """The next hundred undecided documents, numbered from 0."""
    pending = b.table(spark, sf_dir, "documents").join(b.table(spark, sf_dir, "labels").where("quality is not null"), "doc_id",
        "left_anti").orderBy("doc_id").limit(100)
    return pending.select("doc_id", (F.row_number().over(W.partitionBy(F.lit(1)).orderBy("doc_id")) - 1).alias("position"))


def decision_coverage(spark, sf_dir):
    """Ids of a batch without a decision, and decisions for ids outside it."""
    batch = b.table(spark, sf_dir, "documents").where("lang = 'en'").select("doc_id")
    decided = b.table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return batch.join(decided, "doc_id", "left_anti").agg(F.lit("missing").alias("kind"),
        F.count("*").alias("n")).unionByName(decided.join(batch, "doc_id", "left_anti").agg(F.lit("foreign").alias("kind"), F.count("*").alias("n")))


def decision_violations(spark, sf_dir):
    """Approved without labels, or labels without approval."""
    d = b.table(spark, sf_dir, "labels").select("doc_id", F.col("quality") == 1, F.col("toxic") == 1).toDF("doc_id", "approved", "labelled")
    return d.where(F.col("approved") != F.col("labelled")).groupBy("approved").agg(F.count("*").alias("violations"))


def audit_metrics(spark, sf_dir):
    """Precision, false negatives and exact matches of a reviewer against the labels, with the gates."""
    d = b.table(spark, sf_dir, "labels").join(b.table(spark, sf_dir, "documents"), "doc_id").withColumn("said",
        F.when(F.col("n_chars") % 7 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    share = lambda a, n: F.coalesce(F.try_divide(a.cast("double"), n), F.lit(0.0))
    m = d.agg(F.count("*").alias("n"), share(F.count_if((F.col("said") == 1) & (F.col("quality") == 1)), F.count_if(F.col("said") == 1)).alias("p"),
        share(F.count_if((F.col("said") == 0) & (F.col("quality") == 1)), F.count_if(F.col("said") == 0)).alias("f"),
        share(F.count_if(F.col("said") == F.col("quality")), F.count("*")).alias("e"))
    return m.select("n", F.round("p", 4).alias("precision"), F.round("f", 4).alias("false_negatives"), F.round("e", 4).alias("exact"),
        ((F.col("p") >= 0.9) & (F.col("f") <= 0.1) & (F.col("e") >= 0.85) & (F.col("n") >= 300)).alias("passes"))


def audit_sample(spark, sf_dir):
    """Disjoint strata in order of priority, each by hash rank up to its size."""
    d = b.table(spark, sf_dir, "documents").join(b.table(spark, sf_dir, "labels"), "doc_id", "left")
    stratum = F.when(F.col("quality") == 0, "rejected").when(F.col("toxic") == 1, "several").when(F.col("quality") == 1,
        "approved").when(F.col("n_chars") > 5000, "long").otherwise("undecided")
    size = F.create_map(*map(F.lit, ("rejected", 20, "several", 10, "approved", 40, "long", 15, "undecided", 30)))
    rank = c.hash_rank(F.concat_ws(":", F.lit("20260730"), F.col("doc_id").cast("string")))
    numbered = d.withColumn("stratum", stratum).withColumn("rank", F.row_number().over(W.partitionBy("stratum").orderBy(rank, "doc_id")))
    # the literal bound, that of the largest stratum, limits the sort before and after the shuffle
    return numbered.where("rank <= 40").where(F.col("rank") <= size[F.col("stratum")]).select("doc_id", "stratum")


def pilot_selection(spark, sf_dir):
    """Per label five groups by hash rank, and five with several labels, without repeats."""
    rank = c.hash_rank(F.concat_ws(":", F.lit("9"), F.col("group_id").cast("string")))
    per = b.posts(spark, sf_dir).select("group_id", "label").distinct()
    each = windows.top_per_group(per.withColumn("h", rank), ["label"], [F.asc("h"), F.asc("group_id")], 5).select("group_id")
    several = per.groupBy("group_id").agg(F.count("*").alias("labels")).where("labels > 4").withColumn("h", rank).orderBy("h",
        "group_id").limit(5).select("group_id")
    return each.unionByName(several).distinct()


def pilot_measure(spark, sf_dir):
    """Rows before and after, by table: what grew."""
    before = aggregates.labelled_counts(spark, posts=b.posts(spark, sf_dir).where("published < timestamp_ntz'2000-01-01'"),
        edges=b.edges(spark, sf_dir).where("first_seen < timestamp_ntz'2000-01-01'"))
    after = aggregates.labelled_counts(spark, posts=b.posts(spark, sf_dir), edges=b.edges(spark, sf_dir))
    j = before.withColumnRenamed("n", "before").join(after.withColumnRenamed("n", "after"), "name")
    return j.select("name", "before", "after", (F.col("after") - F.col("before")).alias("grown"),
        F.ceil((F.col("after") - F.col("before")) * 1.3).alias("projected"))


def strict_ids(spark, sf_dir):
    """Ids of a page: valid ones (whole and positive), sorted and without repeats, and the next offset by the raw length."""
    ids = F.transform(F.array_sort(F.collect_list("l_suppkey")), lambda x: x - 3)
    return b.table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(ids.alias("raw")).select("l_orderkey",
        F.array_join(F.transform(F.array_distinct(F.filter("raw", lambda x: x > 0)), lambda x: x.cast("string")), ",").alias("ids"),
        F.size("raw").cast("long").alias("next_offset"), F.size(F.filter("raw", lambda x: x <= 0)).cast("long").alias("invalid"))


G, P, J, C, E = b.GROUPS_SQL, b.POSTS_SQL, b.JOBS_SQL, b.CALLS_SQL, b.EDGES_SQL
_RUNS = "runs AS (SELECT run_id, count(*) AS jobs, " + ", ".join(f"count(*) FILTER (WHERE status = '{x}') AS {x}" for x in ("completed", "pending",
    "running", "failed", "retry_wait")) + """,
    CAST(sum(attempts) AS BIGINT) AS attempts, CAST(sum(greatest(attempts - 1, 0)) AS BIGINT) AS retries, min(created) AS first, max(created) AS last
    FROM jobs GROUP BY 1)"""
_HASH = "list_reduce(list_prepend(0::BIGINT, list_transform(range(8), lambda i: ('0x' || substr(sha256(TEXT), CAST(8*i+1 AS BIGINT), 8))::BIGINT)), lambda x, w: (x * 294967296 + w) % 1000000000)"
_RULES = (("collection.error", "critical", "failed > 10", "failed"), ("collection.no_active_run", "critical", "running + pending = 0", "jobs"),
    ("collection.stalled", "critical", "pending > 0 AND running = 0", "pending"), ("collection.retry_spike", "warning", "retries >= jobs * 3",
    "retries"), ("collection.errors", "warning", "failed > 0 AND failed <= 10", "failed"),
    ("collection.method_limit_wait", "warning", "retry_wait > completed / 2", "retry_wait"))
QUERIES = {
    "backlog_wide": (backlog_wide, f"""WITH {G}, {P}, {J}, {C}, s AS (SELECT group_id, max(published) FILTER (WHERE kind = 'F') AS ok, max(published)
        FILTER (WHERE kind = 'P') AS later FROM posts GROUP BY 1), a AS (SELECT * FROM groups LEFT JOIN s USING (group_id)),
        g AS (SELECT count(*) AS groups, count(*) FILTER (WHERE status = 'approved') AS approved, count(*) FILTER (WHERE status = 'approved' AND ok IS
        NULL) AS unresolved, count(*) FILTER (WHERE status = 'approved' AND (ok IS NULL OR ok < TIMESTAMP '{b.ORDERS_AS_OF}' - INTERVAL 365 DAY)) AS
        due,
        count(*) FILTER (WHERE status = 'approved' AND ok IS NULL AND later > TIMESTAMP '2001-01-01') AS deferred, count(*) FILTER (WHERE status =
        'approved' AND ok IS NOT NULL) AS successful FROM a),
        j AS (SELECT count(*) AS jobs, count(*) FILTER (WHERE status IN ('pending','retry_wait')) AS open_jobs, count(*) FILTER (WHERE status =
        'running') AS leased_jobs, count(DISTINCT run_id) AS runs FROM jobs), u AS (SELECT count(DISTINCT token) AS users, count(DISTINCT token)
        FILTER (WHERE code <> 0) AS limited FROM calls)
        SELECT *, round(CASE WHEN approved = 0 THEN 100.0 ELSE successful * 100.0 / approved END, 4)::DOUBLE AS coverage FROM g, j, u"""),
    "run_summary": (run_summary, f"WITH {J}, {_RUNS} SELECT * FROM runs"),
    "global_summary": (global_summary, " UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS n FROM {t}" for t in ("region", "nation", "customer",
    "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"))),
    "verify_invariants": (verify_invariants, f"""WITH {G}, {P}, v AS (SELECT 'duplicate_attachments' AS rule, count(*) AS violations FROM (SELECT 1
        FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) UNION ALL SELECT 'duplicate_posts', count(*) FROM (SELECT 1 FROM posts
        GROUP BY post_id HAVING count(*) > 1)
        UNION ALL SELECT 'duplicate_group_dates', count(*) FROM (SELECT 1 FROM posts GROUP BY group_id, published HAVING count(*) > 1) UNION ALL
        SELECT 'orphan_posts', count(*) FROM posts WHERE group_id NOT IN (SELECT group_id FROM groups) UNION ALL SELECT 'rejected_posts', count(*)
        FROM posts WHERE group_id IN (SELECT group_id FROM groups WHERE status = 'rejected')) SELECT *, violations = 0 AS holds FROM v"""),
    "error_categories": (error_categories, f"""WITH {C} SELECT CASE WHEN code = 9 THEN 'flood' WHEN code = 6 THEN 'rate' ELSE 'other' END AS category,
        count(*) AS n, count(DISTINCT token) AS tokens, max(ts) AS newest FROM calls WHERE method = 'error' GROUP BY 1"""),
    "classification_summary": (classification_summary, """WITH d AS (SELECT lang, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)), u AS
        (SELECT lang AS subject, quality, toxic FROM d UNION ALL SELECT 'all', quality, toxic FROM d)
        SELECT subject, count(*) AS documents, count(quality) AS decided, count(*) FILTER (WHERE quality = 1) AS approved, count(*) FILTER (WHERE
        quality = 1 AND toxic = 1) AS several_labels, round(count(quality) * 100.0 / count(*), 4)::DOUBLE AS coverage FROM u GROUP BY 1"""),
    "search_run_summary": (search_run_summary, """WITH p AS (SELECT page_id, regexp_extract(url, '^https?://([^/]+)', 1) AS host, regexp_extract(url,
        '^https?://[^/]+([^?#]*)', 1) AS path FROM pages), f AS (SELECT host, row_number() OVER (PARTITION BY host, path ORDER BY page_id) = 1 AS new
        FROM p) SELECT host, count(*) AS found, count(*) FILTER (WHERE new) AS new, count(*) FILTER (WHERE NOT new) AS known FROM f GROUP BY 1"""),
    "monitor_snapshot": (monitor_snapshot, f"""WITH {J}, {C}, {_RUNS}, r AS (SELECT * FROM runs ORDER BY CASE WHEN running > 0 THEN 0 WHEN pending > 0
        THEN 1 ELSE 2 END, jobs DESC, run_id LIMIT 1), c AS (SELECT count(*) AS calls, count(*) FILTER (WHERE code <> 0) AS limited FROM calls WHERE
        ts >= TIMESTAMP '{b.EVENTS_AS_OF}' - INTERVAL 24 HOUR), p AS (SELECT count(*) AS posts FROM orders)
        SELECT
        '{{"run_id":' || run_id || ',"jobs":' || jobs || ',"completed":' || completed || ',"pending":' || pending || ',"failed":' || failed || ',"retries":' || retries || ',"calls":' || calls || ',"limited":' || limited || ',"posts":' || posts || '}}'
        AS snapshot FROM r, c, p"""),
    "issues": (issues,
    f"WITH {J}, {_RUNS} " + " UNION ALL ".join(f"SELECT run_id, '{k}' AS key, '{s}' AS severity, CAST({d} AS VARCHAR) AS detail FROM runs WHERE {h}" for k,
    s, h, d in _RULES)),
    "keyword_effectiveness": (keyword_effectiveness, f"""WITH {G}, {P}, l AS (SELECT DISTINCT group_id, label FROM posts) SELECT segment AS subject,
        count(DISTINCT group_id) AS groups, count(*) AS links, count(DISTINCT label) AS keywords FROM l JOIN groups USING (group_id) GROUP BY 1"""),
    "cooldown_summary": (cooldown_summary, f"""WITH {C}, u AS (SELECT *, CASE WHEN code <> 0 THEN ts + INTERVAL 2 HOUR END AS until FROM calls) SELECT
        method, count(*) FILTER (WHERE until > TIMESTAMP '2024-01-30') AS blocked, min(until) FILTER (WHERE until > TIMESTAMP '2024-01-30') AS
        next_free, count(*) FILTER (WHERE code = 0) AS successes FROM u GROUP BY 1"""),
    "pilot_decisions": (pilot_decisions, f"""WITH {J}, {_RUNS}, o AS (SELECT *, pending + running + retry_wait AS open FROM runs) SELECT run_id, CASE
        WHEN jobs = 0 THEN 'empty' WHEN open = 0 THEN 'finished' WHEN running > 0 THEN 'active' WHEN pending > 0 THEN 'resumable' ELSE 'waiting' END
        AS classification, open FROM o"""),
    "plan_preview": (plan_preview, f"""WITH {G}, {P}, n AS (SELECT group_id, count(*) AS posts FROM posts GROUP BY 1) SELECT count(*) AS jobs,
        CAST(sum((posts + 4) // 5) AS BIGINT) AS requests, CAST(sum(posts * 768) AS BIGINT) AS bytes FROM n JOIN groups USING (group_id) WHERE status
        = 'approved'"""),
    "capacity_projection": (capacity_projection, f"""WITH {E}, d AS (SELECT count(*) AS due FROM customer), m AS (SELECT count(DISTINCT user_id) AS
        measured, count(*) AS n FROM edges), g AS (SELECT due, measured, CAST(ceil(n * 101 * due / measured::DOUBLE) AS BIGINT) AS growth, due * 112
        AS snapshot FROM d, m), t AS (SELECT *, CAST(ceil((growth + snapshot) * 1.3::DOUBLE) AS BIGINT) AS total FROM g)
        SELECT due, measured, growth, snapshot, total, concat_ws(',', CASE WHEN total > 10000000 THEN 'over_limit' END, CASE WHEN measured < 500 THEN
        'small_pilot' END) AS reasons, total <= 10000000 AND measured >= 500 AS passes FROM t"""),
    "eligible_posts": (eligible_posts, f"""WITH {G}, {P}, r AS (SELECT p.*, row_number() OVER (PARTITION BY group_id ORDER BY published DESC, post_id)
        AS rank FROM posts p JOIN groups USING (group_id) WHERE status = 'approved' AND published >= TIMESTAMP '2001-03-01'),
        a AS (SELECT l_orderkey AS post_id, string_agg(l_linenumber || ':' || l_partkey, ',' ORDER BY l_linenumber, l_partkey) AS attachments FROM
        lineitem GROUP BY 1) SELECT group_id, post_id, CAST(rank AS INT) AS rank, coalesce(attachments, '') AS attachments FROM r LEFT JOIN a USING
        (post_id) WHERE rank <= 5"""),
    "eligible_profiles": (eligible_profiles, f"""WITH {E}, {P}, z AS (SELECT community_id, count(*) AS members FROM edges GROUP BY 1), l AS (SELECT
        user_id, string_agg(community_id, ',' ORDER BY members DESC, community_id) AS communities FROM edges JOIN z USING (community_id) WHERE
        last_seen >= TIMESTAMP '2001-06-01' GROUP BY 1),
        p AS (SELECT group_id AS user_id, string_agg(post_id, ',' ORDER BY post_id) AS posts FROM posts WHERE published >= TIMESTAMP '2001-03-01'
        GROUP BY 1) SELECT user_id, posts, communities FROM p JOIN l USING (user_id)"""),
    "pending_batch": (pending_batch, """SELECT doc_id, CAST(row_number() OVER (ORDER BY doc_id) - 1 AS INT) AS position FROM documents WHERE doc_id
        NOT IN (SELECT doc_id FROM labels WHERE quality IS NOT NULL) ORDER BY doc_id LIMIT 100"""),
    "decision_coverage": (decision_coverage, """SELECT 'missing' AS kind, count(*) AS n FROM documents WHERE lang = 'en' AND doc_id NOT IN (SELECT
        doc_id FROM labels WHERE quality = 1) UNION ALL SELECT 'foreign', count(*) FROM labels WHERE quality = 1 AND doc_id NOT IN (SELECT doc_id FROM
        documents WHERE lang = 'en')"""),
    "decision_violations": (decision_violations, """SELECT quality = 1 AS approved, count(*) AS violations FROM labels WHERE (quality = 1) <> (toxic =
        1) GROUP BY 1"""),
    "audit_metrics": (audit_metrics, """WITH d AS (SELECT quality, CASE WHEN n_chars % 7 = 0 THEN 1 - quality ELSE quality END AS said FROM labels
        JOIN documents USING (doc_id)), m AS (SELECT count(*) AS n, coalesce(count(*) FILTER (WHERE said = 1 AND quality = 1) / nullif(count(*) FILTER
        (WHERE said = 1), 0)::DOUBLE, 0) AS p, coalesce(count(*) FILTER (WHERE said = 0 AND quality = 1) / nullif(count(*) FILTER (WHERE said = 0),
        0)::DOUBLE, 0) AS f, count(*) FILTER (WHERE said = quality) / count(*)::DOUBLE AS e FROM d)
        SELECT n, round(p, 4) AS precision, round(f, 4) AS false_negatives, round(e, 4) AS exact, p >= 0.9 AND f <= 0.1 AND e >= 0.85 AND n >= 300 AS
        passes FROM m"""),
    "audit_sample": (audit_sample, f"""WITH s AS (SELECT doc_id, CASE WHEN quality = 0 THEN 'rejected' WHEN toxic = 1 THEN 'several' WHEN quality = 1
        THEN 'approved' WHEN n_chars > 5000 THEN 'long' ELSE 'undecided' END AS stratum, {_HASH.replace("TEXT", "'20260730:' || doc_id")} AS h FROM
        documents LEFT JOIN labels USING (doc_id)), r AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY h, doc_id) AS rank FROM s) SELECT
        doc_id, stratum FROM r WHERE rank <= CASE stratum WHEN 'rejected' THEN 20 WHEN 'several' THEN 10 WHEN 'approved' THEN 40 WHEN 'long' THEN 15
        ELSE 30 END"""),
    "pilot_selection": (pilot_selection, f"""WITH {P}, l AS (SELECT DISTINCT group_id, label, {_HASH.replace("TEXT", "'9:' || group_id")} AS h FROM
        posts), r AS (SELECT group_id FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY h, group_id) AS n FROM l) WHERE n <= 5), m AS
        (SELECT group_id FROM (SELECT group_id, h, count(*) AS n FROM l GROUP BY 1, 2) WHERE n > 4 ORDER BY h, group_id LIMIT 5) SELECT group_id FROM
        r UNION SELECT group_id FROM m"""),
    "pilot_measure": (pilot_measure, f"""WITH {E}, n AS (SELECT 'posts' AS name, count(*) FILTER (WHERE o_orderdate < TIMESTAMP '2000-01-01') AS
        before, count(*) AS after FROM orders UNION ALL SELECT 'edges', count(*) FILTER (WHERE first_seen < TIMESTAMP '2000-01-01'), count(*) FROM
        edges) SELECT *, after - before AS grown, CAST(ceil((after - before) * 1.3::DOUBLE) AS BIGINT) AS projected FROM n"""),
    "strict_ids": (strict_ids, """WITH r AS (SELECT l_orderkey, list_sort(list(l_suppkey - 3)) AS raw FROM lineitem GROUP BY 1) SELECT l_orderkey,
        array_to_string(list_sort(list_distinct(list_filter(raw, lambda x: x > 0))), ',') AS ids, len(raw) AS next_offset, len(list_filter(raw, lambda
        x: x <= 0)) AS invalid FROM r"""),
}
