"""Nested exports, the import of embedding bundles, and the checks of repeated, altered and outdated imports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import bindings as b
from ..functions import columns as c
from ..operators import encoding, merkle, windows
from ..operators import merge as m

POSTS_FROM, EDGES_FROM = "2001-03-01", "2001-06-01"


def attachment_lists(spark, sf_dir) -> DataFrame:
    """post_id, attachments: in order of position, photo or video by part."""
    part = F.col("l_partkey")
    item = F.struct(F.col("l_linenumber").alias("position"), F.when(part % 3 == 0, "video").otherwise("photo").alias("type"), part.alias("id"),
        F.col("l_quantity").cast("int").alias("width"))
    return b.table(spark, sf_dir,
        "lineitem").groupBy(F.col("l_orderkey").alias("post_id")).agg(F.array_sort(F.collect_list(item)).alias("attachments"))


def with_modality(posts: DataFrame, attachments: DataFrame) -> DataFrame:
    """Posts (post_id, text, ...) with their attachments, none where there are none, and the modality of all."""
    a = posts.join(attachments, "post_id", "left")
    empty = F.array().cast(attachments.schema["attachments"].dataType)
    a = a.withColumn("attachments", F.coalesce("attachments", empty))
    has = lambda kind: F.exists("attachments", lambda x: x["type"] == kind)
    text = c.strip(F.coalesce("text", F.lit("")))
    return a.withColumn("modality", c.modality(text != "", has("photo"), has("video"))).withColumn("text", text)


def company_posts(spark, sf_dir):
    """Posts of approved groups in the window, five for each group, ranked after both filters: nested records as JSON.

    The subject is the least label, or a default where there is none; posts without a group drop out.
    """
    p = b.posts(spark, sf_dir).where(F.col("published") >= b.moment(POSTS_FROM)).withColumn("text",
        F.when(F.col("post_id") % 4 != 0, F.concat(F.lit("  "), "label")))
    labels = b.posts(spark, sf_dir).where("kind = 'P'").groupBy("group_id").agg(F.min("label").alias("subject"))
    approved = b.groups(spark, sf_dir).where("status = 'approved'").select("group_id").join(labels, "group_id", "left")
    top = windows.top_per_group(p.join(approved, "group_id"), ["group_id"], [F.desc("published"), F.asc("post_id")], 5)
    full = with_modality(top, attachment_lists(spark, sf_dir))
    record = F.struct("post_id", "group_id", F.coalesce("subject", F.lit("customer_acquisition")).alias("subject"), "text",
        F.col("modality").alias("modality_profile"), "attachments")
    return full.select("group_id", "post_id", F.to_json(record).alias("record"))


def demographics(row: dict[str, Column]) -> tuple[Column, Column, Column]:
    """(text, number of attributes, map without nulls) of eight attributes in fixed order; an empty city or education is none."""
    sex = row["sex"]
    filled = lambda x: F.when(x != "", x)
    parts = [
        ("пол", F.when(sex == 2, "мужской").when(sex == 1, "женский").otherwise(sex.cast("string"))), ("город", filled(row["city"])),
        ("образование", filled(row["education"])), ("семейное положение", row["relation"]),
        ("подарки", row["gifts"]), ("подписчики", row["followers"]), ("друзья", row["friends"]), ("день рождения", row["birthday"]),
    ]
    shown = [F.concat(F.lit(f"{name}: "), value.cast("string")) for name, value in parts]
    known = F.map_filter(F.create_map(*[x for k, v in row.items() for x in (F.lit(k), v.cast("string"))]), lambda k, v: v.isNotNull())
    return F.concat_ws(", ", *shown), sum((x.isNotNull().cast("long") for x in shown), F.lit(0).cast("long")), known


#: Attributes of a user, made from the id.
PEOPLE = {
    "sex": "CASE WHEN c_custkey % 4 <> 0 THEN c_custkey % 3 END",
    "city": "CASE c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'city ' || CAST(c_nationkey AS VARCHAR(9)) END",
    "education": "CASE WHEN c_custkey % 6 = 0 THEN c_mktsegment END",
    "relation": "CASE WHEN c_custkey % 7 < 3 THEN c_custkey % 7 END", "gifts": "CASE WHEN c_custkey % 8 < 4 THEN c_custkey % 8 END",
    "followers": "CASE WHEN c_custkey % 9 < 5 THEN c_custkey * 3 END", "friends": "CASE WHEN c_custkey % 10 < 6 THEN c_custkey * 2 END",
    "birthday": "CASE WHEN c_custkey % 11 < 7 THEN '1.' || CAST(c_custkey % 12 + 1 AS VARCHAR(9)) END",
}


def demographics_full(spark, sf_dir):
    """All eight attributes as text, their number, and how many entries the map without nulls has."""
    people = b.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), *(F.expr(e).alias(k) for k, e in PEOPLE.items()))
    text, number, known = demographics({k: F.col(k) for k in PEOPLE})
    return people.select("user_id", text.alias("about"), number.alias("attributes"), F.size(known).cast("long").alias("known"))


def user_profiles(spark, sf_dir):
    """Profiles of users with a recent post and a current subscription: three latest posts, communities by size, attributes; nested JSON.

    Communities of unknown size come last; a missing name is an empty one.
    """
    members = b.edges(spark, sf_dir).groupBy("community_id").agg(F.count("*").alias("n"))
    named = b.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("community_id"),
        F.when(F.col("s_suppkey") % 4 != 0, F.col("s_name")).alias("name"))
    sized = named.join(members, "community_id", "left").select("community_id", F.coalesce("name", F.lit("")).alias("name"),
        F.when(F.col("community_id") % 3 != 0, F.col("n")).alias("members"))
    subs = b.edges(spark, sf_dir).where(F.col("last_seen") >= b.moment(EDGES_FROM)).join(sized, "community_id")
    ordered = F.array_sort(F.collect_list(F.struct(F.col("members").isNull().alias("none"), (-F.col("members")).alias("less"), "community_id", "name",
        "members")))
    listed = subs.groupBy("user_id").agg(F.transform(ordered, lambda x: F.struct(x["community_id"].alias("community_id"), x["name"].alias("name"),
        x["members"].alias("members_count"))).alias("subscriptions"))
    p = b.posts(spark, sf_dir).where(F.col("published") >= b.moment(POSTS_FROM)).withColumnRenamed("group_id", "user_id")
    top = windows.top_per_group(p, ["user_id"], [F.desc("published"), F.asc("post_id")], 3)
    posts = top.groupBy("user_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "post_id", "kind"))),
        lambda x: F.struct(x["post_id"].alias("post_id"), x["kind"].alias("kind"))).alias("posts"))
    people = b.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), *(F.expr(e).alias(k) for k, e in PEOPLE.items()))
    about, number, _ = demographics({k: F.col(k) for k in PEOPLE})
    profile = F.struct("user_id", "posts", "subscriptions", about.alias("demographics"), number.alias("attributes"))
    return posts.join(listed, "user_id").join(people, "user_id").select("user_id", F.to_json(profile).alias("profile"))


# --- embeddings ---


def import_embeddings(target: DataFrame, bundle: DataFrame) -> DataFrame:
    """Merges a bundle (post_id, run_id, model_name, dim, vector, modality, created) by post: the first import sets ``created``, each later one ``updated``."""
    new = bundle.withColumn("updated", F.col("created"))
    taken = ("run_id", "model_name", "dim", "vector", "modality", "updated")
    return m.merge(target, new.select(*target.columns), ["post_id"], dict.fromkeys(taken, "take"))


def embeddings_import(spark, sf_dir):
    """Vectors with even ids are there already; the bundle has those divisible by three, its vectors joined by key."""
    v = b.table(spark, sf_dir, "embeddings").where("vec_id is not null")
    size = F.size("embedding").cast("long")
    old = v.where("vec_id % 2 = 0").select(
        F.col("vec_id").alias("post_id"), F.lit("r1").alias("run_id"), F.lit("m1").alias("model_name"), size.alias("dim"),
        F.transform("embedding", lambda x: x.cast("double") * 0).alias("vector"), F.lit("text_only").alias("modality"),
        F.lit(1).cast("long").alias("created"), F.lit(None).cast("long").alias("updated"),
    )
    vectors = v.where("vec_id % 3 = 0").select(F.col("vec_id").alias("post_id"), F.transform("embedding", lambda x: x.cast("double")).alias("vector"))
    meta = v.where("vec_id % 3 = 0").select(F.col("vec_id").alias("post_id"), size.alias("dim"),
        F.when(F.col("label") % 2 == 0, "trimodal").otherwise("text_image").alias("modality"))
    bundle = meta.join(vectors, "post_id").withColumns({"run_id": F.lit("r2"), "model_name": F.lit("m2"), "created": F.lit(5).cast("long")})
    out = import_embeddings(old, bundle)
    return out.select("post_id", "run_id", "model_name", "dim", "modality", "created", "updated",
        F.round(F.aggregate("vector", F.lit(0.0), lambda s, x: s + F.abs(x)), 4).alias("mass"))


# --- repeated and outdated imports ---


def _decisions(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Stored decisions (id, approved, labels), and those of a file that differs in a few rows."""
    d = b.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), (F.col("quality") == 1).alias("approved"),
        F.when(F.col("toxic") == 1, F.array(F.lit("food"), F.lit("b"))).otherwise(F.array(F.lit("b"))).alias("labels"))
    said = d.where("id % 11 <> 0").select("id", F.when(F.col("id") % 17 == 0, ~F.col("approved")).otherwise(F.col("approved")).alias("approved"),
        F.when(F.col("id") % 5 == 0, F.reverse("labels")).when(F.col("id") % 23 == 0, F.array()).otherwise(F.col("labels")).alias("labels"))
    return d, said


def reimport_check(stored: DataFrame, said: DataFrame) -> DataFrame:
    """(id, fault) for decisions that an import, run again, would change: the stored state must equal them, labels as sets."""
    s = stored.select("id", F.col("approved").alias("was"), F.array_sort("labels").alias("had"))
    x = said.select("id", "approved", F.array_sort("labels").alias("labels")).join(s, "id", "left")
    fault = F.when(F.col("was").isNull(), "unknown").when(F.col("was") != F.col("approved"), "status").when(F.col("had") != F.col("labels"), "labels")
    return x.select("id", fault.alias("fault")).where("fault is not null")


def reimport_faults(spark, sf_dir):
    return reimport_check(*_decisions(spark, sf_dir))


def outdated_decisions(spark, sf_dir):
    """A document that decides on an earlier state: ids without a decision, unknown ids, and rows whose state has changed since."""
    stored, said = _decisions(spark, sf_dir)
    said = said.unionByName(said.where("id % 29 = 0").select((F.col("id") + 1_000_000).alias("id"), "approved", "labels"))
    missing = stored.join(said, "id", "left_anti").select("id", F.lit("missing").alias("fault"))
    return missing.unionByName(reimport_check(stored, said))


def _snapshots(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """A snapshot of the groups, and one that has been tampered with: some statuses altered, some groups gone."""
    g = b.groups(spark, sf_dir).select("group_id", "name", "status")
    altered = g.withColumn("status", F.when(F.col("group_id") % 97 == 7, "altered").otherwise(F.col("status"))).where("group_id % 101 <> 3")
    return g, altered


def tamper_check(spark, sf_dir):
    """A snapshot, the same in another order, and one with altered rows: its root, and which roots agree."""
    g, altered = _snapshots(spark, sf_dir)
    rows = F.concat_ws(":", F.col("group_id").cast("string"), "name", "status")
    first = merkle.root(g, rows, leaf_rows=64)
    again = merkle.root(g.repartition(5, "name"), rows, leaf_rows=64).select(F.col("digest").alias("again"))
    other = merkle.root(altered, rows, leaf_rows=64).select(F.col("digest").alias("other"))
    return first.crossJoin(again).crossJoin(other).select("rows", "digest", (F.col("digest") == F.col("again")).alias("same"),
        (F.col("digest") == F.col("other")).alias("altered_same"))  # a row each


def tampered_rows(spark, sf_dir):
    """The rows that two snapshots do not share, found by going down their trees: only leaves that differ are read again."""
    g, altered = _snapshots(spark, sf_dir)
    depth = merkle.depth_for(g.count(), 64)
    nodes = [merkle.leaves(merkle.row_digests(x, merkle.canonical(x)), depth).select("prefix", F.col("digest").alias(n)) for x, n in ((g, "a"),
        (altered, "b"))]
    changed = nodes[0].join(nodes[1], "prefix", "full").where("not (a <=> b)").select("prefix")
    return merkle.differences(g, altered, changed, depth)


def fixed_snapshot(spark, sf_dir):
    """Users that a campaign fixes at its start, and whether they are still those that are eligible: counts before and after, and what has drifted."""
    before = b.groups(spark, sf_dir).where("status = 'approved' and balance > 0").select("group_id")
    after = b.groups(spark, sf_dir).where("status = 'approved' and balance > 500 or group_id % 50 = 0").select("group_id")
    both = before.withColumn("old", F.lit(True)).join(after.withColumn("new", F.lit(True)), "group_id", "full_outer")
    x = both.agg(F.count("old").alias("before"), F.count("new").alias("after"), F.count_if(F.col("new").isNull()).alias("gone"),
        F.count_if(F.col("old").isNull()).alias("added"))
    return x.select("*", ((F.col("gone") == 0) & (F.col("added") == 0)).alias("stands"))


# --- the queue: deferral, probes, fallback ---


def deferred_jobs(spark, sf_dir):
    """Running jobs whose method is blocked wait until it is free, and the attempt does not count; the others go on."""
    blocked = b.calls(spark, sf_dir).where("code = 9").groupBy("method").agg(F.max("ts").alias("last"))
    of_type = F.create_map(*map(F.lit, ("posts", "click", "members", "error", "profile", "none")))
    j = b.jobs(spark, sf_dir).where("status = 'running'").withColumn("method", of_type[F.col("job_type")]).join(F.broadcast(blocked), "method",
        "left")  # a row for each method
    wait = F.col("last").isNotNull()
    return j.select("job_id", F.when(wait, "retry_wait").otherwise("running").alias("status"),
        F.when(wait, F.greatest(F.col("attempts") - 1, F.lit(0))).otherwise(F.col("attempts")).alias("attempts"),
        F.when(wait, F.col("last") + F.expr("INTERVAL 1 HOUR")).alias("next_attempt"))


def probes(spark, sf_dir):
    """Calls in a pause after a limit: until its end none goes through, then exactly one is the probe, whose result opens or prolongs."""
    limited = b.calls(spark, sf_dir).where("code = 9").select("token", "method", F.col("ts").alias("limited"), F.col("event_id").alias("limit_id"))
    calls = b.calls(spark, sf_dir).select("token", "method", "ts", "event_id", "code")
    later = limited.join(calls, ["token", "method"]).where((F.col("ts") >= F.col("limited") + F.expr("INTERVAL 1 HOUR")))
    first = later.groupBy("limit_id").agg(F.min_by(F.struct("event_id", "code"), F.struct("ts", "event_id")).alias("p"))
    return first.select("limit_id", F.col("p.event_id").alias("probe_id"), F.when(F.col("p.code") == 0,
        "opened").otherwise("prolonged").alias("outcome"))


def with_fallback(batches: DataFrame, size: int) -> DataFrame:
    """Rows (seq, id, fails) in batches of ``size``: a batch without failures succeeds as one; else each row is tried by itself, and failures are recorded.

    Columns id, batch, way (batch or single), stage (of a failure).
    """
    numbered = batches.withColumn("batch", F.floor(F.col("seq") / size))
    bad = numbered.groupBy("batch").agg(F.max("fails").alias("bad"))
    x = numbered.join(bad, "batch")
    return x.select("id", "batch", F.when(F.col("bad"), "single").otherwise("batch").alias("way"), F.when(F.col("fails"), "encode").alias("stage"))


def batch_fallback(spark, sf_dir):
    d = b.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("seq"), F.col("doc_id").alias("id"),
        F.coalesce(F.col("n_chars") % 37 == 0, F.lit(False)).alias("fails"))
    return with_fallback(d, 16)


def encoder_failures(spark, sf_dir):
    """All documents through an encoder that cannot take some of them: a batch that fails is tried row by row, and what fails alone is recorded."""
    docs = b.table(spark, sf_dir, "documents").select("doc_id", "text")
    run = encoding.encoded(docs, encoding.Seeded(8, fails="@"), "doc_id")
    return run.where("vector is null").select("doc_id", "stage", "error_type", "message")


def keyword_containment(spark, sf_dir):
    """Which of the keywords a group's name and description hold, case-folded: (part, keyword)."""
    words = spark.createDataFrame([(w,) for w in ("steel", "brushed copper", "ed n", "tin")], "keyword string")
    text = F.lower(F.concat_ws(" ", "p_name", "p_type"))
    return b.table(spark, sf_dir, "part").select("p_partkey", text.alias("text")).join(F.broadcast(words),
        F.col("text").contains(F.col("keyword"))).select("p_partkey", "keyword")


G, P, E, J, C = b.GROUPS_SQL, b.POSTS_SQL, b.EDGES_SQL, b.JOBS_SQL, b.CALLS_SQL
_ATT = """att AS (SELECT l_orderkey AS post_id,
    string_agg('{"position":' || l_linenumber || ',"type":"' || CASE WHEN l_partkey % 3 = 0 THEN 'video' ELSE 'photo' END || '","id":' || l_partkey || ',"width":' || CAST(l_quantity AS INT) || '}',
    ',' ORDER BY l_linenumber, CASE WHEN l_partkey % 3 = 0 THEN 'video' ELSE 'photo' END, l_partkey, CAST(l_quantity AS INT)) AS items,
    bool_or(l_partkey % 3 <> 0) AS photo, bool_or(l_partkey % 3 = 0) AS video FROM lineitem GROUP BY 1)"""
_PEOPLE = ", ".join(f"{e} AS {k}" for k, e in PEOPLE.items())
_ABOUT = "concat_ws(', ', 'пол: ' || CASE sex WHEN 2 THEN 'мужской' WHEN 1 THEN 'женский' ELSE sex::VARCHAR END, 'город: ' || nullif(city, ''), 'образование: ' || nullif(education, ''), 'семейное положение: ' || relation, 'подарки: ' || gifts, 'подписчики: ' || followers, 'друзья: ' || friends, 'день рождения: ' || birthday)"
_NUMBER = "CAST((sex IS NOT NULL)::INT + (coalesce(city, '') <> '')::INT + (coalesce(education, '') <> '')::INT + (relation IS NOT NULL)::INT + (gifts IS NOT NULL)::INT + (followers IS NOT NULL)::INT + (friends IS NOT NULL)::INT + (birthday IS NOT NULL)::INT AS BIGINT)"
_KNOWN = "CAST(" + " + ".join(f"({k} IS NOT NULL)::INT" for k in PEOPLE) + " AS BIGINT)"
_DEC = """d AS (SELECT doc_id AS id, quality = 1 AS approved, CASE WHEN toxic = 1 THEN 2 ELSE 1 END AS n FROM labels), s AS (SELECT id, CASE WHEN id %
    17 = 0 THEN NOT approved ELSE approved END AS approved, CASE WHEN id % 5 <> 0 AND id % 23 = 0 THEN 0 ELSE n END AS n FROM d WHERE id % 11 <> 0)"""
QUERIES = {
    "company_posts": (company_posts, f"""WITH {G}, {P}, {_ATT}, l AS (SELECT group_id, min(label) AS subject FROM posts WHERE kind = 'P' GROUP BY 1),
        r AS (SELECT p.*, subject, row_number() OVER (PARTITION BY p.group_id ORDER BY published DESC, post_id) AS rank FROM posts p JOIN groups g ON
        g.group_id = p.group_id LEFT JOIN l ON l.group_id = p.group_id WHERE g.status = 'approved' AND published >= TIMESTAMP '{POSTS_FROM}'),
        x AS (SELECT *, CASE WHEN post_id % 4 <> 0 THEN label ELSE '' END AS text, coalesce(photo, false) AS ph, coalesce(video, false) AS vi FROM r
        LEFT JOIN att USING (post_id) WHERE rank <= 5)
        SELECT group_id, post_id,
        '{{"post_id":' || post_id || ',"group_id":' || group_id || ',"subject":"' || coalesce(subject, 'customer_acquisition') || '","text":"' || text || '","modality_profile":"' ||
        CASE WHEN ph AND vi THEN 'trimodal' WHEN text <> '' AND vi THEN 'text_video' WHEN text <> '' AND ph THEN 'text_image' WHEN vi THEN 'video_only' WHEN ph THEN 'image_only' WHEN text <> '' THEN 'text_only' ELSE 'empty' END || '","attachments":[' || coalesce(items, '') || ']}}'
        AS record FROM x"""),
    "demographics_full": (demographics_full, f"""WITH p AS (SELECT c_custkey AS user_id, {_PEOPLE} FROM customer) SELECT user_id, {_ABOUT} AS about,
        {_NUMBER} AS attributes, {_KNOWN} AS known FROM p"""),
    "user_profiles": (user_profiles, f"""WITH {E}, {P}, z AS (SELECT community_id, count(*) AS n FROM edges GROUP BY 1), c AS (SELECT s_suppkey AS
        community_id, CASE WHEN s_suppkey % 4 <> 0 THEN s_name ELSE '' END AS name, CASE WHEN s_suppkey % 3 <> 0 THEN n END AS members FROM supplier
        LEFT JOIN z ON z.community_id = s_suppkey),
        l AS (SELECT user_id,
        string_agg('{{"community_id":' || community_id || ',"name":"' || name || '"' || coalesce(',"members_count":' || members, '') || '}}', ','
        ORDER BY members DESC NULLS LAST, community_id) AS subs FROM edges JOIN c USING (community_id) WHERE last_seen >= TIMESTAMP '{EDGES_FROM}'
        GROUP BY 1),
        r AS (SELECT group_id AS user_id, post_id, kind, row_number() OVER (PARTITION BY group_id ORDER BY published DESC, post_id) AS rank FROM posts
        WHERE published >= TIMESTAMP '{POSTS_FROM}'),
        o AS (SELECT user_id, string_agg('{{"post_id":' || post_id || ',"kind":"' || kind || '"}}', ',' ORDER BY rank) AS posts FROM r WHERE rank <= 3
        GROUP BY 1), p AS (SELECT c_custkey AS user_id, {_PEOPLE} FROM customer)
        SELECT user_id,
        '{{"user_id":' || user_id || ',"posts":[' || posts || '],"subscriptions":[' || subs || '],"demographics":"' || {_ABOUT} || '","attributes":' || {_NUMBER} || '}}'
        AS profile FROM o JOIN l USING (user_id) JOIN p USING (user_id)"""),
    "embeddings_import": (embeddings_import, """WITH o AS (SELECT vec_id AS post_id, len(embedding) AS dim FROM embeddings WHERE vec_id % 2 = 0), n AS
        (SELECT vec_id AS post_id, len(embedding) AS dim, CASE WHEN label % 2 = 0 THEN 'trimodal' ELSE 'text_image' END AS modality,
        round(list_sum(list_transform(embedding, lambda x: abs(x::DOUBLE))), 4) AS mass FROM embeddings WHERE vec_id % 3 = 0)
        SELECT coalesce(n.post_id, o.post_id) AS post_id, CASE WHEN n.post_id IS NULL THEN 'r1' ELSE 'r2' END AS run_id, CASE WHEN n.post_id IS NULL
        THEN 'm1' ELSE 'm2' END AS model_name, coalesce(n.dim, o.dim) AS dim, coalesce(n.modality, 'text_only') AS modality,
        CASE WHEN o.post_id IS NULL THEN 5 ELSE 1 END::BIGINT AS created, CASE WHEN n.post_id IS NOT NULL THEN 5 END::BIGINT AS updated,
        coalesce(mass, 0.0) AS mass FROM o FULL OUTER JOIN n ON o.post_id = n.post_id"""),
    "reimport_faults": (reimport_faults, f"""WITH {_DEC}, x AS (SELECT id, CASE WHEN d.approved <> s.approved THEN 'status' WHEN d.n <> s.n THEN
        'labels' END AS fault FROM s JOIN d USING (id)) SELECT * FROM x WHERE fault IS NOT NULL"""),
    "outdated_decisions": (outdated_decisions, f"""WITH {_DEC}, t AS (SELECT * FROM s UNION ALL SELECT id + 1000000, approved, n FROM s WHERE id % 29
        = 0), x AS (SELECT id, CASE WHEN d.approved IS NULL THEN 'unknown' WHEN d.approved <> t.approved THEN 'status' WHEN d.n <> t.n THEN 'labels'
        END AS fault FROM t LEFT JOIN d USING (id))
        SELECT id, 'missing' AS fault FROM d WHERE id NOT IN (SELECT id FROM t) UNION ALL SELECT * FROM x WHERE fault IS NOT NULL"""),
    "tamper_check": (tamper_check, f"""WITH {G}, {b.merkle_sql("SELECT concat_ws(':', CAST(group_id AS VARCHAR), name, status) AS text FROM groups", 64)}
        SELECT rows, digest, true AS same, false AS altered_same FROM root"""),
    "tampered_rows": (tampered_rows, f"""WITH {G}, a AS (SELECT group_id, name, status, CASE WHEN group_id % 97 = 7 THEN 'altered' ELSE status END AS
        later, group_id % 101 = 3 AS gone FROM groups) SELECT group_id, name, status, CAST(1 AS BIGINT) AS surplus FROM a WHERE gone OR later <> status
        UNION ALL SELECT group_id, name, later, -1 FROM a WHERE NOT gone AND later <> status"""),
    "fixed_snapshot": (fixed_snapshot, f"""WITH {G}, x AS (SELECT status = 'approved' AND balance > 0 AS old, (status = 'approved' AND balance > 500)
        OR group_id % 50 = 0 AS new FROM groups)
        SELECT count(*) FILTER (WHERE old) AS before, count(*) FILTER (WHERE new) AS after, count(*) FILTER (WHERE old AND NOT new) AS gone, count(*)
        FILTER (WHERE new AND NOT old) AS added, count(*) FILTER (WHERE old <> new) = 0 AS stands FROM x"""),
    "deferred_jobs": (deferred_jobs, f"""WITH {J}, {C}, m AS (SELECT method, max(ts) AS last FROM calls WHERE code = 9 GROUP BY 1), x AS (SELECT j.*,
        last FROM jobs j LEFT JOIN m ON m.method = CASE job_type WHEN 'posts' THEN 'click' WHEN 'members' THEN 'error' ELSE 'none' END WHERE status =
        'running')
        SELECT job_id, CASE WHEN last IS NULL THEN 'running' ELSE 'retry_wait' END AS status, CASE WHEN last IS NULL THEN attempts ELSE
        greatest(attempts - 1, 0) END AS attempts, last + INTERVAL 1 HOUR AS next_attempt FROM x"""),
    "probes": (probes, f"""WITH {C}, l AS (SELECT event_id AS limit_id, token, method, ts AS limited FROM calls WHERE code = 9), x AS (SELECT
        limit_id, event_id AS probe_id, CASE WHEN code = 0 THEN 'opened' ELSE 'prolonged' END AS outcome, row_number() OVER (PARTITION BY limit_id
        ORDER BY ts, event_id) AS n
        FROM l JOIN calls USING (token, method) WHERE ts >= limited + INTERVAL 1 HOUR) SELECT limit_id, probe_id, outcome FROM x WHERE n = 1"""),
    "batch_fallback": (batch_fallback, """WITH d AS (SELECT doc_id AS id, doc_id // 16 AS batch, coalesce(n_chars % 37 = 0, false) AS fails FROM
        documents) SELECT id, batch, CASE WHEN max(fails) OVER (PARTITION BY batch) THEN 'single' ELSE 'batch' END AS way, CASE WHEN fails THEN
        'encode' END AS stage FROM d"""),
    "encoder_failures": (encoder_failures, """SELECT doc_id, 'encode_batch' AS stage, 'ValueError' AS error_type, 'cannot encode @' AS message FROM documents
        WHERE contains(text, '@')"""),
    "keyword_containment": (keyword_containment, """SELECT p_partkey, keyword FROM part, (VALUES ('steel'), ('brushed copper'), ('ed n'), ('tin'))
        k(keyword) WHERE contains(lower(p_name || ' ' || p_type), keyword)"""),
}
