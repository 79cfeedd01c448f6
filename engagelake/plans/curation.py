"""Audits in sequence, decisions in both formats, state tables, the registry of keywords, and the full sample with its report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import bindings as b
from ..functions import columns as c
from ..operators import embeddings as e
from ..operators import merge as m
from ..operators import merkle, quantiles, sampling, windows

# The seed, strata and sizes of an audit, its words and gates.
SEED = 20260730
STRATA = (("food_service_and_delivery", 100), ("rejected_to_approved", 50), ("approved_added_food_service", 50), ("approved_food_service", 100),
    ("rejected_food_service_candidate", 100), ("borderline", 100))
WORDS = ("кафе", "ресторан", "бар")

#: Decisions on groups, made from ids: before and after, and a confidence.
DECISIONS = {
    "id": "c_custkey", "was_approved": "c_custkey % 3 <> 0", "had_food": "c_custkey % 4 = 0", "approved": "c_custkey % 7 <> 0",
    "food": "c_custkey % 5 < 3 AND c_custkey % 7 <> 0", "delivery": "c_custkey % 6 = 0", "flag": "c_custkey % 5 < 3",
    "confidence": "c_custkey % 100",
    "about": "CASE c_custkey % 9 WHEN 0 THEN 'Кафе' WHEN 1 THEN 'БАР у моря' WHEN 2 THEN 'ресторан' ELSE c_name END",
}
CONDITIONS = {
    "food_service_and_delivery": "food AND delivery", "rejected_to_approved": "NOT was_approved AND approved",
    "approved_added_food_service": "was_approved AND food AND NOT had_food", "approved_food_service": "approved AND food",
    "rejected_food_service_candidate": "NOT flag",
    "borderline": "word OR confidence < 85",
}


def decided(spark, sf_dir) -> DataFrame:
    d = b.table(spark, sf_dir, "customer").select(*(F.expr(x).alias(k) for k, x in DECISIONS.items()))
    text = F.lower("about")
    return d.withColumn("word", F.exists(F.array(*map(F.lit, WORDS)), lambda w: text.contains(w))).withColumn("h",
        c.hash_rank(F.concat_ws(":", F.lit(str(SEED)), F.col("id").cast("string"))))


def sequential_strata(rows: DataFrame, key: str, strata, conditions, rank: str) -> DataFrame:
    """(key, stratum): each stratum in turn takes its first rows by rank among those that match it and none before has taken.

    A stratum takes a fixed number, so what is taken is small, and every step is a limited sort.
    """
    taken = None
    for name, size in strata:
        left = rows.where(F.expr(conditions[name]))
        if taken is not None:
            left = left.join(F.broadcast(taken.select(key)), key, "left_anti")  # the strata's sizes at most
        new = left.orderBy(rank, key).limit(size).select(key, F.lit(name).alias("stratum"))
        taken = new if taken is None else taken.unionByName(new)
    return taken


def sequential_audit(spark, sf_dir):
    return sequential_strata(decided(spark, sf_dir), "id", STRATA, CONDITIONS, "h")


def audit_shortages(spark, sf_dir):
    """How many rows each stratum is short of."""
    got = sequential_audit(spark, sf_dir).groupBy("stratum").agg(F.count("*").alias("n"))
    required = spark.createDataFrame(list(STRATA), "stratum string, required long")
    return required.join(F.broadcast(got), "stratum", "left").select("stratum", "required",
        (F.col("required") - F.coalesce("n", F.lit(0))).alias("short"))  # a row for each stratum


def audit_evaluation(spark, sf_dir):
    """One row: precision, missed share and exact matches of a second reader, errors by word, and whether all gates are passed."""
    r = decided(spark, sf_dir).withColumns({"says_food": F.expr("CASE WHEN id % 37 = 0 THEN NOT food ELSE food END"),
        "says_delivery": F.expr("CASE WHEN id % 41 = 0 THEN NOT delivery ELSE delivery END")})
    wrong = (F.col("says_food") != F.col("food")) & (F.col("id") % 2 == 0)
    share = lambda part, whole: F.coalesce(F.try_divide(F.count_if(part).cast("double"), F.count_if(whole)), F.lit(0.0))
    multi, text = F.col("food") & F.col("delivery"), F.lower("about")
    x = r.agg(
        F.count("*").alias("results"), share(F.col("food") & F.col("says_food"), F.col("food")).alias("p"),
        share(F.col("says_food") & ~F.col("food"), F.col("says_food")).alias("f"), share(multi & F.col("says_food") & F.col("says_delivery"),
        multi).alias("e"),
        *(F.count_if(text.contains(w)).alias(f"n{i}") for i, w in enumerate(WORDS)),
        *(F.count_if(text.contains(w) & wrong).alias(f"e{i}") for i, w in enumerate(WORDS)),
    )
    steady = F.lit(True)
    for i in range(len(WORDS)):
        steady = steady & ((F.col(f"n{i}") < 10) | (F.col(f"e{i}") / F.col(f"n{i}") <= 0.1))
    passed = (F.col("results") >= sum(n for _, n in STRATA)) & (F.col("p") >= 0.9) & (F.col("f") <= 0.1) & (F.col("e") >= 0.85) & steady
    return x.select("results", *(F.round(k, 4).alias(k) for k in "pfe"), *(f"{k}{i}" for i in range(len(WORDS)) for k in "ne"),
        steady.alias("steady"), passed.alias("passed"))


def built_decisions(spark, sf_dir):
    """From the approved ids alone: groups of the batch that are not listed are rejected; labels are the subjects of matched keywords, with full confidence."""
    batch = b.groups(spark, sf_dir).where("group_id % 3 = 0").select("group_id")
    listed = b.groups(spark, sf_dir).where("group_id % 6 = 0").select("group_id", F.lit(True).alias("listed"))
    subjects = b.posts(spark, sf_dir).groupBy("group_id").agg(F.array_sort(F.collect_set("label")).alias("subjects"))
    x = batch.join(listed, "group_id", "left").join(subjects, "group_id", "left").withColumn("approved", F.coalesce("listed", F.lit(False)))
    labels = F.when(F.col("approved"), F.coalesce("subjects", F.array().cast("array<string>"))).otherwise(F.array().cast("array<string>"))
    return x.select("group_id", "approved", F.array_join(labels, ",").alias("labels"), F.lit(1.0).alias("confidence"))


def decision_invariants(spark, sf_dir):
    """(id, fault): approved without labels or the reverse, a label twice, a label lost, the flag against the label, and a refusal that changes something."""
    d = decided(spark, sf_dir)
    had = F.when(F.col("had_food"), F.array(F.lit("food"), F.lit("b"))).otherwise(F.array(F.lit("b")))
    has = F.filter(F.array(F.when(F.col("food"), "food"), F.when(F.col("id") % 8 != 0, "b"), F.when(F.col("id") % 10 == 0, "b")),
        lambda x: x.isNotNull())
    x = d.select("id", "approved", "was_approved", "flag", had.alias("had"), has.alias("has"))
    size = lambda a: F.size(a)
    faults = F.filter(F.array(
        F.when(F.col("approved") != (size("has") > 0), "approval"), F.when(size(F.array_distinct("has")) != size("has"), "repeated"),
        F.when(size(F.array_except("had", "has")) > 0, "lost"),
        F.when(F.col("flag") != F.array_contains("has", "food"), "flag"),
        F.when(~F.col("flag") & ((F.col("approved") != F.col("was_approved")) | (F.array_sort(F.array_distinct("has")) != F.array_sort("had"))),
        "refusal"),
    ), lambda f: f.isNotNull())
    return x.select("id", F.explode(faults).alias("fault"))


def decision_snapshot(spark, sf_dir):
    """Drafts of all decisions, as canonical JSON with their context, and how far the work has come: one row for each state, with the root of its tree."""
    d = decided(spark, sf_dir).withColumn("state", F.when(F.col("id") % 3 == 0, "draft").when(F.col("confidence") < 85,
        "borderline").otherwise("final"))
    draft = F.to_json(F.struct("approved", "id", "was_approved"))
    counts = d.groupBy("state").agg(F.count("*").alias("decisions"), F.count_if("approved").alias("approved"))
    return counts.join(merkle.root(d, draft, by=["state"], leaf_rows=64).drop("rows"), "state")


# --- state tables and registries ---


def state_merge(spark, sf_dir):
    """States of users after a run: a page on the way keeps the last success, the last page sets it and the next day, a refusal sets its reason; each sets the last attempt."""
    old = b.table(spark, sf_dir, "customer").where("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("user_id"), F.lit(1).alias("last_attempt"),
        F.when(F.col("c_custkey") % 2 == 0, 1).alias("last_success"), F.lit(10).alias("next_day"),
        F.when(F.col("c_custkey") % 5 == 0, "privacy_or_access").alias("terminal"), F.lit(3).alias("collected"))
    run = b.table(spark, sf_dir, "customer").where("c_custkey % 4 <> 0").select(F.col("c_custkey").alias("user_id"),
        (F.col("c_custkey") % 3).alias("kind"), F.when(F.col("c_custkey") % 8 == 1, 15).otherwise(18).alias("error"))
    page, last, refused = (F.col("kind") == i for i in range(3))
    news = run.select(
        "user_id", F.lit(20).alias("last_attempt"), F.when(last, 20).alias("last_success"), F.when(~page, 50).alias("next_day"),
        F.when(refused, F.when(F.col("error").isin(15, 30, 260), "privacy_or_access").otherwise("deleted_or_unavailable")).alias("terminal"),
        F.when(~refused, 7).alias("collected"),
    )
    return m.merge(old, news, ["user_id"], {"last_attempt": "take", "last_success": "coalesce", "next_day": "coalesce", "terminal": "take",
        "collected": "coalesce"})


def edges_reopen(spark, sf_dir):
    """A page of edges: known ones are current again with the later date and this run, new ones begin."""
    old = b.edges(spark, sf_dir).where("user_id % 3 <> 0").select("user_id", "community_id", "first_seen", "last_seen",
        F.lit("r1").alias("source_run"), (F.col("community_id") % 2 == 0).alias("is_current"))
    day = F.expr("INTERVAL 5 DAY")
    page = b.edges(spark, sf_dir).where("user_id % 2 = 0").select("user_id", "community_id", F.col("last_seen").alias("first_seen"),
        (F.col("last_seen") + day).alias("last_seen"), F.lit("r2").alias("source_run"), F.lit(True).alias("is_current"))
    out = m.merge(old, page, ["user_id", "community_id"], {"last_seen": "greatest", "source_run": "take", "is_current": "take"})
    return out.groupBy("source_run", "is_current").agg(F.count("*").alias("edges"), F.min("first_seen").alias("first"),
        F.max("last_seen").alias("last"))


def users_upsert(spark, sf_dir):
    """Profiles: what the new one does not say stays as it was."""
    old = b.table(spark, sf_dir, "customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("city"), F.lit(1).alias("updated"))
    new = b.table(spark, sf_dir, "customer").where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("user_id"),
        F.when(F.col("c_custkey") % 5 != 0, F.upper("c_name")).alias("name"), F.when(F.col("c_custkey") % 7 == 0, "moved").alias("city"),
        F.lit(2).alias("updated"))
    return m.merge(old, new, ["user_id"], {"name": "coalesce", "city": "coalesce", "updated": "take"})


def keyword_registry(spark, sf_dir):
    """Configured keywords by identity: of equal ones the first counts; known ones are switched on and keep their number, those no longer configured are switched off."""
    words = b.table(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_partkey") % 2 == 0,
        F.upper("p_type")).otherwise(F.concat(F.lit("  "), "p_type")).alias("word"))
    wanted = m.last_wins(words.where("p_size < 25").withColumn("identity", c.keyword_identity(F.col("word"))), ["identity"],
        [F.asc("p_partkey")]).select("identity", F.col("p_partkey").alias("number"), F.lit(True).alias("active"))
    known = words.where("p_size > 20").withColumn("identity",
        c.keyword_identity(F.col("word"))).groupBy("identity").agg((F.min("p_partkey") + 1_000_000).alias("number"), F.lit(True).alias("active"))
    known = known.withColumn("active", F.col("active") & (F.length("identity") % 2 == 0))
    merged = m.merge(known, wanted, ["identity"], {"active": "take"})
    off = merged.join(wanted.select("identity", F.lit(True).alias("wanted")), "identity", "left")
    return off.select("identity", "number", F.coalesce("wanted", F.lit(False)).alias("active"))


def run_ids(spark, sf_dir):
    """Runs get random ids: as many as rows, each once, of 36 characters."""
    r = b.table(spark, sf_dir, "customer").select(F.uuid().alias("id"))
    return r.agg(F.count("*").alias("rows"), F.countDistinct("id").alias("ids"), F.max(F.length("id")).cast("long").alias("length"))


def resume_pending(spark, sf_dir):
    """What a run that was broken off has still to do, and how many batches of 32 that is."""
    posts = b.posts(spark, sf_dir).select("post_id")
    done = b.posts(spark, sf_dir).where("published < timestamp_ntz'1999-01-01'").select("post_id")
    left = posts.join(done, "post_id", "left_anti")
    return left.agg(F.count("*").alias("pending"), F.ceil(F.count("*") / 32).alias("batches"), F.min("post_id").alias("first"))


def json_paths(spark, sf_dir):
    """Values by nested path, from objects of two levels; a path that is not there is null."""
    doc = F.to_json(F.struct(F.struct(F.struct("event_type", F.col("user_id").alias("n")).alias("b")).alias("a"), F.array("value").alias("list")))
    x = b.table(spark, sf_dir, "events").select("event_id", doc.alias("d"))
    at = lambda path: F.get_json_object("d", path)
    return x.where(at("$.a.b.event_type") == "click").select("event_id", at("$.a.b.n").cast("long").alias("n"), at("$.a.x.n").alias("none"),
        F.round(at("$.list[0]").cast("double"), 4).alias("first"))


def id_pages(spark, sf_dir):
    """Ids of pages as they come, as texts: whole positive numbers count, sorted and once; others are counted as bad; the next offset goes by the raw length."""
    raw = F.when(F.col("l_linenumber") == 3, "x1").when(F.col("l_linenumber") == 4,
        F.concat(F.lit("-"), F.col("l_suppkey").cast("string"))).when(F.col("l_linenumber") == 5, "2.5").when(F.col("l_linenumber") == 6,
        None).otherwise(F.col("l_suppkey").cast("string"))
    pages = b.table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.coalesce(raw, F.lit(""))).alias("raw"))
    good = F.filter("raw", lambda x: x.rlike("^[0-9]{1,18}$") & (F.try_to_number(x, F.lit("9" * 18)) > 0))
    ids = F.array_sort(F.array_distinct(F.transform(good, lambda x: x.cast("long"))))
    return pages.select("l_orderkey", F.array_join(F.transform(ids, lambda x: x.cast("string")), ",").alias("ids"),
        (F.size("raw") - F.size(good)).cast("long").alias("bad"), F.size("raw").cast("long").alias("next_offset"))


def terminal_runs(spark, sf_dir):
    """A finished job that is finished again changes nothing; a run is over when its last job is, and takes the later of the two ends."""
    j = b.jobs(spark, sf_dir).where("status in ('completed', 'failed')").select("run_id", "job_id", F.col("created").alias("ended"), "status")
    again = j.where("job_id % 3 = 0").select("run_id", "job_id", (F.col("ended") + F.expr("INTERVAL 1 DAY")).alias("ended"),
        F.lit("failed").alias("status"))
    kept = m.insert_missing(j, again, ["job_id"])
    return kept.groupBy("run_id").agg(F.count("*").alias("ended_jobs"), F.max("ended").alias("ended"),
        F.count_if(F.col("status") == "failed").alias("failed"))


def daily_with_retry(spark, sf_dir):
    """Daily reports by local date: sent at the first try that succeeds, pending until then, and never twice."""
    local = F.to_date(F.col("ts") + F.expr("INTERVAL 3 HOUR")).cast("string")
    tries = b.table(spark, sf_dir, "events").where("event_type = 'click'").select(local.alias("day"), "ts", "event_id",
        (F.get_json_object("props", "$.k").cast("int") % 4 == 0).alias("delivered"))
    sent = tries.groupBy("day").agg(F.min(F.when(F.col("delivered"), F.struct("ts", "event_id"))).alias("sent"))
    x = tries.join(sent, "day").where(F.col("sent").isNull() | (F.struct("ts", "event_id") <= F.col("sent")))
    return x.groupBy("day").agg(F.count("*").alias("tries"), F.max("sent.event_id").alias("event_id"), F.max("sent").isNull().alias("pending"))


# --- the full sample ---

TARGET = 100


def _posts(spark, sf_dir) -> DataFrame:
    """Posts with subject, text, pictures and videos: orders, their documents and lines; a video's length is its line's quantity."""
    video = F.col("l_partkey") % 3 == 0
    media = b.table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("post_id")).agg(F.max(~video & (F.col("l_partkey") % 3 == 1)).alias("photo"),
        F.max(video).alias("video"), F.max(F.when(video, F.col("l_quantity"))).alias("duration"))
    texts = b.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("post_id"), F.length("text").alias("text_length"))
    posts = b.posts(spark, sf_dir).select("post_id", "group_id", F.substring("label", 3, 20).alias("subject"), F.col("post_id").alias("seq"))
    x = posts.join(media, "post_id", "left").join(texts, "post_id", "left")
    flag = lambda n: F.coalesce(n, F.lit(False))
    return x.select("post_id", "group_id", "subject", "seq", F.coalesce("text_length", F.lit(0)).alias("text_length"),
        F.coalesce("duration", F.lit(0.0)).alias("duration"), c.modality(F.coalesce("text_length", F.lit(0)) > 0, flag("photo"), flag("video")).alias("modality"))


def _quantiles(p: DataFrame) -> tuple[tuple[float, float], tuple[float, float]]:
    """Of text lengths, and of the durations of posts with a video."""
    return quantiles.terciles(p, F.col("text_length")), quantiles.terciles(p, F.when(F.col("duration") > 0, F.col("duration")))


def binned(p: DataFrame) -> DataFrame:
    """Posts with the bins of text length and of duration; quantiles of durations are those of videos, posts without one have none."""
    (t1, t2), (v1, v2) = _quantiles(p)
    return p.select(*p.columns, c.three_bins(F.col("text_length"), F.lit(t1), F.lit(t2)).alias("t_bin"),
        F.when(F.col("duration") > 0, c.three_bins(F.col("duration"), F.lit(v1), F.lit(v2))).otherwise("none").alias("v_bin"))


def full_sample_of(p: DataFrame, target: int = TARGET, seed: int = 42) -> DataFrame:
    """Of posts with their bins."""
    return sampling.stratified(p, ["subject", "modality", "t_bin", "v_bin"], sampling.hash_sample_rank(seed, "post_id", "group_id"), "seq",
        target)


def full_sample(spark, sf_dir):
    return full_sample_of(binned(_posts(spark, sf_dir))).select("post_id", "subject", "modality", "t_bin", "v_bin")


def sampling_report(spark, sf_dir):
    """(measure, value): sizes, strata covered, quantiles, shares and how far they are off, and the two tests of distribution."""
    p = binned(_posts(spark, sf_dir))
    s = full_sample_of(p)
    strata = ["subject", "modality", "t_bin", "v_bin"]
    coverage = p.select(*strata).distinct().join(s.select(*strata).distinct().withColumn("in", F.lit(1)), strata,
        "left").agg(F.lit("strata_coverage").alias("measure"), (F.count("in") / F.count("*")).alias("value"))
    named = [(f"{kind}_{q}", float(v)) for kind, pair in zip(("text", "video"), _quantiles(p), strict=True) for q, v in zip(("q33", "q66"), pair, strict=True)]
    cuts = spark.createDataFrame(named, "measure string, value double")
    size = s.agg(F.lit("actual_size").alias("measure"),
        F.count("*").cast("double").alias("value")).unionByName(p.agg(F.lit("population_size").alias("measure"),
        F.count("*").cast("double").alias("value")))
    out = coverage.unionByName(cuts).unionByName(size)
    for margin in ("modality", "subject"):
        a = p.groupBy(margin).agg(F.count("*").alias("n")).crossJoin(p.agg(F.count("*").alias("total")))  # a row each
        d = s.groupBy(margin).agg(F.count("*").alias("k")).crossJoin(s.agg(F.count("*").alias("sampled")))
        x = a.join(d, margin, "left").withColumns({"was": F.col("n") / F.col("total"), "is": F.coalesce(F.col("k") / F.col("sampled"), F.lit(0.0))})
        named = F.create_map(F.concat(F.lit(f"{margin}_"), margin), F.col("was"), F.concat(F.lit(f"sample_{margin}_"), margin), F.col("is"),
            F.concat(F.lit(f"delta_{margin}_"), margin), F.abs(F.col("is") - F.col("was")))
        out = out.unionByName(x.select(F.explode(named).alias("measure", "value")))
    ks = sampling.ks_distance(p, s, "text_length")
    ks = ks.select(F.explode(F.create_map(F.lit("ks"), F.col("d"), F.lit("ks_p"), sampling.ks_pvalue(F.col("d"), F.col("n"),
        F.col("m")))).alias("measure", "value"))
    chi = sampling.chi_square(p, s, "modality").select("statistic", sampling.chi_square_pvalue(F.col("statistic"), F.col("df")).alias("p"))
    chi = chi.select(F.explode(F.create_map(F.lit("chi2"), F.col("statistic"), F.lit("chi2_p"), F.col("p"))).alias("measure", "value"))
    return out.unionByName(ks).unionByName(chi).withColumn("value", F.round("value", 6))


def pca_plane(spark, sf_dir):
    return e.projection(b.table(spark, sf_dir, "embeddings"), "vec_id")


def label_top_words(spark, sf_dir):
    """Beyond the reference: the five commonest longer words of each language."""
    w = b.table(spark, sf_dir, "documents").where("text is not null").select("lang",
        F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{6,}"), F.lit(0))).alias("word")).groupBy("lang",
        "word").agg(F.count("*").alias("n"))
    return windows.top_per_group(w, ["lang"], [F.desc("n"), F.asc("word")], 5).select("lang", "word", "n")


_D = "d0 AS (SELECT " + ", ".join(f"{x} AS {k}" for k,
    x in DECISIONS.items()) + " FROM customer), d AS (SELECT *, " + " OR ".join(f"contains(lower(about), '{w}')" for w in WORDS) + f""" AS
    word,
 list_reduce(list_prepend(0::BIGINT, list_transform(range(8), lambda i: ('0x' || substr(sha256('{SEED}:' || id), CAST(8*i+1 AS BIGINT), 8))::BIGINT)),
    lambda x, w: (x * 294967296 + w) % 1000000000) AS h FROM d0)"""
_S = ", ".join(
    f"s{i} AS (SELECT id, '{name}' AS stratum FROM d WHERE ({CONDITIONS[name]})" + "".join(f" AND id NOT IN (SELECT id FROM s{j})" for j in range(i)) + f" ORDER BY h, id LIMIT {size})" for i,
    (name, size) in enumerate(STRATA)
)
_ALL = " UNION ALL ".join(f"SELECT * FROM s{i}" for i in range(len(STRATA)))
_SYN = """l AS (SELECT l_orderkey AS k, bool_or(l_partkey % 3 = 1) AS photo, bool_or(l_partkey % 3 = 0) AS video, max(l_quantity) FILTER (WHERE
    l_partkey % 3 = 0) AS duration FROM lineitem GROUP BY 1),
 y0 AS (SELECT o_orderkey AS post_id, o_custkey AS group_id, substr(o_orderpriority, 3, 20) AS subject, o_orderkey AS seq, coalesce(length(text), 0) AS
    text_length, coalesce(duration, 0) AS duration, coalesce(photo, false) AS photo, coalesce(video, false) AS video FROM orders LEFT JOIN l ON k =
    o_orderkey LEFT JOIN documents ON doc_id = o_orderkey),
 y AS (SELECT *, CASE WHEN photo AND video THEN 'trimodal' WHEN text_length > 0 AND video THEN 'text_video' WHEN text_length > 0 AND photo THEN
    'text_image' WHEN video THEN 'video_only' WHEN photo THEN 'image_only' WHEN text_length > 0 THEN 'text_only' ELSE 'empty' END AS modality FROM y0),
 q AS (SELECT quantile_cont(text_length, 0.33) AS t1, quantile_cont(text_length, 0.66) AS t2, quantile_cont(duration, 0.33) FILTER (WHERE duration >
    0) AS v1, quantile_cont(duration, 0.66) FILTER (WHERE duration > 0) AS v2 FROM y),
 p AS (SELECT y.*, CASE WHEN text_length <= t1 THEN 'low' WHEN text_length <= t2 THEN 'mid' ELSE 'high' END AS t_bin, CASE WHEN duration = 0 THEN
    'none' WHEN duration <= v1 THEN 'low' WHEN duration <= v2 THEN 'mid' ELSE 'high' END AS v_bin FROM y, q),
 h AS (SELECT *, list_reduce(list_prepend(0::BIGINT, list_transform(range(8), lambda i: ('0x' || substr(sha256('42:' || post_id || ':' || group_id),
    CAST(8*i+1 AS BIGINT), 8))::BIGINT)), lambda x, w: (x * 294967296 + w) % 1000000000) AS r FROM p),
 z AS (SELECT subject, modality, t_bin, v_bin, count(*) AS n, min(seq) AS first FROM p GROUP BY 1, 2, 3, 4), k AS (SELECT *, least(n,
    CAST(floor(100::DOUBLE * (n / (SELECT count(*) FROM p)::DOUBLE)) AS BIGINT)) AS k FROM z),
 t AS (SELECT *, row_number() OVER (ORDER BY n - k DESC, k, first) AS turn, 100 - sum(k) OVER () AS spare FROM k), u AS (SELECT subject, modality,
    t_bin, v_bin, k + CASE WHEN turn <= spare AND k < n THEN 1 ELSE 0 END AS quota FROM t),
 s AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY subject, modality, t_bin, v_bin ORDER BY r, seq) AS nth FROM h) JOIN u USING (subject,
    modality, t_bin, v_bin) WHERE nth <= quota)"""
_SHARES = """m{0} AS (SELECT {0} AS name, count(*) / (SELECT count(*) FROM p)::DOUBLE AS was, (SELECT count(*) FROM s WHERE s.{0} = p.{0}) / (SELECT
    count(*) FROM s)::DOUBLE AS now FROM p GROUP BY 1)"""
_ROWS = """SELECT '{0}_' || name, was FROM m{0} UNION ALL SELECT 'sample_{0}_' || name, now FROM m{0} UNION ALL SELECT 'delta_{0}_' || name, abs(now -
    was) FROM m{0}"""
_REPORT = f"""{_SHARES.format("modality")}, {_SHARES.format("subject")},
 g AS (SELECT text_length AS v, count(*) AS a, 0 AS b FROM p GROUP BY 1 UNION ALL SELECT text_length, 0, count(*) FROM s GROUP BY 1),
 f AS (SELECT v, sum(sum(a)) OVER (ORDER BY v) / (SELECT count(*) FROM p)::DOUBLE AS fp, sum(sum(b)) OVER (ORDER BY v) / (SELECT count(*) FROM
    s)::DOUBLE AS fs FROM g GROUP BY v),
 d AS (SELECT max(abs(fp - fs)) AS d, (SELECT count(*) FROM p) * (SELECT count(*) FROM s) / ((SELECT count(*) FROM p) + (SELECT count(*) FROM s))::DOUBLE AS nm
    FROM f), lam AS (SELECT d, (sqrt(nm) + 0.12 + 0.11 / sqrt(nm)) * d AS l FROM d),
 x2 AS (SELECT sum(pow(now - was, 2) / was) * (SELECT count(*) FROM s) AS x2, greatest(count(*) - 1, 1)::DOUBLE AS df FROM mmodality),
 wh AS (SELECT x2, (pow(x2 / df, 1::DOUBLE / 3) - (1 - 2 / (9 * df))) / sqrt(2 / (9 * df)) / sqrt(2) AS x FROM x2),
 erf AS (SELECT x2, sign(x) * exp(-x * x) * list_sum(list_transform(range(100), lambda n: pow(abs(x), 2 * n + 1) / gamma(n + 1.5))) AS e FROM wh)
 SELECT measure, round(value, 6) AS value FROM (SELECT 'strata_coverage' AS measure, (SELECT count(*) FROM (SELECT DISTINCT subject, modality, t_bin, v_bin FROM
    s)) / count(*)::DOUBLE AS value FROM z UNION ALL SELECT 'text_q33', t1 FROM q UNION ALL SELECT 'text_q66', t2 FROM q UNION ALL SELECT 'video_q33', v1
    FROM q UNION ALL SELECT 'video_q66', v2 FROM q UNION ALL SELECT 'actual_size', count(*) FROM s UNION ALL SELECT 'population_size', count(*) FROM p
    UNION ALL {_ROWS.format("modality")} UNION ALL {_ROWS.format("subject")} UNION ALL SELECT 'ks', d FROM d UNION ALL SELECT 'ks_p', CASE WHEN l <= 0
    THEN 1 ELSE greatest(0, least(1, list_sum(list_transform(range(1, 101), lambda k: 2 * pow(-1, k - 1) * exp(-2.0 * k * k * l * l))))) END FROM lam
    UNION ALL SELECT 'chi2', x2 FROM x2 UNION ALL SELECT 'chi2_p', CASE WHEN x2 <= 0 THEN 1 ELSE (1 - e) / 2 END FROM erf)"""
E = b.EDGES_SQL
QUERIES = {
    "sequential_audit": (sequential_audit, f"WITH {_D}, {_S} {_ALL}"),
    "audit_shortages": (audit_shortages, f"""WITH {_D}, {_S}, a AS ({_ALL}), r(stratum, required) AS (VALUES
        {', '.join(f"('{n}', {k}::BIGINT)" for n, k in STRATA)}) SELECT stratum, required, required - (SELECT count(*) FROM a WHERE a.stratum =
        r.stratum) AS short FROM r"""),
    "audit_evaluation": (audit_evaluation, f"""WITH {_D}, r AS (SELECT *, CASE WHEN id % 37 = 0 THEN NOT food ELSE food END AS sf, CASE WHEN id % 41 =
        0 THEN NOT delivery ELSE delivery END AS sd FROM d),
        x AS (SELECT count(*) AS results, coalesce(count(*) FILTER (WHERE food AND sf) / nullif(count(*) FILTER (WHERE food), 0)::DOUBLE, 0) AS p,
        coalesce(count(*) FILTER (WHERE sf AND NOT food) / nullif(count(*) FILTER (WHERE sf), 0)::DOUBLE, 0) AS f, coalesce(count(*) FILTER (WHERE
        food AND delivery AND sf AND sd) / nullif(count(*) FILTER (WHERE food AND delivery), 0)::DOUBLE, 0) AS e,
        {", ".join(f"count(*) FILTER (WHERE contains(lower(about), '{w}')) AS n{i}, count(*) FILTER (WHERE contains(lower(about), '{w}') AND sf <> food AND id % 2 = 0) AS e{i}" for i, w in enumerate(WORDS))}
        FROM r),
        y AS (SELECT *, (n0 < 10 OR e0 / n0::DOUBLE <= 0.1) AND (n1 < 10 OR e1 / n1::DOUBLE <= 0.1) AND (n2 < 10 OR e2 / n2::DOUBLE <= 0.1) AS steady
        FROM x)
        SELECT results, round(p, 4) AS p, round(f, 4) AS f, round(e, 4) AS e, n0, e0, n1, e1, n2, e2, steady, results >= 500 AND p >= 0.9 AND f <= 0.1
        AND e >= 0.85 AND steady AS passed FROM y"""),
    "built_decisions": (built_decisions, """WITH s AS (SELECT o_custkey AS group_id, string_agg(DISTINCT o_orderpriority, ',' ORDER BY
        o_orderpriority) AS l FROM orders GROUP BY 1) SELECT c_custkey AS group_id, c_custkey % 6 = 0 AS approved, CASE WHEN c_custkey % 6 = 0 THEN
        coalesce(l, '') ELSE '' END AS labels, 1.0::DOUBLE AS confidence FROM customer LEFT JOIN s ON s.group_id = c_custkey WHERE c_custkey % 3 = 0"""),
    "decision_invariants": (decision_invariants, f"""WITH {_D}, x AS (SELECT id, approved, was_approved, flag, food, had_food, (id % 8 <> 0)::INT +
        (id % 10 = 0)::INT AS nb FROM d)
        SELECT id, 'approval' AS fault FROM x WHERE approved <> (food OR nb > 0) UNION ALL SELECT id, 'repeated' FROM x WHERE nb = 2 UNION ALL SELECT
        id, 'lost' FROM x WHERE nb = 0 OR (had_food AND NOT food)
        UNION ALL SELECT id, 'flag' FROM x WHERE flag <> food UNION ALL SELECT id, 'refusal' FROM x WHERE NOT flag AND (approved <> was_approved OR
        food <> had_food OR nb = 0)"""),
    "decision_snapshot": (decision_snapshot, f"""WITH {_D}, x AS (SELECT *, CASE WHEN id % 3 = 0 THEN 'draft' WHEN confidence < 85 THEN 'borderline'
        ELSE 'final' END AS state FROM d), {b.merkle_sql("SELECT state, '{\"approved\":' || approved || ',\"id\":' || id || ',\"was_approved\":' || was_approved || '}' AS text FROM x", 64, "state")},
        c AS (SELECT state, count(*) AS decisions, count(*) FILTER (WHERE approved) AS approved FROM x GROUP BY 1)
        SELECT state, decisions, approved, digest FROM c JOIN root USING (state)"""),
    "state_merge": (state_merge, """WITH o AS (SELECT c_custkey AS u, CASE WHEN c_custkey % 2 = 0 THEN 1 END AS s FROM customer WHERE c_custkey % 3 <>
        0), n AS (SELECT c_custkey AS u, c_custkey % 3 AS k, CASE WHEN c_custkey % 8 = 1 THEN 15 ELSE 18 END AS err FROM customer WHERE c_custkey % 4
        <> 0),
        j AS (SELECT coalesce(o.u, n.u) AS user_id, o.u AS ou, n.u AS nu, s, k, err FROM o FULL OUTER JOIN n ON o.u = n.u) SELECT user_id, CASE WHEN
        nu IS NULL THEN 1 ELSE 20 END AS last_attempt, CASE WHEN k = 1 THEN 20 ELSE s END AS last_success, CASE WHEN k IN (1, 2) THEN 50 WHEN ou IS
        NOT NULL THEN 10 END AS next_day,
        CASE WHEN nu IS NULL THEN CASE WHEN user_id % 5 = 0 THEN 'privacy_or_access' END WHEN k = 2 THEN CASE WHEN err = 15 THEN 'privacy_or_access'
        ELSE 'deleted_or_unavailable' END END AS terminal, CASE WHEN k IN (0, 1) THEN 7 WHEN ou IS NOT NULL THEN 3 END AS collected FROM j"""),
    "edges_reopen": (edges_reopen, f"""WITH {E}, o AS (SELECT * FROM edges WHERE user_id % 3 <> 0), n AS (SELECT * FROM edges WHERE user_id % 2 = 0),
        j AS (SELECT CASE WHEN n.user_id IS NULL THEN 'r1' ELSE 'r2' END AS source_run, CASE WHEN n.user_id IS NULL THEN o.community_id % 2 = 0 ELSE
        true END AS is_current, coalesce(o.first_seen, n.last_seen) AS f, CASE WHEN n.user_id IS NULL THEN o.last_seen ELSE n.last_seen + INTERVAL 5
        DAY END AS l
        FROM o FULL OUTER JOIN n ON o.user_id = n.user_id AND o.community_id = n.community_id) SELECT source_run, is_current, count(*) AS edges,
        min(f) AS first, max(l) AS last FROM j GROUP BY 1, 2"""),
    "users_upsert": (users_upsert, """WITH o AS (SELECT * FROM customer WHERE c_custkey % 2 = 0), n AS (SELECT c_custkey, CASE WHEN c_custkey % 5 <> 0
        THEN upper(c_name) END AS name, CASE WHEN c_custkey % 7 = 0 THEN 'moved' END AS city FROM customer WHERE c_custkey % 3 = 0)
        SELECT coalesce(o.c_custkey, n.c_custkey) AS user_id, coalesce(name, c_name) AS name, coalesce(city, c_mktsegment) AS city, CASE WHEN
        n.c_custkey IS NULL THEN 1 ELSE 2 END AS updated FROM o FULL OUTER JOIN n ON o.c_custkey = n.c_custkey"""),
    "keyword_registry": (keyword_registry, """WITH i AS (SELECT p_partkey, p_size, lower(trim(p_type)) AS identity FROM part), w AS (SELECT identity,
        min(p_partkey) AS number FROM i WHERE p_size < 25 GROUP BY 1), k AS (SELECT identity, min(p_partkey) + 1000000 AS number FROM i WHERE p_size >
        20 GROUP BY 1)
        SELECT coalesce(k.identity, w.identity) AS identity, coalesce(k.number, w.number) AS number, w.identity IS NOT NULL AS active FROM k FULL
        OUTER JOIN w ON k.identity = w.identity"""),
    "run_ids": (run_ids, """WITH u AS (SELECT uuid()::VARCHAR AS id FROM customer) SELECT count(*) AS rows, count(DISTINCT id) AS ids, max(length(id))
        AS length FROM u"""),
    "resume_pending": (resume_pending, """SELECT count(*) AS pending, CAST(ceil(count(*) / 32) AS BIGINT) AS batches, min(o_orderkey) AS first FROM
        orders WHERE o_orderdate >= TIMESTAMP '1999-01-01'"""),
    "json_paths": (json_paths, """SELECT event_id, user_id AS n, NULL::VARCHAR AS none, round(value, 4) AS first FROM events WHERE event_type =
        'click'"""),
    "id_pages": (id_pages, """WITH r AS (SELECT l_orderkey, l_suppkey AS id, l_linenumber IN (3, 4, 5, 6) OR l_suppkey <= 0 AS bad FROM lineitem)
        SELECT l_orderkey, coalesce(array_to_string(list_sort(list_distinct(list(id) FILTER (WHERE NOT bad))), ','), '') AS ids, count(*) FILTER
        (WHERE bad) AS bad, count(*) AS next_offset FROM r GROUP BY 1"""),
    "terminal_runs": (terminal_runs, f"""WITH {b.JOBS_SQL} SELECT run_id, count(*) AS ended_jobs, max(created) AS ended, count(*) FILTER (WHERE status
        = 'failed') AS failed FROM jobs WHERE status IN ('completed', 'failed') GROUP BY 1"""),
    "daily_with_retry": (daily_with_retry, """WITH t AS (SELECT CAST(CAST(ts + INTERVAL 3 HOUR AS DATE) AS VARCHAR) AS day, ts, event_id,
        CAST(json_extract_string(props, '$.k') AS INT) % 4 = 0 AS ok FROM events WHERE event_type = 'click'),
        n AS (SELECT *, coalesce(sum(ok::INT) OVER (PARTITION BY day ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS
        before FROM t) SELECT day, count(*) AS tries, max(event_id) FILTER (WHERE ok) AS event_id, max(event_id) FILTER (WHERE ok) IS NULL AS pending
        FROM n WHERE before = 0 GROUP BY 1"""),
    "full_sample": (full_sample, f"WITH {_SYN} SELECT post_id, subject, modality, t_bin, v_bin FROM s"),
    "sampling_report": (sampling_report, f"WITH {_SYN}, {_REPORT}"),
    "pca_plane": (pca_plane, None),
    "label_top_words": (label_top_words, """WITH w AS (SELECT lang, unnest(regexp_extract_all(lower(text), '[a-z]{6,}')) AS word FROM documents WHERE
        text IS NOT NULL), c AS (SELECT lang, word, count(*) AS n FROM w GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY
        n DESC, word) AS k FROM c) SELECT lang, word, n FROM r WHERE k <= 5"""),
}
