"""Queries over scans, predicates and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import bindings as b
from ..functions import columns as c


def scan_filter_project(spark, sf_dir):
    p = b.posts(spark, sf_dir)
    return p.where(F.col("kind").isin("F", "O") & (F.col("published") >= b.moment("2001-01-01")) & ~F.col("label").isin("5-LOW")).select("post_id",
        "group_id", "kind")


def access_filter(spark, sf_dir):
    g = b.groups(spark, sf_dir)
    deactivated = F.when(F.col("group_id") % 11 == 0, "deleted")
    closed = F.when(F.col("group_id") % 5 != 0, F.col("group_id") % 3 == 0)
    return g.select("group_id", c.has_access(deactivated, closed, F.col("balance") > 5000).alias("accessible"),
        (F.coalesce(closed, F.lit(False)) & ~(F.col("balance") > 5000)).alias("closed_without_access"))


def staleness_flags(spark, sf_dir):
    seen = b.posts(spark, sf_dir).where("kind = 'F'").groupBy("group_id").agg(F.max("published").alias("seen"))
    joined = b.groups(spark, sf_dir).join(seen, "group_id", "left")
    return joined.select("group_id", c.stale(F.col("seen"), b.moment(b.ORDERS_AS_OF), 180 * 86400).alias("stale"),
        F.greatest("seen", b.moment("2000-01-01")).alias("floor_seen"))


def json_key_filter(spark, sf_dir):
    return b.table(spark, sf_dir, "events").where(F.get_json_object("props", "$.k") == "7").select("event_id", "user_id", "event_type")


def json_counters(spark, sf_dir):
    k = F.coalesce(F.get_json_object("props", "$.k").cast("long"), F.lit(0))
    return b.table(spark, sf_dir, "events").groupBy("event_type").agg(F.sum(k).alias("total_k"),
        F.sum(F.coalesce(F.get_json_object("props", "$.missing").cast("long"), F.lit(0))).alias("total_missing"))


def regex_filter(spark, sf_dir):
    return b.table(spark, sf_dir, "documents").where(F.col("text").rlike("(?i)(password|token)")).select("doc_id", "lang")


def like_filter(spark, sf_dir):
    return b.table(spark, sf_dir, "part").where(F.col("p_name").like("%ring%")).select("p_partkey", "p_name")


def keyset_page(spark, sf_dir):
    return b.table(spark, sf_dir, "customer").where("c_custkey > 40").orderBy("c_custkey").limit(25).select("c_custkey", "c_name")


def text_normalise(spark, sf_dir):
    text = F.concat(F.lit("  "), F.upper("p_name"), F.lit(" \t "), F.col("p_brand"), F.lit("\n"))
    return b.table(spark, sf_dir, "part").select("p_partkey", c.keyword_identity(text).alias("identity"),
        F.length(c.strip(text)).cast("long").alias("n"), F.left(c.strip(text), F.lit(5)).alias("head"))


def secret_mask(spark, sf_dir):
    """Documents with a key and a database address put in, in forms that are masked and in others that are not."""
    text = F.concat(F.replace("text", F.lit('token = "'), F.lit("Token=")), F.lit(" & PASSWORD=a&b postgresql+asyncpg://u:p@host/"),
        F.col("doc_id").cast("string"), F.lit(" mysql://u:p@host secret=1"))
    return b.table(spark, sf_dir, "documents").select("doc_id", F.md5(c.masked(text)).alias("digest"),
        F.right(c.masked(text), F.lit(40)).alias("tail"))


def content_hashes(spark, sf_dir):
    edited = F.when(F.col("post_id") % 3 == 0, F.col("post_id"))
    return b.posts(spark, sf_dir).select("post_id", c.content_hash(F.col("label"), F.col("group_id"), edited).alias("content_hash"))


def hash_rank_mod(spark, sf_dir):
    return b.posts(spark, sf_dir).select("post_id", c.hash_rank(F.concat_ws(":", F.lit("42"), "post_id", "group_id")).alias("rank"))


def bins(spark, sf_dir):
    return b.table(spark, sf_dir, "documents").select("doc_id", c.three_bins(F.col("n_chars"), 1053.67, 2209.68).alias("bin"))


def modality_profile(spark, sf_dir):
    k = F.col("event_id")
    return b.table(spark, sf_dir, "events").select("event_id", c.modality(k % 2 == 0, k % 3 == 0, k % 5 == 0).alias("modality"))


def retry_delays(spark, sf_dir):
    return b.jobs(spark, sf_dir).where("status in ('retry_wait', 'failed')").select("job_id",
        c.retry_delay(F.col("attempts"), F.col("job_type") != "posts").cast("long").alias("delay"))


def demographics_text(spark, sf_dir):
    sex = F.when(F.col("c_custkey") % 3 == 1, "female").when(F.col("c_custkey") % 3 == 2, "male")
    city = F.nullif(F.when(F.col("c_nationkey") % 4 == 0, F.lit("")).otherwise(F.concat(F.lit("city "), F.col("c_nationkey").cast("string"))),
        F.lit(""))
    parts = [F.concat(F.lit("sex: "), sex), F.concat(F.lit("city: "), city), F.when(F.col("c_acctbal") > 0,
        F.concat(F.lit("segment: "), "c_mktsegment"))]
    return b.table(spark, sf_dir, "customer").select("c_custkey", F.concat_ws(", ", *parts).alias("about"),
        sum(p.isNotNull().cast("long") for p in parts).alias("attributes"), F.size(F.map_filter(F.create_map(F.lit("sex"), sex, F.lit("city"), city),
        lambda k, v: v.isNotNull())).cast("long").alias("known"))


def set_ops_on_labels(spark, sf_dir):
    labels = b.posts(spark, sf_dir).groupBy("group_id").agg(F.array_sort(F.collect_set("label")).alias("labels"))
    wanted = F.array(F.lit("1-URGENT"), F.lit("2-HIGH"))
    return labels.select("group_id", F.array_join("labels", "|").alias("labels"), (F.size(F.array_except(wanted, "labels")) == 0).alias("covers"),
        F.array_join(F.array_sort(F.array_union("labels", wanted)), "|").alias("either"))


def percent_buckets(spark, sf_dir):
    done = F.count_if(F.col("status").isin("completed", "failed"))
    runs = b.jobs(spark, sf_dir).groupBy("run_id").agg(done.alias("done"), F.count("*").alias("jobs"))
    return runs.select("run_id", c.percent_bucket(F.col("done"), F.col("jobs")).alias("bucket"), c.pages_needed(F.col("jobs"), 100).alias("pages"))


def byte_texts(spark, sf_dir):
    n = F.pow(F.lit(10.0), (F.col("p_partkey") % 13)) * (F.col("p_size") + 1.3)
    return b.table(spark, sf_dir, "part").select("p_partkey", c.bytes_text(n).alias("size_text"),
        c.uptime_text(F.col("p_partkey") * 3601).alias("uptime"))


def html_escapes(spark, sf_dir):
    return b.table(spark, sf_dir, "pages").select("page_id", F.md5(c.html_escape(F.col("html"))).alias("digest"))


def epoch_moments(spark, sf_dir):
    return b.table(spark, sf_dir, "orders").select("o_orderkey", c.epoch_moment((F.col("o_orderkey") - 100) * 86400).alias("moment"))


def local_dates(spark, sf_dir):
    return b.table(spark, sf_dir, "events").select("event_id", F.to_date(F.col("ts") + F.expr("INTERVAL 3 HOUR")).cast("string").alias("local_date"))


def page_addresses(spark, sf_dir):
    name = F.when(F.col("c_custkey") % 3 == 0, F.lit("  ")).when(F.col("c_custkey") % 3 == 1, F.col("c_name"))
    return b.table(spark, sf_dir, "customer").select("c_custkey", c.page_address(name, F.col("c_custkey")).alias("address"))


def unit_vectors(spark, sf_dir):
    scaled = F.transform("embedding", lambda x: x.cast("double") * 3)
    return b.table(spark, sf_dir, "embeddings").select("vec_id", F.round(c.norm(c.unit(scaled)), 6).alias("norm"),
        F.round(F.element_at(c.unit(scaled), 1), 5).alias("first"))


def config_hashes(spark, sf_dir):
    text = F.concat_ws("|", "job_type", F.col("run_id").cast("string"), F.col("priority").cast("string"))
    return b.jobs(spark, sf_dir).select(F.sha2(text, 256).alias("plan_key")).groupBy("plan_key").agg(F.count("*").alias("jobs"))


WS = r"^[\s\p{Z}]+|[\s\p{Z}]+$"
_HASH = "sha256('42:' || CAST(post_id AS VARCHAR) || ':' || CAST(group_id AS VARCHAR))"
_NORM = "sqrt(list_sum(list_transform(embedding, lambda x: (x::DOUBLE*3)*(x::DOUBLE*3))))"
QUERIES = {
    "scan_filter_project": (scan_filter_project, f"""WITH {b.POSTS_SQL} SELECT post_id, group_id, kind FROM posts WHERE kind IN ('F','O') AND
        published >= TIMESTAMP '2001-01-01' AND label NOT IN ('5-LOW')"""),
    "access_filter": (access_filter, f"""WITH {b.GROUPS_SQL}, f AS (SELECT group_id, CASE WHEN group_id % 11 = 0 THEN 'deleted' END AS gone, CASE WHEN
        group_id % 5 <> 0 THEN group_id % 3 = 0 END AS closed, balance > 5000 AS can FROM groups)
        SELECT group_id, gone IS NULL AND (NOT coalesce(closed, false) OR coalesce(can, false)) AS accessible, coalesce(closed, false) AND NOT can AS
        closed_without_access FROM f"""),
    "staleness_flags": (staleness_flags, f"""WITH {b.GROUPS_SQL}, {b.POSTS_SQL}, s AS (SELECT group_id, max(published) AS seen FROM posts WHERE kind =
        'F' GROUP BY 1)
        SELECT g.group_id, seen IS NULL OR seen < TIMESTAMP '{b.ORDERS_AS_OF}' - INTERVAL 180 DAY AS stale, greatest(seen, TIMESTAMP '2000-01-01') AS
        floor_seen FROM groups g LEFT JOIN s USING (group_id)"""),
    "json_key_filter": (json_key_filter, "SELECT event_id, user_id, event_type FROM events WHERE json_extract_string(props, '$.k') = '7'"),
    "json_counters": (json_counters, """SELECT event_type, CAST(sum(coalesce(CAST(json_extract_string(props, '$.k') AS BIGINT), 0)) AS BIGINT) AS
        total_k, CAST(sum(coalesce(CAST(json_extract_string(props, '$.missing') AS BIGINT), 0)) AS BIGINT) AS total_missing FROM events GROUP BY 1"""),
    "regex_filter": (regex_filter, "SELECT doc_id, lang FROM documents WHERE regexp_matches(text, '(password|token)', 'i')"),
    "like_filter": (like_filter, "SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%ring%'"),
    "keyset_page": (keyset_page, "SELECT c_custkey, c_name FROM customer WHERE c_custkey > 40 ORDER BY c_custkey LIMIT 25"),
    "text_normalise": (text_normalise, r"""WITH t AS (SELECT p_partkey, '  ' || upper(p_name) || ' ' || chr(9) || ' ' || p_brand || chr(10) AS x FROM
        part), s AS (SELECT p_partkey, regexp_replace(x, '^\s+|\s+$', '', 'g') AS x FROM t)
        SELECT p_partkey, regexp_replace(translate(lower(x), 'ё', 'е'), '\s+', ' ', 'g') AS identity, length(x) AS n, left(x, 5) AS head FROM s"""),
    "secret_mask": (secret_mask, r"""WITH t AS (SELECT doc_id, replace(text, 'token = "', 'Token=') ||
        ' & PASSWORD=a&b postgresql+asyncpg://u:p@host/' || doc_id || ' mysql://u:p@host secret=1' AS t FROM documents),
        m AS (SELECT doc_id, left(regexp_replace(regexp_replace(t, '(access_token|token|password)=([^&\s]+)', '[СКРЫТО]', 'gi'),
        'postgresql(\+asyncpg)?://[^\s]+', '[СКРЫТО]', 'g'), 2000) AS t FROM t) SELECT doc_id, md5(t) AS digest, right(t, 40) AS tail FROM m"""),
    "content_hashes": (content_hashes, f"""WITH {b.POSTS_SQL} SELECT post_id, sha256(coalesce(label,'') || chr(0) || CAST(group_id AS VARCHAR) ||
        chr(0) || CASE WHEN post_id % 3 = 0 THEN CAST(post_id AS VARCHAR) ELSE 'None' END) AS content_hash FROM posts"""),
    "hash_rank_mod": (hash_rank_mod, f"""WITH {b.POSTS_SQL}, h AS (SELECT post_id, {_HASH} AS h FROM posts)
        SELECT post_id, list_reduce(list_prepend(0::BIGINT, list_transform(range(8), lambda i: ('0x' || substr(h, CAST(8*i+1 AS BIGINT),
        8))::BIGINT)), lambda a, w: (a * 294967296 + w) % 1000000000) AS rank FROM h"""),
    "bins": (bins, "SELECT doc_id, CASE WHEN n_chars <= 1053.67 THEN 'low' WHEN n_chars <= 2209.68 THEN 'mid' ELSE 'high' END AS bin FROM documents"),
    "modality_profile": (modality_profile, """SELECT event_id, CASE WHEN event_id % 15 = 0 THEN 'trimodal' WHEN event_id % 10 = 0 THEN 'text_video'
        WHEN event_id % 6 = 0 THEN 'text_image' WHEN event_id % 5 = 0 THEN 'video_only'
        WHEN event_id % 3 = 0 THEN 'image_only' WHEN event_id % 2 = 0 THEN 'text_only' ELSE 'empty' END AS modality FROM events"""),
    "retry_delays": (retry_delays, f"""WITH {b.JOBS_SQL} SELECT job_id, CAST(CASE WHEN attempts <= 5 THEN
        ([60,300,900,3600,21600])[greatest(least(attempts,5),1)] WHEN job_type <> 'posts' THEN least(86400, 21600 * pow(2, least(2, attempts-5))) END
        AS BIGINT) AS delay
        FROM jobs WHERE status IN ('retry_wait','failed')"""),
    "demographics_text": (demographics_text, """WITH p AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 1 THEN 'female' WHEN c_custkey % 3 = 2 THEN
        'male' END AS sex, CASE WHEN c_nationkey % 4 <> 0 THEN 'city ' || c_nationkey END AS city, CASE WHEN c_acctbal > 0 THEN 'segment: ' ||
        c_mktsegment END AS seg FROM customer)
        SELECT c_custkey, concat_ws(', ', 'sex: ' || sex, 'city: ' || city, seg) AS about, CAST((sex IS NOT NULL)::INT + (city IS NOT NULL)::INT +
        (seg IS NOT NULL)::INT AS BIGINT) AS attributes, CAST((sex IS NOT NULL)::INT + (city IS NOT NULL)::INT AS BIGINT) AS known FROM p"""),
    "set_ops_on_labels": (set_ops_on_labels, f"""WITH {b.POSTS_SQL}, l AS (SELECT group_id, list_sort(list(DISTINCT label)) AS labels FROM posts GROUP
        BY 1)
        SELECT group_id, array_to_string(labels, '|') AS labels, list_has_all(labels, ['1-URGENT','2-HIGH']) AS covers,
        array_to_string(list_sort(list_distinct(list_concat(labels, ['1-URGENT','2-HIGH']))), '|') AS either FROM l"""),
    "percent_buckets": (percent_buckets, f"""WITH {b.JOBS_SQL}, r AS (SELECT run_id, count(*) FILTER (WHERE status IN ('completed','failed')) AS done,
        count(*) AS jobs FROM jobs GROUP BY 1)
        SELECT run_id, CAST(least(100, done * 100 // jobs) // 10 * 10 AS BIGINT) AS bucket, (jobs + 99) // 100 AS pages FROM r"""),
    "byte_texts": (byte_texts, """WITH n AS (SELECT p_partkey, pow(10.0, p_partkey % 13) * (p_size + 1.3) AS n FROM part)
        SELECT p_partkey, CASE WHEN n < 1024 THEN printf('%.0f B', n) WHEN n < pow(1024,2) THEN printf('%.0f KiB', n/1024) WHEN n < pow(1024,3) THEN
        printf('%.0f MiB', n/pow(1024,2)) WHEN n < pow(1024,4) THEN printf('%.1f GiB', n/pow(1024,3)) ELSE printf('%.1f TiB', n/pow(1024,4)) END AS
        size_text,
        (p_partkey*3601)//86400 || ' d ' || (p_partkey*3601)%86400//3600 || ' h' AS uptime FROM n"""),
    "html_escapes": (html_escapes, """SELECT page_id, md5(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')) AS digest FROM
        pages"""),
    "epoch_moments": (epoch_moments, """SELECT o_orderkey, CASE WHEN o_orderkey > 100 THEN TIMESTAMP '1970-01-01' + to_days(CAST(o_orderkey - 100 AS
        INT)) END AS moment FROM orders"""),
    "local_dates": (local_dates, "SELECT event_id, CAST(CAST(ts + INTERVAL 3 HOUR AS DATE) AS VARCHAR) AS local_date FROM events"),
    "page_addresses": (page_addresses, """SELECT c_custkey, 'https://example.org/' || CASE WHEN c_custkey % 3 = 1 THEN c_name ELSE 'club' || c_custkey
        END AS address FROM customer"""),
    "unit_vectors": (unit_vectors, f"""SELECT vec_id, round(sqrt(list_sum(list_transform(embedding, lambda x:
        ((x::DOUBLE*3)/{_NORM})*((x::DOUBLE*3)/{_NORM})))), 6) AS norm, round(embedding[1]::DOUBLE*3/{_NORM}, 5) AS first FROM embeddings"""),
    "config_hashes": (config_hashes, f"""WITH {b.JOBS_SQL} SELECT sha256(job_type || '|' || run_id || '|' || priority) AS plan_key, count(*) AS jobs
        FROM jobs GROUP BY 1"""),
}
