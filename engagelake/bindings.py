"""The domain's tables over the star schema: groups, posts, attachments, edges, jobs, calls.

groups = customer, posts = orders, attachments = lineitem, communities = supplier, users = event
users, jobs = orders by status, API calls = events. Only names change; everything stays lazy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed moments that stand for "now", so that results do not depend on the day.
ORDERS_AS_OF = "2001-08-01 00:00:00"
EVENTS_AS_OF = "2024-01-31 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def moment(text: str):
    """A timestamp without zone, as the tables have them."""
    return F.to_timestamp_ntz(F.lit(text))


def groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment = F.col("c_mktsegment")
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("group_id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"),
        F.col("c_acctbal").alias("balance"), segment.alias("segment"),
        F.when(segment.isin("BUILDING", "MACHINERY"), "approved").when(segment == "FURNITURE", "rejected").otherwise("pending").alias("status"),
    )


GROUPS_SQL = """groups AS (SELECT c_custkey AS group_id, c_name AS name, c_nationkey AS nation, c_acctbal AS balance, c_mktsegment AS segment,
  CASE WHEN c_mktsegment IN ('BUILDING','MACHINERY') THEN 'approved' WHEN c_mktsegment = 'FURNITURE' THEN 'rejected' ELSE 'pending' END AS status FROM
    customer)"""


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("post_id"), F.col("o_custkey").alias("group_id"), F.col("o_orderdate").alias("published"),
        F.col("o_orderstatus").alias("kind"), F.col("o_totalprice").alias("reach"), F.col("o_orderpriority").alias("label")
    )


POSTS_SQL = """posts AS (SELECT o_orderkey AS post_id, o_custkey AS group_id, o_orderdate AS published, o_orderstatus AS kind, o_totalprice AS reach,
    o_orderpriority AS label FROM orders)"""


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jobs: state by order status, attempts by the order key, priority by its label's digit."""
    status = F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("job_id"), (F.col("o_custkey") % 50).alias("run_id"),
        F.element_at(F.array(*map(F.lit, ("posts", "members", "profile"))), (F.col("o_orderkey") % 3 + 1).cast("int")).alias("job_type"),
        F.col("o_custkey").alias("entity_id"),
        F.when(status == "F", "completed").when(status == "O", "pending").when(F.col("o_orderkey") % 5 == 0,
        "running").when(F.col("o_orderkey") % 7 == 0, "failed").otherwise("retry_wait").alias("status"),
        (F.col("o_orderkey") % 9).cast("int").alias("attempts"), F.substring("o_orderpriority", 1, 1).cast("int").alias("priority"),
        F.col("o_orderdate").alias("created"),
        F.when(F.col("o_orderkey") % 4 == 0,
        F.col("o_orderdate") + F.expr("make_dt_interval(cast(o_orderkey % 30 as int), 0, 0, 0)")).alias("next_attempt"),
    )


JOBS_SQL = """jobs AS (SELECT o_orderkey AS job_id, o_custkey % 50 AS run_id, (['posts','members','profile'])[o_orderkey % 3 + 1] AS job_type,
    o_custkey AS entity_id,
  CASE WHEN o_orderstatus = 'F' THEN 'completed' WHEN o_orderstatus = 'O' THEN 'pending' WHEN o_orderkey % 5 = 0 THEN 'running' WHEN o_orderkey % 7 =
    0 THEN 'failed' ELSE 'retry_wait' END AS status,
  CAST(o_orderkey % 9 AS INT) AS attempts, CAST(substr(o_orderpriority,1,1) AS INT) AS priority, o_orderdate AS created,
  CASE WHEN o_orderkey % 4 = 0 THEN o_orderdate + to_days(CAST(o_orderkey % 30 AS INT)) END AS next_attempt FROM orders)"""


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """API calls: an event's user is the token, its type the method; its counter's last digit gives a code."""
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("token"), F.col("event_type").alias("method"), "ts",
        F.when(k % 10 == 6, 6).when(k % 10 == 9, 9).otherwise(0).alias("code"), k.alias("k"))


CALLS_SQL = """calls AS (SELECT event_id, user_id AS token, event_type AS method, ts, CASE WHEN k % 10 = 6 THEN 6 WHEN k % 10 = 9 THEN 9 ELSE 0 END AS
    code, k
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events))"""


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user-community edges: who has ordered from whom, with first and last ship date."""
    return (
        table(spark, sf_dir, "orders").join(table(spark, sf_dir, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
        .groupBy(F.col("o_custkey").alias("user_id"), F.col("l_suppkey").alias("community_id"))
        .agg(F.min("l_shipdate").alias("first_seen"), F.max("l_shipdate").alias("last_seen"), F.max("o_orderkey").alias("source_run"))
    )


EDGES_SQL = """edges AS (SELECT o_custkey AS user_id, l_suppkey AS community_id, min(l_shipdate) AS first_seen, max(l_shipdate) AS last_seen,
    max(o_orderkey) AS source_run
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2)"""


def merkle_sql(rows: str, leaf_rows: int, by: str = "") -> str:
    """CTEs that end in root (by, digest, rows): the tree over the column text of ``rows``, written out for depths of up to five."""
    g = f"{by}, " if by else ""
    depth = " ".join(f"WHEN n <= {leaf_rows * 16**d} THEN {d}" for d in range(5))
    out = f"""r AS ({rows}), sizes AS (SELECT count(*) AS n FROM r {"GROUP BY " + by if by else ""}), deep AS (SELECT CASE {depth} ELSE 5 END AS d FROM
        (SELECT max(n) AS n FROM sizes)),
        h AS (SELECT {g}sha256(text) AS h, count(*) AS n FROM r GROUP BY {g}sha256(text)),
        level5 AS (SELECT {g}left(h, (SELECT d FROM deep)) AS prefix, sha256(string_agg(h || '*' || n, ',' ORDER BY h)) AS digest, sum(n) AS rows
            FROM h GROUP BY ALL)"""
    for k in range(4, -1, -1):
        out += f""", level{k} AS (SELECT {g}left(prefix, greatest(length(prefix) - 1, 0)) AS prefix, CASE WHEN max(length(prefix)) = 0 THEN max(digest)
            ELSE sha256(string_agg(prefix || ':' || digest, ',' ORDER BY prefix)) END AS digest, sum(rows) AS rows FROM level{k + 1}
            GROUP BY {g}left(prefix, greatest(length(prefix) - 1, 0)))"""
    return out + f", root AS (SELECT {g}digest, CAST(rows AS BIGINT) AS rows FROM level0)"
