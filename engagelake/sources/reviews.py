"""A review of groups as files: the snapshot with empty decisions, its progress and validation, and reading it back with all checks.

``decisions`` is a folder of JSON lines, one for each group with its whole context; ``header.json``, ``progress.json`` and ``validation.json`` stand beside
it. The snapshot's digest is the root of its tree (``operators.merkle``), so that exports of any size are checked without passing through one place.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import merkle
from . import files

CONTEXT = ("vk_id", "name", "description", "status", "matched_keywords", "previous_approved", "previous_labels")
DECISION = "food_service boolean, final_approved boolean, final_labels array<string>, confidence double, reason string"
ROW = ("vk_id long, name string, description string, status string, matched_keywords array<struct<subject:string,keyword:string>>, "
    "previous_approved boolean, previous_labels array<string>, ") + DECISION


def contexts(groups: DataFrame, labels: DataFrame, keywords: DataFrame) -> DataFrame:
    """CONTEXT of each group (group_id, vk_id, name, description, status, approved), from labels (group_id, label) and keywords (group_id, keyword_id, subject, keyword)."""
    listed = labels.groupBy("group_id").agg(F.array_sort(F.collect_list("label")).alias("previous_labels"))
    matched = keywords.groupBy("group_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("keyword_id", "subject", "keyword"))),
        lambda k: F.struct(k["subject"].alias("subject"), k["keyword"].alias("keyword"))).alias("matched_keywords"))
    x = groups.join(listed, "group_id", "left").join(matched, "group_id", "left")
    return x.select("vk_id", "name", "description", "status", F.coalesce("matched_keywords",
        F.array().cast("array<struct<subject:string,keyword:string>>")).alias("matched_keywords"), F.col("approved").alias("previous_approved"),
        F.coalesce("previous_labels", F.array().cast("array<string>")).alias("previous_labels"))


def snapshot_digest(rows: DataFrame) -> tuple[str, int]:
    """The root of the contexts' tree, and their number."""
    one = merkle.root(rows.select(*CONTEXT)).first()
    return one.digest, one.rows


def put(spark: SparkSession, path: str, value: dict) -> None:
    files.delete(spark, path)
    files.put_new(spark, path, json.dumps(value, ensure_ascii=False, indent=2))


def prepare(rows: DataFrame, path: str, operation: str, source: str, now: str) -> dict:
    """Writes the snapshot ``rows`` (CONTEXT) with empty decisions; gives the progress. The header comes last: without it there is no export."""
    spark = rows.sparkSession
    empty = [F.lit("").alias(n) if n == "reason" else F.lit(None).cast(t).alias(n) for n, t in (c.split() for c in DECISION.split(", "))]
    rows.select(*CONTEXT, *empty).write.option("ignoreNullFields", "false").json(f"{path}/decisions")
    digest, n = snapshot_digest(spark.read.schema(ROW).json(f"{path}/decisions"))  # of what stands in the files
    progress = {"operation_id": operation, "snapshot_sha256": digest, "total": n, "completed": 0, "remaining": n, "status": "awaiting_semantic_review",
        "updated_at": now}
    put(spark, f"{path}/progress.json", progress)
    put(spark, f"{path}/validation.json", {"operation_id": operation, "valid": False, "status": "not_validated", "expected_decisions": n,
        "validated_decisions": 0})
    put(spark, f"{path}/header.json", {"operation_id": operation, "source": source, "snapshot_sha256": digest, "expected_count": n})
    return progress


def faults(reviewed: DataFrame) -> Column:
    """What is wrong with a decision: an array of names, empty of a good one."""
    labels, approved = F.coalesce("final_labels", F.array().cast("array<string>")), F.col("final_approved")
    rules = {
        "undecided": approved.isNull() | F.col("food_service").isNull(),
        "labels": approved != (F.size(labels) > 0), "repeated_label": F.size(F.array_distinct(labels)) < F.size(labels),
        "lost_label": approved & (F.size(F.array_except("previous_labels", labels)) > 0),
        "flag": F.col("food_service") != F.array_contains(labels, "food_service"),
        "confidence": F.col("confidence").isNull() | ~F.col("confidence").between(0, 1), "reason": F.length(F.trim(F.coalesce("reason", F.lit("")))) < 10,
    }
    return F.filter(F.array(*(F.when(F.coalesce(bad, F.lit(False)), n) for n, bad in rules.items())), lambda x: x.isNotNull())


def load(spark: SparkSession, path: str, decisions: str | None = None) -> DataFrame:
    """The rows (ROW) of a finished review, in ``path`` or in the folder ``decisions``; fails unless everything is in order.

    The contexts must be those that were exported, all of them, each once, and every decision must be without faults; progress and validation are
    brought up to date either way.
    """
    header = json.loads(files.text_of(spark, f"{path}/header.json"))
    rows = spark.read.schema(ROW).json(decisions or f"{path}/decisions")
    digest, n = snapshot_digest(rows)
    bad = rows.select(faults(rows).alias("f"))
    sums = bad.agg(F.count_if(F.size("f") == 0).alias("good"), F.count_if(F.array_contains("f", "undecided")).alias("open")).first()
    wrong = {r.fault: r["count"] for r in bad.select(F.explode("f").alias("fault")).groupBy("fault").count().collect()}  # one row for each rule
    same = digest == header["snapshot_sha256"] and n == header["expected_count"]
    valid = same and sums.good == n
    done = n - sums.open
    put(spark, f"{path}/validation.json", {"operation_id": header["operation_id"], "valid": valid, "status": "validated" if valid else "rejected",
        "expected_decisions": header["expected_count"], "validated_decisions": sums.good, "faults": dict(sorted(wrong.items()))})
    progress = json.loads(files.text_of(spark, f"{path}/progress.json"))
    put(spark, f"{path}/progress.json", progress | {"completed": done, "remaining": n - done, "status": "completed" if valid else "in_review"})
    if not same:
        raise ValueError("the context of the snapshot has changed since it was exported")
    if not valid:
        raise ValueError(f"the review is not complete: {wrong}")
    return rows


def fixed(eligible: DataFrame, resolved: DataFrame, expected: dict, path: str, limit: int | None = None) -> DataFrame:
    """Fixes the users (user_id) of a campaign as a table in ``path``, if the counts are still those of its preview; else nothing is left and it fails.

    ``expected``: eligible, resolved, snapshot, snapshot_resolved. With a ``limit`` only the first so many unresolved users are fixed. Counts are taken
    before, and again of what has been written, since users may change while it is written.
    """
    spark = eligible.sparkSession
    users, done = eligible.select("user_id").distinct(), resolved.select("user_id").distinct()
    n = users.count()
    k = users.join(done, "user_id", "left_semi").count()
    snapshot = n if limit is None else min(n - k, limit)
    now = {"eligible": n, "resolved": k, "snapshot": snapshot, "snapshot_resolved": k if limit is None else 0}
    if now != expected:
        raise ValueError(f"counts have changed since the preview: {now} instead of {expected}")
    chosen = users if limit is None else users.join(done, "user_id", "left_anti").orderBy("user_id").limit(snapshot)
    chosen.write.parquet(path)
    written = spark.read.parquet(path)
    after = written.count(), written.join(done, "user_id", "left_semi").count()
    if after != (now["snapshot"], now["snapshot_resolved"]):
        files.delete(spark, path)
        raise ValueError(f"users have changed while the snapshot was taken: {after}")
    return written
