"""JSON lines of nested records, batch exports, decisions, media digests and embedding bundles."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import files

POST = "post_id bigint, group_id bigint, community_vk_id bigint, subject string, published_at timestamp, text string, modality_profile string, attachments array<struct<position:int,attachment_type:string,width:int,height:int,external_url:string>>"
DECISION = "batch_id string, approved_group_ids array<bigint>, results array<struct<group_id:bigint,status:string,labels:array<string>,confidence:double>>"


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Objects by schema: keys it lacks are dropped, blank lines skipped, malformed lines fail."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    """One object for each line, nulls included."""
    df.write.option("ignoreNullFields", "false").json(path)


def batch_document(items: DataFrame, batch_id: str) -> DataFrame:
    """One JSON document: the batch's groups in order of position, each with its keywords. A batch is bounded."""
    groups = F.array_sort(F.collect_list(F.struct("position", "group_id", "name", F.array_sort("keywords").alias("keywords"))))
    return items.agg(groups.alias("groups")).select(F.to_json(F.struct(F.lit(batch_id).alias("batch_id"), "groups")).alias("document"))


def decisions(documents: DataFrame, column: str = "document") -> DataFrame:
    """A row for each decision of either format; a document must have exactly one of the two.

    Columns batch_id, group_id, status, labels, confidence, valid.
    """
    d = documents.select(F.from_json(column, DECISION).alias("d")).select("d.*")
    valid = F.col("approved_group_ids").isNotNull() != F.col("results").isNotNull()
    listed = F.transform("approved_group_ids", lambda g: F.struct(g.alias("group_id"), F.lit("approved").alias("status"),
        F.array().cast("array<string>").alias("labels"), F.lit(1.0).alias("confidence")))
    return d.select("batch_id", valid.alias("valid"), F.explode_outer(F.coalesce("results", listed)).alias("r")).select("batch_id", "r.*", "valid")


def normalised_attachments(raw: DataFrame, column: str = "raw") -> DataFrame:
    """(type, width, height, url, caption) from raw attachments: the widest size, links for link and doc only, captions for link only."""
    schema = "type string, photo struct<sizes:array<struct<width:int,height:int,url:string>>>, link struct<url:string,caption:string>, doc struct<url:string>"
    a = raw.withColumn("a", F.from_json(column, schema))
    widest = F.array_max(F.transform("a.photo.sizes", lambda s: F.struct(s["width"].alias("width"), s["height"].alias("height"))))
    kind = F.col("a.type")
    return a.select(*raw.columns, kind.alias("type"), widest["width"].alias("width"), widest["height"].alias("height"),
        F.when(kind == "link", F.col("a.link.url")).when(kind == "doc", F.col("a.doc.url")).alias("url"),
        F.when(kind == "link", F.col("a.link.caption")).alias("caption"))


def search_page(items: DataFrame) -> DataFrame:
    """One row: raw, private, deleted and open groups of a page (is_closed, deactivated)."""
    gone, closed = F.col("deactivated").isNotNull(), F.coalesce(F.col("is_closed"), F.lit(False))
    return items.agg(F.count("*").alias("raw"), F.count_if(closed & ~gone).alias("private"), F.count_if(gone).alias("deleted"),
        F.count_if(~closed & ~gone).alias("items"))


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, sha256) of the files under a folder; the reader leaves empty ones out, which are not valid media."""
    return spark.read.format("binaryFile").load(path).where("length > 0").select("path", "length", F.sha2("content", 256).alias("sha256"))


#: The reports that a bundle can have.
REPORTS = ("run_config", "sampling_report", "embedding_quality_report", "video_calibration_report")


def write_bundle(vectors: DataFrame, metadata: DataFrame, failures: DataFrame, path: str, key: str = "post_id", **reports: DataFrame | dict) -> None:
    """A bundle: vectors with their metadata, joined by key (never by position), and beside them the failures and the reports of the run.

    ``reports``: run_config, sampling_report, embedding_quality_report, video_calibration_report, each a dictionary or a table of (measure, value) or of one
    row; a report that is not given has no file. ``manifest.json`` comes last and names what there is: a bundle without it is not complete.
    """
    spark = vectors.sparkSession
    if wrong := set(reports) - set(REPORTS):
        raise ValueError(f"unknown reports: {sorted(wrong)}")
    metadata.join(vectors, key).write.parquet(f"{path}/embeddings")
    failures.write.json(f"{path}/failures")
    for name, report in reports.items():
        if isinstance(report, DataFrame):
            rows = report.limit(10_000).collect()
            report = {r.measure: r.value for r in rows} if report.columns == ["measure", "value"] else rows[0].asDict(True)
        files.put_new(spark, f"{path}/{name}.json", json.dumps(report, ensure_ascii=False, indent=2, sort_keys=True, default=str))
    written = spark.read.parquet(f"{path}/embeddings")
    files.put_new(spark, f"{path}/manifest.json", json.dumps({"rows": written.count(), "reports": sorted(reports)}))


def read_report(spark: SparkSession, path: str, name: str) -> dict | None:
    """A report of a bundle, None if it has none."""
    return json.loads(files.text_of(spark, f"{path}/{name}.json")) if files.exists(spark, f"{path}/{name}.json") else None


def read_bundle(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/embeddings")
