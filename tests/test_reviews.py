import json
import re

import pytest
from pyspark.sql import functions as F

from engagelake.sources import records, reviews


@pytest.fixture
def review(spark, tmp_path):
    groups = spark.createDataFrame([(i, 100 + i, f"é {i}", None if i == 2 else "d", "s", i % 2 == 0) for i in range(6)],
        "group_id long, vk_id long, name string, description string, status string, approved boolean")
    labels = spark.createDataFrame([(0, "b"), (0, "a"), (2, "food_service")], "group_id long, label string")
    keywords = spark.createDataFrame([(0, 2, "x", "k2"), (0, 1, "y", "k1")], "group_id long, keyword_id long, subject string, keyword string")
    rows = reviews.contexts(groups, labels, keywords)
    path = str(tmp_path / "review")
    progress = reviews.prepare(rows.repartition(3), path, "op-1", "food", "2026-01-01T00:00:00")
    return path, rows, progress


def decide(spark, path, out, change=lambda r: r):
    lines = []
    for r in spark.read.text(f"{path}/decisions").collect():
        d = json.loads(r.value)
        d |= {"final_approved": d["previous_approved"], "final_labels": (d["previous_labels"] or ["new"]) if d["previous_approved"] else [], "confidence": 0.9,
            "reason": "looked at its description"}
        d["food_service"] = "food_service" in d["final_labels"]
        lines.append(json.dumps(change(d), ensure_ascii=False))
    (out).mkdir()
    (out / "all.json").write_text("\n".join(lines))
    return str(out)


def test_a_review_goes_round(spark, review, tmp_path):
    path, rows, progress = review
    assert progress["total"] == progress["remaining"] == 6 and re.fullmatch("[0-9a-f]{64}", progress["snapshot_sha256"])
    assert reviews.snapshot_digest(rows)[0] == progress["snapshot_sha256"]
    with pytest.raises(ValueError, match="not complete"):
        reviews.load(spark, path)
    state = json.loads((tmp_path / "review/validation.json").read_text())
    assert state["valid"] is False and state["validated_decisions"] == 0 and state["faults"]["undecided"] == 6
    done = reviews.load(spark, path, decide(spark, path, tmp_path / "done"))
    assert done.count() == 6 and done.where("vk_id = 100").first().matched_keywords[0].keyword == "k1"
    assert json.loads((tmp_path / "review/progress.json").read_text())["status"] == "completed"
    assert json.loads((tmp_path / "review/validation.json").read_text())["valid"] is True


@pytest.mark.parametrize("name, change", [
    ("changed", lambda d: d | {"name": "other"} if d["vk_id"] == 103 else d), ("changed", lambda d: d | {"vk_id": 100} if d["vk_id"] == 101 else d),
    ("labels", lambda d: d | {"final_labels": []}), ("lost_label", lambda d: d | ({"final_labels": ["a"]} if d["vk_id"] == 100 else {})),
    ("flag", lambda d: d | {"food_service": True}), ("reason", lambda d: d | {"reason": "short  "}), ("confidence", lambda d: d | {"confidence": 1.5}),
    ("repeated_label", lambda d: d | {"final_labels": d["final_labels"] * 2}),
])
def test_faults_are_found(spark, review, tmp_path, name, change):
    path, _, _ = review
    with pytest.raises(ValueError, match=name):
        reviews.load(spark, path, decide(spark, path, tmp_path / "done", change))


def test_a_snapshot_is_fixed_or_nothing(spark, tmp_path):
    users, resolved = spark.range(100).withColumnRenamed("id", "user_id"), spark.range(30, 130).withColumnRenamed("id", "user_id")
    expected = {"eligible": 100, "resolved": 70, "snapshot": 100, "snapshot_resolved": 70}
    assert reviews.fixed(users, resolved, expected, str(tmp_path / "a")).count() == 100
    limited = reviews.fixed(users, resolved, expected | {"snapshot": 20, "snapshot_resolved": 0}, str(tmp_path / "b"), limit=20)
    assert sorted(r.user_id for r in limited.collect()) == list(range(20))
    with pytest.raises(ValueError, match="since the preview"):
        reviews.fixed(users, resolved, expected | {"resolved": 69}, str(tmp_path / "c"))
    assert not (tmp_path / "c").exists()
    # users that change while the snapshot is taken: each job sees others
    from pyspark.sql.functions import udf

    seen = tmp_path / "jobs"
    drift = udf(lambda x: bool(seen.exists() or x < 100), "boolean").asNondeterministic()
    mark = udf(lambda x: (seen.touch(), x)[1] if x == 99 else x, "long").asNondeterministic()
    moving = spark.range(0, 110, 1, 1).where(drift(F.col("id"))).select(mark(F.col("id")).alias("user_id"))
    with pytest.raises(ValueError):
        reviews.fixed(moving, resolved.limit(0), {"eligible": 100, "resolved": 0, "snapshot": 100, "snapshot_resolved": 0}, str(tmp_path / "d"))
    assert not (tmp_path / "d").exists()


def test_a_bundle_has_its_reports(spark, tmp_path):
    vectors = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "post_id long, vector array<double>")
    path = str(tmp_path / "bundle")
    report = spark.createDataFrame([("ks", 0.5), ("chi2", 1.5)], "measure string, value double")
    records.write_bundle(vectors, vectors.select("post_id"), vectors.limit(0), path, run_config={"seed": 42, "é": None}, sampling_report=report,
        embedding_quality_report=vectors.agg(F.count("*").alias("vectors")))
    assert records.read_report(spark, path, "run_config") == {"seed": 42, "é": None} and records.read_report(spark, path, "sampling_report") == {"ks": 0.5,
        "chi2": 1.5}
    assert records.read_report(spark, path, "embedding_quality_report") == {"vectors": 2} and records.read_report(spark, path, "video_calibration_report") is None
    assert json.loads((tmp_path / "bundle/manifest.json").read_text())["rows"] == 2
    with pytest.raises(ValueError, match="unknown"):
        records.write_bundle(vectors, vectors.select("post_id"), vectors.limit(0), str(tmp_path / "x"), other={})
