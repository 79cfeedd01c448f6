import hashlib
import json

import pytest

from engagelake.sources import records


def test_jsonl_round_trip(spark, tmp_path):
    (tmp_path / "in.jsonl").write_text('{"post_id": 1, "text": "a", "unknown": 3, "attachments": [{"position": 0, "attachment_type": "photo"}]}\n\n{"post_id": 2}\n')
    df = records.read_jsonl(spark, str(tmp_path / "in.jsonl"), records.POST)
    assert [(r.post_id, r.text) for r in df.orderBy("post_id").collect()] == [(1, "a"), (2, None)] and "unknown" not in df.columns
    records.write_jsonl(df, str(tmp_path / "out"))
    assert sorted(map(str, records.read_jsonl(spark, str(tmp_path / "out"), records.POST).collect())) == sorted(map(str, df.collect()))
    (tmp_path / "bad.jsonl").write_text("{no\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        records.read_jsonl(spark, str(tmp_path / "bad.jsonl"), records.POST).collect()


def test_batches_and_decisions(spark):
    items = spark.createDataFrame([(1, 11, "b", ["y", "x"]), (0, 10, "a", [])], "position int, group_id long, name string, keywords array<string>")
    doc = json.loads(records.batch_document(items, "B1").first()[0])
    assert [g["group_id"] for g in doc["groups"]] == [10, 11] and doc["groups"][1]["keywords"] == ["x", "y"]
    docs = spark.createDataFrame([('{"batch_id":"a","approved_group_ids":[1,2]}',),
        ('{"batch_id":"b","results":[{"group_id":3,"status":"rejected","labels":[],"confidence":0.5}]}',), ('{"batch_id":"c"}',)], "document string")
    got = {(r.batch_id, r.group_id, r.status, r.valid) for r in records.decisions(docs).collect()}
    assert got == {("a", 1, "approved", True), ("a", 2, "approved", True), ("b", 3, "rejected", True), ("c", None, None, False)}


def test_attachments_and_pages(spark):
    raw = spark.createDataFrame([(1, '{"type":"photo","photo":{"sizes":[{"width":1,"height":9},{"width":5,"height":2}]}}'),
        (2, '{"type":"link","link":{"url":"u","caption":"c"}}'), (3, '{"type":"doc","doc":{"url":"d"}}')], "id int, raw string")
    got = {r.id: (r.type, r.width, r.height, r.url, r.caption) for r in records.normalised_attachments(raw).collect()}
    assert got == {1: ("photo", 5, 2, None, None), 2: ("link", None, None, "u", "c"), 3: ("doc", None, None, "d", None)}
    page = spark.createDataFrame([(True, None), (False, None), (None, None), (True, "deleted")], "is_closed boolean, deactivated string")
    assert tuple(records.search_page(page).first()) == (4, 1, 1, 2)


def test_files_and_bundles(spark, tmp_path):
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "a.jpg").write_bytes(b"x")
    (tmp_path / "m" / "b.jpg").write_bytes(b"")
    assert [(r.path[-5:], r.sha256) for r in records.file_digests(spark, str(tmp_path / "m")).collect()] == [("a.jpg",
        hashlib.sha256(b"x").hexdigest())]
    v = spark.createDataFrame([(2, [1.0]), (1, [0.0])], "post_id long, embedding array<double>")
    m = spark.createDataFrame([(1, "a"), (2, "b")], "post_id long, subject string")
    records.write_bundle(v, m, spark.createDataFrame([(3, "text", "empty")], "post_id long, stage string, message string"), str(tmp_path / "bundle"))
    assert {(r.post_id, r.subject, r.embedding[0]) for r in records.read_bundle(spark, str(tmp_path / "bundle")).collect()} == {(1, "a", 0.0),
        (2, "b", 1.0)}


def test_sizes_of_tables_are_those_of_their_files(spark, sf_dir):
    import os

    from engagelake.plans import canonical

    want = {f[:-8]: os.path.getsize(f"{sf_dir}/{f}") for f in os.listdir(sf_dir) if f.endswith(".parquet") and os.path.isfile(f"{sf_dir}/{f}")}
    got = {r.relation: (r.bytes, r.rows, r.size) for r in canonical.table_sizes(spark, sf_dir).collect()}
    if want:
        assert {k: v[0] for k, v in got.items()} == want
        assert canonical.report_database_size(spark, sf_dir).first().bytes == sum(want.values())
    assert got["nation"][1] == 25 and got["orders"][1] == 1500 and all(v[2] for v in got.values())


def test_the_chosen_run(spark):
    from engagelake.plans import canonical

    runs = spark.createDataFrame([(1, "completed", 9), (2, "running", 1), (3, "paused", 5), (4, "running", 3)], "run_id long, status string, created_day long")
    queue = spark.createDataFrame([(3, "pending"), (1, "completed")], "run_id long, status string")
    pick = lambda r, **k: canonical.chosen_run(r, queue, **k).first().run_id
    assert pick(runs) == 4 and pick(runs, explicit=1) == 1 and pick(runs, explicit=77) == 4
    assert pick(runs.where("status <> 'running'")) == 3 and pick(runs.where("status = 'completed'")) == 1
