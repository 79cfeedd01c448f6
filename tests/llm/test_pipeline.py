"""The pipeline's stages against plain versions of what each must keep."""

import re

import corpus_pipeline
import pytest

from engagelake.llm import mixing, pii, quality, shared

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = shared.table(spark, sf_dir, "documents")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        docs = shared.written(stage(spark, docs, sf_dir))
        out.append(docs)
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_columns(steps):
    assert [sorted(s.columns) for s in steps[:5]] == [sorted(COLUMNS)] * 5 and len(corpus_pipeline.STAGES) == 5


def test_quality(spark, steps):
    before, after = rows(steps[0]), rows(steps[1])
    labels = {r.doc_id: r.quality for r in shared.table(spark, "/root/testdata/sf0.01", "labels").collect()}
    assert set(after) < set(before)
    good, bad = ([d for d in before if labels.get(d) == q] for q in (1, 0))
    assert sum(d in after for d in good) >= 0.98 * len(good) and sum(d in after for d in bad) <= 0.1 * len(bad)
    model = quality.train(steps[0], shared.table(spark, "/root/testdata/sf0.01", "labels"))
    assert {r.doc_id for r in quality.quality_scores(steps[0], model).where("predicted = 1").collect()} == set(after)


def test_near_duplicates(steps):
    before, after = rows(steps[1]), rows(steps[2])

    def shingles(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])

    ids = sorted(before)
    sets = {d: shingles(before[d].text) for d in ids}
    parent = {d: d for d in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, d in enumerate(ids):
        for e in ids[:i]:
            if sets[d] and sets[e] and len(sets[d] & sets[e]) >= 0.8 * len(sets[d] | sets[e]) - 1e-9:
                p, q = sorted((root(d), root(e)))
                parent[q] = p
    assert set(after) == {d for d in ids if root(d) == d} and all(after[d] == before[d] for d in after)


def test_pii(steps):
    before, after, detector = rows(steps[2]), rows(steps[3]), pii.Detector()
    assert set(before) == set(after)
    for d, r in after.items():
        assert r.text == pii.redact(before[d].text, detector.spans(before[d].text)[1]) and r.n_chars == len(r.text)


def test_mixing(steps):
    before, after = rows(steps[3]), rows(steps[4])
    want = {r.doc_id for r in mixing.mixed(steps[3], token_share=0.75).where("sampled").collect()}
    assert set(after) == want and all(after[d] == before[d] for d in after)


def test_packing(steps):
    assert {r.doc_id for r in steps[5].collect()} == set(rows(steps[4]))


def test_run_leaves_only_its_result(spark):
    sf_dir, at = "/root/testdata/sf0.001", shared.mark()
    out = corpus_pipeline.run(spark, sf_dir)
    assert shared.mark() == at + 1 and out.count() > 0
    docs = shared.table(spark, sf_dir, "documents")
    for _, stage in corpus_pipeline.STAGES:
        docs = shared.written(stage(spark, docs, sf_dir))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, out.select(*columns).collect())) == sorted(map(tuple, docs.select(*columns).collect()))
