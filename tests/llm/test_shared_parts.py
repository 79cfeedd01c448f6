"""Helpers that the corpus operators share."""

import numpy as np
import pyarrow as pa

from engagelake.llm import graph, segments, shared, suffix_dedup, textblock


def test_whole_groups_over_any_batches():
    r = np.random.default_rng(0)
    for _ in range(60):
        keys = np.sort(r.integers(0, 6, r.integers(1, 30)))
        table = pa.table({"k": keys, "v": np.arange(len(keys))})
        cuts = np.sort(r.integers(0, len(keys) + 1, 5))
        batches = [table.slice(a, b - a).combine_chunks().to_batches()[0] for a, b in zip([0, *cuts], [*cuts, len(keys)], strict=True) if b > a]
        got = []
        for whole, at in graph.whole_groups(iter(batches), ["k"]):
            assert at[0] == 0 and at[-1] == whole.num_rows
            got += [whole.column("v").slice(a, b - a).to_pylist() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        assert got == [np.flatnonzero(keys == k).tolist() for k in np.unique(keys)]


def test_components(spark):
    chain = [(i, i + 1) for i in range(100, 140)]
    star = [(1, i) for i in range(200, 400)]
    edges = spark.createDataFrame([*chain, *star, (7, 7), (9, 8), (8, 9), (-5, 50)], "a long, b long")
    got = {r.id: r.component for r in graph.components(edges).collect()}
    want = dict.fromkeys(range(100, 141), 100) | dict.fromkeys([1, *range(200, 400)], 1) | {8: 8, 9: 8, -5: -5, 50: -5}
    assert got == want
    assert graph.components(edges.limit(0)).count() == 0


def test_forest_spans():
    r = np.random.default_rng(5)
    for _ in range(100):
        n = int(r.integers(1, 40))
        forest, kept = graph.Forest(n), []
        parent = list(range(n))

        def root(x, parent=parent):
            while parent[x] != x:
                x = parent[x]
            return x

        for _ in range(3):
            a, b = r.integers(0, n, 25), r.integers(0, n, 25)
            k = forest.links(a, b)
            kept += [(a[i], b[i]) for i in k]
            for x, y in zip(a.tolist(), b.tolist(), strict=True):
                p, q = sorted((root(x), root(y)))
                parent[q] = p
        assert forest.label.tolist() == [root(x) for x in range(n)] and len(kept) == n - len(set(forest.label.tolist()))
        again = graph.Forest(n)
        again.links(np.array([x for x, _ in kept], int), np.array([y for _, y in kept], int))
        assert again.label.tolist() == forest.label.tolist()


def test_block_pairs_cover_and_grow_slowly(spark):
    def placed(m):
        members = spark.range(m).selectExpr("id % 2 as g", "id as rid").where("g = 0 or rid < 100")
        return graph.block_pairs(members, ["g"], "rid").select("g", "i_", "j_", "own_", "rid").toPandas()

    small = placed(1200)
    for _, own in small.groupby("g"):
        blocks = own.groupby(["i_", "j_"])["rid"].apply(set)
        n = own["i_"].max() + 1
        assert len(blocks) == n * (n + 1) // 2
        of = own.drop_duplicates("rid").set_index("rid")["own_"]
        assert all(s == {r for r, b in of.items() if b in key} for key, s in blocks.items())
    # a pair of blocks of one group: payload rows grow as m ** 1.5
    assert len(placed(40_000)) <= 2 * 20_000**1.5


def test_words_and_hashes():
    texts = ["", " a\tbb \n", "x", "é y\x0bz", " "]
    column = pa.array([*texts, None])
    data, offsets = shared.utf8(column.slice(0))
    start, end, bounds = textblock.words(data, offsets)
    raw = data.tobytes()
    got = [[raw[a:b] for a, b in zip(start[lo:hi], end[lo:hi], strict=True)] for lo, hi in zip(bounds[:-1], bounds[1:], strict=True)]
    assert got == [t.encode().split() for t in texts] + [[]]
    h = textblock.word_hashes(*(np.frombuffer(b"ab ab ba", np.uint8), np.array([0, 3, 6]), np.array([2, 5, 8])))
    assert h[0] == h[1] != h[2]


def test_sliding_min():
    x = np.random.default_rng(1).integers(0, 99, 50)
    for w in (1, 2, 3, 7, 31, 50):
        assert textblock.sliding_min(x, w).tolist() == [x[i : i + w].min() for i in range(51 - w)]


def test_segments_cover_all_windows_once():
    r = np.random.default_rng(2)
    w = segments.Windows(10, 4, segments.byte_symbols)
    raw = [r.integers(97, 100, n).astype(np.uint8).tobytes() for n in (0, 9, 10, 80, 3, 200)]
    data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in raw])])
    values, bounds, _, _ = w.symbols(data, offsets)
    row, place, n, anchor = segments.segments_of(textblock.prefix(values), bounds, w)
    covered = shared.ragged(place, n)
    assert covered.tolist() == shared.ragged(offsets[:-1], np.maximum(np.diff(offsets) - 9, 0)).tolist()
    by_window = {}  # equal windows have equal anchors
    for p, k, a in zip(place.tolist(), n.tolist(), anchor.tolist(), strict=True):
        for i in range(p, p + k):
            assert by_window.setdefault(data[i : i + 10].tobytes(), a) == a


def test_tables_are_swept(spark):
    one = shared.written(spark.range(3).toDF("x"))
    at = shared.mark()
    two, three = shared.written(one), shared.written(one)
    shared.sweep(spark, at, three)
    assert three.count() == 3 and one.count() == 3 and shared.mark() == at + 1
    try:
        assert spark.read.schema("x long").parquet(two.written_to).count() == 0
    except Exception as gone:
        assert "PATH_NOT_FOUND" in str(gone)
    shared.dropped(spark, one, three)


def test_a_scope_leaves_no_tables(spark, sf_dir, tmp_path):
    import os

    from engagelake.llm import registry, shared

    folder = shared.shared_dir(spark).removeprefix("file:")
    before = {n for n in os.listdir(folder) if n.startswith("engagelake-")}
    for name in ("op3_substring_dedup", "op4_ngram_jaccard_join", "op12_nearest_neighbours", "op13_prefix_trie"):
        with shared.scope(spark):
            registry.queries()[name](spark, sf_dir).write.parquet(str(tmp_path / name))
        assert {n for n in os.listdir(folder) if n.startswith("engagelake-")} == before, name
        assert spark.read.parquet(str(tmp_path / name)).count() > 0


def test_spread_anti(spark, monkeypatch):
    from pyspark.sql import functions as F

    from engagelake.llm import graph

    monkeypatch.setattr(graph, "HEAVY", 5)
    rows = spark.range(200).select(F.when(F.col("id") < 90, 0).otherwise(F.col("id") % 20).alias("k"), "id")
    sums = rows.groupBy("k").agg(F.count("*").alias("n")).where("k in (0, 3, 7)")
    got = sorted(r.id for r in graph.spread_anti(rows, sums, ["k"], "n", 200).collect())
    assert got == sorted(r.id for r in rows.where("k not in (0, 3, 7)").collect())


def test_words_of_long_texts_hash_alike(monkeypatch):
    from engagelake.llm import textblock

    r = np.random.default_rng(3)
    text = b" ".join(bytes(r.integers(97, 123, int(n), np.uint8)) for n in r.integers(1, 12, 3000)) + b"  " + b"z" * 900 + b"\n x"
    data = np.frombuffer(text, np.uint8)
    start, end, _ = textblock.words(data, np.array([0, 700, len(data)]))
    want = textblock.word_hashes(data, start, end)
    for long in (64, 1000, 8000):
        monkeypatch.setattr(textblock, "LONG", long)
        assert (textblock.word_hashes(data, start, end) == want).all()
        some = end - start > 3
        assert (textblock.word_hashes(data, start[some], end[some]) == want[some]).all()


def test_long_texts_in_bounded_memory():
    """The shingles and topics of one text of 50 MB: under 1 GB beside the text."""
    import tracemalloc

    from engagelake.llm import mixing, ngram_join, segments

    text = np.tile(np.frombuffer(b"".join(b"word%d and " % i for i in range(5000)), np.uint8), 850)[:50_000_000]
    at = np.array([0, len(text)])
    for step in (lambda: ngram_join.shingle_sets(text, at), lambda: mixing.word_classes(text, at), lambda: segments.word_symbols(text, at)):
        tracemalloc.start()
        step()
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 1e9, peak


def test_garbage_goes_when_a_table_is_written(spark):
    jvm = spark.sparkContext._jvm
    ref = jvm.java.lang.ref.WeakReference(jvm.java.util.ArrayList())
    with shared.scope(spark):
        shared.written(spark.range(3))
        assert ref.get() is None


def test_spans_of_masks_without_a_loop_over_rows():
    """Runs of the masks of all rows at once, against a row at a time; masks that touch stay apart."""
    r = np.random.default_rng(11)
    masks = [r.random(r.integers(1, 7)) < 0.6 for _ in range(120)]
    number, later = np.sort(r.integers(0, 120, 300)), r.random(300) < 0.3
    want = []
    for i, (k, whole) in enumerate(zip(number.tolist(), later.tolist(), strict=True)):
        a, z = suffix_dedup.runs_of(np.ones(len(masks[k]), bool) if whole else masks[k])
        want += [(i, int(x), int(y - x)) for x, y in zip(a, z, strict=True)]
    assert sorted(zip(*(x.tolist() for x in suffix_dedup.mask_spans(masks, number, later)), strict=True)) == sorted(want)


def test_segments_by_their_windows():
    """Each segment's windows share the leftmost least run, rows apart, against a window at a time; short rows have none."""
    r, w = np.random.default_rng(12), suffix_dedup.BYTES
    for _ in range(20):
        bounds = np.concatenate([[0], np.cumsum(r.choice([0, 10, 49, 50, 51, 200], 6))])
        sums = textblock.prefix(r.integers(1, 3, bounds[-1]).astype(np.uint64))
        at = np.arange(max(0, bounds[-1] - w.gram + 1))
        h = textblock.run_hashes(sums, at, at + w.gram)
        assert not len(at) or np.array_equal(h, textblock.all_run_hashes(sums, w.gram))
        low = np.uint64((1 << max(1, int(bounds[-1] - 1).bit_length())) - 1)
        want = []
        for row, (a, z) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
            for p in range(a, z - w.width + 1):
                own = p + int(np.argmin(h[p : p + w.width - w.gram + 1] & ~low))
                if want and want[-1][0] == row and want[-1][3] == own:
                    want[-1][2] += 1
                else:
                    want.append([row, p, 1, own])
        got = segments.segments_of(sums, bounds, w)
        assert [x[:3] for x in want] == [list(x) for x in zip(*(x.tolist() for x in got[:3]), strict=True)]
        assert np.array_equal(got[3], textblock.mix(h[[x[3] for x in want]]))
