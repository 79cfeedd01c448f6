"""Operators 11 to 13 against brute force, on whole small tables and on awkward rows."""

import hashlib
import re
import zlib
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from engagelake.llm import periodic, pruned_graph, shared, trie

EMPTY = hashlib.sha256().hexdigest()


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# --- 11 ---


def brute_runs(w):
    n, out = len(w), []
    for p in range(1, n // 3 + 1):
        i = 0
        while i + p < n:
            if w[i] != w[i + p]:
                i += 1
                continue
            s = i
            while i + p < n and w[i] == w[i + p]:
                i += 1
            e = i + p
            if e - s >= max(24, 3 * p) and all(any(w[k] != w[k + q] for k in range(s, e - q)) for q in range(1, p)):
                out.append((s, e - s, p))
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text, repeat):
    w = words(text)
    n = len(w)
    if repeat and doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        if h % 10 == 0:
            w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    runs = brute_runs(w)
    best = (None,) * 4
    if runs:
        s, length, p = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))
        best = (s, length, p, 1000 * length // p)
    gone = {i for s, length, p in runs for i in range(s + p, s + length)}
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    listed = "".join(f"{s},{length},{p}\n" for s, length, p in runs)
    return (doc_id, len(runs), *best, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


CONTRACT_11 = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def rows(df, columns=None):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)


def test_runs_on_the_table(spark, sf_dir):
    docs = shared.table(spark, sf_dir, "documents")
    want = sorted((brute_row(r.doc_id, r.text, True) for r in docs.collect()), key=repr)
    assert rows(periodic.op11_periodic_runs(spark, sf_dir), CONTRACT_11) == want
    assert sum(r[1] > 0 for r in want) > 5


def test_runs_awkward(spark):
    line = "one two three "
    long = " ".join(f"w{i}" for i in range(40_000)) + " " + line * 30 + " ".join(f"v{i}" for i in range(9)) + " x" * 40
    data = [(0, line * 8), (0, line * 8), (None, "a " * 30), (4, None), (5, ""), (6, " \t\n"), (7, "a " * 23), (8, "a b " * 24), (9, long),
        (10, "é漢 😀 " * 40), (11, ("a b " * 12 + "c ") * 5), (12, "a b " * 13 + "x y z " * 9), (30, "a a b " * 50)]
    docs = spark.createDataFrame([(*r, 1, 2, 3) for r in data], "doc_id long, text string, h long, start long, period long")
    for repeat in (False, True):
        got = periodic.periodic_runs(docs, repeat)
        by_id = defaultdict(list)
        for r in rows(got, CONTRACT_11):
            by_id[r[0]].append(r)
        for i, text in data:
            if i != 9:
                assert brute_row(i, text, repeat) in by_id[i]
        assert sum(map(len, by_id.values())) == len(data)
        if not repeat:
            assert by_id[9][0][1:6] == (2, 40_099, 40, 1, 40_000)  # the greatest exponent, after the longer run
        assert {r.n_words for r in got.where("doc_id = 9").collect()} == {len(words(long))}
    assert periodic.periodic_runs(docs.limit(0)).count() == 0


unit = st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=12), st.integers(1, 70))


@settings(max_examples=150, deadline=None, suppress_health_check=[HealthCheck.too_slow])
@given(st.lists(st.lists(unit, max_size=5), min_size=1, max_size=4), st.sampled_from([1 << 19, 50]))
def test_runs_of_any_words(texts, probes):
    texts = [[x for u, n in t for x in (u * n)[:n]] for t in texts]
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    before, periodic.PROBES = periodic.PROBES, probes
    try:
        got = list(zip(*(x.tolist() for x in periodic.runs_of(np.array([x for t in texts for x in t], np.int32), bounds)), strict=True))
    finally:
        periodic.PROBES = before
    assert got == [(s + int(b), s + int(b) + n, p) for b, t in zip(bounds, texts, strict=False) for s, n, p in brute_runs(t)]


def test_probes_are_not_wasted_on_repeats():
    """One word throughout, or every other word: as many comparisons as the grid has points, give or take."""
    for ids in (np.zeros(100_000, np.int32), np.where(np.arange(100_000) % 2, np.arange(100_000), 0).astype(np.int32)):
        done, before = [], periodic.reach
        periodic.reach = lambda *a: (lambda out: (done.append(int(out.sum())), out)[1])(before(*a))
        try:
            periodic.runs_of(ids, np.array([0, len(ids)]))
        finally:
            periodic.reach = before
        assert sum(done) < 10 * len(ids)


# --- 12 ---


def brute_nearest(vectors, every, k):
    """query -> its k nearest (vec_id, score), of sound vectors (vec_id, vector) with distinct ids."""
    x = np.array([v for _, v in vectors], float)
    x = x / np.sqrt((x * x).sum(1, keepdims=True))
    ids = np.array([i for i, _ in vectors])
    out = {}
    for i, q in zip(ids.tolist(), x, strict=True):
        if i % every == 0:
            score = x @ q
            order = [j for j in np.lexsort((ids, -np.round(score, 12))).tolist() if ids[j] != i][:k]
            out[i] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def answered(df):
    out = defaultdict(dict)
    for r in df.collect():
        assert r["rank"] not in out[r.query_id]
        out[r.query_id][r["rank"]] = (r.vec_id, r.score)
    for q, found in out.items():
        assert sorted(found) == list(range(1, len(found) + 1))
        assert [found[k] for k in sorted(found)] == sorted(found.values(), key=lambda x: (-x[1], x[0])) and q not in {v for v, _ in found.values()}
    return {q: [found[k] for k in sorted(found)] for q, found in out.items()}


def recall(got, want):
    assert got.keys() == want.keys()
    return np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / max(1, len(want[q])) for q in want])


@pytest.mark.parametrize("folder", ["sf0.01", "sf0.1"])
def test_nearest_on_the_table(spark, folder):
    path = f"/root/testdata/{folder}"
    vectors = [(r.vec_id, r.embedding) for r in shared.table(spark, path, "embeddings").collect()]
    want, got = brute_nearest(vectors, 50, 5), answered(pruned_graph.op12_nearest_neighbours(spark, path))
    assert recall(got, want) >= 0.97
    scores = {i: np.array(v, float) / np.linalg.norm(np.array(v, float)) for i, v in vectors}
    assert all(abs(s - scores[q] @ scores[i]) < 1e-12 for q, found in got.items() for i, s in found)


def test_nearest_copies_and_awkward_rows(spark):
    r = np.random.default_rng(3)
    hot, others = r.normal(size=8).tolist(), r.normal(size=(100, 8)).tolist()
    data = [(i, hot) for i in range(300)] + [(300 + i, v) for i, v in enumerate(others)] + [(5, hot), (None, hot)]
    data += [(1000, None), (1050, []), (1100, [0.0] * 8), (1150, [1.0, None] * 4), (1200, [float("nan")] * 8), (1250, [float("inf")] + [1.0] * 7),
        (1300, [1.0, 2.0]), (1301, [2.0, 4.1]), (-50, others[0])]
    df = spark.createDataFrame([(*x, 1, 2, "x") for x in data], "vec_id long, embedding array<double>, rid long, shard long, place string")
    got = answered(pruned_graph.nearest(df))
    sound = [(i, v) for i, v in data[:401] if i is not None] + [(-50, others[0])]
    want = brute_nearest(list(dict(sound).items()), 50, 5)
    assert got.pop(1300) == [(1301, pytest.approx(1.0, abs=1e-3))]
    assert recall(got, want) == 1.0
    assert [i for i, _ in got[0]] == [1, 2, 3, 4, 5] and [i for i, _ in got[50]] == [0, 1, 2, 3, 4]
    assert [i for i, _ in got[-50]][0] == 300 and got[-50][0][1] == pytest.approx(1.0)
    assert pruned_graph.nearest(df.limit(0)).count() == 0
    assert pruned_graph.nearest(df.where("vec_id = 1000")).count() == 0 and pruned_graph.nearest(df.where("vec_id = 50")).count() == 0


def test_nearest_over_many_shards(spark, monkeypatch):
    monkeypatch.setattr(pruned_graph, "SHARD_ROWS", 300)
    r = np.random.default_rng(4)
    vectors = [(i, v.tolist()) for i, v in enumerate(r.normal(size=(2000, 16)))]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    assert recall(answered(pruned_graph.nearest(df, every=20)), brute_nearest(vectors, 20, 5)) >= 0.97


def crowds(seed):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(3, 32))
    yield centres[r.integers(0, 3, 3000)] + 0.02 * r.normal(size=(3000, 32))  # nothing but tight crowds
    yield np.concatenate([centres[0] + 1e-3 * r.normal(size=(1500, 32)), r.normal(size=(1500, 32))])
    yield r.normal(size=(3000, 32))
    yield r.normal(size=(300, 32))[r.integers(0, 300, 3000)] + 0.1 * r.normal(size=(3000, 32))


def test_graph_recall():
    for x in crowds(5):
        x = x / np.sqrt((x * x).sum(1, keepdims=True))
        single = x.astype(np.float32)
        made = pruned_graph.Graph(single, 6, 1)
        degree = (made.links >= 0).sum(1)
        assert degree.max() <= made.room and degree.min() > 0
        assert all(len(set(row)) == len(row) and i not in row for i, row in enumerate(r[r >= 0].tolist() for r in made.links[:200]))
        q = np.arange(0, len(x), 20)
        want = np.argsort(-(x[q] @ x.T), axis=1, kind="stable")[:, :6]
        at, away = pruned_graph.beam_search(single, made.links, made.entries, single[q], made.beam)
        assert (np.diff(away[:, :6], axis=1) >= 0).all()
        assert np.mean([len(set(a) & set(b)) / 6 for a, b in zip(at[:, :6].tolist(), want.tolist(), strict=True)]) >= 0.95


def test_robust_prune_keeps_diverse_edges():
    angle = np.array([0, 0.1, 0.11, 0.12, -0.3, 0.5])
    x = np.stack([np.cos(angle), np.sin(angle)], 1).astype(np.float32)
    got = pruned_graph.robust_prune(x, np.array([0]), np.array([[5, 3, 0, 4, 2, 1, -1]]), 4, 1.2)[0].tolist()
    assert got == [1, 4, -1, -1]  # 2, 3 and 5 are closer to 1 than to 0


# --- 13 ---


def brute_trie(data, rebuild):
    """Rows (conv_id, turn, role, text) of distinct turns to the rows of the result."""
    own = defaultdict(list)
    for c, turn, role, text in data:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    paths = {}
    for c, turns in own.items():
        if rebuild:
            h = zlib.crc32(str(c).encode()) % 9
            paths[c] = own.get(c - c % 5, [])[:h] + turns[h:]
        else:
            paths[c] = turns
    members = defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    saved, leaves = {}, {}
    for node in sorted(members, key=len, reverse=True):
        size = len(node[-1][1].encode()) if node else 0
        saved[node] = (len(members[node]) - 1) * size + sum(saved[c] for c in children[node])
        leaves[node] = sum(leaves[c] for c in children[node]) or 1
    out = []
    for node, ms in members.items():
        ends = ",".join(map(str, sorted(c for c in ms if len(paths[c]) == len(node))))
        out.append((min(ms), len(node), min(members[node[:-1]]) if node else None, len(ms), len(children[node]), leaves[node], saved[node],
            hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


CONTRACT_13 = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
TURNS = "conv_id long, turn long, role string, text string"


def test_trie_on_the_table(spark, sf_dir):
    turns = [tuple(r) for r in shared.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert rows(trie.op13_prefix_trie(spark, sf_dir), CONTRACT_13) == brute_trie(turns, True)
    assert rows(trie.prefix_trie(shared.table(spark, sf_dir, "conversations")), CONTRACT_13) == brute_trie(turns, False)


@pytest.mark.parametrize("rebuild", [False, True])
@pytest.mark.parametrize("chunk", [1024, 2])
def test_trie_of_many_shapes(spark, monkeypatch, rebuild, chunk):
    """Deep shared prefixes, copies, prefixes of one another, hot first turns, a long conversation, small chunks and packets."""
    monkeypatch.setattr(trie, "CHUNK", chunk)
    monkeypatch.setattr(trie, "PACKET", 3)
    monkeypatch.setattr("engagelake.llm.graph.HEAVY", 5)
    r = np.random.default_rng(6)
    data = []
    for c in r.permutation(120).tolist():
        kind = c % 4
        path = [0] * int(r.integers(0, 12)) if kind == 0 else r.integers(0, 2, int(r.integers(1, 6))).tolist() if kind == 1 else [0, 1, 1, 0]
        if c == 51:
            path = r.integers(0, 3, 300).tolist()
        data += [(c, None if k == 0 and c % 3 else k, "user" if k % 2 else None, ["", "é漢", "long text"][w] or None) for k, w in enumerate(path)]
    data += [(-7, 1, "user", "x"), (-7, 5, "user", "x"), (7_000_000_000, 3, None, None)]
    df = spark.createDataFrame([(*x, 1, "y", 0) for x in data], TURNS + ", depth long, x1 string, chunk int")
    assert rows(trie.prefix_trie(df, rebuild), CONTRACT_13) == brute_trie(data, rebuild)


def test_trie_awkward(spark):
    empty = spark.createDataFrame([], TURNS)
    assert trie.prefix_trie(empty).count() == 0 and trie.prefix_trie(empty, True).count() == 0
    # no base, and fewer turns than it would take over: a member of the root alone
    lone = next(c for c in range(1, 100) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1)
    got = rows(trie.prefix_trie(spark.createDataFrame([(lone, 0, "user", "hi")], TURNS), True), CONTRACT_13)
    assert got == [(lone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(lone).encode()).hexdigest())]
    # repeated rows are further turns; rows of no conversation are left out
    turns = [(1, 0, "user", "a"), (1, 0, "user", "a"), (2, 0, "user", "a"), (None, 0, "user", "a")]
    got = rows(trie.prefix_trie(spark.createDataFrame(turns, TURNS)), CONTRACT_13)
    sha = {k: hashlib.sha256(k.encode()).hexdigest() for k in ("1", "2")}
    assert got == sorted([(1, 0, None, 2, 1, 1, 1, EMPTY), (1, 1, 1, 2, 1, 1, 1, sha["2"]), (1, 2, 1, 1, 0, 1, 0, sha["1"])], key=repr)


def test_no_machine_local_paths_are_left(spark, sf_dir):
    for name in ("op11_periodic_runs", "op12_nearest_neighbours", "op13_prefix_trie"):
        from engagelake.llm import registry

        assert registry.queries()[name](spark, sf_dir).columns
