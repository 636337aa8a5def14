"""The forest against brute force over all rows, and its cases."""

import os

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ratekit.llm import ann_forest as AF
from ratekit.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def _brute(rows, k, asked):
    """{query_id: [(score, vec_id)]} over rows (id, vector): the k best, ties to the smaller id."""
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], float)
    out = {}
    for q in np.flatnonzero([asked(i) for i in ids]):
        s = AF.cosines(np.repeat(x[q:q + 1], len(x), axis=0), x)
        order = [j for j in np.lexsort((ids, -s)) if j != q][:k]
        out[int(ids[q])] = [(float(s[j]), int(ids[j])) for j in order]
    return out


def _by_query(df):
    got = {}
    for r in df.orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return got


def _recall(got, want):
    hits = sum(len({v for _, v, _ in got.get(q, [])} & {v for _, v in best}) for q, best in want.items())
    return hits / sum(map(len, want.values()))


def _frame(spark, rows, schema="vec_id long, embedding array<float>"):
    return spark.createDataFrame(rows, schema)


def test_query_recall_and_exact_scores(spark):
    t = pq.read_table(os.path.join(SF, "embeddings.parquet"))
    rows = list(zip(t["vec_id"].to_pylist(), t["embedding"].to_pylist()))
    got = _by_query(QUERIES["op11_ann_forest"](spark, SF))
    want = _brute(rows, 5, lambda i: i % 50 == 0)
    assert got.keys() == want.keys() and _recall(got, want) >= 0.9
    x = dict(rows)
    for q, found in got.items():
        assert [r for r, _, _ in found] == [1, 2, 3, 4, 5] and q not in {v for _, v, _ in found}
        assert found == sorted(found, key=lambda f: (-f[2], f[1]))
        for _, v, s in found:
            a, b = np.array(x[q], float), np.array(x[v], float)
            assert s == pytest.approx(a @ b / np.linalg.norm(a) / np.linalg.norm(b), abs=1e-12)


def test_recall_on_vectors_with_little_structure(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(10, 32))
    x = (centres[rng.integers(0, 10, 4000)] * 0.4 + rng.normal(size=(4000, 32))).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got = _by_query(AF.nearest(_frame(spark, rows), F.col("id") % 50 == 0, 5, sample=1000))
    assert _recall(got, _brute(rows, 5, lambda i: i % 50 == 0)) >= 0.9


def test_little_work_suffices_in_tight_clusters(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(200, 16))
    x = centres[np.arange(4000) % 200] + 0.02 * rng.normal(size=(4000, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(x.astype(np.float32))]
    got = _by_query(AF.nearest(_frame(spark, rows), F.col("id") % 50 == 0, 5, share=0.1))
    assert _recall(got, _brute(rows, 5, lambda i: i % 50 == 0)) >= 0.95


def test_copies_ties_and_what_takes_no_part(spark):
    rng = np.random.default_rng(5)
    hot = [1.0, 2.0, 0.0, -1.0]
    rows = [(i, hot) for i in range(0, 300, 2)] + [(i, rng.normal(size=4).round(2).tolist()) for i in range(1, 300, 2)]
    sound = [(i, np.array(v, np.float32).tolist()) for i, v in rows]
    nothing = [(1000, None), (1050, []), (1100, [0.0, 0.0, 0.0, 0.0]), (1150, [1.0, None, 0.0, 0.0]),
               (1200, [float("nan"), 1.0, 1.0, 1.0]), (1250, [float("inf"), 1.0, 1.0, 1.0]), (1300, [1.0, 2.0]),
               (None, [1.0, 1.0, 1.0, 1.0])]
    df = _frame(spark, sound + nothing + sound[:3])  # repeated rows are one
    got = _by_query(AF.nearest(df, F.col("id") % 50 == 0, 5, share=16.0))
    want = _brute(sound, 5, lambda i: i % 50 == 0)
    assert {q: [(s, v) for _, v, s in f] for q, f in got.items()} == want
    assert got[0] == [(r, 2 * r, got[0][0][2]) for r in range(1, 6)]


def test_signed_zeros_scales_and_clashing_columns(spark):
    rows = [(0, [1e-200, 0.0, 0.0]), (1, [3e200, -0.0, 0.0]), (2, [1.0, 1.0, 0.0]), (3, [3e200, 0.0, 0.0]),
            (50, [-1e300, 1e300, 0.0])]
    df = spark.createDataFrame([(*r, "x", 1, [9.0], 0.5) for r in rows],
                               "vec_id long, embedding array<double>, id string, rank int, vector array<double>, score double")
    got = _by_query(AF.nearest(df, F.col("id") % 50 == 0, 5, share=16.0))
    assert {q: [(s, v) for _, v, s in f] for q, f in got.items()} == _brute(rows, 5, lambda i: i % 50 == 0)
    assert [v for _, v, _ in got[0]] == [1, 3, 2, 50] and got[0][0][2] == got[0][1][2] == 1.0


def test_few_and_no_rows(spark):
    assert AF.nearest(_frame(spark, []), F.col("id") % 50 == 0).count() == 0
    assert AF.nearest(_frame(spark, [(0, [1.0, 0.0])]), F.col("id") % 50 == 0).count() == 0
    assert AF.nearest(_frame(spark, [(0, None), (50, [0.0])]), F.col("id") % 50 == 0).count() == 0
    got = _by_query(AF.nearest(_frame(spark, [(0, [1.0, 0.0]), (7, [1.0, 1.0])]), F.col("id") % 50 == 0))
    assert [(r, v) for r, v, _ in got[0]] == [(1, 7)]


def test_one_id_with_two_vectors_is_the_least(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [0.0, 2.0]), (2, [3.0, 0.1])]
    got = _by_query(AF.nearest(_frame(spark, rows), F.col("id") % 50 == 0))
    assert [v for _, v, _ in got[0]] == [1, 2]


def test_queries_in_blocks_answer_alike(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(600, 8)).astype(np.float32))]
    whole = _by_query(AF.nearest(_frame(spark, rows), F.col("id") % 5 == 0))
    monkeypatch.setattr(AF, "QUERY_BYTES", 4_000)
    assert _by_query(AF.nearest(_frame(spark, rows).repartition(7), F.col("id") % 5 == 0)) == whole


def test_one_queue_opens_the_nearest_leaf_of_any_tree():
    rng = np.random.default_rng(7)
    x = AF.units(rng.normal(size=(500, 6)))
    forest = [AF.fit_tree(x, s, 16) for s in range(3)]
    sizes = [np.bincount(t.leaf_of(x), minlength=t.leaves) for t in forest]
    q = x[0]

    def cost(t, leaf):  # over the path from the root: squared distances to planes on whose wrong side the leaf lies
        def walk(node, far):
            if node < 0:
                return far if ~node == leaf else None
            s = float(t.normal[node] @ q - t.cut[node])
            a = walk(t.left[node], far + (s * s if s > 0 else 0))
            return a if a is not None else walk(t.right[node], far + (0 if s > 0 else s * s))
        return walk(0, 0.0)

    order = sorted((cost(t, n), i, n) for i, t in enumerate(forest) for n in range(t.leaves))
    taken = AF.leaves_for(q, forest, sizes, 200)
    n = sum(map(len, taken))
    assert {(i, int(leaf)) for i, leaves in enumerate(taken) for leaf in leaves} == {(i, leaf) for _, i, leaf in order[:n]}
    held = [sizes[i][leaf] for _, i, leaf in order[:n]]
    assert sum(held) >= 200 > sum(held[:-1])
