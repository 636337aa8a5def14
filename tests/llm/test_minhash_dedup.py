import random
from itertools import combinations

import numpy as np
import pytest
from llm_helpers import compare
from ratekit.llm import minhash_dedup as MD
from ratekit.llm.common import WordHashes, shingles
from ratekit.llm.components import connected_components
from ratekit.llm.queries import ORACLE_SQL, QUERIES


def shingle_set(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def brute(rows):
    """doc_id -> (size, component) by comparing all pairs."""
    sets = {i: shingle_set(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in combinations(sorted(sets), 2):
        inter, union = len(sets[a] & sets[b]), len(sets[a] | sets[b])
        if union and 100 * inter >= 85 * union:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {i: (len(s), root(i)) for i, s in sets.items()}


def planted(seed=1):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(900)]
    rows, i = [], 0
    passage = " ".join(rng.choice(vocab) for _ in range(60))
    for size in (1, 2, 5, 40):
        for _ in range(5):
            base = [rng.choice(vocab) for _ in range(rng.choice([7, 30, 120, 300]))]
            for k in range(size):
                w = list(base)
                for _ in range(rng.randrange(0, 4)):
                    w[rng.randrange(len(w))] = rng.choice(vocab)
                text = " ".join(w) + (" " + passage if k % 3 == 0 else "")
                rows.append((i, text if k % 5 else text.upper()))
                i += 1
    rows += [(i, None), (i + 1, ""), (i + 2, " \n"), (i + 3, "two words"), (i + 4, "Two\tWORDS"), (i + 5, "É é é é"),
             (i + 6, "é é é é")]
    rng.shuffle(rows)
    return rows


def test_every_place_fills_and_estimates_similarity():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 20, 1000):
        assert (MD.sketch(rng.integers(0, 2**63, n).astype(np.uint64)) != np.uint64(2**64 - 1)).all()
    both, own = rng.integers(0, 2**63, 600).astype(np.uint64), rng.integers(0, 2**63, 150).astype(np.uint64)
    a, b = np.concatenate([both, own[:75]]), np.concatenate([both, own[75:]])
    assert abs((MD.sketch(a, 512) == MD.sketch(b, 512)).mean() - 0.8) < 0.08


def test_short_text_never_equals_a_shingle():
    h = WordHashes()
    assert len(shingles(h.of([b"a"] * 4))) == 1 and len(shingles(h.of([b"a"] * 5))) == 1
    assert shingles(h.of([b"a"] * 4))[0] != shingles(h.of([b"a"] * 5))[0]


def test_components_match_brute_force(spark, docs_of):
    rows = planted()
    got = {r.doc_id: r for r in MD.near_duplicates(docs_of(rows)).collect()}
    want = brute(rows)
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())


def test_query_matches_sql(spark, duck):
    compare(spark, duck, "op4_minhash_dedup", QUERIES, ORACLE_SQL)


def test_components_of_paths_loops_and_nothing(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 100), (200, 201), (201, 200), (300, 290), (290, 310)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(51)} | {200: 200, 201: 200, 290: 290, 300: 290, 310: 290}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_keep_first_nulls_repeats_and_empty(spark, docs_of):
    text = " ".join(f"x{i}" for i in range(40))
    docs = docs_of([(5, text), (3, text), (3, text), (None, text), (None, None), (9, None), (10, ""), (11, "other text")])
    kept = MD.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [
        (False, 3), (False, 9), (False, 10), (False, 11), (True, 0), (True, 0)]
    assert MD.near_duplicates(docs.limit(0)).count() == 0


def test_lower_threshold_than_the_bands_allow_is_refused(spark, docs_of):
    with pytest.raises(ValueError):
        MD.near_duplicates(docs_of([(1, "x")]), threshold_pct=50)
