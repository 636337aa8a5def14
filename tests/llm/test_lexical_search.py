"""Lexical search against a ranking made term by term in plain Python."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from llm_helpers import compare

from ratekit.llm import lexical_search as LS
from ratekit.llm.oracle import ORACLE_SQL
from ratekit.llm.queries import QUERIES

_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def _terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in _TERM.findall(text or "")]


def _brute(items, docs, k):
    cut = [(i, Counter(_terms(t)), len(_terms(t))) for i, t in docs]
    cut = [d for d in cut if d[2]]
    N, L = len(cut), sum(d[2] for d in cut)
    df = Counter(t for _, c, _ in cut for t in c)
    out = []
    for item_id, words in {(i, tuple(sorted(set(_terms(t))))) for i, t in items}:
        scored = []
        for doc_id, c, n in cut:
            m = 100 - 90 + (90 * n * N) // L
            s = sum(math.floor(1000 * math.log((2 * N + 2) / (2 * df[w] + 1))) * ((10**9 * c[w]) // (1000 * c[w] + 8 * m))
                    for w in words if w in c)
            if s > 0:
                scored.append((-s, doc_id is not None, doc_id or 0))
        out += [(item_id, r + 1, d if there else None, -s) for r, (s, there, d) in enumerate(sorted(scored)[:k])]
    return sorted(map(repr, out))


def _run(spark, items, docs, k=10, schema="doc_id long, text string", extra=()):
    i = spark.createDataFrame(items, "item_id long, text string")
    d = spark.createDataFrame([(*x, *extra) for x in docs], schema)
    return sorted(repr(tuple(r)) for r in LS.search(i, d, k).collect())


def test_query_matches_sql(spark, duck):
    compare(spark, duck, "op13_lexical_search", QUERIES, ORACLE_SQL)


_DOCS = [(i, " ".join(f"w{(i * j) % 23}" for j in range(1, 3 + i % 17))) for i in range(300)]
_ITEMS = [(0, "w1 w2 W3"), (1, "w5"), (1, "w5"), (1, "w6 w7"), (2, "nowhere"), (3, "..."), (None, "w2"), (4, None),
          (5, " ".join(f"w{j}" for j in range(23)))]


def test_ties_repeats_nulls_and_clashing_columns(spark):
    docs = _DOCS + _DOCS[:40] + [(None, "w1 w2"), (None, "w1 w2"), (-7, "w1 w2"), (9999, None), (9998, ""), (9997, "-- !"),
                                 (8888, "Ünï w1ö w1—w2 ꙮ"), (7777, "w3 " * 300_000)]
    items = _ITEMS + [(6, "ünï Ünï"), (7, "W1Ö w2")]
    assert _run(spark, items, docs) == _brute(items, docs, 10)
    wide = "doc_id long, text string, item_id int, n string, term int, tf string, score int, rank int"
    assert _run(spark, items, docs, 3, wide, (1, "n", 2, "t", 3, 4)) == _brute(items, docs, 3)


def test_empty_tables(spark):
    assert _run(spark, [], _DOCS) == [] and _run(spark, _ITEMS, []) == []
    assert _run(spark, _ITEMS, [(1, None), (2, "")]) == []


def test_items_in_blocks_and_vocabulary_in_tiles_rank_alike(spark, monkeypatch):
    monkeypatch.setattr(LS, "BLOCK_BYTES", 300)
    assert _run(spark, _ITEMS, _DOCS) == _brute(_ITEMS, _DOCS, 10)


def test_partial_sums_stay_exact():
    rng = np.random.default_rng(0)
    words, n = 700, 40
    weights = rng.integers(1, 27_000, words)
    block = LS.Block(list(range(5)), [], [np.sort(rng.choice(words, 600, replace=False)) for _ in range(5)])
    lengths = np.full(n, words)
    term, tf, m = np.tile(np.arange(words), n), rng.integers(1, 50, n * words), rng.integers(10, 10_000, n)
    value = LS.impacts(tf, np.repeat(m, words)).reshape(n, words)
    want = np.array([[int(sum(int(weights[p]) * int(row[p]) for p in b)) for b in block.places] for row in value])
    for width in (700, 64, 1):
        tiles = [(lo, min(lo + width, words), LS._dense(
            np.repeat(np.arange(5), 600), np.concatenate(block.places), weights[np.concatenate(block.places)], lo,
            min(lo + width, words), 5).T) for lo in range(0, words, width)]
        assert (LS.score_tile(lengths, term, tf, m, tiles) == want).all()
    for heavy in (1, 27_000, 10**9, 10**12):
        assert heavy * 10**6 * LS.tile_width(np.array([heavy])) < 2**53 or LS.tile_width(np.array([heavy])) == 1


def test_long_documents_do_not_overflow():
    n = np.array([10**12, 5])
    assert LS.norms(n, 10**9, 10**13).tolist() == [10 + 90 * 10**12 * 10**9 // 10**13, 10]


@pytest.mark.parametrize("k", [1, 10])
def test_best_keeps_ties_by_id_over_tiles(k):
    best = LS._Best(1, k)
    for at in (30, 10, 20, 0):
        best.offer(np.full((10, 1), 7), np.arange(at, at + 10), np.zeros(10, bool))
    assert best.id[0].tolist() == list(range(k))
