"""Merkle manifest against trees built level by level in plain Python."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
from llm_helpers import compare
from pyspark.sql import functions as F

from ratekit.llm import merkle_manifest as MM
from ratekit.llm.oracle import ORACLE_SQL
from ratekit.llm.queries import QUERIES


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(*values):
    return _h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def _tree(leaves):
    levels = [list(leaves)]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([_h(*below[i:i + 2]) for i in range(0, len(below), 2)])
    return levels


def _climb(levels, i, node):
    siblings = []
    for level in levels[:-1]:
        run = level[i // 2 * 2:i // 2 * 2 + 2]
        siblings += [x for j, x in enumerate(run) if j != i % 2]
        node = _h(*[node if j == i % 2 else x for j, x in enumerate(run)])
        i //= 2
    return siblings, node


def _brute(rows):
    """rows (doc_id, source, lang, n_chars, text) → sorted result rows."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append((r[0] is not None, r[0] or 0, _leaf(*r), r))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: _tree([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in order}
    top = _tree([trees[g][-1][0] for g in order])
    out = []
    for at, g in enumerate(order):
        for i, (_, _, leaf, r) in enumerate(sorted(groups[g], key=lambda x: x[:3])):
            now = leaf
            if r[0] is not None and r[3] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0:
                now = _leaf(r[0], r[1], r[2], r[3] + 1, r[4])
            own, node = _climb(trees[g], i, now)
            above, root = _climb(top, at, node)
            out.append((r[0], leaf, trees[g][-1][0], top[-1][0], _h(*own, *above), root, root == top[-1][0]))
    return sorted(map(repr, out))


_SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"
_COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def _audit(spark, rows, schema=_SCHEMA, extra=()):
    df = spark.createDataFrame([(*r, *extra) for r in rows], schema)
    got = MM.audit(df, F.crc32(F.col("doc_id").cast("string")) % 7 == 0)
    assert got.columns == _COLUMNS
    return sorted(repr(tuple(r)) for r in got.collect())


def test_query_matches_sql(spark, duck):
    compare(spark, duck, "op12_merkle_manifest", QUERIES, ORACLE_SQL)


def test_trees_of_several_tiers_match_brute_force(spark):
    n = 2 * 2**MM.HEIGHT + 37
    rows = [(i, "s", "en", i % 50, f"text {i}") for i in range(n)]
    rows += [(i, None, "de", None, "") for i in range(2**MM.HEIGHT)] + [(7, "s", "fr", 3, None)]
    assert _audit(spark, rows) == _brute(rows)


def test_edges(spark):
    rows = [(None, None, None, None, None), (5, "a", None, 1, "x"), (5, "a", None, 1, "x"), (5, "a", None, 1, "y"),
            (0, "", "", 0, ""), (-3, "b", "Ü", 9, "ü\n" * 400_000), (2**40, "b", "Z", 9, "z"), (1, "b", "z", 9, "z")]
    assert _audit(spark, rows) == _brute(rows)
    # names that the operator uses itself are other columns like any
    wide = _SCHEMA + ", tree string, idx int, carry int, digest string, leaf string, n long, block int"
    assert _audit(spark, rows, wide, ("t", 1, 2, "d", "l", 3, 4)) == _brute(rows)
    assert _audit(spark, rows[:1]) == _brute(rows[:1])
    assert _audit(spark, []) == []


def test_many_groups_make_a_top_tree_of_several_tiers(spark):
    rows = [(i, "s", f"l{i:05d}", 1, "t") for i in range(2**MM.HEIGHT + 3)]
    assert _audit(spark, rows) == _brute(rows)


def test_the_log_is_in_completion_order(spark):
    n = 2**MM.HEIGHT + 300
    df = spark.createDataFrame([(None, i, _h(str(i)), None) for i in range(n)] + [("a", 1, _h("a"), None)],
                               "tree string, id long, digest string, carry string")
    m = MM.manifest(df)
    log = {t: {} for t in (None, "a")}
    for r in MM.log_nodes(m.groups).collect():
        assert r.position not in log[r.tree]
        log[r.tree][r.position] = r.digest
    levels = _tree([_h(str(i)) for i in range(n)])
    want, done = [], [0] * len(levels)
    for i in range(1, n + 1):  # after leaf i, every node whose leaves are all there
        for h, level in enumerate(levels):
            ready = len(level) if i == n else i >> h
            want += level[done[h]:ready]
            done[h] = ready
    assert [log[None][p] for p in range(len(log[None]))] == want
    assert log["a"] == {0: _h("a")}
    assert m.root == _h(levels[-1][0], _h("a"))


def test_places_follow_from_subtree_sizes():
    for n in (1, 2, 3, 7, 8, 21):
        sizes = [len(level) for level in _tree(["x"] * n)]
        at = sorted(int(p) for h, k in enumerate(sizes) for p in MM.position(h, np.arange(k), n))
        assert at == list(range(sum(sizes)))
