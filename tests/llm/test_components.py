import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F
from ratekit.llm import components as CO
from ratekit.llm.components import link_buckets
from ratekit.session import materialize


def brute(sets, threshold):
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in combinations(sorted(sets), 2):
        if 100 * len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {i: root(i) for i in sets}


def test_members_of_one_bucket_far_and_near(spark):
    """Copies edited more and less, in one bucket: the hub is similar to few of them."""
    rng = random.Random(8)
    for threshold, sizes in ((85, (60, 60)), (80, (8, 40))):
        sets, i = {}, 0
        for group in range(3):
            base = [rng.randrange(2**40) for _ in range(rng.randint(*sizes))]
            for _ in range(45):
                s, edits = list(base), rng.choice([0, 1, 2, 3, 4, 5, 8, 20])
                for _ in range(min(edits, len(s) - 1)):
                    s[rng.randrange(len(s))] = rng.choice([rng.randrange(2**40), base[0], 7])
                sets[i] = set(s)
                i += 1
        order = list(sets)
        rng.shuffle(order)
        sets = {k: sets[v] for k, v in enumerate(order)}
        table = materialize(spark.createDataFrame([(k, sorted(v)) for k, v in sets.items()], "id long, s array<long>"), "t")
        buckets = materialize(spark.createDataFrame([(1, k) for k in sets] + [(2, k) for k in sets if k % 2],
                                                    "bucket long, id long"), "b")
        labels = {r.node: r.component for r in link_buckets(
            buckets, lambda ids: table.join(ids, "id", "left_semi"), threshold).collect()}
        assert {k: labels.get(k, k) for k in sets} == brute(sets, threshold)


def test_marks_rule_out_no_similar_pair_and_most_others(spark):
    rng = random.Random(3)
    rows = []
    for i in range(300):
        a = {rng.getrandbits(63) for _ in range(rng.randint(1, 120))}
        b = set(rng.sample(sorted(a), rng.randint(len(a) * 2 // 3, len(a)))) | {rng.getrandbits(63) for _ in range(rng.randint(0, 30))}
        rows += [(2 * i, sorted(a)), (2 * i + 1, sorted(b))]
    sets = spark.createDataFrame(rows + [(600, [])], "id long, s array<long>")
    marks = materialize(CO._marks(sets, None), "marks")
    assert {r.id: r.n for r in marks.collect()} == {i: len(s) for i, s in rows} | {600: 0}
    pair = (F.col("a_id") % 2 == 0) & (F.col("b_id") == F.col("a_id") + 1)
    left = {r.a_id // 2 for r in CO._named(marks, "a_").join(CO._named(marks, "b_"), pair).where(
        CO._alike(80, "a_", "b_")).collect()}
    by = dict(rows)
    similar = {i for i in range(300) if 100 * len(set(by[2 * i]) & set(by[2 * i + 1])) >= 80 * len(set(by[2 * i]) | set(by[2 * i + 1]))}
    assert similar <= left and len(left) < len(similar) + 60 < 250


@pytest.mark.parametrize("pairwise", [256, 2])
def test_sets_that_cannot_be_similar_are_not_compared(spark, monkeypatch, pairwise):
    """Unlike sets that share their rarest elements, in one bucket: pairs grew with the square of its size."""
    rng = random.Random(4)
    sets = {i: sorted({1000 + i % 3, *(rng.getrandbits(60) for _ in range(4)), *rng.sample(range(100), 30)}) for i in range(120)}
    sets |= {120 + i: [*sets[i][:-1], 7 + 2**61 + i] for i in range(20)}
    table = materialize(spark.createDataFrame(list(sets.items()), "id long, s array<long>"), "t")
    buckets = materialize(spark.createDataFrame([(1, k) for k in sets], "bucket long, id long"), "b")
    compared, own = [], CO._Links._similar
    monkeypatch.setattr(CO, "PAIRWISE", pairwise)
    monkeypatch.setattr(CO._Links, "_similar", lambda self, pairs: compared.append(pairs.count()) or own(self, pairs))
    labels = {r.node: r.component for r in link_buckets(buckets, lambda ids: table.join(ids, "id", "left_semi"), 80).collect()}
    assert {k: labels.get(k, k) for k in sets} == brute({k: set(s) for k, s in sets.items()}, 80)
    assert sum(compared) <= len(sets)
