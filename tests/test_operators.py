"""Hand-computed fixtures and properties for the operators (synthetic rows only)."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratekit.functions import columns as C
from ratekit.models import latent as L
from ratekit.operators import evaluation as E
from ratekit.operators import features as FE
from ratekit.operators import history as H
from ratekit.operators import ordering as O
from ratekit.operators import profile as PR
from ratekit.operators import splits as S
from ratekit.plans.queries import REGISTRY


# --- scalar functions -----------------------------------------------------------------

def test_round_clip_half_even(spark):
    df = spark.createDataFrame([(0.5,), (2.5,), (3.5,), (-0.5,), (7.2,), (1.49,)], "p double")
    got = [r[0] for r in df.select(C.round_clip_rating("p")).collect()]
    assert got == [1, 2, 4, 1, 5, 1]


def test_argmax_first_on_tie_and_expected_rating(spark):
    df = spark.createDataFrame([([0.2, 0.4, 0.4, 0.0, 0.0],), ([0.0, 0.0, 0.0, 0.0, 1.0],)],
                               "p array<double>")
    rows = df.select(C.argmax_class("p").alias("a"), C.expected_rating("p").alias("e")).collect()
    assert [r.a for r in rows] == [1, 4]
    assert rows[0].e == pytest.approx(0.2 + 0.8 + 1.2)
    assert rows[1].e == pytest.approx(5.0)


def test_softmax_sums_to_one_and_is_shift_invariant(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0],), ([1001.0, 1002.0, 1003.0],)], "x array<double>")
    rows = df.select(C.softmax("x").alias("p")).collect()
    for r in rows:
        assert sum(r.p) == pytest.approx(1.0)
    assert rows[0].p == pytest.approx(rows[1].p)


def test_date_parse_one_or_two_digit_day_and_null(spark):
    df = spark.createDataFrame([("4-Feb-1971",), ("01-Jan-1995",), (None,)], "d string")
    got = [r[0] for r in df.select(C.date_text_to_epoch("d")).collect()]
    assert got == [34473600, 788918400, None]


def test_date_parse_rejects_garbage(spark):
    df = spark.createDataFrame([("not a date",)], "d string")
    with pytest.raises(Exception):
        df.select(C.date_text_to_epoch("d")).collect()


def test_max_norm_clip(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.3, 0.4],)], "v array<double>")
    got = [r[0] for r in df.select(C.l2_norm(C.max_norm_clip("v"))).collect()]
    assert got == pytest.approx([1.0, 0.5])


# --- ordering helpers --------------------------------------------------------------------

def test_global_row_number_matches_sort(spark):
    vals = random.Random(1).sample(range(100000), 500)
    df = spark.createDataFrame([(v,) for v in vals], "x long").repartition(7)
    got = {r.x: r.rn for r in O.global_row_number(df, ["x"], n_ranges=5).collect()}
    assert got == {v: i + 1 for i, v in enumerate(sorted(vals))}


def test_running_totals_match_cumsum(spark):
    rng = random.Random(2)
    rows = [(i, rng.randint(0, 9)) for i in range(300)]
    df = spark.createDataFrame(rows, "o long, v long").repartition(5)
    got = {r.o: r.cum_v for r in O.running_totals(df, ["o"], ["v"], n_ranges=4).collect()}
    acc, want = 0, {}
    for o, v in rows:
        acc += v
        want[o] = acc
    assert got == want


# --- profiling ----------------------------------------------------------------------------------

def test_duplicates_treat_nulls_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, 3), (2, 3), (2, 3), (4, 5)], "a int, b int")
    r = PR.duplicate_count(df).first()
    assert (r.rows, r.distinct_rows, r.duplicates) == (6, 3, 3)


def test_null_profile_and_all_null_column(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, None, None)], "a int, b string, c string")
    nulls = {r.column_name: r.null_count for r in PR.null_counts(df).collect()}
    assert nulls == {"a": 0, "b": 2, "c": 1}
    assert PR.drop_all_null_columns(df).columns == ["a", "c"]


def test_histogram_constant_column_and_max_folding(spark):
    const = spark.createDataFrame([(5,), (5,)], "age int")
    h = PR.histogram(const, "age", 4).collect()
    assert [r["count"] for r in h] == [2, 0, 0, 0]
    df = spark.createDataFrame([(0,), (5,), (10,)], "age int")
    h = PR.histogram(df, "age", 2).collect()
    assert [r["count"] for r in h] == [1, 2]


def test_value_counts_domain_zero_fill(spark):
    df = spark.createDataFrame([(1,), (1,), (3,)], "rating int")
    got = [(r.rating, r["count"]) for r in S.class_frequency(df).collect()]
    assert got == [(1, 2), (2, 0), (3, 1), (4, 0), (5, 0)]


# --- features -------------------------------------------------------------------------------------

def test_standard_scaler_population_std_and_zero_variance(spark):
    df = spark.createDataFrame([(1.0, 7.0), (3.0, 7.0), (None, 7.0)], "x double, c double")
    rows = FE.standard_scale(df, ["x", "c"]).collect()
    assert [r.x for r in rows] == [-1.0, 1.0, None]
    assert [r.c for r in rows] == [0.0, 0.0, 0.0]


def test_one_hot_sorted_and_fixed_domain(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, "z")], "id int, g string")
    out = FE.one_hot(df, ["g"])
    assert out.columns == ["id", "g_a", "g_b", "g_z"]
    fixed = FE.one_hot(df, ["g"], {"g": ["a", "b"]}).orderBy("id").collect()
    assert [(r.g_a, r.g_b) for r in fixed] == [(0, 1), (1, 0), (0, 0)]


def test_label_encoder_numeric_order_dense(spark):
    df = spark.createDataFrame([(10,), (2,), (1,), (2,), (10,)], "user_id long")
    m = {r.user_id: r.user_id_idx for r in FE.fit_label_encoder(df, "user_id").collect()}
    assert m == {1: 0, 2: 1, 10: 2}


def test_noise_is_reproducible_and_keeps_zero(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 0.0), ("c", None)], "k string, x double")
    a = FE.multiplicative_noise(df, ["x"], 0.1, "k").orderBy("k").collect()
    b = FE.multiplicative_noise(df.repartition(3), ["x"], 0.1, "k").orderBy("k").collect()
    assert a == b
    assert a[1].x == 0.0 and a[2].x is None and a[0].x != 1.0


# --- splits ------------------------------------------------------------------------------------

def _ratings(spark, users=37, seed=3):
    rng = random.Random(seed)
    rows = []
    for u in range(users):
        for j in range(rng.randint(1, 25)):
            rows.append((f"k{u}_{j}", u, rng.randint(1, 5)))
    return spark.createDataFrame(rows, "k string, user_id long, rating int")


def test_stratified_split_exact_sizes_and_quotas(spark):
    df = _ratings(spark)
    n = df.count()
    out = S.stratified_split(df, test=0.1, val=0.1, relative_to="total").cache()
    sizes = {r.split: r["count"] for r in out.groupBy("split").count().collect()}
    n_test = -(-n // 10)
    n_val = -(-(n - n_test) // 9)
    assert sizes.get("test", 0) == n_test
    assert sizes.get("val", 0) == n_val
    assert sum(sizes.values()) == n
    per = out.groupBy("user_id").agg(F.count("*").alias("n"),
                                     F.sum((F.col("split") == "test").cast("int")).alias("t")).collect()
    for r in per:  # each user gets floor or floor + 1 of its share
        assert r.n // 10 <= r.t <= r.n // 10 + 1
    again = S.stratified_split(df.repartition(5), test=0.1, val=0.1, relative_to="total")
    assert sorted(out.select("k", "split").collect()) == sorted(again.select("k", "split").collect())


def test_random_split_sizes(spark):
    df = _ratings(spark, users=50)
    n = df.count()
    out = S.random_split(df, test=0.1, val=0.15, relative_to="remainder")
    sizes = {r.split: r["count"] for r in out.groupBy("split").count().collect()}
    n_test = -(-n // 10)
    assert sizes["test"] == n_test
    assert sizes["val"] == -(-(n - n_test) * 3 // 20)


def test_class_weights(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,)], "rating int")
    bal = {r.rating: r.weight for r in S.balanced_class_weights(df).collect()}
    assert bal == pytest.approx({1: 4 / 6, 2: 2.0})
    inv = {r.rating: r.weight for r in S.inverse_frequency_weights(df).collect()}
    assert sum(inv.values()) == pytest.approx(2.0)
    assert inv[2] / inv[1] == pytest.approx(3.0)


def test_epoch_batches_sizes(spark):
    df = spark.createDataFrame([(f"k{i}",) for i in range(23)], "k string")
    b = S.epoch_batches(df, batch_size=5, epoch=2)
    sizes = sorted(r["count"] for r in b.groupBy("batch_id").count().collect())
    assert sizes == [3, 5, 5, 5, 5]


# --- evaluation ---------------------------------------------------------------------------------

def test_prf_zero_division_and_class_union(spark):
    # class 3 never predicted, class 4 predicted but never actual
    rows = [(1, 1), (1, 2), (2, 2), (3, 2), (2, 4)]
    df = spark.createDataFrame(rows, "actual int, predicted int")
    pc = {r["class"]: r for r in E.per_class_prf(df).collect()}
    assert sorted(pc) == [1, 2, 3, 4]
    assert pc[3].precision == 0.0 and pc[3].recall == 0.0 and pc[3].f1 == 0.0
    assert pc[4].precision == 0.0 and pc[4].support == 0
    assert pc[2].precision == pytest.approx(1 / 3) and pc[2].recall == pytest.approx(1 / 2)
    avg = E.averaged_prf(E.per_class_prf(df)).first()
    assert avg.macro_precision == pytest.approx((1 + 1 / 3 + 0 + 0) / 4)
    f1 = {c: pc[c].f1 for c in pc}
    assert avg.weighted_f1 == pytest.approx((f1[1] * 2 + f1[2] * 2 + f1[3] * 1) / 5)


def test_confusion_matrix_total_and_empty_rows(spark):
    df = spark.createDataFrame([(1, 1), (5, 1)], "actual int, predicted int")
    cm = E.confusion_matrix(df).collect()
    assert len(cm) == 25 and sum(r.n for r in cm) == 2
    wide = E.confusion_matrix_wide(df).collect()
    assert [r.pred_1 for r in wide] == [1, 0, 0, 0, 1]


def _brute_auc(labels, scores):
    pos = [s for l, s in zip(labels, scores) if l == 1]
    neg = [s for l, s in zip(labels, scores) if l == 0]
    tot = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in itertools.product(pos, neg))
    return tot / (len(pos) * len(neg))


def test_auc_equals_pairwise_brute_force_with_ties(spark):
    rng = random.Random(5)
    rows = [(c, rng.randint(0, 1), float(rng.randint(0, 6))) for c in (1, 2) for _ in range(60)]
    df = spark.createDataFrame(rows, "class int, label int, score double")
    got = {r["class"]: r.auc for r in E.auc(df).collect()}
    for c in (1, 2):
        lab = [l for cc, l, s in rows if cc == c]
        sc = [s for cc, l, s in rows if cc == c]
        assert got[c] == pytest.approx(_brute_auc(lab, sc))
    flipped = df.withColumn("score", -F.col("score"))
    got2 = {r["class"]: r.auc for r in E.auc(flipped).collect()}
    for c in (1, 2):
        assert got2[c] == pytest.approx(1 - got[c])


def test_roc_curve_points(spark):
    df = spark.createDataFrame([(1, 1, 0.9), (1, 0, 0.8), (1, 1, 0.8), (1, 0, 0.1)],
                               "class int, label int, score double")
    pts = sorted((r.fpr, r.tpr) for r in E.roc_curve(df).collect())
    assert pts == [(0.0, 0.0), (0.0, 0.5), (0.5, 1.0), (1.0, 1.0)]


def test_batch_mean_of_means_overweights_short_batch(spark):
    df = spark.createDataFrame([(0, 1.0), (0, 1.0), (0, 1.0), (1, 4.0)], "batch_id int, l double")
    assert E.batch_mean_of_means(df, "l").first().loss == pytest.approx(2.5)


def test_kl_zero_for_standard_normal(spark):
    df = spark.createDataFrame([([0.0, 0.0], [0.0, 0.0]), ([1.0, 0.0], [0.0, 0.0])],
                               "mu array<double>, lv array<double>")
    got = [r[0] for r in df.select(E.kl_to_standard_normal("mu", "lv")).collect()]
    assert got == pytest.approx([0.0, 0.5])


# --- history ---------------------------------------------------------------------------------------

def _hist(spark, runs):
    rows = [(run, e + 1, None, float(v)) for run, losses in runs.items() for e, v in enumerate(losses)]
    return spark.createDataFrame(rows, "run string, epoch int, train_loss double, val_loss double")


def test_early_stop_cases(spark):
    runs = {
        "improves": [5, 4, 3, 2, 1],
        "plateau": [3, 2, 2, 2, 2, 2, 1],       # equal losses are not improvements
        "exact": [1, 2, 2, 2],                   # stops exactly at patience 3 (epoch 4)
        "never": [1, 1, 1, 0.5, 1, 1],
    }
    s = {r.run: r for r in H.run_summary(_hist(spark, runs), patience=3).collect()}
    assert s["improves"].stop_epoch is None and s["improves"].best_epoch == 5
    assert s["plateau"].stop_epoch == 5 and s["plateau"].best_epoch == 2
    assert s["exact"].stop_epoch == 4 and s["exact"].best_epoch == 1
    assert s["never"].stop_epoch is None and s["never"].epochs_run == 6
    assert s["never"].best_epoch == 4


def _plateau_reference(losses, lr, factor=0.5, patience=2, threshold=1e-4):
    best, bad, out = float("inf"), 0, []
    for loss in losses:
        out.append(lr)
        if loss < best * (1 - threshold):
            best, bad = loss, 0
        else:
            bad += 1
        if bad > patience:
            lr, bad = lr * factor, 0
    return out


def test_plateau_lr_matches_scheduler_semantics(spark):
    runs = {"a": [5, 4, 4, 4, 4, 4, 4, 3, 3, 3, 3, 3], "b": [1, 0.99995, 0.9999, 2, 2, 2, 2]}
    got = H.plateau_learning_rate(_hist(spark, runs), 0.01).collect()
    for run, losses in runs.items():
        lrs = [r.lr for r in got if r.run == run]
        assert lrs == pytest.approx(_plateau_reference(losses, 0.01))


def test_stratified_split_with_hot_user(spark):
    # user 0 holds a third of all rows; the split must still be exact and the
    # hot user's rows must be spread over several ranges, not one task
    rows = [(f"h{i}", 0, 3) for i in range(400)]
    rows += [(f"c{u}_{j}", u, 4) for u in range(1, 81) for j in range(10)]
    df = spark.createDataFrame(rows, "k string, user_id long, rating int")
    out = S.stratified_split(df, test=0.1, val=0.1, relative_to="total")
    hot = {r.split: r["count"] for r in out.where("user_id = 0").groupBy("split").count().collect()}
    assert hot["test"] == 40 and hot["val"] == 40 and hot["train"] == 320
    ranked = O.global_row_number(df.withColumn("_h", S.seeded_hash(42, "k")),
                                 ["user_id", "_h"], n_ranges=6)
    per_range = (ranked.where("user_id = 0").select(F.spark_partition_id().alias("p"))
                 .distinct().count())
    assert per_range >= 2


def test_cross_entropy_zero_probability_and_one_hot_rows(spark):
    import math
    rows = [([1.0, 0.0, 0.0, 0.0, 0.0], 0), ([0.0, 1.0, 0.0, 0.0, 0.0], 0), ([0.2] * 5, 2)]
    df = spark.createDataFrame(rows, "p array<double>, y int")
    ce = E.weighted_cross_entropy(df, "p", "y").first().cross_entropy
    want = (0.0 - math.log(1e-15) - math.log(0.2)) / 3
    assert ce == pytest.approx(want)


def test_feature_matrix_fills_missing_item_with_zero(spark):
    r = spark.createDataFrame([("a", 1, 10, 5), ("b", 2, 99, 3)],
                              "k string, user_id long, item_id long, rating int")
    u = spark.createDataFrame([(1, 0.5), (2, -0.5)], "user_id long, age double")
    it = spark.createDataFrame([(10, 1, 1.5)], "item_id long, g_x int, release_date double")
    fm = {x.k: x for x in FE.feature_matrix(r, u, it).collect()}
    assert fm["b"].g_x == 0 and fm["b"].release_date == 0.0 and fm["b"].rating == 3
    assert fm["a"].g_x == 1 and fm["a"].age == 0.5


def test_splits_do_not_depend_on_shuffle_partitions(spark):
    df = _ratings(spark, users=30, seed=9)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        a = sorted(S.stratified_split(df).select("k", "split").collect())
        b = sorted(S.random_split(df).select("k", "split").collect())
        e = sorted(FE.fit_label_encoder(df, "user_id").collect())
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        assert a == sorted(S.stratified_split(df).select("k", "split").collect())
        assert b == sorted(S.random_split(df).select("k", "split").collect())
        assert e == sorted(FE.fit_label_encoder(df, "user_id").collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_ordering_helpers_edge_cases(spark):
    empty = spark.createDataFrame([], "x long, v long")
    assert O.global_row_number(empty, ["x"]).count() == 0
    # ties keep distinct consecutive numbers; descending order is honoured
    df = spark.createDataFrame([(1, 1), (3, 1), (3, 1), (2, 1)], "x long, v long")
    rn = sorted((r.x, r.rn) for r in O.global_row_number(df, [F.desc("x")], n_ranges=3).collect())
    assert [x for x, _ in rn] == [1, 2, 3, 3]
    assert sorted(r for _, r in rn) == [1, 2, 3, 4]
    assert dict(rn)[1] == 4 and dict(rn)[2] == 3
    run = {r.x: r.cum_v for r in O.running_totals(
        spark.createDataFrame([(5, 2), (1, 3), (9, 4)], "x long, v long"), [F.desc("x")], ["v"]).collect()}
    assert run == {9: 4, 5: 6, 1: 9}


# --- splits with repeated keys -----------------------------------------------------------------

def _sizes(df):
    return {r.split: r.n for r in df.groupBy("split").agg(F.count("*").alias("n")).collect()}


def _ceil(n, f):
    return -(-n * f.numerator // f.denominator)


@pytest.mark.parametrize("hot_at", [10, 200_000])
def test_random_split_is_exact_with_repeated_and_null_keys(spark, monkeypatch, hot_at):
    monkeypatch.setattr(S, "HOT", hot_at)
    rows = [(None, i % 3) for i in range(100)] + [("same", 7)] * 200 + [(f"k{i}", i) for i in range(307)]
    df = spark.createDataFrame(rows, "k string, x int")
    for test, val in ((0.1, 0.1), (0.33, 0.5), (0.5, 0.15)):
        got = S.random_split(df, "k", test, val, "remainder", out="split")
        n_test = _ceil(607, S.as_fraction(test))
        n_val = _ceil(607 - n_test, S.as_fraction(val))
        assert _sizes(got) == {"test": n_test, "val": n_val, "train": 607 - n_test - n_val}
        assert sorted((r.k or "", r.x) for r in got.collect()) == sorted((k or "", x) for k, x in rows)
        again = S.random_split(df.repartition(7), "k", test, val, "remainder", out="split")
        assert sorted(map(repr, map(tuple, again.collect()))) == sorted(map(repr, map(tuple, got.collect())))


@pytest.mark.parametrize("hot_at", [10, 200_000])
def test_stratified_split_is_exact_with_repeated_keys_and_a_heavy_stratum(spark, monkeypatch, hot_at):
    monkeypatch.setattr(S, "HOT", hot_at)
    rows = [(None, f"n{i % 4}") for i in range(30)] + [(1, "same")] * 150 + [(1, f"a{i}") for i in range(50)]
    rows += [(2, None)] * 40 + [(3, "b")] + [(i, f"c{i}-{j % 3}") for i in range(4, 30) for j in range(i % 9)]
    df = spark.createDataFrame(rows, "user_id int, k string")
    got = S.stratified_split(df, "user_id", "k", 0.15, 0.15)
    f = S.validation_fraction(0.15, 0.15, "total")
    n_test = _ceil(len(rows), S.as_fraction(0.15))
    n_val = _ceil(len(rows) - n_test, f)
    assert _sizes(got) == {"test": n_test, "val": n_val, "train": len(rows) - n_test - n_val}
    assert sorted(map(repr, [(r.user_id, r.k) for r in got.collect()])) == sorted(map(repr, rows))
    for r in got.groupBy("user_id").agg(F.count("*").alias("n"), F.sum((F.col("split") == "test").cast("int")).alias("t")).collect():
        assert r.n * 15 // 100 <= r.t <= r.n * 15 // 100 + 1


def test_splits_of_an_empty_table(spark):
    df = spark.createDataFrame([], "user_id int, k string")
    assert S.stratified_split(df).count() == 0 and S.random_split(df).count() == 0


# --- automatic bins, open domains, components --------------------------------------------------

def test_automatic_bins_follow_the_rule_on_exact_quantiles(spark):
    rng = random.Random(5)
    values = [rng.gauss(10, 2) for _ in range(3000)] + [rng.expovariate(0.05) for _ in range(50)]
    rows = [(v,) for v in values] + [(None,), (float("nan"),), (float("inf"),)]
    df = spark.createDataFrame(rows, "x double")
    got = PR.automatic_bins(df, "x").first()
    x = sorted(values)
    n, spread = len(x), x[-1] - x[0]
    q1, q3 = x[math.ceil(0.25 * n) - 1], x[math.ceil(0.75 * n) - 1]
    want = math.ceil(spread / min(spread / (math.log2(n) + 1), 2 * (q3 - q1) / n ** (1 / 3)))
    assert (got.n, got.lo, got.hi, got.bins) == (n, x[0], x[-1], want)
    h = PR.automatic_histogram(df, "x").collect()
    assert [r.bin for r in h] == list(range(want)) and sum(r["count"] for r in h) == n
    # a coarse summary moves a quartile by its stated share of the ranks at most
    q = PR.quantile_points(df, "x", (0.25, 0.75), accuracy=50).first().q
    assert all(abs(sum(v <= got_q for v in x) - p * n) <= n / 50 + 1 for got_q, p in zip(q, (0.25, 0.75)))


def test_automatic_bins_without_spread_or_values(spark):
    one = spark.createDataFrame([(3.0,), (3.0,), (None,)], "x double")
    assert [tuple(r) for r in PR.automatic_histogram(one, "x").collect()] == [(0, 3.0, 3.0, 2)]
    none = spark.createDataFrame([(None,), (float("nan"),)], "x double")
    assert PR.automatic_bins(none, "x").count() == 0 and PR.automatic_histogram(none, "x").count() == 0
    flat = spark.createDataFrame([(0.0,)] * 90 + [(float(i),) for i in range(10)], "x double")
    assert PR.automatic_bins(flat, "x").first().bins == 8  # no interquartile range: Sturges alone


def test_open_domain_encodes_heavy_unknown_and_null_values(spark):
    rows = [(i, "heavy") for i in range(120)] + [(200 + i, f"v{i:02d}") for i in range(30)] + [(300, None)]
    df = spark.createDataFrame(rows, "id int, c string")
    dictionary = FE.category_dictionary(df, "c")
    codes = {r.value: r.code for r in dictionary.collect()}
    assert [codes[v] for v in sorted(codes)] == list(range(31))
    new = df.unionByName(spark.createDataFrame([(400, "unseen"), (401, None)], "id int, c string"))
    for hot in (100, 10_000):
        got = FE.sparse_one_hot(new, "c", dictionary, hot=hot, salts=4).collect()
        assert len(got) == len(rows) + 2
        for r in got:
            v = r.c_onehot
            assert v.size == 31 and (v.indices, v.values) == (([codes[r.c]], [1.0]) if r.c in codes else ([], []))
    frequent = FE.category_dictionary(df, "c", least=2)
    assert [r.value for r in frequent.collect()] == ["heavy"]
    empty = FE.sparse_one_hot(new.limit(1), "c", FE.category_dictionary(df.limit(0), "c")).first().c_onehot
    assert (empty.size, empty.indices) == (0, [])


def test_randomised_components_are_those_of_the_covariance(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(400, 30)) * np.linspace(6, 0.1, 30) + 50
    x = x @ np.linalg.qr(rng.normal(size=(30, 30)))[0]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(400, None)], "id int, v array<double>")
    rows, variance, parts = L.randomised_pca(df, "v", 3, keep=("id",), rounds=8)
    values, vectors = np.linalg.eigh(np.cov(x.T))
    assert variance == pytest.approx(values[::-1][:3], rel=1e-6)
    assert np.allclose(np.abs(np.sum(parts * vectors[:, ::-1][:, :3].T, axis=1)), 1, atol=1e-5)
    got = {r.id: [r.pc_1, r.pc_2, r.pc_3] for r in rows.collect()}
    assert np.allclose([got[i] for i in range(400)], (x - x.mean(axis=0)) @ parts.T) and got[400] == [None] * 3
    again = L.randomised_pca(df.repartition(5), "v", 3, rounds=8)
    assert np.allclose(again[2], parts, atol=1e-9)
    with pytest.raises(ValueError):
        L.randomised_pca(df.limit(0), "v", 1)


def test_balanced_weights_compute_their_rows_once(spark):
    # the counts are stored: what the totals and the rows read has no aggregate over the source left
    w = S.balanced_class_weights(spark.range(100).select((F.col("id") % 3).cast("int").alias("rating")), "rating")
    assert [(r.rating, r["count"], round(r.weight, 6)) for r in w.collect()] == [
        (0, 34, round(100 / 102, 6)), (1, 33, round(100 / 99, 6)), (2, 33, round(100 / 99, 6))]
    assert "Range" not in w._jdf.queryExecution().optimizedPlan().toString()


def test_split_keys_are_stored_as_longs_in_the_order_of_their_hash(spark, monkeypatch):
    stored = {}
    keep = S.materialize
    monkeypatch.setattr(S, "materialize", lambda df, name, *a: stored.setdefault(name, keep(df, name, *a)))
    df = spark.range(500).select(F.col("id").cast("string").alias("k"), (F.col("id") % 20).alias("user_id"))
    S.stratified_split(df)
    assert [f.dataType.simpleString() for f in stored["split-keys"].schema] == ["bigint", "bigint"]
    rows = df.select(S.seeded_hash(42, "k").alias("h"), S.narrow(S.seeded_hash(42, "k")).alias("p")).collect()
    assert [r.h for r in sorted(rows, key=lambda r: r.p)] == sorted(r.h for r in rows)


def test_cold_and_hot_strata_are_cut_alike(spark, monkeypatch):
    # users of 1 to 40 rows, a null user, keys that repeat: strata over HOT go by prefixes, the others by one shuffle
    df = spark.range(900).select((F.col("id") % 450).cast("string").alias("k"), F.col("id").alias("row"),
                                 F.when(F.col("id") % 11 != 0, F.floor(F.sqrt("id"))).alias("user_id"))
    got = {}
    for at in (0, 20, 200_000):
        monkeypatch.setattr(S, "HOT", at)
        got[at] = sorted((r.row, r.split) for r in S.stratified_split(df, test=0.2, val=0.2).collect())
    assert got[0] == got[20] == got[200_000] and len(got[0]) == 900
    assert sum(s == "test" for _, s in got[0]) == 180


def test_both_lookups_move_vectors_with_rows_that_have_both(spark, monkeypatch):
    rows = spark.createDataFrame([("a", 1, 2), ("b", 1, 9), ("c", 9, 2), ("d", 9, 9), ("e", None, 2), ("f", 3, 1), ("g", 4, 9),
                                  ("h", 9, 4)], "k string, user_id long, item_id long")
    e = spark.createDataFrame([(1, [1.0, 2.0]), (2, [3.0, 4.0]), (2, None), (3, None), (4, [5.0, 6.0]), (4, [7.0, 8.0]),
                               (None, [9.0, 9.0])], "vec_id long, embedding array<double>")
    want = FE.lookup_vectors(FE.lookup_vectors(rows, e, "user_id", "vec_id", "embedding", "u"), e, "item_id", "vec_id",
                             "embedding", "v").collect()
    both = lambda r: r.u is not None and r.v is not None
    want = sorted(((r.k, int(r.u is not None), int(r.v is not None), (r.u, r.v) if both(r) else None) for r in want), key=str)
    for at in (FE.BROADCAST_IDS, 0):
        monkeypatch.setattr(FE, "BROADCAST_IDS", at)
        got = FE.lookup_both(rows, e, "user_id", "item_id", "vec_id", "embedding").collect()
        assert want == sorted(((r.k, r.has_u, r.has_v, (r.u, r.v) if both(r) else None) for r in got), key=str)


def test_splits_of_named_columns_compute_rows_once_and_label_alike(spark):
    base = spark.range(700).select((F.col("id") % 650).cast("string").alias("k"), (F.col("id") % 9).alias("user_id"),
                                   F.col("id").alias("item_id"))
    for df in (base.where("item_id < 650"), base):  # different keys, and keys that repeat
        for split in (S.stratified_split, S.random_split):
            whole = split(df, test=0.1, val=0.1)
            for columns in (["user_id", "item_id"], ["k", "item_id"]):
                part = split(df, test=0.1, val=0.1, columns=columns)
                assert part.columns == [*columns, "split"]
                assert sorted(part.collect()) == sorted(whole.select(*columns, "split").collect())
    seen = spark.sparkContext.accumulator(0)
    counted = F.udf(lambda x: (seen.add(1), x)[1], "string")
    once = base.where("item_id < 650").withColumn("k", counted("k"))
    S.random_split(once, columns=["item_id"]).collect()
    assert seen.value == 650


def test_ranges_of_a_stored_split_follow_the_tables_it_reads(spark, monkeypatch):
    monkeypatch.setattr(O, "RANGE_BYTES", 1 << 20)
    df = spark.range(3000).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("user_id"))
    rows = S.random_split(df, columns=["k"]).where("split = 'train'").select("k")
    assert O._range_count(rows) == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_a_stratified_split_of_named_columns_needs_no_cuts(spark, monkeypatch):
    """Same labels as over all columns, with large strata, null ones and, at last, repeated keys."""
    rows = [(None if u == 9 else u, f"k{u}-{i}", float(i)) for u in range(10) for i in range(3 + 7 * u)]
    df = spark.createDataFrame(rows, "user_id long, k string, v double")
    pick = lambda x: sorted(map(repr, x.select("user_id", "v", "split").collect()))
    whole = S.stratified_split(df, test=0.15, val=0.15)
    want = pick(whole)
    with monkeypatch.context() as m:
        m.setattr(S, "_cuts", None)
        assert pick(S.stratified_split(df, test=0.15, val=0.15, columns=("user_id", "v"))) == want
        m.setattr(S, "HOT", 30)
        assert pick(S.stratified_split(df, test=0.15, val=0.15, columns=("v", "user_id"))) == want
        assert S.stratified_split(df.limit(0), columns=("user_id", "v")).count() == 0
    twice = df.unionByName(df).withColumn("k", F.when(F.col("user_id") > 4, "one").otherwise(F.col("k")))
    want = pick(S.stratified_split(twice))
    assert pick(S.stratified_split(twice, columns=("user_id", "v"))) == want


def test_noisy_features_do_not_join_the_ratings_with_the_users(spark):
    plan = REGISTRY["noisy_user_features"](spark, "/root/testdata/sf0.001")
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1  # the cuts, one row
