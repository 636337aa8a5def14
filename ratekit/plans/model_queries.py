"""Registered model queries, over ratings that can be learnt.

The ratings are planted (`testdata.planted_ratings`: a user effect, an item
effect, an interaction and noise), so a model that works beats the mean by
far.  Scores are floating numbers that no SQL engine repeats,
so the queries return what SQL can state: which rows a model must score,
that each one is scored and in range, class supports counted from the
model's own confusion cells, the errors of constant baselines by value, and
whether the model's figures are better than those.  (Against ALS the models
are held by the tests, on low-rank ratings.)  Each kind is fitted once in a session and shared by the queries that ask for it.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..models import latent as L
from ..models import rating_models as M
from ..models.trainer import BATCH_ROWS
from ..operators import evaluation as E
from ..operators import features as FE
from ..session import arrow_batches, in_session, materialize, own_session, shared_path
from ..sources import testdata as TD
from .queries import items_processed, query, user_feature_names, users_processed

#: A model learns if its test MAE is under this share of the train mean's.
LEARNS = 0.8
#: Sizes and settings of the queries' models.
NET = {"rank": 8, "tower": (64, 32), "latent": 8, "batch": 256, "lr": 0.02, "init": 0.3, "embedding_decay": 0.1,
       "dropout": 0.0, "epochs": 12, "plateau_patience": 4}
#: Epochs of the run that is cut and resumed, and after which it is cut.
RESUMED, CUT = 4, 2

_FITTED: dict[tuple, M.FitResult] = {}


def _inputs(spark, d, kind: str, **net) -> tuple[DataFrame, M.ModelConfig]:
    ratings, net = TD.planted_ratings(spark, d), {**NET, **net}
    if kind.startswith("ncf"):
        return ratings, M.config_for(kind, net)
    up, ip = users_processed(spark, d), items_processed(spark, d)
    return FE.feature_matrix(ratings, up, ip), M.config_for(
        kind, net, user_features=tuple(user_feature_names(up)), item_features=("release_date", *TD.GENRES))


def fitted(spark, d, kind: str, rows=None) -> M.FitResult:
    """The kind's model, fitted at its first use in a session; ``rows``, if given, gets the split ratings."""
    key = (spark.sparkContext.applicationId, str(d), kind)
    if key not in _FITTED:
        res = M.fit(*_inputs(spark, d, kind), rows=rows and in_session(rows(), spark))
        with arrow_batches(spark, BATCH_ROWS):
            res.scored_test = materialize(res.scored_test.withColumnRenamed("rating", "actual"), "scored")
        _FITTED[key] = res
    return _FITTED[key]


def _fit_every(spark, d) -> None:
    """Fit all kinds at the same time: a small fit has fewer tasks than the cluster has cores.

    Kinds with one split rule and one input share their split ratings.
    """
    def prepared(kind):
        return M.prepare(*_inputs(own_session(spark), d, kind))

    def rule(kind):
        cfg = M.DEFAULTS[kind]
        return kind.startswith("ncf"), cfg.split, cfg.test, cfg.val, cfg.relative_to, cfg.seed

    missing = [k for k in M.KINDS if (spark.sparkContext.applicationId, str(d), k) not in _FITTED]
    with ThreadPoolExecutor(2 * len(M.KINDS)) as pool:
        splits = {rule(k): pool.submit(prepared, k) for k in {rule(k): k for k in missing}.values()}
        for fit in [pool.submit(fitted, own_session(spark), d, k, splits[rule(k)].result) for k in missing]:
            fit.result()


def _scores(spark, d, kind: str) -> DataFrame:
    """Per test row: that it is scored and in range, and whether its model learns."""
    res = fitted(spark, d, kind)
    scored = res.scored_test
    err = F.avg(F.abs(F.col("prediction") - F.col("actual")))
    base = F.avg(F.abs(F.lit(res.train_mean) - F.col("actual")))
    learns = scored.agg((err < LEARNS * base).alias("learns"))  # one row
    ok = F.col("predicted").between(1, 5)
    if kind in M.CLASSIFIERS:
        total = F.aggregate("probabilities", F.lit(0.0), lambda s, p: s + p)
        ok = ok & (F.abs(total - 1) < 1e-9) & F.col("prediction").between(1, 5)
    return scored.crossJoin(F.broadcast(learns)).select(
        "k", "user_id", "item_id", "actual", (F.col("prediction").isNotNull() & ~F.isnan("prediction")).alias("scored"),
        ok.alias("in_range"), "learns")


@query
def ncf_classifier_scores(spark, d):
    """O-76 + O-82: GMF and tower branches → softmax, expected rating and class."""
    return _scores(spark, d, "ncf_classifier")


@query
def ncf_regressor_scores(spark, d):
    """O-77 + O-23: the same branches → learnt scaled sigmoid."""
    return _scores(spark, d, "ncf_regressor")


@query
def hybrid_classifier_scores(spark, d):
    """O-78: with user and item features, class-weighted."""
    return _scores(spark, d, "hybrid_classifier")


@query
def hybrid_regressor_scores(spark, d):
    """O-79: with user and item features, bounded regressor."""
    return _scores(spark, d, "hybrid_regressor")


@query
def autoencoder_scores(spark, d):
    """O-80: non-linear encoder and decoder, residual branch, latent-norm penalty."""
    return _scores(spark, d, "autoencoder")


@query
def vae_scores(spark, d):
    """O-81: the variational autoencoder, scored with the latent mean."""
    return _scores(spark, d, "variational")


@query
def autoencoder_latent(spark, d):
    """O-83: per test rating, the size of its latent vector and that all of it is finite."""
    lat = fitted(spark, d, "autoencoder").scored_test
    return lat.select("user_id", "item_id", F.col("actual").alias("rating"), F.size("latent").alias("latent_size"),
                      F.forall("latent", lambda x: ~F.isnan(x) & (F.abs(x) < 1e6)).alias("finite"))


def _baselines(splits: DataFrame) -> DataFrame:
    """One row: share of the test rows in the commonest training class, MAE and RMSE of the training mean.

    From counts of five classes, so that any engine gets the same doubles.
    """
    counts = materialize(splits.groupBy("split", "rating").count(), "class-counts")
    train = counts.where("split = 'train'").agg(
        (F.sum(F.col("rating") * F.col("count")) / F.sum("count")).alias("mean"),
        F.max(F.struct("count", -F.col("rating"))).alias("top"))
    off = F.col("rating") - F.col("mean")
    return counts.where("split = 'test'").crossJoin(F.broadcast(train)).agg(
        (F.sum(F.when(F.col("rating") == -F.col("top.col2"), F.col("count")).otherwise(0)) / F.sum("count")).alias("accuracy"),
        (F.sum(F.abs(off) * F.col("count")) / F.sum("count")).alias("mae"),
        F.sqrt(F.sum(off * off * F.col("count")) / F.sum("count")).alias("rmse"))


def _figures(spark, d, kind: str) -> DataFrame:
    """A kind's rows of `model_test_metrics`, stored."""
    parts = []
    res = fitted(spark, d, kind)
    scored = res.scored_test
    long = materialize(E.classification_metrics(scored, kind, "actual", "predicted", "prediction"), "metrics")
    base = _baselines(res.splits)
    overall = long.where("class IS NULL").crossJoin(F.broadcast(base))
    ref = F.when(F.col("metric") == "accuracy", F.col("accuracy")).when(F.col("metric") == "mae", F.col("mae")).when(
        F.col("metric") == "rmse", F.col("rmse"))
    better = F.when(F.col("metric") == "accuracy", F.col("value") > ref).when(
        F.col("metric").isin("mae", "rmse"), F.col("value") < LEARNS * ref).otherwise(F.col("value").between(0.2, 1))
    n = F.broadcast(scored.agg(F.count("*").alias("n")))
    parts.append(overall.crossJoin(n).select("model", "metric", "class", "n", F.round(ref, 9).alias("base"),
                                             better.alias("within_bound")))
    cells = E.confusion_matrix(scored, "actual", "predicted")
    support = F.broadcast(cells.groupBy(F.col("actual").alias("class")).agg(F.sum("n").alias("n")))
    per = long.where("class IS NOT NULL").groupBy("model", "class").pivot("metric", ["precision", "recall", "f1"]).agg(
        F.first("value"))
    p, r, f1 = (F.coalesce(F.col(c), F.lit(0.0)) for c in ("precision", "recall", "f1"))
    agree = p.between(0, 1) & r.between(0, 1) & (F.abs(f1 * (p + r) - 2 * p * r) < 1e-9)
    for m in ("precision", "recall", "f1"):
        parts.append(per.join(support, "class").select("model", F.lit(m).alias("metric"), "class", "n",
                                                       F.lit(None).cast("double").alias("base"), agree.alias("within_bound")))
    score = (lambda c: F.element_at("probabilities", c)) if kind in M.CLASSIFIERS else \
        (lambda c: C.distance_score("prediction", F.lit(float(c))))
    auc = E.auc(E.one_vs_rest(scored, "actual", score)).select(F.col("class").cast("int").alias("class"), "auc")
    parts.append(auc.join(support, "class").select(
        F.lit(kind).alias("model"), F.lit("auc").alias("metric"), "class", "n",
        F.lit(None).cast("double").alias("base"), (F.col("auc") > 0.6).alias("within_bound")))
    return materialize(reduce(DataFrame.unionByName, parts), "figures")


@query
def model_test_metrics(spark, d):
    """O-07 + O-84: every model's metrics, overall and per class, against baselines.

    ``n``: the rows behind a figure (for a class, the sum of its confusion
    cells); ``base``: accuracy of the commonest training class, MAE and RMSE
    of the training mean; ``within_bound``: whether the model's figure is
    better than the baseline, AUC over 0.6, and precision, recall and F1 are
    shares that agree with each other.
    """
    _fit_every(spark, d)
    # a kind's figures take many short jobs, which do not need those of the others
    with ThreadPoolExecutor(len(M.KINDS)) as pool:
        parts = [pool.submit(_figures, own_session(spark), d, kind) for kind in M.KINDS]
        return reduce(DataFrame.unionByName, [in_session(p.result(), spark) for p in parts])


@query
def model_roundtrip(spark, d):
    """O-06: a saved model scores the test rows as it did before."""
    res = fitted(spark, d, "ncf_regressor")
    path = shared_path(spark, "model")
    res.model.save(path)
    a = res.scored_test.select("k", F.col("prediction").alias("before"))
    b = M.RatingModel.load(spark, path).transform(res.splits.where("split = 'test'")).select(
        "k", F.col("prediction").alias("after"))
    same = F.sum((F.abs(F.col("before") - F.col("after")) < 1e-12).cast("long"))
    return a.join(b, "k").agg(F.count(F.lit(1)).alias("scored"), same.alias("equal"))


@query
def training_resume(spark, d):
    """O-06: a run that is cut and resumed from its store scores the test rows as an uncut one does."""
    ratings, cfg = _inputs(spark, d, "ncf_regressor", epochs=RESUMED)
    rows = M.prepare(ratings, cfg)
    store = shared_path(spark, "training")

    def uncut(own):
        return M.fit(ratings, cfg, in_session(rows, own))

    def resumed(own):
        M.fit(ratings, cfg, in_session(rows, own), store, stop_after=CUT)
        return M.fit(ratings, cfg, in_session(rows, own), store)

    with ThreadPoolExecutor(2) as pool:  # the two runs do not need each other
        runs = [pool.submit(run, own_session(spark)) for run in (uncut, resumed)]
        whole, again = (r.result() for r in runs)
    a = whole.scored_test.select("k", F.col("prediction").alias("uncut"))
    b = again.scored_test.select("k", F.col("prediction").alias("resumed"))
    epochs = F.broadcast(again.history.agg(F.count("*").alias("epochs")))
    same = F.sum((F.abs(F.col("uncut") - F.col("resumed")) < 1e-9).cast("long"))
    return a.join(b, "k").agg(F.count(F.lit(1)).alias("scored"), same.alias("equal")).crossJoin(epochs)


@query
def vae_training_history(spark, d):
    """O-69, O-73…O-75, O-85 on a real run: annealing from 0, improvement after the first epoch."""
    h = fitted(spark, d, "variational").history
    best = h.agg(F.min(F.struct("val_loss", "epoch", "recon_loss")).alias("b"))
    return h.where("epoch = 1").crossJoin(F.broadcast(best)).select(
        "run", F.col("kl_weight").alias("first_kl_weight"), (F.col("b.epoch") > 1).alias("best_after_first"),
        (F.col("b.recon_loss") < F.col("recon_loss")).alias("reconstructs_better"))


@query
def latent_pca(spark, d):
    """O-72: centred PCA of the whole embeddings table: every vector projected, components in order."""
    e = TD.embeddings(spark, d)
    out, ratios = L.centred_pca(e, "embedding", 2, keep=("vec_id", "label"))
    ordered = ratios[0] >= ratios[1] > 0 and sum(ratios) <= 1 + 1e-9
    return out.select("vec_id", "label", (F.col("pc_1").isNotNull() & F.col("pc_2").isNotNull()).alias("projected"),
                      F.lit(ordered).alias("in_order"))


@query
def latent_pca_moments(spark, d):
    """O-72: all components of the embeddings by the randomised method, held against the covariance.

    The variances add up to its trace and their squares to its squared
    norm; ``off_orthogonal``: the largest product of two components;
    ``off_variance``: the largest difference between a component's variance
    and that of the rows projected onto it.
    """
    e = TD.embeddings(spark, d)
    k = e.select(F.max(F.size("embedding"))).first()[0]
    rows, variance, parts = L.randomised_pca(e, "embedding", k)
    found = rows.agg(*[F.var_samp(f"pc_{i + 1}").alias(f"v{i}") for i in range(k)])
    off = F.greatest(*[F.abs(F.col(f"v{i}") - F.lit(float(v))) for i, v in enumerate(variance)])
    cross = float(abs(parts @ parts.T - np.eye(k)).max())
    return found.select(F.lit(k).cast("long").alias("components"), F.round(F.lit(float(variance.sum())), 6).alias("total_variance"),
                        F.round(F.lit(float((variance ** 2).sum())), 6).alias("squared_variance"),
                        F.round(F.lit(cross), 6).alias("off_orthogonal"), F.round(off, 6).alias("off_variance"))
