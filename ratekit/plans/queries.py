"""Registered queries: each one runs an operator family over the test tables.

Every query takes (spark, sf_dir) and returns a DataFrame; the SQL oracle
of the same name is in ``plans/oracle.py``.  Floating outputs are rounded
to 6 decimals (9 for history losses, 5 for vector maths) on both sides so
that summation order does not decide the comparison.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import columns as C
from ..operators import evaluation as E
from ..operators import features as FE
from ..operators import history as H
from ..operators import profile as PR
from ..operators import splits as S
from ..session import materialize, shared_path
from ..sources import delimited as D
from ..sources import testdata as TD
from . import params as P

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def R(c: Column | str, digits: int = 6) -> Column:
    """Round for comparison; "+ 0.0" turns a negative zero into zero."""
    return F.round(F.col(c) if isinstance(c, str) else c, digits) + F.lit(0.0)


# --- shared building blocks ------------------------------------------------------

def stratified(spark, d, *columns):
    return S.stratified_split(TD.ratings(spark, d), "user_id", "k", P.STRAT_TEST, P.STRAT_VAL,
                              "total", P.SEED, columns=columns or None)


def randomly_split(spark, d, *columns):
    return S.random_split(TD.ratings(spark, d), "k", P.RAND_TEST, P.RAND_VAL, "remainder", P.SEED,
                          columns=columns or None)


def users_processed(spark, d) -> DataFrame:
    """zip dropped, age standard-scaled, gender/occupation one-hot."""
    u = TD.users(spark, d).drop("zip_code")
    u = FE.standard_scale(u, ["age"])
    return FE.one_hot(u, ["gender", "occupation"], {"gender": TD.GENDERS, "occupation": TD.OCCUPATIONS})


def items_processed(spark, d) -> DataFrame:
    """release date → epoch → z-score; all-null column dropped; rows with nulls
    dropped; title and url dropped."""
    it = D.structure_items(TD.items(spark, d))
    it = it.drop("video_release_date")  # all null (see all_null_columns)
    it = FE.standard_scale(it, ["release_date"])
    it = PR.drop_null_rows(it)
    return it.drop("title", "url")


def user_feature_names(up: DataFrame) -> list[str]:
    return [c for c in up.columns if c != "user_id"]


def features(spark, d):
    up = users_processed(spark, d)
    ip = items_processed(spark, d)
    r = TD.ratings(spark, d).select("k", "user_id", "item_id", "rating")
    fm = FE.feature_matrix(r, up, ip)
    cols = user_feature_names(up) + ["release_date"] + TD.GENRES
    return fm, cols


def probs(spark, d):
    return TD.scored_classes(spark, d)


def rounded_predictions(spark, d):
    s = TD.scored(spark, d)
    return s.withColumn("predicted", C.round_clip_rating("prediction"))


def history(spark, d):
    sp = randomly_split(spark, d)
    u = TD.users(spark, d).select("user_id", "occupation")
    x = sp.join(u, "user_id", "left")
    return H.incremental_mean_history(x.where("split = 'train'"), x.where("split = 'val'"),
                                      "occupation", P.HIST_EPOCHS, "k", "rating",
                                      P.HIST_PRIOR, P.SEED)


# --- flagship -------------------------------------------------------------------------

@query
def rating_by_occupation(spark, d):
    """Rating distribution and mean rating per occupation (ratings ⟕ users)."""
    # Pre-aggregate per user (map-side combined) so the join with users moves
    # one row per user instead of one per rating; a user holding a third of
    # all ratings is still a single partial row.
    r = TD.ratings(spark, d)
    per_user = r.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("rating").cast("long").alias("_s"),
        *[F.sum(F.when(F.col("rating") == c, 1).otherwise(0)).cast("long").alias(f"n_{c}")
          for c in range(1, 6)])
    u = TD.users(spark, d).select("user_id", "occupation")
    j = per_user.join(u, "user_id", "left")
    return j.groupBy("occupation").agg(
        F.sum("_n").alias("ratings"),
        R(F.sum("_s") / F.sum("_n")).alias("mean_rating"),
        *[F.sum(f"n_{c}").cast("long").alias(f"n_{c}") for c in range(1, 6)])


# --- sources and sinks -------------------------------------------------------------------

@query
def ratings_tsv_roundtrip(spark, d):
    """Ratings written as headerless TSV, read back with the raw reader."""
    path = shared_path(spark, "ratings_tsv")
    D.write_delimited(TD.ratings(spark, d).select("user_id", "item_id", "rating", "ts"), path, "\t")
    schema = T.StructType([T.StructField("user_id", T.LongType()),
                           T.StructField("item_id", T.LongType()),
                           T.StructField("rating", T.IntegerType()),
                           T.StructField("timestamp", T.LongType())])
    return D.read_raw_ratings(spark, path, schema)


def _items_raw_schema():
    return T.StructType(
        [T.StructField("item_id", T.LongType()), T.StructField("title", T.StringType()),
         T.StructField("release_date", T.StringType()),
         T.StructField("video_release_date", T.StringType()),
         T.StructField("url", T.StringType())]
        + [T.StructField(g, T.IntegerType()) for g in TD.GENRES])


@query
def items_pipe_latin1_roundtrip(spark, d):
    """Items written pipe-separated in latin-1, read back, date text → epoch."""
    path = shared_path(spark, "items_pipe")
    D.write_delimited(TD.items(spark, d), path, "|", encoding="ISO-8859-1")
    return D.structure_items(D.read_raw_items(spark, path, _items_raw_schema()))


_USERS_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType()), T.StructField("age", T.IntegerType()),
    T.StructField("gender", T.StringType()), T.StructField("occupation", T.StringType()),
    T.StructField("zip_code", T.StringType())])


@query
def users_pipe_roundtrip(spark, d):
    path = shared_path(spark, "users_pipe")
    D.write_delimited(TD.users(spark, d), path, "|")
    return D.read_raw_users(spark, path, _USERS_SCHEMA)


@query
def users_csv_header_roundtrip(spark, d):
    path = shared_path(spark, "users_csv")
    D.write_layer(TD.users(spark, d), path, fmt="csv")
    return D.read_csv_with_header(spark, path, _USERS_SCHEMA)


# --- profiling ----------------------------------------------------------------------------

@query
def null_profile(spark, d):
    parts = [PR.null_counts(df).select(F.lit(name).alias("table_name"), "column_name", "null_count")
             for name, df in (("ratings", TD.ratings(spark, d)), ("users", TD.users(spark, d)),
                              ("items", TD.items(spark, d)))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def all_null_columns(spark, d):
    return PR.all_null_columns(TD.items(spark, d))


@query
def items_dropna(spark, d):
    it = PR.drop_all_null_columns(TD.items(spark, d))
    return PR.drop_null_rows(it).drop("title", "url")


@query
def duplicate_rows(spark, d):
    r = PR.duplicate_count(TD.ratings(spark, d), ["user_id", "item_id", "rating"])
    u = PR.duplicate_count(TD.users(spark, d))
    return (r.select(F.lit("ratings").alias("table_name"), "*")
            .unionByName(u.select(F.lit("users").alias("table_name"), "*")))


@query
def rating_distribution(spark, d):
    return PR.value_counts(TD.ratings(spark, d), "rating", by="key")


@query
def occupation_counts(spark, d):
    return PR.value_counts(TD.users(spark, d), "occupation", by="count")


@query
def genre_totals(spark, d):
    return PR.column_totals(TD.items(spark, d), TD.GENRES, key="genre", value="total")


@query
def distinct_counts(spark, d):
    r = PR.distinct_counts(TD.ratings(spark, d), ["user_id", "item_id"])
    return r.unionByName(PR.distinct_counts(TD.users(spark, d), ["zip_code"]))


@query
def zip_unique_pct(spark, d):
    return PR.unique_percentage(TD.users(spark, d), "zip_code").withColumn(
        "unique_pct", R("unique_pct"))


@query
def age_histogram(spark, d):
    h = PR.histogram(TD.users(spark, d), "age", P.HIST_BINS)
    return h.select("bin", R("lo").alias("lo"), R("hi").alias("hi"), "count")


@query
def timestamp_histogram(spark, d):
    """O-43: rating times in the bins that the data ask for."""
    h = PR.automatic_histogram(TD.ratings(spark, d), "ts", P.QUANTILE_ACCURACY)
    return h.select("bin", R("lo", 3).alias("lo"), R("hi", 3).alias("hi"), "count")


@query
def title_onehot(spark, d):
    """O-14 over an open domain: each item's title as a sparse vector, encoded by a stored dictionary."""
    items = TD.items(spark, d).select("item_id", "title")
    coded = FE.sparse_one_hot(items, "title", FE.category_dictionary(items, "title"), "v", hot=P.HOT_VALUE)
    return coded.select("item_id", F.col("v.size").alias("size"), F.element_at("v.indices", 1).alias("place"),
                        F.element_at("v.values", 1).alias("value"))


@query
def split_sizes_stratified(spark, d):
    return PR.split_sizes(stratified(spark, d, "user_id", "item_id"))


@query
def split_sizes_random(spark, d):
    return PR.split_sizes(randomly_split(spark, d))


# --- features --------------------------------------------------------------------------------

@query
def release_date_epoch(spark, d):
    it = TD.items(spark, d)
    return it.select("item_id", F.col("release_date").alias("release_text"),
                     C.date_text_to_epoch("release_date").alias("release_epoch"))


@query
def scaled_timestamps(spark, d):
    r = TD.ratings(spark, d).select("k", "ts")
    return FE.standard_scale(r, ["ts"], suffix="_z").select("k", R("ts_z").alias("ts_z"))


@query
def users_processed_query(spark, d):
    up = users_processed(spark, d)
    return up.withColumn("age", R("age"))


@query
def items_processed_query(spark, d):
    return items_processed(spark, d).withColumn("release_date", R("release_date"))


@query
def encode_users(spark, d):
    return FE.fit_label_encoder(TD.ratings(spark, d), "user_id", "user_idx")


@query
def encode_items(spark, d):
    return FE.fit_label_encoder(TD.ratings(spark, d), "item_id", "item_idx")


@query
def id_cardinality(spark, d):
    r = TD.ratings(spark, d)
    return r.agg(FE.id_cardinality(r, "user_id"), FE.id_cardinality(r, "item_id"))


@query
def feature_matrix(spark, d):
    fm, cols = features(spark, d)
    return fm.select("k", "user_id", "item_id", "rating",
                     *[R(c).alias(c) if c in ("age", "release_date") else F.col(c) for c in cols])


@query
def feature_vectors(spark, d):
    fm, cols = features(spark, d)
    v = fm.select("k", FE.assemble(cols, "features"))
    return v.select("k", F.size("features").alias("n_features"),
                    R(C.vector_sum("features")).alias("feature_sum"))


@query
def noisy_user_features(spark, d):
    # the ages of an id, one as a rule, come with its orders: the ratings are not shuffled for them
    up = users_processed(spark, d).groupBy("user_id").agg(F.collect_list(F.struct("age")).alias("ages"))
    sp = S.random_split(TD.ratings(spark, d, up), "k", P.RAND_TEST, P.RAND_VAL, "remainder", P.SEED,
                        columns=("k", "ages"), follows=("ages",))
    x = sp.select("k", "split", F.explode_outer("ages").alias("of"))
    x = x.select("k", "split", F.col("of.age").cast("double").alias("age")).na.fill(0.0, ["age"])
    noisy = FE.multiplicative_noise(x, ["age"], P.NOISE_SIGMA, "k", P.SEED,
                                    train_mask=F.col("split") == "train")
    return noisy.select("k", "split", R("age").alias("age"))


@query
def display_buckets(spark, d):
    r = TD.ratings(spark, d).select("user_id", "item_id")
    nd = r.agg(F.countDistinct("user_id").alias("_nu"), F.countDistinct("item_id").alias("_ni"))
    x = r.crossJoin(F.broadcast(nd))  # one-row statistics table
    return (x.groupBy(C.display_bucket("user_id", F.col("_nu")).alias("user_bucket"),
                      C.display_bucket("item_id", F.col("_ni")).alias("item_bucket"))
            .agg(F.count(F.lit(1)).alias("n")))


@query
def gmf_lookup(spark, d):
    r = TD.ratings(spark, d).select("k", "user_id", "item_id")
    e = TD.embeddings(spark, d)
    x = FE.lookup_both(r, e, "user_id", "item_id", "vec_id", "embedding")
    both = F.col("u").isNotNull() & F.col("v").isNotNull()
    cat = C.concat_vectors("u", "v")
    return x.select(
        "k", F.col("has_u").alias("has_user"), F.col("has_v").alias("has_item"),
        R(C.dot("u", "v"), 5).alias("gmf_score"),
        F.when(both, F.size(cat)).alias("concat_dim"),
        F.when(both, R(C.l2_norm(cat), 5)).alias("concat_norm"))


@query
def embedding_max_norm(spark, d):
    e = TD.embeddings(spark, d)
    return e.select("vec_id", R(C.l2_norm("embedding")).alias("norm_before"),
                    R(C.l2_norm(C.max_norm_clip("embedding", 1.0))).alias("norm_after"))


# --- splits and weights ----------------------------------------------------------------------

@query
def stratified_split(spark, d):
    return stratified(spark, d).select("k", "user_id", "split")


@query
def random_split(spark, d):
    return randomly_split(spark, d).select("k", "split")


@query
def epoch_batches(spark, d):
    tr = randomly_split(spark, d, "k").where("split = 'train'").select("k")
    return S.epoch_batches(tr, "k", P.BATCH_SIZE, P.BATCH_EPOCH, P.SEED, stored=True).select(
        "k", "batch_id", "position")


@query
def first_n_sample(spark, d):
    r = TD.ratings(spark, d).select("k", "user_id", "item_id", "rating")
    return S.first_n(r, P.SAMPLE_N, "k")


@query
def class_frequency(spark, d):
    return S.class_frequency(TD.ratings(spark, d), "rating")


@query
def balanced_class_weights(spark, d):
    tr = stratified(spark, d, "user_id", "rating").where("split = 'train'")
    return S.balanced_class_weights(tr, "rating").withColumn("weight", R("weight"))


@query
def inverse_frequency_weights(spark, d):
    tr = randomly_split(spark, d).where("split = 'train'")
    return S.inverse_frequency_weights(tr, "rating").withColumn("weight", R("weight"))


# --- scoring functions -------------------------------------------------------------------

@query
def round_clip_predictions(spark, d):
    s = rounded_predictions(spark, d)
    return s.select("k", "actual", "predicted",
                    C.rating_to_class("actual").alias("actual_class"),
                    C.rating_to_class("predicted").alias("predicted_class"))


@query
def argmax_predictions(spark, d):
    p = probs(spark, d)
    return p.select("k", "actual", C.argmax_class("probabilities").alias("predicted_class"))


@query
def softmax_probabilities(spark, d):
    s = TD.scored(spark, d)
    logits = F.array(*[F.lit(-2.0) * F.abs(F.col("prediction") - F.lit(float(c)))
                       for c in range(1, 6)])
    p = s.select("k", C.softmax(logits, 5).alias("p"))
    return p.select("k", *[R(F.element_at("p", i)).alias(f"prob_{i}") for i in range(1, 6)])


@query
def expected_rating(spark, d):
    p = probs(spark, d)
    return p.select("k", "actual", R(C.expected_rating("probabilities", 5)).alias("expected_rating"))


@query
def scaled_sigmoid(spark, d):
    s = TD.scored(spark, d)
    return s.select("k", R(C.scaled_sigmoid(F.col("prediction") - F.lit(3.0), 4.0, 1.0))
                    .alias("bounded_prediction"))


@query
def one_vs_rest_scores(spark, d):
    s = TD.scored(spark, d)
    rows = F.explode(F.array(*[
        F.struct(F.lit(c).alias("class"),
                 C.one_vs_rest_label("actual", F.lit(c)).alias("label"),
                 C.distance_score("prediction", F.lit(c)).alias("score"))
        for c in range(1, 6)]))
    return s.select("k", rows.alias("r")).select("k", "r.class", "r.label", R("r.score").alias("score"))


# --- evaluation --------------------------------------------------------------------------------

@query
def accuracy(spark, d):
    return E.accuracy(rounded_predictions(spark, d), "actual", "predicted").select(
        R("accuracy").alias("accuracy"))


@query
def per_class_prf(spark, d):
    m = E.per_class_prf(rounded_predictions(spark, d), "actual", "predicted")
    return m.select("class", "support", "predicted_n", "tp", R("precision").alias("precision"),
                    R("recall").alias("recall"), R("f1").alias("f1"))


@query
def macro_weighted_prf(spark, d):
    a = E.averaged_prf(E.per_class_prf(rounded_predictions(spark, d), "actual", "predicted"))
    return a.select(*[R(c).alias(c) for c in a.columns])


@query
def confusion_matrix(spark, d):
    return E.confusion_matrix(rounded_predictions(spark, d), "actual", "predicted")


@query
def confusion_matrix_wide(spark, d):
    return E.confusion_matrix_wide(rounded_predictions(spark, d), "actual", "predicted")


@query
def regression_errors(spark, d):
    # both sources from one scan: each row gives a scalar and an expected rating
    s = TD.scored(spark, d).withColumn("probabilities", TD.class_probabilities(F.col("prediction")))
    p = s.select("actual", F.explode(F.array(
        F.struct(F.lit("scalar").alias("source"), F.col("prediction").alias("p")),
        F.struct(F.lit("expected_rating").alias("source"), C.expected_rating("probabilities", 5).alias("p")))))
    out = E.regression_errors(p.select("actual", "col.*"), "actual", "p", by="source")
    return out.select("source", "n", R("mae").alias("mae"), R("mse").alias("mse"),
                      R("rmse").alias("rmse"))


def _ovr_probs(spark, d):
    p = probs(spark, d)
    return E.one_vs_rest(p, "actual", lambda c: F.element_at("probabilities", c))


def _ovr_scalar(spark, d):
    s = TD.scored(spark, d)
    return E.one_vs_rest(s, "actual", lambda c: C.distance_score("prediction", F.lit(float(c))))


def _roc(ovr):
    return E.roc_curve(ovr).select("class", R("threshold").alias("threshold"),
                                   R("fpr").alias("fpr"), R("tpr").alias("tpr"))


@query
def roc_curve_probabilities(spark, d):
    return _roc(_ovr_probs(spark, d))


@query
def roc_curve_scalar(spark, d):
    return _roc(_ovr_scalar(spark, d))


@query
def auc_probabilities(spark, d):
    return E.auc(_ovr_probs(spark, d)).select("class", R("auc").alias("auc"))


@query
def auc_scalar(spark, d):
    return E.auc(_ovr_scalar(spark, d)).select("class", R("auc").alias("auc"))


@query
def weighted_cross_entropy(spark, d):
    p = probs(spark, d).withColumn("class_idx", C.rating_to_class("actual"))
    # one pass → one row per class, stored once (three consumers below)
    per = E.class_nll(p, "probabilities", "class_idx").checkpoint(eager=True)
    w = S.inverse_frequency_from_counts(per, "class_idx", "n")
    wce = E.weighted_cross_entropy_from_sums(per, "class_idx", w)
    return wce.select(R("weighted_ce").alias("weighted_ce"), R("unweighted_ce").alias("unweighted_ce"))


@query
def batch_mean_loss(spark, d):
    tr = randomly_split(spark, d).where("split = 'train'").select("k", "rating", "pred")
    b = S.epoch_batches(tr, "k", P.BATCH_SIZE, P.BATCH_EPOCH, P.SEED)
    se = (F.col("pred") - F.col("rating")) * (F.col("pred") - F.col("rating"))
    b = b.withColumn("se", se)
    bm = E.batch_mean_of_means(b, "se", "batch_id")
    rm = b.agg(F.avg("se").alias("row_mean_loss"))
    return bm.crossJoin(rm).select(R("loss").alias("batch_mean_loss"), "batches",
                                   R("row_mean_loss").alias("row_mean_loss"))


def _mu_logvar(e: DataFrame) -> DataFrame:
    """Read each 64-d vector as a 32-d mean and a 32-d log-variance."""
    return e.select("label", F.slice("embedding", 1, 32).alias("mu"),
                    F.slice("embedding", 33, 32).alias("logvar"), "embedding")


@query
def kl_divergence(spark, d):
    e = _mu_logvar(TD.embeddings(spark, d))
    return (e.groupBy("label").agg(F.count(F.lit(1)).alias("n"),
                                   F.avg(E.kl_to_standard_normal("mu", "logvar")).alias("kl"))
            .select("label", "n", R("kl").alias("kl")))


@query
def latent_norm(spark, d):
    e = TD.embeddings(spark, d)
    m = e.groupBy("label").agg(F.avg(C.l2_norm("embedding")).alias("m"))
    return m.select("label", R("m").alias("mean_l2_norm"),
                    R(F.lit(P.LATENT_NORM_WEIGHT) * F.col("m")).alias("penalty"))


@query
def training_history(spark, d):
    h = history(spark, d)
    return h.select("run", "epoch", R("train_loss", 9).alias("train_loss"),
                    R("val_loss", 9).alias("val_loss"))


@query
def composite_loss(spark, d):
    h = history(spark, d)
    e = _mu_logvar(TD.embeddings(spark, d))
    kl = e.agg(F.avg(E.kl_to_standard_normal("mu", "logvar")).alias("kl"))
    x = h.crossJoin(F.broadcast(kl))  # one-row table
    w = E.kl_weight(F.col("epoch"), P.HIST_EPOCHS)
    return x.select("run", "epoch", R("val_loss").alias("recon_loss"), R("kl").alias("kl"),
                    R(w).alias("kl_weight"),
                    R(E.composite_loss(F.col("val_loss"), F.col("kl"), F.col("epoch"),
                                       P.HIST_EPOCHS)).alias("total_loss"))


@query
def prediction_pairs(spark, d):
    return TD.scored(spark, d).select("k", "actual", "prediction")


def baseline_metrics(spark, d) -> DataFrame:
    """(model, metric, value): baseline predictors fitted on the training split
    and scored on the test split, all four in one pass over the test rows."""
    # four consumers below: the split has stored the rows once, narrow
    sp = randomly_split(spark, d, "user_id", "item_id", "rating", "pred")
    tr = sp.where("split = 'train'")
    te = sp.where("split = 'test'")
    gm = tr.agg(F.avg(F.col("rating").cast("double")).alias("g"))  # one row
    um = tr.groupBy("user_id").agg(F.avg(F.col("rating").cast("double")).alias("u"))
    im = tr.groupBy("item_id").agg(F.avg(F.col("rating").cast("double")).alias("i"))
    # user/item mean tables grow with the ids: AQE picks the join strategy
    x = (te.join(um, "user_id", "left").join(im, "item_id", "left")
         .crossJoin(F.broadcast(gm)))
    models = {"stand_in": F.col("pred"), "global_mean": F.col("g"),
              "user_mean": F.coalesce("u", "g"), "item_mean": F.coalesce("i", "g")}
    y = F.col("rating")
    aggs = []
    for name, p in models.items():
        err = p - y
        aggs += [F.avg((y == C.round_clip_rating(p)).cast("double")).alias(f"{name}|accuracy"),
                 F.avg(F.abs(err)).alias(f"{name}|mae"),
                 F.sqrt(F.avg(err * err)).alias(f"{name}|rmse")]
    wide = x.agg(*aggs)
    pairs = ", ".join(f"'{c.split('|')[0]}', '{c.split('|')[1]}', `{c}`" for c in wide.columns)
    return wide.selectExpr(f"stack({len(wide.columns)}, {pairs}) AS (model, metric, value)")


@query
def model_metrics(spark, d):
    return baseline_metrics(spark, d).withColumn("value", R("value"))


@query
def model_ranking(spark, d):
    m = E.rank_models(baseline_metrics(spark, d))
    return m.select("model", "metric", R("value").alias("value"), "rank")


@query
def relative_change(spark, d):
    m = E.relative_change(baseline_metrics(spark, d), "global_mean")
    return m.select("model", "metric", R("value").alias("value"),
                    R("improvement_pct").alias("improvement_pct"))


@query
def early_stop_summary(spark, d):
    s = H.run_summary(history(spark, d), P.PATIENCE)
    return s.select("run", "stop_epoch", "epochs_run", "best_epoch",
                    R("best_loss", 9).alias("best_loss"))


@query
def plateau_lr(spark, d):
    return H.plateau_learning_rate(history(spark, d), P.LR0, P.PLATEAU_FACTOR,
                                   P.PLATEAU_PATIENCE, P.PLATEAU_THRESHOLD,
                                   stop_patience=P.PATIENCE)


# registered names that differ from the Python function names
REGISTRY["users_processed"] = REGISTRY.pop("users_processed_query")
REGISTRY["items_processed"] = REGISTRY.pop("items_processed_query")
