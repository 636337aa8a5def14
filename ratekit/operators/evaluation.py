"""Evaluation as DataFrame aggregations.

Conventions (those of the common Python metric library the reference
uses): an undefined precision, recall or F1 counts as 0; macro averages run
over the classes present in either the actual or the predicted column;
weighted averages use the true support.

Classification metrics scan the large input once with map-side combining
into tables of at most k (per class) or k² (confusion) rows; everything
after that is tiny.  Cross-entropy is pre-aggregated per class before class
weights are applied.
ROC curves and AUC pre-aggregate to one row per (class, distinct score) and
take running sums with the range-partitioned helper, so no task has to hold
a whole class.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from .ordering import running_totals

CLASSES = (1, 2, 3, 4, 5)


def _safe_div(num: Column, den: Column) -> Column:
    return F.when(den == 0, F.lit(0.0)).otherwise(num / den)


# --- O-54 accuracy, O-59/O-60 errors -----------------------------------------------

def accuracy(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    return df.agg(F.avg((F.col(actual) == F.col(predicted)).cast("double")).alias("accuracy"))


def regression_errors(df: DataFrame, actual: str = "actual",
                      prediction: str = "prediction", by: str | None = None) -> DataFrame:
    """(n, mae, mse, rmse) in one pass, of all rows or for each value of ``by``."""
    err = F.col(prediction).cast("double") - F.col(actual).cast("double")
    return df.groupBy(*[by] if by else []).agg(F.count(F.lit(1)).alias("n"), F.avg(F.abs(err)).alias("mae"),
                  F.avg(err * err).alias("mse")).withColumn("rmse", F.sqrt("mse"))


# --- O-58 confusion matrix -------------------------------------------------------

def pair_counts(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """(actual, predicted, n) for the pairs that occur (≤ k² rows)."""
    return (df.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted"))
            .agg(F.count(F.lit(1)).alias("n")))


def confusion_matrix(df: DataFrame, actual: str = "actual", predicted: str = "predicted",
                     labels: Sequence[int] | None = CLASSES) -> DataFrame:
    """Long form (actual, predicted, n) over labels × labels, zero-filled.

    ``labels=None`` uses the labels observed in either column.
    """
    counts = pair_counts(df, actual, predicted)
    spark = df.sparkSession
    if labels is None:
        lab = (counts.select(F.col("actual").alias("label"))
               .union(counts.select(F.col("predicted").alias("label"))).distinct())
    else:
        lab = spark.createDataFrame([(int(v),) for v in labels], ["label"])
    lab = lab.select(F.col("label").cast("int").alias("label"))
    grid = (lab.select(F.col("label").alias("actual"))
            .crossJoin(lab.select(F.col("label").alias("predicted"))))
    # grid has k² rows, counts ≤ k² rows: both sides tiny by construction
    return (grid.join(counts, ["actual", "predicted"], "left")
            .select("actual", "predicted", F.coalesce("n", F.lit(0)).cast("long").alias("n"))
            .orderBy("actual", "predicted"))


def confusion_matrix_wide(df: DataFrame, actual: str = "actual", predicted: str = "predicted",
                          labels: Sequence[int] = CLASSES) -> DataFrame:
    """Rows actual, one column per predicted label (pivot with a fixed value
    list, so Spark needs no extra pass to find the labels)."""
    long = confusion_matrix(df, actual, predicted, labels)
    return (long.groupBy("actual").pivot("predicted", list(labels)).agg(F.sum("n"))
            .select("actual", *[F.col(str(v)).cast("long").alias(f"pred_{v}") for v in labels])
            .orderBy("actual"))


# --- O-55 … O-57 precision / recall / F1 ----------------------------------------------

def per_class_prf(df: DataFrame, actual: str = "actual", predicted: str = "predicted",
                  labels: Sequence[int] | None = None) -> DataFrame:
    """(class, support, predicted_n, tp, precision, recall, f1) per class.

    One pass: every row contributes (actual class: support, tp) and
    (predicted class: predicted_n); a single grouped sum (map-side combined,
    k output rows) gives all counts.  Classes are those present in either
    column, or ``labels``.
    """
    hit = (F.col(actual) == F.col(predicted)).cast("long")
    rows = df.select(F.explode(F.array(
        F.struct(F.col(actual).cast("int").alias("class"), F.lit(1).cast("long").alias("a"),
                 F.lit(0).cast("long").alias("p"), hit.alias("tp")),
        F.struct(F.col(predicted).cast("int").alias("class"), F.lit(0).cast("long").alias("a"),
                 F.lit(1).cast("long").alias("p"), F.lit(0).cast("long").alias("tp")),
    )).alias("_r")).select("_r.*")
    t = rows.groupBy("class").agg(F.sum("a").alias("support"), F.sum("p").alias("predicted_n"),
                                  F.sum("tp").alias("tp"))
    if labels is not None:
        dom = df.sparkSession.createDataFrame([(int(v),) for v in labels], "class int")
        t = dom.join(F.broadcast(t.where(F.col("class").isin(list(labels)))), "class", "left").na.fill(0)
    t = t.select("class", *[F.col(c).cast("long").alias(c) for c in ("support", "predicted_n", "tp")])
    return (t.withColumn("precision", _safe_div(F.col("tp").cast("double"), F.col("predicted_n")))
            .withColumn("recall", _safe_div(F.col("tp").cast("double"), F.col("support")))
            .withColumn("f1", _safe_div(2.0 * F.col("tp"),
                                        F.col("support") + F.col("predicted_n")))
            .orderBy("class"))


def averaged_prf(per_class: DataFrame) -> DataFrame:
    """(macro_precision, macro_recall, macro_f1, weighted_f1) from per_class_prf."""
    return per_class.agg(
        F.avg("precision").alias("macro_precision"),
        F.avg("recall").alias("macro_recall"),
        F.avg("f1").alias("macro_f1"),
        _safe_div(F.sum(F.col("f1") * F.col("support")), F.sum("support")).alias("weighted_f1"),
    )


# --- O-61 … O-63 ROC and AUC ---------------------------------------------------------

def one_vs_rest(df: DataFrame, actual: str, score_for_class, classes=CLASSES) -> DataFrame:
    """Explode rows into (class, label, score) for each class.

    ``score_for_class(c)`` returns the score column for class c.  The
    explosion is a projection (no shuffle): each input row yields k rows.
    """
    structs = [F.struct(F.lit(int(c)).alias("class"),
                        C.one_vs_rest_label(F.col(actual), F.lit(int(c))).alias("label"),
                        score_for_class(c).cast("double").alias("score"))
               for c in classes]
    return df.select(F.explode(F.array(*structs)).alias("_r")).select("_r.*")


def _score_counts(ovr: DataFrame) -> DataFrame:
    """One row per (class, distinct score): positives and negatives there."""
    return ovr.groupBy("class", "score").agg(
        F.sum("label").cast("long").alias("pos"),
        F.sum(1 - F.col("label")).cast("long").alias("neg"))


def _with_running(ovr: DataFrame) -> DataFrame:
    """Per (class, score) rows with in-class running counts in descending score order."""
    run = running_totals(_score_counts(ovr), [F.asc("class"), F.desc("score")], ["pos", "neg"])
    # class totals from the checkpointed counts (one row per class)
    tot = run.groupBy("class").agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    before = Window.orderBy("class").rowsBetween(Window.unboundedPreceding, -1)
    tot = tot.select("class", "P", "N",
                     F.coalesce(F.sum("P").over(before), F.lit(0)).alias("_bp"),
                     F.coalesce(F.sum("N").over(before), F.lit(0)).alias("_bn"))
    # tot: one row per class → bounded broadcast
    return (run.join(F.broadcast(tot), "class")
            .withColumn("tp", F.col("cum_pos") - F.col("_bp"))
            .withColumn("fp", F.col("cum_neg") - F.col("_bn"))
            .drop("cum_pos", "cum_neg", "_bp", "_bn"))


def roc_curve(ovr: DataFrame) -> DataFrame:
    """(class, threshold, fpr, tpr): one point per distinct score (descending),
    plus the (0, 0) start point with a null threshold."""
    run = _with_running(ovr)
    # classes come from the checkpointed score counts, not a rescan of ovr
    classes = run.select("class").distinct()
    pts = run.select("class", F.col("score").alias("threshold"),
                     _safe_div(F.col("fp").cast("double"), F.col("N")).alias("fpr"),
                     _safe_div(F.col("tp").cast("double"), F.col("P")).alias("tpr"))
    start = (classes
             .select("class", F.lit(None).cast("double").alias("threshold"),
                     F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")))
    return start.unionByName(pts)


def auc(ovr: DataFrame) -> DataFrame:
    """(class, auc): area under the ROC curve, equal to the tie-averaged
    rank statistic Σ pos(s)·(neg below s + ½ neg at s) / (P·N)."""
    run = _with_running(ovr)
    below = F.col("N") - F.col("fp")  # negatives with a lower score
    term = F.col("pos") * (below + 0.5 * F.col("neg"))
    return (run.groupBy("class")
            .agg(_safe_div(F.sum(term), F.first("P") * F.first("N")).alias("auc"))
            .orderBy("class"))


# --- O-64 … O-69 losses ---------------------------------------------------------------

def class_nll(df: DataFrame, probs: str, label_idx: str, least_probability: float = 1e-15) -> DataFrame:
    """(label_idx, n, nll_sum): per-class count and summed −log p_y (one pass,
    k output rows).  Both cross-entropy forms below combine these sums.

    A probability counts as ``least_probability`` at least: Spark's log(0) is
    null, which would silently drop the row from the sum."""
    p = F.greatest(F.element_at(F.col(probs), F.col(label_idx) + 1), F.lit(least_probability))
    nll = -F.log(p)
    return df.groupBy(label_idx).agg(F.count(F.lit(1)).alias("n"), F.sum(nll).alias("nll_sum"))


def weighted_cross_entropy_from_sums(per_class: DataFrame, label_idx: str,
                                     weights: DataFrame) -> DataFrame:
    """(weighted_ce, unweighted_ce) from ``class_nll`` sums and a
    (label_idx, weight) table – both tables have one row per class."""
    j = per_class.join(weights.select(label_idx, F.col("weight").alias("_w")), label_idx, "left")
    return j.agg(
        (F.sum(F.col("_w") * F.col("nll_sum")) / F.sum(F.col("_w") * F.col("n"))).alias("weighted_ce"),
        (F.sum("nll_sum") / F.sum("n")).alias("unweighted_ce"))


def weighted_cross_entropy(df: DataFrame, probs: str, label_idx: str,
                           weights: DataFrame | None = None, weight_key: str = "class_idx",
                           weight_col: str = "weight") -> DataFrame:
    """Σ w_y · (−log p_y) / Σ w_y (unweighted when ``weights`` is None).

    ``label_idx`` is the zero-based class; ``weights`` is a small per-class
    table.  Rows are pre-aggregated per class first, so the weights meet a
    k-row table: Σ_c w_c·S_c / Σ_c w_c·n_c.
    """
    per = class_nll(df, probs, label_idx)
    if weights is None:
        return per.agg((F.sum("nll_sum") / F.sum("n")).alias("cross_entropy"))
    w = weights.select(F.col(weight_key).alias(label_idx), F.col(weight_col).alias("_w"))
    j = per.join(w, label_idx, "left")
    return j.agg((F.sum(F.col("_w") * F.col("nll_sum")) / F.sum(F.col("_w") * F.col("n")))
                 .alias("cross_entropy"))


def batch_mean_of_means(df: DataFrame, loss: Column | str, batch: str = "batch_id") -> DataFrame:
    """Σ_batches mean(loss in batch) / #batches (a short last batch weighs
    as much as a full one)."""
    loss_c = F.col(loss) if isinstance(loss, str) else loss
    per = df.groupBy(batch).agg(F.avg(loss_c).alias("_m"))
    return per.agg(F.avg("_m").alias("loss"), F.count(F.lit(1)).alias("batches"))


def kl_to_standard_normal(mu: str | Column, logvar: str | Column) -> Column:
    """Per row −½ Σ (1 + lv − μ² − e^lv)."""
    pairs = F.zip_with(F.col(mu) if isinstance(mu, str) else mu,
                       F.col(logvar) if isinstance(logvar, str) else logvar,
                       lambda m, lv: F.lit(1.0) + lv - m * m - F.exp(lv))
    return F.lit(-0.5) * F.aggregate(pairs, F.lit(0.0), lambda acc, x: acc + x)


def kl_weight(epoch: Column, epochs: int, cap: float = 0.1) -> Column:
    """Annealed KL weight min(cap, (epoch − 1) · cap / (epochs // 2)) of 1-based
    epochs: nothing in the first epoch, the cap from the middle on."""
    half = max(1, epochs // 2)
    return F.least(F.lit(cap), (epoch.cast("double") - 1) * F.lit(cap) / F.lit(float(half)))


def composite_loss(recon: Column, kl: Column, epoch: Column, epochs: int,
                   cap: float = 0.1) -> Column:
    return recon + kl_weight(epoch, epochs, cap) * kl


# --- O-53, O-71 model comparison ---------------------------------------------------

LOWER_IS_BETTER = ("mae", "rmse", "mse", "loss", "cross_entropy")


def _direction(metric: Column) -> Column:
    return F.when(metric.isin(*LOWER_IS_BETTER), F.lit(1.0)).otherwise(F.lit(-1.0))


def rank_models(metrics: DataFrame) -> DataFrame:
    """Add ``rank`` per metric (1 = best; lower is better for error metrics).

    Partitioned by metric: one small group per metric name.
    """
    w = Window.partitionBy("metric").orderBy(_direction(F.col("metric")) * F.col("value"))
    return metrics.withColumn("rank", F.rank().over(w))


def relative_change(metrics: DataFrame, baseline_model: str) -> DataFrame:
    """Improvement in % over the baseline model, per metric (positive = better).

    The baseline's value comes from a window over each metric (one row per
    model), so ``metrics`` is computed once; a metric that the baseline
    lacks keeps its rows, with a null improvement.
    """
    base = F.max(F.when(F.col("model") == baseline_model, F.col("value"))).over(Window.partitionBy("metric"))
    d = _direction(F.col("metric"))
    return (metrics.withColumn("_b", base)
            .withColumn("improvement_pct", F.when(F.col("_b").isNotNull(), _safe_div(
                d * (F.col("_b") - F.col("value")) * 100.0, F.abs(F.col("_b")))))
            .drop("_b"))


# --- O-07 metrics table ------------------------------------------------------------

def classification_metrics(scored: DataFrame, model: str, actual: str = "actual",
                           predicted: str = "predicted",
                           prediction: str | None = "prediction") -> DataFrame:
    """Long-form (model, metric, class, value) table for one scored set."""
    pcl = per_class_prf(scored, actual, predicted).persist()
    avg = averaged_prf(pcl)
    acc = accuracy(scored, actual, predicted)
    parts = [acc.select(F.lit("accuracy").alias("metric"), F.col("accuracy").alias("value"))]
    for m in ("macro_precision", "macro_recall", "macro_f1", "weighted_f1"):
        parts.append(avg.select(F.lit(m).alias("metric"), F.col(m).alias("value")))
    if prediction is not None:
        err = regression_errors(scored, actual, prediction)
        for m in ("mae", "rmse"):
            parts.append(err.select(F.lit(m).alias("metric"), F.col(m).alias("value")))
    overall = parts[0]
    for p in parts[1:]:
        overall = overall.unionByName(p)
    overall = overall.select(F.lit(model).alias("model"), "metric",
                             F.lit(None).cast("int").alias("class"), "value")
    per = pcl.select(F.lit(model).alias("model"),
                     F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value"))
                                         for m in ("precision", "recall", "f1")])).alias("_m"),
                     F.col("class")).select("model", "_m.metric", "class", "_m.value")
    return overall.unionByName(per)
