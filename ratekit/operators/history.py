"""Training-history operators: best epoch, early stop, plateau learning rate.

A history is a table (run, epoch, train_loss, val_loss[, …]) with 1-based
epochs.  Per-run windows are bounded by the number of epochs, a small
configuration constant, so partitioning by run is safe.

``incremental_mean_history`` produces a real history from rating data: an
online global-mean predictor that sees one more chunk of the training rows
per epoch.  Its losses are built from integer sums, so every engine gets
bit-identical values – which makes the loop-control operators below
checkable against SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C


def incremental_mean_history(train: DataFrame, val: DataFrame, run: str, epochs: int,
                             key: str = "k", label: str = "rating", prior: float = 3.0,
                             seed: int = 42) -> DataFrame:
    """(run, epoch, train_loss, val_loss) of an online mean predictor.

    Training rows are dealt to ``epochs`` chunks by a seeded hash.  At epoch
    e the model has seen chunks 1..e; train_loss is the progressive loss of
    the previous estimate on chunk e, val_loss the MSE of the new estimate
    on the validation rows of the run.
    """
    chunk = (F.floor(C.hash_uniform(F.col(key), F.lit(seed)) * epochs) + 1).cast("int")
    y = F.col(label).cast("long")
    per = (train.groupBy(F.col(run).alias("run"), chunk.alias("epoch"))
           .agg(F.count(F.lit(1)).alias("n"), F.sum(y).alias("s1"), F.sum(y * y).alias("s2")))
    grid = per.select("run").distinct().select(
        "run", F.explode(F.sequence(F.lit(1), F.lit(epochs))).alias("epoch"))
    per = _join_runs(grid, per, ["run", "epoch"]).na.fill(0, ["n", "s1", "s2"])
    w = Window.partitionBy("run").orderBy("epoch")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    cum_n, cum_s = F.sum("n").over(upto), F.sum("s1").over(upto)
    prev_n, prev_s = F.sum("n").over(before), F.sum("s1").over(before)
    per = (per.withColumn("m", F.when(cum_n > 0, cum_s / cum_n).otherwise(F.lit(prior)))
           .withColumn("m_prev", F.when(F.coalesce(prev_n, F.lit(0)) > 0, prev_s / prev_n)
                       .otherwise(F.lit(prior))))
    v = (val.groupBy(F.col(run).alias("run"))
         .agg(F.count(F.lit(1)).alias("nv"), F.sum(y).alias("v1"), F.sum(y * y).alias("v2")))
    mse = lambda s2, s1, n, m: (s2 - F.lit(2) * m * s1 + n * m * m) / n
    out = _join_runs(per, v, ["run"])
    # The history has runs × epochs rows; it is written once (reliable
    # checkpoint) so that the loop-control operators reading it several
    # times do not rescan the rating rows.
    return out.select(
        "run", "epoch",
        F.when(F.col("n") > 0, mse(F.col("s2"), F.col("s1"), F.col("n"), F.col("m_prev")))
        .alias("train_loss"),
        F.when(F.col("nv") > 0, mse(F.col("v2"), F.col("v1"), F.col("nv"), F.col("m")))
        .alias("val_loss")).checkpoint(eager=True)


def _join_runs(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join in which a null run meets a null run (rows without a known group are one run)."""
    other = right.withColumnsRenamed({k: f"_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return left.join(other, on, "left").drop(*[f"_{k}" for k in keys])


def early_stopping(history: DataFrame, patience: int, loss: str = "val_loss") -> DataFrame:
    """Per (run, epoch): improved flag, epochs without improvement, stop flag.

    An epoch improves when its loss is strictly below every earlier loss
    (the first epoch always does).  Training stops at the first epoch whose
    count of epochs since the last improvement reaches ``patience``.
    """
    w = Window.partitionBy("run").orderBy("epoch")
    best_before = F.min(loss).over(w.rowsBetween(Window.unboundedPreceding, -1))
    h = history.withColumn("improved", best_before.isNull() | (F.col(loss) < best_before))
    last_imp = F.max(F.when(F.col("improved"), F.col("epoch"))).over(
        w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    h = h.withColumn("since_improvement", F.col("epoch") - last_imp)
    return h.withColumn("stops", F.col("since_improvement") >= patience)


def run_summary(history: DataFrame, patience: int, loss: str = "val_loss") -> DataFrame:
    """(run, stop_epoch, epochs_run, best_epoch, best_loss) per run.

    ``stop_epoch`` is null when the patience never runs out; the best epoch
    is searched among the epochs actually run, the first of equal losses
    winning (strict improvement).
    """
    es = early_stopping(history, patience, loss)
    stops = es.groupBy("run").agg(
        F.min(F.when(F.col("stops"), F.col("epoch"))).alias("stop_epoch"),
        F.max("epoch").alias("_last"))
    ran = _join_runs(es, stops, ["run"]).where(
        F.col("stop_epoch").isNull() | (F.col("epoch") <= F.col("stop_epoch")))
    best = ran.groupBy("run").agg(
        F.min_by("epoch", F.struct(F.col(loss), F.col("epoch"))).alias("best_epoch"),
        F.min(loss).alias("best_loss"))
    return (_join_runs(stops, best, ["run"])
            .select("run", "stop_epoch",
                    F.coalesce("stop_epoch", "_last").alias("epochs_run"),
                    "best_epoch", "best_loss")
            .orderBy("run"))


def plateau_learning_rate(history: DataFrame, lr0: float, factor: float = 0.5,
                          patience: int = 2, threshold: float = 1e-4,
                          stop_patience: int | None = None, loss: str = "val_loss") -> DataFrame:
    """(run, epoch, lr): learning rate in effect during each epoch.

    Reduce-on-plateau in "min" mode with a relative threshold: an epoch is
    better when loss < best·(1 − threshold); after more than ``patience``
    bad epochs the rate is multiplied by ``factor`` and the count restarts.
    The scheduler steps after each epoch; with ``stop_patience`` it does not
    step on the stopping epoch and epochs after it are dropped.

    The fold is a per-run ``aggregate`` over that run's epochs.  A run has one
    row per epoch, whatever the size of the training data, so the array is
    as long as the run's configured number of epochs.
    """
    h = history
    if stop_patience is not None:
        summ = run_summary(history, stop_patience, loss).select("run", "epochs_run")
        h = _join_runs(h, summ, ["run"]).where(F.col("epoch") <= F.col("epochs_run")).drop("epochs_run")
    per_run = h.groupBy("run").agg(
        F.array_sort(F.collect_list(F.struct(F.col("epoch"), F.col(loss).alias("l")))).alias("hs"))
    init = F.struct(F.lit(float("inf")).alias("best"), F.lit(0).alias("bad"),
                    F.lit(float(lr0)).alias("lr"),
                    F.array().cast("array<struct<epoch:int,lr:double>>").alias("out"))

    def step(acc, x):
        better = x["l"] < acc["best"] * F.lit(1.0 - threshold)
        best = F.when(better, x["l"]).otherwise(acc["best"])
        bad = F.when(better, F.lit(0)).otherwise(acc["bad"] + 1)
        reduce = bad > patience
        out = F.concat(acc["out"], F.array(F.struct(x["epoch"].cast("int").alias("epoch"),
                                                    acc["lr"].alias("lr"))))
        return F.struct(best.alias("best"), F.when(reduce, F.lit(0)).otherwise(bad).alias("bad"),
                        F.when(reduce, acc["lr"] * F.lit(factor)).otherwise(acc["lr"]).alias("lr"),
                        out.alias("out"))

    folded = per_run.select("run", F.aggregate("hs", init, step)["out"].alias("o"))
    return (folded.select("run", F.explode("o").alias("e"))
            .select("run", F.col("e.epoch").alias("epoch"), F.col("e.lr").alias("lr"))
            .orderBy("run", "epoch"))
