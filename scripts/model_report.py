"""Fit every rating model once and report seconds and test quality.

usage: python scripts/model_report.py [sf_dir] > MODELS.json

Ratings are the planted ones; quality stands next to that of the train
mean on the same test split.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from ratekit.models import rating_models as M  # noqa: E402
from ratekit.operators import evaluation as E  # noqa: E402
from ratekit.plans import model_queries as Q  # noqa: E402
from ratekit.session import get_session, materialize, ship_package  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[8]", shuffle_partitions=16,
                        extra={"spark.ui.enabled": "false", "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    report = {"sf": os.path.basename(sf.rstrip("/")), "models": {}}
    for kind in M.KINDS:
        t0 = time.perf_counter()
        res = M.fit(*Q._inputs(spark, sf, kind))
        t1 = time.perf_counter()
        scored = materialize(res.scored_test, "scored")
        t2 = time.perf_counter()
        err = E.regression_errors(scored, "rating", "prediction").first()
        base = E.regression_errors(scored.withColumn("prediction", F.lit(res.train_mean)), "rating", "prediction").first()
        best = res.history.orderBy("val_loss").first()
        report["models"][kind] = {
            "fit_s": round(t1 - t0, 1), "score_s": round(t2 - t1, 1), "n_test": err["n"], "mae": round(err["mae"], 4),
            "rmse": round(err["rmse"], 4), "accuracy": round(E.accuracy(scored, "rating", "predicted").first()[0], 4),
            "baseline_mae": round(base["mae"], 4), "epochs": res.history.count(), "best_epoch": best["epoch"]}
    print(json.dumps(report, indent=1))


if __name__ == "__main__":
    main()
