"""End-to-end jobs as the reference runs them, on the stand-in tables.

    python -m appraise.plans.jobs forest-submission --sf /root/testdata/sf0.01 --out <dir>

``forest-submission`` (the tuned-forest flow): training frame → 3-fold CV over mtry →
hold-out MAE / correlation on a 60 % stratified split → refit on all rows with the best mtry →
score every property for the six submission months → CSV (header, no quotes, no row numbers).
Every step is a Spark job; the driver only sees the CV metrics and the hold-out numbers.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import functions as F

from appraise.operators import evaluate as V
from appraise.operators.score import SUBMISSION_MONTHS, score_months
from appraise.plans.cleaning import clean_properties, model_frame
from appraise.plans.modelling import FINAL_TREES, LABEL, MAX_DEPTH, MTRY, final_forest, forest, forest_cv, holdout
from appraise.session import build_session, scratch_path
from appraise.sources import io


def forest_submission(spark, sf: str, out: str | None = None, mtry_grid=MTRY, num_trees: int = FINAL_TREES, max_depth: int = MAX_DEPTH) -> dict:
    frame = model_frame(spark, sf)
    cvm, _grid, best = forest_cv(frame, mtry_grid, num_trees, max_depth)
    _held, scored = holdout(frame, forest(num_trees, max_depth, best))
    m = V.error_metrics(scored.select(F.col(LABEL).alias("obs"), F.col("prediction").alias("pred"))).first()
    final = final_forest(frame, best, num_trees, max_depth)
    wide = score_months(final, clean_properties(spark, sf, fill=False), "id_parcel", SUBMISSION_MONTHS)
    target = out or scratch_path(spark, "submission")
    io.write_csv(wide.withColumnRenamed("id_parcel", "ParcelId"), target)
    return {"cv_mae": dict(zip(map(int, mtry_grid), map(float, cvm.avgMetrics))), "best_mtry": best,
            "holdout_mae": m["mae"], "holdout_corr": m["corr"], "submission": target}


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("job", choices=["forest-submission"])
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--out", default=None)
    a = ap.parse_args()
    spark = build_session()
    print(json.dumps(forest_submission(spark, a.sf, a.out)))
    spark.stop()


if __name__ == "__main__":
    main()
