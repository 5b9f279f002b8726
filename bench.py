"""Headline queries at one scale; prints one JSON line.

``BENCH_SF_DIR`` names the input folder, ``BENCH_CPUS`` the local cores. The
load step and the model fit are timed on their own; every query is timed to
the last output row. ``BENCH_CV=1`` adds the five-fold cross-validation.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from adjudica.operators import marts, metrics, model, quality  # noqa: E402
from adjudica.operators.analytics import ANALYTICS  # noqa: E402
from adjudica.plans import staging  # noqa: E402
from adjudica.plans.catalogue import all_queries  # noqa: E402
from adjudica.session import local_session  # noqa: E402
from adjudica.sources.testdata import raw_tables  # noqa: E402


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cores, shuffle_partitions=cores)
    times: dict[str, float] = {}

    def timed(name: str, run) -> None:
        start = time.perf_counter()
        run()
        times[name] = round(time.perf_counter() - start, 3)

    catalogue = all_queries()
    # A cold JVM and its first jobs, timed apart so that the load shows its own work.
    timed("warm_up", lambda: drain(raw_tables(spark, sf_dir)["labels"].groupBy("PotentialFraud").count()))
    timed("load_star", lambda: staging.staged_path(spark, sf_dir))
    star = staging.staged_star(spark, sf_dir)
    for name, build in ANALYTICS.items():
        timed(name, lambda build=build: drain(build(star)))
    timed("q08_orphan_claims", lambda: drain(catalogue["q08_orphan_claims"](spark, sf_dir)))
    timed("raw_audit", lambda: drain(catalogue["v01_raw_audit"](spark, sf_dir)))
    timed("constraints", lambda: drain(quality.constraint_audit(star)))
    timed("primary_keys", lambda: drain(quality.primary_key_audit(star)))
    timed("foreign_keys", lambda: drain(catalogue["c03_foreign_keys"](spark, sf_dir)))
    timed("features", lambda: staging.staged_features(spark, sf_dir))
    timed("model_fit", lambda: staging.staged_model(spark, sf_dir))
    if os.environ.get("BENCH_CV"):
        timed("cross_validation", lambda: drain(catalogue["m07_cross_validation"](spark, sf_dir)))
    timed("scores", lambda: staging.staged_scores(spark, sf_dir))
    timed("attributions", lambda: staging.staged_attributions(spark, sf_dir))
    scored = model.as_scored(staging.staged_scores(spark, sf_dir))
    timed("evaluation", lambda: drain(metrics.evaluation_report(scored, 0.5)))
    tables = marts.all_marts(
        star, staging.staged_features(spark, sf_dir), staging.staged_scores(spark, sf_dir)
    )
    for name, df in tables.items():
        timed(f"mart_{name}", lambda df=df: drain(df))
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )


if __name__ == "__main__":
    main()
